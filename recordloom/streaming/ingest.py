"""Incremental ingest with Structured Streaming: files in, merged snapshots out, resumable by checkpoint."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recordloom.operators.merge import upsert
from recordloom.sources.files import Snapshots


def read_new_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def merge_stream(incoming: DataFrame, target: Snapshots, key: str, columns: list[str], source: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """Merge every micro-batch into the newest snapshot; a restart on the same checkpoint reads nothing twice, and a batch that
    is delivered again after its commit (its number is kept with the version) is not merged again.

    Rows of one batch with the same key are reduced to the newest by `arrived` first. Returns the started query,
    which ends when what is there has been read.
    """

    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def apply(batch: DataFrame, batch_id: int) -> None:
        if target.has(f"{stream}-{batch_id}"):
            return
        rows = prepare(batch) if prepare else batch
        rest = [c for c in rows.columns if c != key]
        newest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("arrived", *[F.col(c).cast("string") for c in rest])).alias("r")).select(key, "r.*")
        stored = target.read()
        if stored is None:
            stored = newest.select(key, *columns).limit(0)
        target.commit(upsert(stored, newest, key, columns, source), tag=f"{stream}-{batch_id}")

    return incoming.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by event-time window and kind, with a watermark for late rows."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def failure_breaker(statuses: DataFrame, key: str, order: str, failed: str, least: int = 3, span: int = 10_000) -> DataFrame:
    """`(key, longest)` of the keys whose longest run of failures, in order of a whole number, reaches `least`.

    Runs are counted within spans of `span` numbers and joined over their ends, so a key with a third of all rows is never
    sorted by one task: what is brought together for a key is one row a span."""
    from pyspark.sql import Window

    t = statuses.select(F.col(key).alias("k"), F.col(order).alias("o"), F.coalesce(F.col(failed), F.lit(False)).alias("f"), F.floor(F.col(order) / span).alias("s"))
    w = Window.partitionBy("k", "s").orderBy("o")
    runs = t.withColumn("g", F.sum((~F.col("f")).cast("int")).over(w)).groupBy("k", "s", "g").agg(F.count_if("f").alias("n"), F.count_if(~F.col("f")).alias("ok"))
    # Run 0 begins with the span, the run of the last group ends with it; a span without a success is one run.
    spans = runs.groupBy("k", "s").agg(F.max("n").alias("best"), F.max(F.when(F.col("g") == 0, F.col("n"))).alias("head"), F.max_by("n", "g").alias("tail"), (F.max("g") == 0).alias("whole"))
    listed = spans.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("s", "best", F.coalesce("head", F.lit(0)).alias("head"), "tail", "whole"))).alias("l"))
    zero = F.struct(F.lit(0).cast("long").alias("best"), F.lit(0).cast("long").alias("open"))

    def step(a: Column, x: Column) -> Column:
        through = a["open"] + x["head"]
        return F.struct(F.greatest(a["best"], x["best"], through).alias("best"), F.when(x["whole"], through).otherwise(x["tail"]).alias("open"))

    found = listed.select(F.col("k").alias(key), F.aggregate("l", zero, step)["best"].alias("longest"))
    return found.filter(F.col("longest") >= least)


def backoff_seconds(attempt: Column, base: int = 120, cap: int = 1800) -> Column:
    """Waiting time before an attempt, doubling up to a cap."""
    return F.least(F.lit(base) * F.pow(F.lit(2), attempt - 1), F.lit(cap)).cast("int")
