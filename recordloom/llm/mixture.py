"""Records of several sources mixed to target shares of the total size, by pivotal dependent rounding.

Every document of a source gets the same real number of copies, so that the source's expected tokens are its
target. The whole part is taken; the fractional parts are rounded by pairing documents and moving mass from one
to the other at random until one of them is whole. Mass is counted in tokens, so each move keeps the source's
total exactly, and it is fair, so each document's expected copies stay what they were. One document a partition
stays fractional; these residuals are combined by the same step in a reduction tree whose levels are written,
until one document a source is left, which is rounded up or down at random.

Randomness comes from hashes of the document id and a seed, and pairs are formed in hash order, so a task that
is run again gives the same copies.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from recordloom.session import discard, materialize

#: Residual documents one task of a level takes in.
FAN_IN = 4096
TOKENIZERS = "/opt/tokenizers"


@cache
def _encoder(folder: str, name: str):
    import importlib.util

    import tiktoken

    spec = importlib.util.spec_from_file_location("tokenizer_files", Path(folder) / "__init__.py")
    files = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(files)
    with open(Path(folder) / f"{name}.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(text, folder: str = TOKENIZERS, name: str = "byte_bpe_50k"):
    """Tokens of a text column under a public tokenizer whose files lie in `folder` on every executor; null has 0."""

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoder(folder, name).encode_ordinary
        return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)


def _chance(seed: int, a, b) -> float:
    return xxhash.xxh3_64_intdigest(f"{seed}\x1f{a}\x1f{b}") / 2.0**64


def pair_off(keys: list, sizes: list[int], parts: list[float], seed: int) -> tuple[list[int], int, float]:
    """Pivotal rounding of fractional copies of documents of the given sizes, in the order given.

    Returns 0 or 1 for each document, the index of the one left fractional (-1 for none) and its fraction.
    """
    out = [0] * len(keys)
    at, left = -1, 0.0
    for i, p in enumerate(parts):
        if p <= 1e-12 or p >= 1 - 1e-12:
            out[i] = int(p > 0.5)
            continue
        if at < 0:
            at, left = i, p
            continue
        s, t = sizes[at], sizes[i]
        up, down = min(s * (1 - left), t * p), min(s * left, t * (1 - p))
        move = up if _chance(seed, keys[at], keys[i]) * (up + down) < down else -down
        left, p = left + move / s, p - move / t
        pending = []
        for j, q in ((at, left), (i, p)):
            if q <= 1e-9 or q >= 1 - 1e-9:
                out[j] = int(q > 0.5)
            else:
                pending.append((j, q))
        at, left = pending[0] if pending else (-1, 0.0)
    return out, at, left


def _round(schema: T.StructType, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}  # by source: the one fractional document so far
        for batch in batches:
            for source, rows in batch.groupby("source", sort=False, dropna=False):
                kept = held.pop(source, None)
                if kept is not None:
                    rows = pd.concat([kept, rows])
                rows = rows.reset_index(drop=True)
                whole, at, left = pair_off(rows["key"].tolist(), rows["size"].tolist(), rows["part"].tolist(), seed)
                rows["copies"] += np.asarray(whole, np.int64)
                rows["part"] = 0.0
                if at >= 0:
                    rows.loc[at, "part"] = left
                    held[source] = rows.iloc[[at]]
                    rows = rows.drop(index=at)
                yield rows
        yield from held.values()

    return lambda df: df.mapInPandas(run, schema)


def mixing_plan(totals: list[tuple[str, int]], targets: list[tuple[str, float, int]], total: float | None = None) -> dict[str, tuple[float, float]]:
    """For each source with a target and tokens: (its share among those, copies of each of its documents).

    The shares of sources without documents fall to the others in proportion. Without a wanted `total` the mix
    is as large as the caps on copies allow; a larger wanted total is lowered to that.
    """
    size = {s: n for s, n in totals if n}
    usable = [(s, t, m) for s, t, m in targets if size.get(s) and t and t > 0 and m and m > 0]
    whole = sum(t for _, t, _ in usable)
    if not usable:
        return {}
    most = min(size[s] * m * whole / t for s, t, m in usable)
    wanted = most if total is None else min(total, most)
    return {s: (t / whole, min(float(m), wanted * t / whole / size[s])) for s, t, m in usable}


def mix_sources(docs: DataFrame, id_col: str, source: str, size: str, targets: DataFrame, total: float | None = None, seed: int = 17) -> DataFrame:
    """`(id, source, size, copies)` for each document of a source with a target; `copies` may be 0.

    `targets` holds `source, target_share, max_repeats` (one row a source; a broadcast of that bound). Rows with a
    null or zero size get no copies, sources without a target none at all. Repeated rows are documents of their
    own. Each source's tokens end within one document of its target.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").alias("key"), F.col(f"`{source}`").alias("source"), F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)).alias("size"))
    wanted = [(r[0], r[1], r[2]) for r in targets.select("source", "target_share", "max_repeats").collect()]
    totals = [(r[0], r[1]) for r in slim.join(F.broadcast(targets.select("source").distinct()), "source", "left_semi").groupBy("source").agg(F.sum("size")).collect()]
    plan = mixing_plan(totals, wanted, total)
    rates = spark.createDataFrame([(s, r) for s, (_, r) in plan.items()], "source string, rate double")
    rated = slim.join(F.broadcast(rates), "source")
    start = rated.select(
        "key", "source", "size",
        F.when(F.col("size") > 0, F.floor("rate")).otherwise(F.lit(0)).cast("long").alias("copies"),
        F.when(F.col("size") > 0, F.col("rate") - F.floor("rate")).otherwise(F.lit(0.0)).alias("part"),
    )
    step = _round(start.schema, seed)
    spread = start.repartition(F.col("key")).sortWithinPartitions(F.xxhash64("key", F.lit(seed)), "key", "size")
    open_part = F.col("part") > 0
    level, seen = materialize(step(spread), left=F.sum(open_part.cast("long")))
    done, left = [level.filter(~open_part)], seen["left"] or 0
    residue = level.filter(open_part)
    while left > len(plan):
        tasks = max(1, -(-left // FAN_IN))
        fewer = residue.repartition(tasks, F.xxhash64("key")).sortWithinPartitions("source", F.xxhash64("key", F.lit(seed)), "key", "size")
        level, seen = materialize(step(fewer), left=F.sum(open_part.cast("long")))
        done.append(level.filter(~open_part))
        residue, left = level.filter(open_part), seen["left"] or 0
    chance = (F.xxhash64("key", F.lit(seed + 1)).cast("double") / F.lit(2.0**64)) + 0.5
    last = residue.withColumn("copies", F.col("copies") + (chance < F.col("part")).cast("long"))
    out = last
    for d in done:
        out = out.unionByName(d)
    return out.select(F.col("key").alias(id_col), F.col("source").alias(source), F.col("size").alias(size), "copies")


def mixture_shares(mixed: DataFrame, source: str, size: str, targets: DataFrame) -> DataFrame:
    """Actual shares: `(source, target_share, max_repeats, n_docs, n_copies, most_copies, tokens, actual_share)`,
    one row for each target, also where its source has no document."""
    used = mixed.groupBy(F.col(f"`{source}`").alias("source")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("copies").alias("n_copies"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col(f"`{size}`")).alias("tokens")
    )
    all_tokens = used.agg(F.sum("tokens").alias("all_tokens"))
    rows = targets.join(used, "source", "left").crossJoin(F.broadcast(all_tokens))
    zero = {c: 0 for c in ("n_docs", "n_copies", "most_copies", "tokens")}
    share = F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens")).otherwise(F.lit(0.0))
    return rows.fillna(zero).select("source", "target_share", "max_repeats", *zero, share.alias("actual_share"))
