"""Session helpers shared by every operator: reading tables, cutting lineage, shipping the code."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_shipped: set[str] = set()


def build_session(app: str = "recordloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects (UTC, adaptive execution); `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_code(spark: SparkSession) -> None:
    """Make the package importable in Python workers, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="recordloom-")) / "recordloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`; only a local session that names none gets a temporary one, as on a
    cluster driver and executors would write to different disks."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """Cut lineage by a table written into the shared checkpoint folder; with metrics observed while writing.

    One job, and the table outlives a lost executor.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    observed = Observation() if metrics else None
    out = df.observe(observed, *[c.alias(k) for k, c in metrics.items()]) if observed else df
    out.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._materialized_at = path
    return written, observed.get if observed else {}


def checkpoint(df: DataFrame) -> DataFrame:
    """`materialize` without metrics."""
    return materialize(df)[0]


def discard(df: DataFrame) -> None:
    """Delete a table of `materialize` that nothing will read again."""
    path = getattr(df, "_materialized_at", None)
    if path:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
