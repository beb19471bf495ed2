"""File sources and sinks: URL lists, two-header CSV, packed blobs, JSON references, sitemaps, failure logs,
versioned snapshots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from recordloom.session import ship_code


def url_list(lines: DataFrame, order: str, value: str) -> DataFrame:
    """`(url, first)`: distinct URLs of lines in order of first mention. Several may share a line, `#` after a blank starts a
    comment, slashes at the end are dropped; null lines have none."""
    words = lines.select(F.col(order).alias("line"), F.posexplode(F.split(F.trim(F.regexp_replace(value, r"(^|\s)#.*$", "")), r"\s+")).alias("pos", "url"))
    urls = words.filter(F.col("url").rlike("^https?://")).select(F.regexp_replace("url", "/+$", "").alias("url"), F.struct("line", "pos").alias("at"))
    return urls.groupBy("url").agg(F.min("at").alias("first"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """`url_list` of a text file."""
    return url_list(spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line")), "line", "value")


def read_two_header_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of CSV files whose second record holds the column names; a BOM, short rows and line breaks in quotes are
    accepted, all values are strings, blank ones null. Of every file the first two records are its header."""
    probe = spark.read.csv(path, header=False, multiLine=True, inferSchema=False)
    numbered = spark.read.schema(", ".join(f"c{i} string" for i in range(len(probe.columns)))).csv(path, header=False, multiLine=True).select("*", F.input_file_name().alias("file__"), F.monotonically_increasing_id().alias("at__"))
    # Files with line breaks in quotes aren't split, so the numbers of one file's records follow one another.
    first = numbered.groupBy("file__").agg(F.min("at__").alias("first__"))
    body = numbered.join(F.broadcast(first), "file__").withColumn("n__", F.col("at__") - F.col("first__"))
    top = body.filter("n__ = 1").orderBy("file__").limit(1).collect()
    if not top:
        return spark.createDataFrame([], "value string")
    columns = [c for c in numbered.columns if not c.endswith("__")]
    names = {c: top[0][c] for c in columns if top[0][c]}
    return body.filter("n__ > 1").select(*[F.nullif(F.trim(F.col(c)), F.lit("")).alias(n) for c, n in names.items()])


def explode_blob(df: DataFrame, id_col: str, blob: str, separator: str = "///") -> DataFrame:
    """`(id, pos, block)` of a text of blocks between separators; blank blocks are left out."""
    parts = F.posexplode(F.transform(F.split(blob, separator), lambda x: F.trim(x))).alias("pos", "block")
    return df.select(id_col, parts).filter("block <> ''")


def dereference(documents: DataFrame, items: DataFrame, ref: str) -> DataFrame:
    """Items with the JSON body their `$ref` names; each document is looked up once whatever refers to it."""
    bodies = documents.groupBy("url").agg(F.max_by("body", "fetched_at").alias("body"))
    return items.join(bodies, items[ref] == bodies["url"], "left").drop("url")


def sitemap_urls(documents: DataFrame, pattern: str) -> DataFrame:
    """Distinct URLs of sitemap bodies that match a pattern."""
    found = F.explode(F.regexp_extract_all("body", F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), 1)).alias("url")
    return documents.select(found).filter(F.col("url").rlike(pattern)).distinct()


def html_links(documents: DataFrame, id_col: str, body: str) -> DataFrame:
    """`(id, pos, href)` of the links of HTML bodies."""
    found = F.posexplode(F.regexp_extract_all(body, F.lit(r"(?i)<a\b[^>]*?href=[\"']([^\"'#]+)"), 1)).alias("pos", "href")
    return documents.select(id_col, found)


def write_url_list(df: DataFrame, url: str, order: str, path: str) -> None:
    """One URL a line in the given order, in as many files as partitions."""
    df.orderBy(order).select(F.col(url).alias("value")).write.mode("overwrite").text(path)


def write_failures(df: DataFrame, path: str) -> None:
    """Rejected rows as `url<TAB>reason` lines."""
    df.select(F.concat_ws("\t", "url", "reason").alias("value")).write.mode("append").text(path)


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns that a table lacks, as nulls of the given type; present ones are untouched."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


class Snapshots:
    """A table as numbered directories: readers see the newest complete one, a commit writes the next."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        ship_code(spark)
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def versions(self) -> list[int]:
        if not self._fs.exists(self._path("")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(""))]
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and self._fs.exists(self._path(f"{n}/_SUCCESS")))

    def read(self, version: int | None = None) -> DataFrame | None:
        known = self.versions()
        return self.spark.read.parquet(f"{self.root}/v={version or known[-1]}") if known else None

    def commit(self, df: DataFrame, partition_by: Iterable[str] = (), tag: str | None = None) -> int:
        """Write the next version; a `tag` names what it holds and is written with it, so `has` knows what was committed."""
        version = (self.versions() or [0])[-1] + 1
        writer = df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.root}/v={version}")
        for marker in ([f"_TAG_{tag}"] if tag else []) + ["_SUCCESS"]:
            self._fs.create(self._path(f"v={version}/{marker}")).close()
        return version

    def has(self, tag: str) -> bool:
        """Whether a complete version was committed under a tag."""
        return any(self._fs.exists(self._path(f"v={v}/_TAG_{tag}")) for v in self.versions())


def next_ids(df: DataFrame, order: str, start: int) -> DataFrame:
    """Rows numbered from `start + 1` in a total order: counts per range partition, then a running number inside,
    so no task sorts all rows."""
    ranged = df.repartitionByRange(order).withColumn("part__", F.spark_partition_id())
    from recordloom.session import checkpoint

    held = checkpoint(ranged)
    counts = held.groupBy("part__").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part__", (F.coalesce(F.sum("n").over(Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part__").orderBy(order))
    return held.join(F.broadcast(before), "part__").withColumn("id", F.lit(start) + F.col("before") + inside).drop("part__", "before")
