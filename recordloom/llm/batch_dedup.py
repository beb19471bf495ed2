"""New batches of event listings checked against everything accepted before, without reprocessing it.

Accepted listings live in a `Store`: a folder of committed versions, each with the facts read from its listings and
their fingerprints in rotated block tables. `check_batch` reads the batch and the store, never the rows the store was
made of; what is new is appended as the next version, and a listing's fingerprints are computed once in its life.

The fingerprint of two headliners is a 64-bit set of their letters (first, second and third occurrence of each). An
added or lost letter changes one bit, a wrong one two, swapped letters none, whatever the order of the names: two
errors in a pair stay within `MAX_BITS`. Table r holds the fingerprint rotated so that block r leads; two fingerprints
at most `MAX_BITS` apart agree in one of `BLOCKS` blocks, so a lookup is an equi-join on (form, scope, table, block).
The scope bounds what a block can meet: the promotion within `POSTPONED` days, or the day. Forms without anything
that can be misspelled (URL number, promotion and number, pair without a date, promotion and day) have one block, the
whole of their hash. The Hamming distance is verified first, on narrow rows; then the facts of both sides are joined
and compared, headliners by their edit distance.

Listings that say exactly the same are looked up once: the first of them stands for all, so a listing repeated by
a third of all rows makes no pairs of its copies.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recordloom.functions.text import squash
from recordloom.llm.components import connected_groups
from recordloom.session import checkpoint, discard

BLOCKS = 5
MAX_BITS = BLOCKS - 1
#: Days a postponed event may move by and still be the same.
POSTPONED = 200
_VERSUS = re.compile(r"\s+(?:vs?\.?|versus|x|contre)\s+", re.I)
_TAIL = re.compile(r"\s*(?:\|\s*\w+|\[[^\]]*\]|\((?:live|card|results|full|replay)[^)]*\))\s*$", re.I)
_NUMBER = re.compile(r"#\s*(\d+)\b|(?<!\S)(\d{1,4})(?=\s*$)")
_URL_NUMBER = re.compile(r"/events/(\d+)")
_NIGHT = re.compile(r"\s*fight\s+night\s*$", re.I)
_YEAR_PLACE = re.compile(r"\s+(?:19|20)\d\d\s*$")

LISTING = T.StructType(
    [
        T.StructField("kind", T.StringType()), T.StructField("id", T.LongType()), T.StructField("promotion", T.StringType()), T.StructField("number", T.IntegerType()),
        T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("rematch", T.IntegerType()), T.StructField("date", T.DateType()),
        T.StructField("url", T.StringType()),
    ]
)
FACTS = [f.name for f in LISTING.fields[2:]]
#: What a store holds: facts with the listing each is a repetition of (itself where none), and block tables.
STORED = T.StructType([*LISTING.fields, T.StructField("root_kind", T.StringType()), T.StructField("root_id", T.LongType())])
TABLES = T.StructType([T.StructField("key", T.LongType()), T.StructField("print", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("id", T.LongType())])
_WIDTH = -(-64 // BLOCKS)
#: Letters with a bit for a third occurrence; they fill the 64 bits.
_THRICE = "adeilmnorstu"


def letter_bits(text: str) -> int:
    """64-bit set of the letters of a text with their first, second and third occurrence, spread over the blocks."""
    seen: dict[int, int] = {}
    bits = 0
    for c in text:
        i = ord(c) - 97 if "a" <= c <= "z" else ord(c) % 26
        seen[i] = n = seen.get(i, 0) + 1
        if n < 3:
            at = i + 26 * (n - 1)
        elif n == 3 and (k := _THRICE.find(chr(97 + i))) >= 0:
            at = 52 + k
        else:
            continue
        bits |= 1 << at * 37 % 64
    return bits - (1 << 64) if bits >> 63 else bits


def _surname(text: str) -> tuple[str, int | None]:
    words = [w for w in re.split(r"\s+", text.strip()) if w]
    tag = None
    if len(words) > 1 and words[-1].isdigit():
        tag = int(words.pop())
    while len(words) > 1 and squash(words[-1]) in ("jr", "sr", "ii", "iii"):
        words.pop()
    return (squash(words[-1]) if words else "", tag)


def read_listing(name: str | None, promotion: str | None, date, url: str | None, promoter: Callable[[str], int]) -> tuple:
    """Facts of a listing: (promotion, number, a, b, rematch, date, url), each None where unknown.

    `promoter` maps a promotion as written to its canonical number, 0 for none.
    """
    text = re.sub(r"\s+", " ", name or "").strip()
    while (m := _TAIL.search(text)) and m.start():
        text = text[: m.start()].strip()
    a = b = rematch = None
    head = text
    if m := _VERSUS.search(text):
        before, colon, after = text[: m.start()].rpartition(": ")
        if not colon:
            before, _, after = text[: m.start()].rpartition(" - ")
        head = before
        (a, _), (b, rematch) = _surname(after), _surname(text[m.end() :].split(" - ")[0])
        a, b = sorted((a, b))
    head = re.sub(r"\s+-\s+[^-\d]*$", "", head.rstrip(": ")).strip()
    number = None
    if m := _NUMBER.search(head):
        number = int(m.group(1) or m.group(2))
        head = head[: m.start()].strip()
        head = re.sub(r"^.*?%d\s+(?=\S)" % number, "", head)
    night = _NIGHT.search(head)
    owner = 0
    for form in dict.fromkeys([head, head[: night.start()] if night else head, head.split(" ")[0]]):
        if form and (owner := promoter(form)):
            break
    if not owner and head and a is None and number is None and (m := re.match(r"([A-Za-z]+?)(\d+)$", head)) and (owner := promoter(m.group(1))):
        number = int(m.group(2))
    if not owner and head:
        words = head.split(" ")
        for k in range(min(5, len(words)), 0, -1):
            if owner := promoter(" ".join(words[:k])):
                break
    if not owner and not head and promotion:
        owner = promoter(re.sub(r"\s+\d+\s*$", "", promotion))
        if number is None and (m := re.search(r"\s(\d+)\s*$", promotion)):
            number = int(m.group(1))
    key = f"c{owner}" if owner else squash(_YEAR_PLACE.sub("", head[: night.start()] if night else head)) or (squash(promotion) if promotion else None)
    found = _URL_NUMBER.search(url or "")
    return (key or None, number, a or None, b or None, rematch, date if isinstance(date, datetime.date) and not pd.isna(date) else None, found.group(1) if found else None)


def listings(df: DataFrame, kind: str, id_col: str, name: str, promotion: str, date: str, url: str, promoter_of: Callable[[], Callable[[str], int]]) -> DataFrame:
    """Facts of every row of `df`; rows without any name have only their URL and date."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        promoter, memo = promoter_of(), {}

        def known(text: str) -> int:
            if text not in memo:
                if len(memo) > 200_000:
                    memo.clear()
                memo[text] = promoter(text)
            return memo[text]

        for batch in batches:
            rows = [(kind, int(i), *read_listing(*[None if x is None or x is pd.NaT else x for x in r], known)) for i, *r in zip(*[batch[c] for c in ("i", "n", "p", "d", "u")])]
            yield pd.DataFrame(rows, columns=LISTING.names, dtype=object)

    picked = df.filter(F.col(f"`{id_col}`").isNotNull()).select(*[F.col(f"`{c}`").alias(k) for k, c in zip("inpdu", (id_col, name, promotion, date, url))])
    return picked.mapInPandas(read, LISTING)


def block_rows(facts: DataFrame, query: bool = False) -> DataFrame:
    """The block tables of listings: `(key, print, kind, id)`, one row for each form and table a listing has; for a
    `query` the rows of the neighbouring scopes too."""
    joined = lambda *parts: F.concat(parts[0].cast("string"), *[x for p in parts[1:] for x in (F.lit("|"), p.cast("string"))])
    promotion, a, b, day = F.col("promotion"), F.col("a"), F.col("b"), F.col("date")

    @F.pandas_udf(T.LongType())
    def letters(texts: pd.Series) -> pd.Series:
        return pd.Series([0 if t is None else letter_bits(t) for t in texts], dtype="int64")

    bare = F.col("number").isNull() & a.isNull()
    whole = [("url", F.col("url")), ("number", joined(promotion, F.col("number"))), ("pair", joined(a, b)), ("day", F.when(bare, joined(promotion, day)))]
    exact = [F.when(text.isNotNull(), F.struct(F.xxhash64(F.lit(form), text).alias("key"), F.lit(0).cast("long").alias("print"))) for form, text in whole]
    period = F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / POSTPONED)
    scopes = [F.concat(F.lit("promoted|"), joined(promotion, period + i)) for i in ((-1, 0, 1) if query else (0,))] + [F.concat(F.lit("dated|"), day.cast("string"))]
    block = lambda r: F.shiftrightunsigned("letters", _WIDTH * r).bitwiseAND(F.lit((1 << _WIDTH) - 1))
    near = [F.when(scope.isNotNull() & a.isNotNull() & b.isNotNull(), F.struct(F.xxhash64(scope, F.lit(r), block(r)).alias("key"), F.col("letters").alias("print"))) for scope in scopes for r in range(BLOCKS)]
    marked = facts.withColumn("letters", letters(F.concat(a, b)))
    return marked.select("kind", "id", F.explode(F.array_compact(F.array(*exact, *near))).alias("t")).select("t.key", "t.print", "kind", "id")


class Store:
    """Accepted listings in a folder of versions; a version counts once its marker is written, so a writer that is lost
    half way leaves nothing behind that is read. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _marked(self, version: int, marker: str) -> bool:
        return self._fs.exists(self._at(f"{self.path}/v={version}/{marker}"))

    def versions(self) -> list[int]:
        """Committed versions that are read: those since the last compaction."""
        if not self._fs.exists(self._at(self.path)):
            return []
        named = [s.getPath().getName() for s in self._fs.listStatus(self._at(self.path))]
        done = [v for v in sorted(int(n[2:]) for n in named if n.startswith("v=")) if self._marked(v, "_COMMITTED")]
        whole = [v for v in done if self._marked(v, "_WHOLE")]
        return [v for v in done if not whole or v >= whole[-1]]

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        paths = [f"{self.path}/v={v}/{part}" for v in self.versions()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def facts(self) -> DataFrame:
        return self._read("facts", STORED)

    def tables(self) -> DataFrame:
        return self._read("tables", TABLES)

    def append(self, facts: DataFrame, whole: bool = False) -> int:
        """Write listings `(*LISTING, root_kind, root_id)` and their block tables as the next version."""
        version = (self.versions() or [0])[-1] + 1
        at = f"{self.path}/v={version}"
        facts.select(*STORED.names).write.mode("overwrite").parquet(f"{at}/facts")
        block_rows(self.spark.read.schema(STORED).parquet(f"{at}/facts")).write.mode("overwrite").parquet(f"{at}/tables")
        for marker in (["_WHOLE"] if whole else []) + ["_COMMITTED"]:
            self._fs.create(self._at(f"{at}/{marker}")).close()
        return version

    def accept(self, listed: DataFrame) -> int:
        """Append listings that are known to differ from one another, such as a first history."""
        return self.append(listed.select(*LISTING.names, F.col("kind").alias("root_kind"), F.col("id").alias("root_id")))

    def compact(self) -> int:
        """All versions rewritten as one, for a store of many small batches."""
        return self.append(self.facts(), whole=True)


def _same(x: str, y: str) -> "F.Column":
    """Whether the facts of two sides denote one event, as a score (0: no)."""
    g = lambda c: (F.col(f"{x}.{c}"), F.col(f"{y}.{c}"))
    equal = {c: (p == q) for c in FACTS for p, q in [g(c)]}
    differ = {c: F.coalesce(~e, F.lit(False)) for c, e in equal.items()}
    same = {c: F.coalesce(e, F.lit(False)) for c, e in equal.items()}
    near = lambda p, q: F.coalesce((p == q) | (F.levenshtein(p, q, 2) >= 0) & (F.char_length(p) >= 5), F.lit(False))
    (a1, a2), (b1, b2) = g("a"), g("b")
    straight, crossed = near(a1, a2) & near(b1, b2), near(a1, b2) & near(b1, a2)
    pair = straight | crossed
    has_pairs = a1.isNotNull() & a2.isNotNull()
    no_pair = has_pairs & ~pair
    gap = F.coalesce(F.abs(F.datediff(*g("date"))), F.lit(0))
    rematch = ~F.coalesce(g("rematch")[0], F.lit(1)).eqNullSafe(F.coalesce(g("rematch")[1], F.lit(1)))
    by_url = same["url"] & ~(differ["number"] & differ["promotion"])
    barred = differ["url"] | differ["number"] | (pair & rematch)
    by_number = same["promotion"] & same["number"] & ~no_pair
    by_pair = pair & ~differ["promotion"] & (gap <= POSTPONED)
    bare = same["promotion"] & same["date"] & ~has_pairs & g("number")[0].isNull() & g("number")[1].isNull()
    return F.when(by_url, 4).when(barred, 0).when(by_number & pair, 3).when(by_number, 2).when(by_pair, 2).when(bare & ~no_pair, 1).otherwise(0), gap


def met_listings(store: Store, facts: DataFrame) -> DataFrame:
    """`(raw, kind, other, distance)`: listings of the store, and earlier ones of `facts`, that share a block with one of
    `facts` and are at most `MAX_BITS` apart; `distance` is the least over the forms that met."""
    asked = block_rows(facts, query=True).select("key", F.col("print").alias("asked"), F.col("id").alias("raw"))
    known = store.tables().unionByName(block_rows(facts)).select("key", "print", "kind", F.col("id").alias("other"))
    apart = F.bit_count(F.col("asked").bitwiseXOR(F.col("print")))
    met = asked.join(known, "key").filter(((F.col("kind") == "event") | (F.col("other") < F.col("raw"))) & (apart <= MAX_BITS))
    return met.groupBy("raw", "kind", "other").agg(F.min(apart).alias("distance"))


def check_batch(store: Store, batch: DataFrame) -> DataFrame:
    """`(raw_id, match_kind, match_id)` for each listing of `batch` that denotes an event of the store (`event`), else a
    listing of smaller id, of the store or the batch (`raw`, the smallest of its group); the store has the batch after it.

    `batch` is a table of facts (`listings`) of kind `raw`, whose ids are larger than those before. Listings without any
    usable fact match nothing.
    """
    said = checkpoint(batch.withColumn("said", F.md5(F.to_json(F.struct(*FACTS)))))
    facts = checkpoint(said.groupBy("said").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in FACTS]).select(F.lit("raw").alias("kind"), "id", *FACTS, "said"))
    own = facts.select(*LISTING.names, F.lit(None).cast("string").alias("root_kind"), F.lit(None).cast("long").alias("root_id"))
    x, y = facts.alias("x"), store.facts().unionByName(own).alias("y")
    met = met_listings(store, facts)
    sides = met.join(x, F.col("raw") == F.col("x.id")).join(y, (met["kind"] == F.col("y.kind")) & (F.col("other") == F.col("y.id")))
    score, gap = _same("x", "y")
    scored = sides.select("raw", met["kind"], "other", F.col("y.root_kind").alias("root_kind"), F.col("y.root_id").alias("root_id"), score.alias("score"), gap.alias("gap"))
    links = checkpoint(scored.filter("score > 0"))
    stored = links.filter("root_kind is not null")
    best = F.min(F.struct((F.col("kind") != "event").alias("through"), (-F.col("score")).alias("s"), "gap", "root_id")).alias("best")
    direct = stored.filter("root_kind = 'event'").groupBy("raw").agg(best).select(F.col("raw").alias("id"), F.col("best.root_id").alias("event"))
    before = stored.filter("root_kind = 'raw'").groupBy(F.col("raw").alias("id")).agg(F.min("root_id").alias("before"))
    groups = checkpoint(connected_groups(links.filter("root_kind is null"), "raw", "other"))
    alone = facts.select("id", "said").join(groups, "id", "left").join(direct, "id", "left").join(before, "id", "left")
    known = checkpoint(alone.select("id", "said", F.coalesce("group_id", "id").alias("group_id"), "event", "before"))
    of_group = known.groupBy("group_id").agg(F.min("event").alias("group_event"), F.min("before").alias("group_before"))
    rooted = checkpoint(known.join(of_group, "group_id").select("id", "said", F.coalesce("event", "group_event").alias("event"), F.least("group_before", "group_id").alias("start")))
    kind, root = F.when(F.col("event").isNotNull(), "event").otherwise("raw"), F.coalesce("event", "start")
    store.append(facts.join(rooted.select("id", kind.alias("root_kind"), root.alias("root_id")), "id"))
    for written in (links, groups, known, facts):
        discard(written)
    match = F.coalesce("event", F.when(F.col("start") < F.col("raw_id"), F.col("start")))
    found = said.select("said", F.col("id").alias("raw_id")).join(rooted.select("said", "event", "start"), "said")
    return found.select("raw_id", kind.alias("match_kind"), match.alias("match_id")).filter("match_id is not null")
