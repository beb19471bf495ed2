"""Variant spellings of names of persons, linked by metric-space partitioning.

A name is a point `(given, surname)`; the distance of two names is the Levenshtein distance of the given names
plus that of the surnames, a true metric. Every given name and every surname of a known person is a pivot, and a known name
lies in the cells of its own two. A name within `RADIUS` of another differs from it by at most one edit in each word or is
in one cell with it: where one word differs by two, the radius leaves nothing for the other. So a query visits its own two
cells, whatever the number of known names near by, and what a cell leaves of the radius is joined exactly: words within r
edits share one of r + 1 segments at a shifted place (pigeonhole), which makes an equi-join. Names of one edit in each word
meet by a beginning or an end of both. Each meeting pair is measured. A name makes a bounded number of keys, nothing is broadcast, and
no name is left out of the join.

Names that agree after normalisation (order, accents, ranks, initials, short forms, nicknames) are distance 0 and found
by plain equi-joins too. Which near names are taken for misspellings is decided after the join (`misspellings`).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from recordloom.functions.text import fold_accents, squash
from recordloom.llm.person_names import formal_names, halves, is_relative, read_name

RADIUS = 2
#: A given name is common when at least one row in so many has it; no more names than that can be.
COMMON = 2000

READING = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("given", T.StringType()), T.StructField("surname", T.StringType()), T.StructField("junior", T.BooleanType())]
)


def common_givens(known: DataFrame, name: str) -> list[str]:
    """Common given names: first words of at least one name in `COMMON` (and two rows), commonest first."""
    first = F.regexp_extract(F.lower(fold_accents(F.col(f"`{name}`"))), r"^\s*([a-z][a-z'\-]{2,})\s+\S", 1)
    counted = known.select(first.alias("g")).filter("g <> ''").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    return [r["g"] for r in counted.filter("n > 1").join(F.broadcast(total), F.col("n") * COMMON >= F.col("total")).orderBy(F.desc("n"), "g").collect()]


def read_names(df: DataFrame, key: str, name: str, common: list[str], nickname: str | None = None, expand: bool = True) -> DataFrame:
    """Readings of names: `(key, kind, given, surname, junior)`; kinds `name`, `short` (a short form's formal
    name), `nick` (nickname for the given name) and `whole` (all letters, for names typed without a blank)."""
    givens, parts = frozenset(g.replace("-", "").replace("'", "") for g in common), halves(common)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, text, nick in zip(batch["key"], batch["name"], batch["nick"]):
                n = None if text is None or is_relative(text) else read_name(text, givens)
                if n is None:
                    continue
                out.append((k, "whole", "", n.whole, n.junior))
                for given, surname in n.readings:
                    out.append((k, "name", given, surname, n.junior))
                    for formal in formal_names(given, parts) if expand else ():
                        out.append((k, "short", formal, surname, n.junior))
                nicks = [n.nickname] if nick is None else [squash(nick)]
                surnames = {s for _, s in n.readings[:1]} | {n.words[-1]}
                out += [(k, "nick", x, s, n.junior) for x in nicks for s in surnames if x and x != s]
            yield pd.DataFrame(out, columns=READING.names, dtype=object)

    nick = F.col(f"`{nickname}`").cast("string") if nickname else F.lit(None).cast("string")
    picked = df.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{name}`").alias("name"), nick.alias("nick"))
    return picked.mapInPandas(read, READING)


def _segments(n: int, parts: int) -> list[tuple[int, int]]:
    """Start and length of the segments of a word of n letters; some are empty where it has fewer letters than parts."""
    sizes = [n // parts + (i >= parts - n % parts) for i in range(parts)]
    starts = [sum(sizes[:i]) for i in range(parts)]
    return list(zip(starts, sizes))


def segment_keys(word: str, radius: int, query: bool) -> list[str]:
    """The segments of a word, or for a query those it may share with a word within `radius` edits."""
    n = len(word)
    if not query:
        return [f"{radius}.{n}.{i}.{word[a : a + size]}" for i, (a, size) in enumerate(_segments(n, radius + 1))]
    keys = []
    for length in range(max(0, n - radius), n + radius + 1):
        shift = n - length
        for i, (a, size) in enumerate(_segments(length, radius + 1)):
            left, right = max(-i, shift - (radius - i)), min(i, shift + (radius - i))
            for at in range(max(0, a + left), min(n - size, a + right) + 1):
                keys.append(f"{radius}.{length}.{i}.{word[at : at + size]}")
    return list(dict.fromkeys(keys))


def half_keys(word: str) -> list[str]:
    """Beginnings and ends of half a word, one of which it shares with any word of one edit: what both keep of the shorter
    word (n letters, or one less than it has) on either side of the edit is half of it at least on one."""
    return [k for p in {len(word) // 2, max(0, len(word) - 1) // 2} for k in (f"<{p}.{word[:p]}", f">{p}.{word[len(word) - p :]}")]


def name_keys(given: str, surname: str, query: bool) -> list[str]:
    """The keys that a name, or the query of one, has: segments of a word in the cell of the other, and halves of both."""
    both = [f"{x}\0{y}" for x in half_keys(given) for y in half_keys(surname)]
    return [f"g{given}\0{k}" for k in segment_keys(surname, RADIUS, query)] + [f"s{surname}\0{k}" for k in segment_keys(given, RADIUS, query)] + both


def _marks(query: bool):
    """`name_keys` as numbers; two keys of one number only make names meet that are then measured."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def marks(given: pd.Series, surname: pd.Series) -> pd.Series:
        return pd.Series([[xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in name_keys(g, s, query)] for g, s in zip(given, surname)], dtype=object)

    return marks


def metric_pairs(queries: DataFrame, known: DataFrame) -> DataFrame:
    """`(query, key, qg, qs, given, surname, g, s)` for every two readings within `RADIUS` (both `(key, given, surname)`),
    with the distances of given names and surnames. Repeated readings give one row, empty words are words."""
    # Spread first: every row becomes some fifty, and a small table would leave them to one task.
    spread = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    q = queries.select(F.col("given").alias("qg"), F.col("surname").alias("qs")).distinct().repartition(spread).select("qg", "qs", F.explode(_marks(True)("qg", "qs")).alias("mark"))
    k = known.select("given", "surname").distinct().repartition(spread).select("given", "surname", F.explode(_marks(False)("given", "surname")).alias("mark"))
    met = q.join(k, "mark").withColumn("g", F.levenshtein("qg", "given", RADIUS)).filter("g >= 0").withColumn("s", F.levenshtein("qs", "surname", RADIUS))
    near = met.filter(f"s >= 0 and g + s <= {RADIUS}").select("qg", "qs", "given", "surname", "g", "s").distinct()
    asked = queries.select(F.col("key").alias("query"), F.col("given").alias("qg"), F.col("surname").alias("qs")).distinct()
    return near.join(asked, ["qg", "qs"]).join(known.select("key", "given", "surname").distinct(), ["given", "surname"])


def misspellings(near: DataFrame, common: list[str]) -> DataFrame:
    """`(query, key, distance)` of the near names that may be one name misspelled: two different common given names are
    two persons' (relatives), and words of a letter (given) or up to three (surname) are too short to tell."""
    plain = list(dict.fromkeys(p.replace("-", "").replace("'", "") for p in common)) or ["?"]
    short = lambda a, b, n: F.least(F.char_length(a), F.char_length(b)) <= n
    kept = near.filter(~(F.col("qg").isin(plain) & F.col("given").isin(plain) & (F.col("g") > 0))).filter(~((F.col("g") > 0) & short("qg", "given", 1)) & ~((F.col("s") > 0) & short("qs", "surname", 3)))
    return kept.groupBy("query", "key").agg(F.min(F.col("g") + F.col("s")).alias("distance"))


def name_candidates(typed: DataFrame, known_names: DataFrame, common: list[str]) -> DataFrame:
    """`(query, key, level, distance)`: known names each typed name may mean, at its best level only.

    Levels: 1 the same name or letters, 2 a short form, an initial or a nickname for the given name, 3 within the
    radius. `typed` and `known_names` are readings; the best level has all its candidates.
    """
    q = typed.select(F.col("key").alias("query"), F.col("kind").alias("qk"), F.col("given").alias("qg"), F.col("surname").alias("qs"))
    k = known_names
    full = q.join(k, (F.col("qg") == F.col("given")) & (F.col("qs") == F.col("surname")) & F.col("qk").isin("name", "short") & F.col("kind").isin("name", "short"))
    full = full.filter("qg <> ''").select("query", "key", F.when((F.col("qk") == "name") & (F.col("kind") == "name"), 1).otherwise(2).alias("level"))
    whole = q.filter("qk = 'whole'").join(k.filter("kind = 'whole'"), F.col("qs") == F.col("surname")).select("query", "key", F.lit(1).alias("level"))
    nick = q.filter("qk = 'nick'").join(k.filter("kind = 'nick'"), (F.col("qg") == F.col("given")) & (F.col("qs") == F.col("surname"))).select("query", "key", F.lit(2).alias("level"))
    one = lambda c: F.substring(c, 1, 1)
    same = (F.col("qs") == F.col("surname")) & (one("qg") == one("given"))
    qn, kn = q.filter("qk = 'name' and qg <> ''"), k.filter("kind = 'name' and given <> ''")
    initials = [a.join(b, same).select("query", "key", F.lit(2).alias("level")) for a, b in ((qn.filter("char_length(qg) = 1"), kn), (qn, kn.filter("char_length(given) = 1")))]
    plain = full.unionByName(whole).unionByName(nick).unionByName(initials[0]).unionByName(initials[1]).groupBy("query", "key").agg(F.min("level").alias("level"))
    near = misspellings(metric_pairs(typed.filter("kind = 'name'"), known_names.filter("kind = 'name'")), common)
    found = plain.withColumn("distance", F.lit(0)).unionByName(near.select("query", "key", F.lit(3).alias("level"), "distance"))
    best = Window.partitionBy("query")
    return found.withColumn("top", F.min(F.struct("level", "distance")).over(best)).filter("level = top.level and distance = top.distance").drop("top")
