"""Queries of the problems tagged llm, named pN_, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from recordloom.functions.domain import history_priority, sites_of
from recordloom.functions.text import squash

from recordloom.llm import canonical
from recordloom.llm.batch_dedup import Store, check_batch, listings
from recordloom.llm.components import connected_groups
from recordloom.llm.leakage import leaked_items
from recordloom.llm.mixture import mix_sources, mixture_shares, token_counts
from recordloom.llm.name_variants import common_givens, name_candidates, read_names
from recordloom.llm.cross_source import bm25_candidates, calibrated, mutual_best
from recordloom.llm.person_names import halves, may_be_same, read_name
from recordloom.llm.profile_terms import SKETCH_BITS, SKETCHES, person_terms, term_kind
from recordloom.llm.survivorship import dominant_rows, history_entries, surviving_records
from recordloom.llm.truncation import EVIDENCE, truncated_texts
from recordloom.operators.packed_fields import count_distinct_items, fit_codes
from recordloom.session import checkpoint, checkpoint_dir, table

Query = Callable[[SparkSession, str], DataFrame]


def corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every corner of every bout: (bout_id, corner, fighter_id, name, weight_class, event_date)."""
    bouts = table(spark, sf_dir, "event_fights")
    sides = [F.struct(F.lit(n).alias("corner"), F.col(f"fighter{n}_id").alias("fighter_id"), F.col(f"fighter{n}_name").alias("name")) for n in (1, 2)]
    return bouts.select(F.col("id").alias("bout_id"), "weight_class", "event_date", F.explode(F.array(*sides)).alias("c")).select("bout_id", "c.*", "weight_class", "event_date")


def resolved_corners(spark: SparkSession, sf_dir: str, asked: DataFrame) -> DataFrame:
    """`asked` corners (bout_id, corner, name, weight_class, event_date) with the one fighter their name means."""
    fighters = table(spark, sf_dir, "fighters").select("id", "name", "nickname", "gender", "weight_class_current", "career_debut_date", "last_fight_date")
    pivots = common_givens(fighters, "name")
    known = checkpoint(read_names(fighters, "id", "name", pivots, nickname="nickname"))
    names = checkpoint(asked.filter("name is not null").groupBy("name").agg(F.count(F.lit(1)).alias("n")))
    typed = checkpoint(read_names(names, "name", "name", pivots))
    candidates = name_candidates(typed, known, pivots)
    junior = lambda d, k, c: d.groupBy(F.col("key").alias(k)).agg(F.max("junior").alias(c))
    women = F.lower("weight_class").rlike("wom|fem")
    weights = table(spark, sf_dir, "canonical_values").filter("field = 'weight_class_current'").select("canon_id", F.lower("canon_name").alias("wc"))
    classed = canonical.map_values(fighters, "id", {"weight_class_current": canonical_blocks(spark, sf_dir)["weight_class_current"]}, "id", skip_exact=False)
    facts = fighters.select("id", F.col("id").cast("string").alias("key"), "gender", "career_debut_date", "last_fight_date")
    facts = facts.join(classed.join(F.broadcast(weights), "canon_id").select("id", "wc"), "id", "left")
    met = (
        candidates.join(junior(typed, "query", "qj"), "query").join(junior(known, "key", "kj"), "key").join(facts, "key")
        .join(asked.select("bout_id", "corner", F.col("name").alias("query"), "weight_class", "event_date"), "query")
        .filter(F.coalesce((F.col("gender") == "F") == women, F.lit(True)))
    )
    active = F.coalesce(F.col("event_date").between(F.date_sub("career_debut_date", 370), F.date_add("last_fight_date", 370)), F.lit(False))
    fitness = (F.col("qj") == F.col("kj")).cast("int") * 2 + F.coalesce(F.col("wc") == F.lower("weight_class"), F.lit(False)).cast("int") * 2 + active.cast("int")
    scored = met.select("bout_id", "corner", "id", fitness.alias("fitness"))
    best = scored.groupBy("bout_id", "corner").agg(F.max(F.struct("fitness", "id")).alias("last"), F.max("fitness").alias("top"), F.min_by("id", F.struct(-F.col("fitness"), "id")).alias("first"))
    return best.filter("first = last.id").select("bout_id", "corner", F.col("first").alias("fighter_id"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(bout_id, corner, fighter_id): corners without an id whose name means a fighter."""
    return resolved_corners(spark, sf_dir, corners(spark, sf_dir).filter("fighter_id is null").drop("fighter_id"))


def p1_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fighter_id, name, n_corners, by_id): every spelling under which a fighter appears on a card, whether by its id or by
    its name alone, with how often."""
    asked = corners(spark, sf_dir)
    found = resolved_corners(spark, sf_dir, asked.filter("fighter_id is null").drop("fighter_id"))
    named = asked.drop("fighter_id").join(found, ["bout_id", "corner"]).select("fighter_id", "name", F.lit(False).alias("by_id"))
    sides = named.unionByName(asked.filter("fighter_id is not null and name is not null").select("fighter_id", "name", F.lit(True).alias("by_id")))
    return sides.groupBy("fighter_id", "name").agg(F.count(F.lit(1)).alias("n_corners"), F.max("by_id").alias("by_id"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, group_id): groups of fighters rows linked by positive matches."""
    return connected_groups(table(spark, sf_dir, "fighter_matches"), "left_id", "right_id", F.col("is_match"))


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "fighters").join(p3_found(spark, sf_dir), "id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(group_id, id): the row that is the best of its group in every respect."""
    codes = fit_codes(table(spark, sf_dir, "fighters"), ["data_source"])["data_source"]
    respects = [
        F.col("data_quality_score"),
        count_distinct_items(F.col("data_source"), codes),
        history_entries(F.col("fight_history")),
        F.col("nationality").isNotNull().cast("int"),
    ]
    return dominant_rows(_members(spark, sf_dir), "group_id", "id", respects)


def p4_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One surviving record for each group, its attributes chosen one by one: the most trusted source of the row, its quality
    score, then the scrape time."""
    members = _members(spark, sf_dir)
    attributes = [c for c in members.columns if c not in ("id", "group_id")]
    trust = F.coalesce(F.array_max(F.transform(sites_of(F.col("data_source")), history_priority)), F.lit(0))
    return surviving_records(members, "group_id", attributes, F.struct(trust.alias("t"), F.coalesce("data_quality_score", F.lit(-1)).alias("q")), F.col("last_scraped_at"))


def canonical_blocks(spark: SparkSession, sf_dir: str) -> dict[str, list[canonical.Block]]:
    """The dictionary of each field, with how often each entry is spelled exactly in the data."""
    listed = table(spark, sf_dir, "canonical_values").select("canon_id", "field", "canon_name", "code")
    fighters = table(spark, sf_dir, "fighters")
    exact = (
        fighters.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("canon_name")) for c in ("nationality", "weight_class_current")])).alias("v"))
        .select("v.*")
        .unionByName(table(spark, sf_dir, "mma_events").select(F.lit("promotion").alias("field"), F.col("promotion").alias("canon_name")))
        .groupBy("field", "canon_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    entries: dict[str, list[tuple[int, str, str | None]]] = {}
    frequency: dict[str, dict[int, int]] = {}
    for r in listed.join(exact, ["field", "canon_name"], "left").sort("canon_id").toLocalIterator():
        entries.setdefault(r["field"], []).append((r["canon_id"], r["canon_name"], r["code"]))
        frequency.setdefault(r["field"], {})[r["canon_id"]] = r["n"] or 0
    countries, outside = canonical.country_tables(spark, entries.get("nationality", []))
    weights = canonical.weight_variants(name for _, name, _ in entries.get("weight_class_current", []))
    plans = {"nationality": (countries, outside), "weight_class_current": (weights, []), "promotion": (canonical.promotion_variants, [])}
    return {f: list(canonical.build_blocks(entries.get(f, []), variants, out, frequency.get(f))) for f, (variants, out) in plans.items()}


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, record_id, canon_id): the entry each free-typed value means, or 0."""
    blocks = canonical_blocks(spark, sf_dir)
    people = canonical.map_values(table(spark, sf_dir, "fighters"), "id", {c: blocks[c] for c in ("nationality", "weight_class_current")})
    return people.unionByName(canonical.map_values(table(spark, sf_dir, "mma_events"), "id", {"promotion": blocks["promotion"]}))


def p6_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, value, n): the values that mean no entry, with how often they are entered."""
    missed = p6_found(spark, sf_dir).filter("canon_id = 0").select("field", "record_id")
    sides = [table(spark, sf_dir, t).select(F.lit(c).alias("field"), F.col("id").alias("record_id"), F.col(c).alias("value")) for t, c in (("fighters", "nationality"), ("fighters", "weight_class_current"), ("mma_events", "promotion"))]
    return sides[0].unionByName(sides[1]).unionByName(sides[2]).join(missed, ["field", "record_id"]).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(raw_id, match_kind, match_id): listings that repeat an event, or a listing before them."""
    block = spark.sparkContext.broadcast(canonical_blocks(spark, sf_dir)["promotion"])

    def promoter():
        return lambda text: canonical.look_up(block.value, text)[1]

    store = Store(spark, f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}")
    store.accept(listings(table(spark, sf_dir, "mma_events"), "event", "id", "name", "promotion", "date", "tapology_url", promoter))
    return check_batch(store, listings(table(spark, sf_dir, "event_batches"), "raw", "raw_id", "name", "promotion", "date", "tapology_url", promoter))


#: Share of a profile's mass that a fighter must reach, and how many of its best fighters are weighed.
FLOOR, BEST = 0.15, 5
#: Confidence from which a pair is a match.
CONFIDENT = 0.5


def p7_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(profile_id, fighter_id, source, score, gap, confidence): profiles and fighters that are each other's best."""
    fighters = table(spark, sf_dir, "fighters")
    profiles = table(spark, sf_dir, "source_profiles")
    blocks = canonical_blocks(spark, sf_dir)
    sent = {f: spark.sparkContext.broadcast(blocks[f]) for f in ("nationality", "weight_class_current")}

    def finder(f: str):
        b = sent[f]
        return lambda: lambda text: canonical.look_up(b.value, text)[1]

    pivots = common_givens(fighters, "name")
    record = F.concat_ws("-", *[F.col(f"record_total_{x}").cast("string") for x in ("wins", "losses", "draws")])
    empty = F.lit(None).cast("string")
    f = fighters.select(
        F.col("id").alias("key"), "name", "nickname", F.col("date_of_birth").alias("born"), F.col("nationality").alias("country"), F.col("height_inches").alias("height"),
        F.col("weight_class_current").alias("weight"), record.alias("record"), F.col("last_fight_date").alias("last"),
    )
    p = profiles.select(
        F.col("profile_id").alias("key"), F.col("full_name").alias("name"), empty.alias("nickname"), F.col("born_text").alias("born"), F.col("country_text").alias("country"),
        F.col("height_text").alias("height"), F.col("weight_text").alias("weight"), F.col("record_text").alias("record"), F.col("last_bout_date").alias("last"),
    )
    known = checkpoint(person_terms(f, pivots, finder("nationality"), finder("weight_class_current"), False))
    asked = checkpoint(person_terms(p, pivots, finder("nationality"), finder("weight_class_current"), True))
    kind = term_kind(F.col("term"))
    weight = F.lit(0.4)
    for kinds, w in ((("whole", "full"), 0.45), (("pre", "suf"), 0.25), (("init", "surname"), 0.3), (("born",), 0.6), (("bornset",), 0.2), (("bornym", "bornmd", "bornyd"), 0.1), (("record", "bout"), 0.35)):
        weight = F.when(kind.isin(*kinds), w).otherwise(weight)
    of_birth = lambda t: term_kind(t).startswith("born")
    scored = bm25_candidates(known.drop("dated"), asked.drop("dated"), FLOOR, BEST, weight, term_kind, of_birth, lambda t: F.substring(term_kind(t), 1, 4), SKETCHES, SKETCH_BITS)
    givens, parts = frozenset(g.replace("-", "").replace("'", "") for g in pivots), halves(pivots)

    @F.pandas_udf(T.BooleanType())
    def names_agree(typed: pd.Series, stored: pd.Series, nick: pd.Series) -> pd.Series:
        out = []
        for x, y, n in zip(typed, stored, nick):
            other = read_name(y, givens)
            if other is not None and n:
                other.nickname = squash(n)
            out.append(may_be_same(read_name(x, givens), other, givens, parts))
        return pd.Series(out, dtype=bool)

    sides = scored.join(profiles.select(F.col("profile_id").alias("query"), "source", "full_name"), "query").join(fighters.select(F.col("id").alias("key"), "name", "nickname"), "key")
    named = sides.filter(names_agree("full_name", "name", "nickname")).drop("full_name", "name", "nickname")
    dated = lambda d, k, c: d.select(F.col("key").alias(k), F.col("dated").alias(c))
    both = named.join(dated(asked, "query", "qd"), "query").join(dated(known, "key", "kd"), "key")
    in_ = lambda *kinds: F.arrays_overlap("shared", F.array(*map(F.lit, kinds)))
    side = lambda c: F.when(in_(c), 1).when(F.array_contains("differ", c), -1).otherwise(0)
    others = Window.partitionBy("query").orderBy(F.desc("rest"), "key")
    ahead = F.col("rest") - F.when(F.row_number().over(others) == 1, F.coalesce(F.lead("rest").over(others), F.lit(0.0))).otherwise(F.first("rest").over(others))
    told = checkpoint(both.withColumn("ahead", ahead))
    features = {"rest": F.col("rest"), "ahead": F.col("ahead"), "spelled": in_("whole", "full").cast("int"), **{c: side(c) for c in ("bout", "record", "country", "class", "height")}}
    dates, same, part = F.col("qd") & F.col("kd"), F.array_contains("shared", "born"), in_("bornym", "bornmd", "bornyd", "bornset")
    sure = calibrated(told, features, F.when(dates, (same | part).cast("int")), {"same": dates & same, "part": dates & ~same & part, "apart": dates & ~same & ~part})
    found = mutual_best(sure.filter(F.col("confidence") >= CONFIDENT))
    return found.select(F.col("query").alias("profile_id"), F.col("key").alias("fighter_id"), "source", "score", "gap", "confidence")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(profile_id, fighter_id): the fighters row of each profile that has one."""
    return p7_matches(spark, sf_dir).select("profile_id", "fighter_id")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, run_words, matched_words, test_words): each leak with the words it holds."""
    return leaked_items(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id): documents that hold at least two fifths of an evaluation text as one run."""
    return p8_leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, n_docs, longest): the evaluation texts that leaked."""
    return p8_leaks(spark, sf_dir).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("run_words").alias("longest"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, copies): how often the mix takes each document of a source with a target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", token_counts(F.col("text")).alias("n_tokens"))
    return mix_sources(checkpoint(docs), "doc_id", "source", "n_tokens", table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of all tokens each source has in the mix, beside its target."""
    return mixture_shares(p9_mix(spark, sf_dir), "source", "n_tokens", table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id): documents whose text was cut off before its end."""
    return truncated_texts(table(spark, sf_dir, "documents"), "doc_id").filter("evidence is not null").select("doc_id")


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source cuts, in all and by what tells it: (source, n_texts, n_truncated, rate, n_limit, n_open, ...)."""
    judged = truncated_texts(table(spark, sf_dir, "documents"), "doc_id")
    by = [F.count_if(F.col("evidence") == e).alias(f"n_{e}") for e in EVIDENCE]
    counts = judged.groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), F.count("evidence").alias("n_truncated"), *by)
    return counts.withColumn("rate", F.col("n_truncated") / F.col("n_texts"))


QUERIES: dict[str, Query] = {"p1_found": p1_found, "p1_variants": p1_variants, "p3_found": p3_found, "p4_found": p4_found, "p4_survivors": p4_survivors, "p6_found": p6_found, "p6_misses": p6_misses, "p5_found": p5_found, "p7_found": p7_found, "p7_matches": p7_matches, "p8_found": p8_found, "p8_leaks": p8_leaks, "p8_items": p8_items, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_rates": p10_rates}

ORACLES: dict[str, str] = {
    "p3_found": """
        WITH RECURSIVE e AS (
            SELECT left_id AS a, right_id AS b FROM fighter_matches WHERE is_match AND left_id <> right_id
            UNION SELECT right_id, left_id FROM fighter_matches WHERE is_match AND left_id <> right_id),
        reach(id, g) AS (SELECT a, a FROM e UNION SELECT e.b, r.g FROM reach r JOIN e ON e.a = r.id)
        SELECT id, min(g) AS group_id FROM reach GROUP BY id""",
}
