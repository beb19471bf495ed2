"""Queries over the matching, join and window-like operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordloom.functions import domain, text
from recordloom.operators import matching
from recordloom.session import table

KEY = "trim(regexp_replace(regexp_replace(lower(strip_accents(translate({0}, 'øØłŁ', 'oOlL'))), '[^a-z0-9 ]', '', 'g'), '\\s+', ' ', 'g'))"


def _fighters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fighters")


def _bouts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "event_fights")


def j3_event_date(spark, d):
    e = table(spark, d, "mma_events").select(F.col("id").alias("event_id"), "date")
    return _bouts(spark, d).select("id", "event_id").join(e, "event_id").select("id", F.col("date").alias("event_date"))


def f14_event_date_sync(spark, d):
    e = table(spark, d, "mma_events").select(F.col("id").alias("event_id"), "date")
    return _bouts(spark, d).select("id", "event_id", "event_date").join(e, "event_id").filter(~F.col("date").eqNullSafe(F.col("event_date"))).select("id", F.col("date").alias("new_date"))


def j4_candidate_counts(spark, d):
    f = _fighters(spark, d).select(F.lower("name").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    p = table(spark, d, "source_profiles").select("profile_id", F.lower("full_name").alias("key"))
    return p.join(f, "key", "left").select("profile_id", F.when(F.coalesce("n", F.lit(0)) == 0, "none").when(F.col("n") == 1, "one").otherwise("many").alias("candidates"))


def j5_birth_token_subset(spark, d):
    f = _fighters(spark, d).filter("date_of_birth is not null").select("id", F.array_distinct(F.filter(F.split(F.lower("name"), " "), lambda w: w != "")).alias("tokens"), F.col("date_of_birth").alias("dob"))
    return matching.token_subset_pairs(f, f, "dob")


def j7_token_candidates(spark, d):
    """Profiles and fighters that share two name words of four letters or more."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), " "), lambda w: F.length(w) >= 4))
    p = table(spark, d, "source_profiles").select(F.col("profile_id").alias("id"), words("full_name").alias("tokens"))
    return matching.token_pair_candidates(p, _fighters(spark, d).select("id", words("name").alias("tokens")))


def j8_event_band(spark, d):
    b = table(spark, d, "event_batches").filter("date is not null").select("raw_id", F.col("date").alias("raw_date"), F.col("city").alias("raw_city"))
    e = table(spark, d, "mma_events").select(F.col("id").alias("event_id"), "date", "city")
    return matching.band_pairs(b, e, "raw_date", "date").filter("raw_city = city").select("raw_id", "event_id", F.datediff("raw_date", "date").alias("gap"))


def j10_real_twins(spark, d):
    """Rows without a history that have a twin with one under the same words in any order."""
    f = _fighters(spark, d).select("id", text.sorted_tokens_key(F.col("name")).alias("key"), F.col("fight_history").isNull().alias("shell"))
    return f.filter("shell").join(f.filter("not shell"), "key", "left_semi").select("id")


def j11_unlinked_fighters(spark, d):
    b = _bouts(spark, d)
    used = b.select(F.explode(F.array("fighter1_id", "fighter2_id")).alias("id")).filter("id is not null")
    return _fighters(spark, d).select("id").join(used, "id", "left_anti")


def _results(spark, d):
    b = _bouts(spark, d).filter("event_date is not null and winner_id is not null")
    sides = F.explode(F.array(F.struct(F.col("fighter1_id").alias("f")), F.struct(F.col("fighter2_id").alias("f")))).alias("s")
    return b.select("id", "winner_id", "event_date", sides).select(F.col("s.f").alias("fighter_id"), (F.datediff("event_date", F.lit("1970-01-01").cast("date")).cast("long") * 100000000 + F.col("id")).alias("ord"), F.when(F.col("s.f") == F.col("winner_id"), "W").otherwise("L").alias("result")).filter("fighter_id is not null")


def w1_streaks(spark, d):
    return matching.current_runs(_results(spark, d), "fighter_id", "ord", "result")


def w3_last_five(spark, d):
    top = matching.top_per_key(_results(spark, d), "fighter_id", [F.desc("ord")], 5)
    return top.groupBy("fighter_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("rank")).alias("r"), "result"))), lambda x: x["result"]), ",").alias("last_5_results"))


def x3_token_overlap(spark, d):
    """Listings and events of near dates that share most name words of more than three letters."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: F.length(w) > 3))
    b = table(spark, d, "event_batches").filter("date is not null").select("raw_id", F.col("date").alias("rd"), words("name").alias("t1"))
    e = table(spark, d, "mma_events").select(F.col("id").alias("event_id"), "date", words("name").alias("t2"))
    shared = F.size(F.array_intersect("t1", "t2"))
    return matching.band_pairs(b, e, "rd", "date").filter((shared >= 2) & (shared / F.least(F.size("t1"), F.size("t2")) >= 0.6)).select("raw_id", "event_id", shared.alias("shared"))


def x4_event_clusters(spark, d):
    """Events of one city and near dates, clustered around the first of each cluster."""
    e = table(spark, d, "mma_events").filter("date is not null and city is not null")
    a = e.select(F.col("id").alias("left"), F.col("date").alias("ld"), F.col("city").alias("lc"))
    pairs = matching.band_pairs(a, e.select(F.col("id").alias("right"), "date", "city"), "ld", "date", 3).filter("lc = city and left < right")
    return matching.leader_clusters(pairs, e)


QUERIES = {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")}

_RES = """res AS (SELECT x.f AS fighter_id, datediff('day', DATE '1970-01-01', b.event_date)::BIGINT * 100000000 + b.id AS ord, CASE WHEN x.f = b.winner_id THEN 'W' ELSE 'L' END AS result
    FROM event_fights b, LATERAL (SELECT unnest([b.fighter1_id, b.fighter2_id]) AS f) x WHERE b.event_date IS NOT NULL AND b.winner_id IS NOT NULL AND x.f IS NOT NULL)"""
_WORDS = "list_distinct(list_filter(string_split({0}, ' '), lambda x: length(x) {1}))"

ORACLES = {
    "j3_event_date": "SELECT b.id, e.date AS event_date FROM event_fights b JOIN mma_events e ON e.id = b.event_id",
    "f14_event_date_sync": "SELECT b.id, e.date AS new_date FROM event_fights b JOIN mma_events e ON e.id = b.event_id WHERE e.date IS DISTINCT FROM b.event_date",
    "j4_candidate_counts": "SELECT profile_id, CASE WHEN coalesce(n, 0) = 0 THEN 'none' WHEN n = 1 THEN 'one' ELSE 'many' END AS candidates FROM source_profiles p LEFT JOIN (SELECT lower(name) k, count(*) n FROM fighters GROUP BY 1) f ON f.k = lower(p.full_name)",
    "j5_birth_token_subset": f"WITH f AS (SELECT id, date_of_birth d, {_WORDS.format('lower(name)', '> 0')} t FROM fighters WHERE date_of_birth IS NOT NULL) SELECT a.id AS left_id, b.id AS right_id FROM f a JOIN f b ON a.d = b.d AND a.id < b.id WHERE len(list_intersect(a.t, b.t)) >= 2 AND len(list_intersect(a.t, b.t)) = least(len(a.t), len(b.t))",
    "j7_token_candidates": f"WITH p AS (SELECT profile_id id, unnest({_WORDS.format('lower(full_name)', '>= 4')}) t FROM source_profiles), f AS (SELECT id, unnest({_WORDS.format('lower(name)', '>= 4')}) t FROM fighters) SELECT p.id AS left_id, f.id AS right_id, count(*) AS shared FROM p JOIN f USING (t) GROUP BY 1, 2 HAVING count(*) >= 2",
    "j8_event_band": "SELECT b.raw_id, e.id AS event_id, datediff('day', e.date, b.date)::INT AS gap FROM event_batches b JOIN mma_events e ON e.date BETWEEN b.date - 1 AND b.date + 1 AND e.city = b.city",
    "j10_real_twins": f"WITH f AS (SELECT id, array_to_string(list_sort(string_split({KEY.format('name')}, ' ')), ' ') k, fight_history IS NULL AS shell FROM fighters) SELECT id FROM f WHERE shell AND k IN (SELECT k FROM f WHERE NOT shell)",
    "j11_unlinked_fighters": "SELECT id FROM fighters WHERE id NOT IN (SELECT fighter1_id FROM event_fights WHERE fighter1_id IS NOT NULL UNION SELECT fighter2_id FROM event_fights WHERE fighter2_id IS NOT NULL)",
    "w1_streaks": f"WITH {_RES}, l AS (SELECT fighter_id, arg_max(result, ord) last_value FROM res GROUP BY 1) SELECT fighter_id, last_value, count(*) AS run FROM res r JOIN l USING (fighter_id) WHERE ord > coalesce((SELECT max(q.ord) FROM res q WHERE q.fighter_id = r.fighter_id AND q.result <> l.last_value), -1) GROUP BY 1, 2",
    "w3_last_five": f"WITH {_RES}, k AS (SELECT *, row_number() OVER (PARTITION BY fighter_id ORDER BY ord DESC) r FROM res) SELECT fighter_id, string_agg(result, ',' ORDER BY ord) AS last_5_results FROM k WHERE r <= 5 GROUP BY 1",
    "x3_token_overlap": "WITH b AS (SELECT raw_id, date, list_distinct(list_filter(regexp_split_to_array(lower(name), '[^a-z0-9]+'), lambda x: length(x) > 3)) t FROM event_batches), e AS (SELECT id, date, list_distinct(list_filter(regexp_split_to_array(lower(name), '[^a-z0-9]+'), lambda x: length(x) > 3)) t FROM mma_events) SELECT raw_id, e.id AS event_id, len(list_intersect(b.t, e.t))::INT AS shared FROM b JOIN e ON e.date BETWEEN b.date - 1 AND b.date + 1 WHERE len(list_intersect(b.t, e.t)) >= 2 AND len(list_intersect(b.t, e.t)) / least(len(b.t), len(e.t)) >= 0.6",
}
