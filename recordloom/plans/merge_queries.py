"""Queries over aggregations, merges and sorts, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import domain, history, text
from recordloom.operators import merge
from recordloom.session import table


def _halves(spark, d):
    """Two overlapping versions of the fighters table, stored and incoming, with values missing on either side."""
    f = table(spark, d, "fighters").select("id", "name", "nickname", "nationality", "weight_class_current", "stance", "record_total_wins", "data_quality_score", "is_verified", "is_active", "gender")
    old = f.filter("stance is not null or is_active").withColumn("nickname", F.when(F.col("is_active"), F.col("nickname"))).drop("is_active", "gender")
    new = f.filter("stance is null or record_total_wins > 1").select("id", F.upper("name").alias("name"), "nickname", F.concat("nationality", F.lit("+")).alias("nationality"), F.when(F.col("is_active"), F.col("weight_class_current")).alias("weight_class_current"), "stance", (F.col("record_total_wins") + 1).alias("record_total_wins"), "data_quality_score", F.lit(None).cast("boolean").alias("is_verified"), F.when(F.col("gender") == "F", "ufc").otherwise("tapology").alias("source"))
    return old, new


_COLUMNS = ("name", "nickname", "nationality", "weight_class_current", "stance", "record_total_wins", "data_quality_score", "is_verified")


def u1_three_policy_upsert(spark, d):
    return merge.upsert(*_halves(spark, d), "id", _COLUMNS, "source")


def f13_row_diff(spark, d):
    old, new = _halves(spark, d)
    return merge.row_diff(old, new, "id", ("name", "nickname", "nationality", "record_total_wins"))


def u8_record_chain(spark, d):
    cols = ["id", *[f"record_{k}_{p}" for k in ("total", "ufc", "other") for p in ("wins", "losses", "draws")]]
    return merge.record_chain(table(spark, d, "fighters").select(*cols))


def k6_replace_children(spark, d):
    """Events with a title bout keep their title bouts only, names in capitals."""
    b = table(spark, d, "event_fights").select("id", "event_id", "bout_order", "fighter1_name", "is_title_fight")
    new = b.filter("is_title_fight").withColumn("fighter1_name", F.upper("fighter1_name"))
    return merge.replace_children(b, new, "event_id").select("id", "event_id", "bout_order", "fighter1_name")


def a4_mode_share(spark, d):
    """Commonest class of a fighter's bouts where it has more than 0.55 of them; ties to the class seen first."""
    b = table(spark, d, "event_fights").filter("weight_class is not null")
    sides = b.select("id", "weight_class", F.explode(F.array("fighter1_id", "fighter2_id")).alias("fighter_id")).filter("fighter_id is not null")
    counts = sides.groupBy("fighter_id", "weight_class").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("seen"))
    best = counts.groupBy("fighter_id").agg(F.sum("n").alias("all"), F.max_by(F.struct("weight_class", "n"), F.struct("n", (-F.col("seen")).alias("s"))).alias("b"))
    return best.filter(F.col("b.n") / F.col("all") > 0.55).select("fighter_id", F.col("b.weight_class").alias("main_class"), F.col("b.n").alias("n"))


def a6_site_counts(spark, d):
    u = table(spark, d, "fighters").select("id", F.explode(F.split("data_source", r"\|")).alias("u"))
    return u.select("id", domain.url_source(F.trim("u")).alias("site")).filter("site <> 'unknown'").groupBy("id").agg(F.least(F.countDistinct("site"), F.lit(4)).cast("int").alias("sites"))


def a9_ordered_distinct(spark, d):
    return table(spark, d, "documents").filter("url is not null").groupBy("url").agg(F.min("doc_id").alias("first_doc"))


def a12_best_history(spark, d):
    """For each name the history of the most trusted source, the smaller id on ties."""
    f = table(spark, d, "fighters").filter("fight_history is not null")
    priority = domain.history_priority(history.history_source(F.col("fight_history")))
    best = F.max_by(F.struct("id", priority.alias("priority")), F.struct(priority, -F.col("id"))).alias("b")
    return f.groupBy(F.lower("name").alias("key")).agg(best).select("key", "b.id", "b.priority")


def a13_event_counts(spark, d):
    return table(spark, d, "event_fights").groupBy("event_id").agg(F.count("winner_id").alias("winners"), F.count(F.lit(1)).alias("bouts"))


def o1_top_rated(spark, d):
    f = table(spark, d, "fighters").select("id", "fightmatrix_rating_points", "record_total_wins")
    return f.orderBy(F.desc_nulls_last("fightmatrix_rating_points"), F.desc_nulls_last("record_total_wins"), "id").limit(50)


def l1_offset_limit(spark, d):
    return table(spark, d, "fighters").select("id", "name").orderBy("id").offset(20).limit(30)


def r1_ledger(spark, d):
    """Listings not yet processed when those of one feed are in the ledger."""
    b = table(spark, d, "event_batches")
    return b.join(b.filter("feed = 'tapology'").select("raw_id"), "raw_id", "left_anti").select("raw_id", "batch_id")


def q_latest_price_by_part(spark, d):
    """Order lines with the running revenue of their part, newest line of each part."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    best = F.max_by(F.struct("l_orderkey", "l_linenumber", "l_extendedprice"), F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("b")
    return li.groupBy("l_partkey").agg(best, F.count(F.lit(1)).alias("n")).select("l_partkey", "b.*", "n")


def q_pricing_summary(spark, d):
    li = table(spark, d, "lineitem").filter("l_shipdate <= '1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("sum_qty"), F.count(F.lit(1)).alias("count_order"))


QUERIES = {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")}

_KEY = "trim(regexp_replace(regexp_replace(lower(strip_accents(translate({0}, 'øØłŁ', 'oOlL'))), '[^a-z0-9 ]', '', 'g'), '\\s+', ' ', 'g'))"
_OLD = "SELECT id, name, CASE WHEN is_active THEN nickname END nickname, nationality, weight_class_current, stance, record_total_wins, data_quality_score, is_verified FROM fighters WHERE stance IS NOT NULL OR is_active"
_NEW = "SELECT id, upper(name) name, nickname, nationality || '+' nationality, CASE WHEN is_active THEN weight_class_current END weight_class_current, stance, record_total_wins + 1 record_total_wins, data_quality_score, NULL::BOOLEAN is_verified, CASE WHEN gender = 'F' THEN 'ufc' ELSE 'tapology' END source FROM fighters WHERE stance IS NULL OR record_total_wins > 1"
_PRIO = "CASE {0} WHEN 'tapology' THEN 4 WHEN 'ufcstats+scrape' THEN 3 WHEN 'ufcstats' THEN 3 WHEN 'event_scrape' THEN 3 WHEN 'ufc_fr' THEN 2 WHEN 'ufc' THEN 2 WHEN 'fightmatrix' THEN 2 WHEN 'underground' THEN 1 ELSE 0 END"
_SRC = "CASE WHEN json_valid(fight_history) THEN lower(trim(json_extract_string(fight_history, '$.source'))) END"
_FI = "CASE WHEN NOT coalesce(json_valid(fight_history), false) THEN [] WHEN ltrim(fight_history) LIKE '[%' THEN json_extract_string(fight_history, '$[*].result') ELSE json_extract_string(fight_history, '$.fights[*].result') END"
ORACLES = {
    "u1_three_policy_upsert": f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NOT NULL THEN o.name ELSE n.name END AS name, CASE WHEN o.id IS NULL THEN n.nickname WHEN n.source IN ('tapology', 'ufc', 'ufc_fr') THEN coalesce(n.nickname, o.nickname) ELSE coalesce(o.nickname, n.nickname) END AS nickname, CASE WHEN o.id IS NULL THEN n.nationality WHEN n.source IN ('ufc', 'ufc_fr') THEN coalesce(n.nationality, o.nationality) ELSE coalesce(o.nationality, n.nationality) END AS nationality, coalesce(n.weight_class_current, o.weight_class_current) AS weight_class_current, CASE WHEN o.id IS NULL THEN n.stance WHEN n.source IN ('ufc', 'ufc_fr') THEN coalesce(n.stance, o.stance) ELSE coalesce(o.stance, n.stance) END AS stance, coalesce(n.record_total_wins, o.record_total_wins) AS record_total_wins, coalesce(n.data_quality_score, o.data_quality_score) AS data_quality_score, coalesce(o.is_verified, n.is_verified) AS is_verified FROM o FULL OUTER JOIN n ON o.id = n.id",
    "f13_row_diff": f"WITH o AS ({_OLD}), n AS ({_NEW}), j AS (SELECT o.id, unnest([['name', o.name, n.name], ['nickname', o.nickname, n.nickname], ['nationality', o.nationality, n.nationality], ['record_total_wins', o.record_total_wins::VARCHAR, n.record_total_wins::VARCHAR]]) x FROM o JOIN n USING (id)) SELECT id, x[1] AS \"column\", CASE WHEN x[2] IS NULL THEN 'filled' ELSE 'overwritten' END AS change FROM j WHERE x[3] IS NOT NULL AND x[2] IS DISTINCT FROM x[3]",
    "u8_record_chain": "WITH t AS (SELECT id, greatest(coalesce(record_total_wins, 0), coalesce(record_ufc_wins, 0)) tw, greatest(coalesce(record_total_losses, 0), coalesce(record_ufc_losses, 0)) tl, greatest(coalesce(record_total_draws, 0), coalesce(record_ufc_draws, 0)) td, record_ufc_wins uw, record_ufc_losses ul, record_ufc_draws ud FROM fighters) SELECT id, tw AS record_total_wins, tl AS record_total_losses, td AS record_total_draws, uw AS record_ufc_wins, ul AS record_ufc_losses, ud AS record_ufc_draws, greatest(tw - coalesce(uw, 0), 0) AS record_other_wins, greatest(tl - coalesce(ul, 0), 0) AS record_other_losses, greatest(td - coalesce(ud, 0), 0) AS record_other_draws, tw + tl + td AS total_fights FROM t",
    "k6_replace_children": "WITH n AS (SELECT id, event_id, bout_order, upper(fighter1_name) fighter1_name FROM event_fights WHERE is_title_fight) SELECT id, event_id, bout_order, fighter1_name FROM event_fights WHERE event_id NOT IN (SELECT event_id FROM n) UNION ALL SELECT * FROM n",
    "a4_mode_share": "WITH s AS (SELECT id, weight_class, unnest([fighter1_id, fighter2_id]) f FROM event_fights WHERE weight_class IS NOT NULL), c AS (SELECT f, weight_class, count(*) n, min(id) m FROM s WHERE f IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY f) a, row_number() OVER (PARTITION BY f ORDER BY n DESC, m) k FROM c) SELECT f AS fighter_id, weight_class AS main_class, n FROM r WHERE k = 1 AND n / a > 0.55",
    "a6_site_counts": "WITH u AS (SELECT id, trim(unnest(string_split(data_source, '|'))) url FROM fighters), h AS (SELECT id, url, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/]*)', 1)) h FROM u), s AS (SELECT id, CASE WHEN contains(h, 'fightmatrix') THEN 'fightmatrix' WHEN contains(h, 'tapology') THEN 'tapology' WHEN contains(h, 'underground') THEN 'underground' WHEN contains(h, 'ufc-fr') THEN 'ufc_fr' WHEN contains(h, 'ufc') AND contains(lower(url), '/athlete/') THEN 'ufc' END s FROM h) SELECT id, least(count(DISTINCT s), 4)::INT AS sites FROM s WHERE s IS NOT NULL GROUP BY 1",
    "a9_ordered_distinct": "SELECT url, min(doc_id) AS first_doc FROM documents WHERE url IS NOT NULL GROUP BY 1",
    "a12_best_history": f"WITH f AS (SELECT lower(name) key, id, {_PRIO.format(_SRC)} p FROM fighters WHERE fight_history IS NOT NULL) SELECT key, id, p AS priority FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY p DESC, id) r FROM f) WHERE r = 1",
    "a13_event_counts": "SELECT event_id, count(winner_id) AS winners, count(*) AS bouts FROM event_fights GROUP BY 1",
    "o1_top_rated": "SELECT id, fightmatrix_rating_points, record_total_wins FROM fighters ORDER BY fightmatrix_rating_points DESC NULLS LAST, record_total_wins DESC NULLS LAST, id LIMIT 50",
    "l1_offset_limit": "SELECT id, name FROM fighters ORDER BY id LIMIT 30 OFFSET 20",
    "r1_ledger": "SELECT raw_id, batch_id FROM event_batches WHERE raw_id NOT IN (SELECT raw_id FROM event_batches WHERE feed = 'tapology')",
    "q_latest_price_by_part": "SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice, n FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) r, count(*) OVER (PARTITION BY l_partkey) n FROM lineitem) WHERE r = 1",
    "q_pricing_summary": "SELECT l_returnflag, l_linestatus, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS sum_qty, count(*) AS count_order FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2",
}
