"""Bouts applied to fighters: counters, streaks, last results and histories after a batch, on top of what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recordloom.functions import history
from recordloom.functions.domain import method_category
from recordloom.functions.text import opponent_key
from recordloom.operators.matching import current_runs, top_per_key

#: Days that two dates of one bout may lie apart.
SAME_BOUT = 4


def fighter_results(bouts: DataFrame) -> DataFrame:
    """One row for each fighter of each decided bout: `(fighter_id, opponent, opponent_id, opp, result, method, category,
    event_date, ord)`, `opp` being the opponent without rank.

    Bouts without a winner count as draws only where the method says so; others change nothing."""
    draw = F.coalesce(F.lower("method").contains("draw"), F.lit(False))
    sides = [F.struct(F.col(f"fighter{i}_id").alias("f"), F.col(f"fighter{j}_name").alias("o"), F.col(f"fighter{j}_id").alias("oid")) for i, j in ((1, 2), (2, 1))]
    flat = bouts.filter((F.col("winner_id").isNotNull() | draw) & F.col("event_date").isNotNull()).select("id", "winner_id", "method", "event_date", "event_id", "bout_order", F.explode(F.array(*sides)).alias("s"))
    result = F.when(F.col("winner_id").isNull(), "D").when(F.col("winner_id") == F.col("s.f"), "W").otherwise("L")
    order = F.struct("event_date", "event_id", "bout_order", "id")
    return flat.filter("s.f is not null").select(
        F.col("s.f").alias("fighter_id"), F.col("s.o").alias("opponent"), F.col("s.oid").alias("opponent_id"), F.coalesce(opponent_key(F.col("s.o")), F.lit("")).alias("opp"), result.alias("result"), "method",
        method_category(F.col("method")).alias("category"), "event_date", order.alias("ord"),
    )


def stored_fights(fighters: DataFrame) -> DataFrame:
    """`(id, fights)`: the stored histories without repetitions."""
    return fighters.select("id", history.without_duplicates(history.fights(F.col("fight_history"))).alias("fights"))


def not_present(results: DataFrame, fights: DataFrame) -> DataFrame:
    """Results that no stored fight tells of: one of the same opponent (by id, else by name) without a date or at most
    `SAME_BOUT` days apart. Of the results of one opponent that follow one another within so many days, the first."""
    flat = fights.select(F.col("id").alias("fid"), F.explode("fights").alias("f")).select("fid", F.coalesce(opponent_key(F.col("f.opponent")), F.lit("")).alias("fo"), F.col("f.opponent_id").alias("foid"), F.try_to_date(F.substring("f.event_date", 1, 10), "yyyy-MM-dd").alias("fd"))
    near = F.col("fd").isNull() | (F.abs(F.datediff("event_date", "fd")) <= SAME_BOUT)
    fresh = results.join(flat, (F.col("fighter_id") == F.col("fid")) & (F.col("opp") == F.col("fo")) & (F.col("opp") != "") & near, "left_anti")
    fresh = fresh.join(flat, (F.col("fighter_id") == F.col("fid")) & (F.col("opponent_id") == F.col("foid")) & near, "left_anti")
    before = F.lag("event_date").over(Window.partitionBy("fighter_id", "opp").orderBy("ord"))
    return fresh.withColumn("before", before).filter(F.col("before").isNull() | (F.datediff("event_date", "before") > SAME_BOUT)).drop("before")


def apply_bouts(fighters: DataFrame, bouts: DataFrame) -> DataFrame:
    """Every fighter with a new bout, after it: record, last date, streak and last five results carried on from the stored
    ones in order of date, method counters recounted over the whole history, and that history, newest first.

    A bout a history tells of already changes nothing, so applying a batch twice equals applying it once."""
    new = not_present(fighter_results(bouts), stored_fights(fighters))
    count = lambda r: F.count_if(F.col("result") == r)
    added = new.groupBy("fighter_id").agg(count("W").alias("w"), count("L").alias("l"), count("D").alias("d"), F.max("event_date").alias("last"))
    runs = current_runs(new, "fighter_id", "ord", "result")
    newest = top_per_key(new.select("fighter_id", "result", "ord"), "fighter_id", [F.desc("ord")], 5).groupBy("fighter_id").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("rank")).alias("k"), "result"))), lambda x: x["result"]).alias("five"))
    # The new fights are part of the row that holds them, so they are listed for each fighter.
    told = F.struct("result", "opponent", "opponent_id", F.lit(None).cast("string").alias("opponent_record"), F.lit(None).cast("string").alias("event"), F.col("event_date").cast("string").alias("event_date"), F.lit("").alias("date"), "method", F.lit(None).cast("string").alias("method_detail"), F.lit(None).cast("int").alias("round"), F.lit(None).cast("string").alias("raw"))
    listed = new.groupBy("fighter_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", told.alias("f"))), asc=False), lambda x: x["f"]).alias("fresh"))
    f = fighters.join(added, fighters["id"] == added["fighter_id"]).drop("fighter_id").join(runs, F.col("id") == F.col("fighter_id")).drop("fighter_id")
    f = f.join(newest, F.col("id") == F.col("fighter_id")).drop("fighter_id").join(listed, F.col("id") == F.col("fighter_id")).drop("fighter_id")
    f = f.withColumn("stored", history.without_duplicates(history.fights(F.col("fight_history"))))
    whole = F.concat("fresh", "stored")
    # Undated entries stay behind the dated ones that stood before them: each takes the day of the entry above it.
    dated = F.aggregate("stored", F.struct(F.lit("9999").alias("d"), F.array().cast("array<string>").alias("ds")), lambda s, x: F.struct(F.coalesce(F.nullif(F.substring(x["event_date"], 1, 10), F.lit("")), s["d"]).alias("d"), F.concat(s["ds"], F.array(F.coalesce(F.nullif(F.substring(x["event_date"], 1, 10), F.lit("")), s["d"]))).alias("ds")))["ds"]
    days = F.concat(F.transform("fresh", lambda x: x["event_date"]), dated)
    order = F.array_sort(F.transform(days, lambda x, i: F.struct(x.alias("d"), (-i).alias("i"))))
    merged = F.transform(F.reverse(order), lambda x: F.element_at(whole, (1 - x["i"]).cast("int")))
    base = lambda c: F.coalesce(F.col(c), F.lit(0))
    wins, losses, draws = base("record_total_wins") + F.col("w"), base("record_total_losses") + F.col("l"), base("record_total_draws") + F.col("d")
    kept = F.filter(F.transform(F.split(F.coalesce("last_5_results", F.lit("")), ","), lambda x: F.upper(F.trim(x))), lambda x: x.isin("W", "L", "D"))
    five = F.concat(kept, F.col("five"))
    streak_n, streak_kind = (F.regexp_extract(F.upper(F.coalesce("current_streak", F.lit(""))), r"^\s*(\d+)([WLD])", i) for i in (1, 2))
    carried = F.when((F.col("run") == F.col("w") + F.col("l") + F.col("d")) & (streak_kind == F.col("last_value")), streak_n.try_cast("int")).otherwise(0)
    by = lambda r, c: F.size(F.filter("merged", lambda x: (F.upper(x["result"]) == r) & (method_category(history.method_of(x)) == c)))
    out = f.withColumn("merged", merged)
    return out.select(
        "id", wins.alias("wins"), losses.alias("losses"), draws.alias("draws"), (wins + losses + draws + base("record_total_nc")).alias("total_fights"),
        *[by(r, c).alias(f"{c}_{n}") for r, n in (("W", "wins"), ("L", "losses")) for c in ("ko", "sub", "dec")], F.greatest("last_fight_date", "last").alias("last_fight_date"),
        F.concat((F.col("run") + carried).cast("string"), "last_value").alias("current_streak"), F.array_join(F.slice(five, F.greatest(F.size(five) - 4, F.lit(1)), 5), ",").alias("last_5_results"), F.size("merged").alias("n_history"),
        F.to_json(F.struct(F.lit("event_scrape").alias("source"), F.size("merged").alias("count"), F.col("merged").alias("fights"))).alias("fight_history"),
    )
