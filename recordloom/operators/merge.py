"""Conflict-resolving merges: column policies as data, set unions, arbitration, validation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Write policies of the columns; those not named are filled only where empty.
NEVER = ("name", "created_at")
REFRESH = (
    "gender weight_class_current weight_class_origin record_total_wins record_total_losses record_total_draws record_total_nc record_ufc_wins record_ufc_losses record_ufc_draws "
    "record_other_wins record_other_losses record_other_draws wins_by_ko_tko wins_by_submission wins_by_decision losses_by_ko_tko losses_by_submission losses_by_decision last_fight_date "
    "days_inactive is_active current_league is_ufc_champion total_fights win_percentage_int finish_rate_int current_streak last_5_results data_quality_score last_scraped_at updated_at notes"
).split()
AUTHORITY = {
    "nickname": ("tapology", "ufc", "ufc_fr"), "date_of_birth": ("tapology", "ufc", "ufc_fr"), "nationality": ("ufc", "ufc_fr"), "photo_url": ("tapology",),
    "photo_thumbnail_url": ("ufc_fr",), "height_inches": ("tapology", "ufc", "ufc_fr"), "reach_inches": ("tapology", "ufc", "ufc_fr"), "stance": ("ufc", "ufc_fr"),
    "first_sport": ("ufc", "ufc_fr"), "career_debut_date": ("fightmatrix", "tapology"),
}


def policy_value(column: str, old: Column, new: Column, source: Column) -> Column:
    """Merged value of a column; a missing incoming value never writes."""
    if column in NEVER:
        return old
    if column in REFRESH:
        return F.coalesce(new, old)
    if column in AUTHORITY:
        return F.when(source.isin(*AUTHORITY[column]), F.coalesce(new, old)).otherwise(F.coalesce(old, new))
    return F.coalesce(old, new)


def upsert(old: DataFrame, new: DataFrame, key: str, columns: Iterable[str], source: str) -> DataFrame:
    """Full outer merge on `key`: rows of either side, each column by its policy. `new` has one row for a key and
    a column `source`. Rows with a null key are kept from `old` and never match."""
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    there = F.col(f"o.{key}").isNotNull()
    values = [F.when(there, policy_value(c, F.col(f"o.{c}"), F.col(f"n.{c}"), F.col(f"n.{source}"))).otherwise(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}"))).alias(c) for c in columns]
    return joined.select(F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key), *values)


def union_sets(*packed: Column, separator: str = "|") -> Column:
    """Ordered union of separator-packed sets, ` | ` between values; null where all are empty."""
    pattern = "\\" + separator
    parts = [F.filter(F.transform(F.split(F.coalesce(p, F.lit("")), pattern), lambda x: F.trim(x)), lambda x: x != "") for p in packed]
    return F.nullif(F.array_join(F.array_distinct(F.concat(*parts)), f" {separator} "), F.lit(""))


def group_merge(members: DataFrame, group: str, rank: Column, first_of: Iterable[str] = (), max_of: Iterable[str] = (), argmax: Mapping[str, Column] | None = None) -> DataFrame:
    """One row for each group: first non-empty values in order of `rank` (ascending struct), maxima with 0 as
    missing, and arg-maxima by priority (the earlier rank wins ties). Plain aggregates with partial combine."""
    m = members.withColumn("rank__", rank)
    aggs = []
    for c in first_of:
        filled = F.col(c).isNotNull() & ((F.trim(c) != "") if dict(members.dtypes)[c] == "string" else F.lit(True))
        aggs.append(F.min_by(F.when(filled, F.col(c)), F.when(filled, F.col("rank__"))).alias(c))
    aggs += [F.nullif(F.max(F.coalesce(F.col(c), F.lit(0))), F.lit(0)).alias(c) for c in max_of]
    for c, priority in (argmax or {}).items():
        aggs.append(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct((-priority).alias("p"), F.col("rank__").alias("r")))).alias(c))
    return m.groupBy(group).agg(*aggs)


def record_chain(df: DataFrame) -> DataFrame:
    """Record columns made consistent, later steps reading earlier ones: total at least the promotion's part,
    other = total - that part, fights = wins + losses + draws."""
    parts = ("wins", "losses", "draws")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    floored = df.withColumns({f"record_total_{p}": F.greatest(zero(f"record_total_{p}"), zero(f"record_ufc_{p}")) for p in parts})
    other = floored.withColumns({f"record_other_{p}": F.greatest(zero(f"record_total_{p}") - zero(f"record_ufc_{p}"), F.lit(0)) for p in parts})
    return other.withColumn("total_fights", sum((F.col(f"record_total_{p}") for p in parts[1:]), F.col("record_total_wins")))


def row_diff(before: DataFrame, after: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """`(key, column, change)` of rows in both: `filled` where a value came, `overwritten` where it changed."""
    b, a = before.alias("b"), after.alias("a")
    changes = [
        F.struct(F.lit(c).alias("column"), F.when(F.col(f"b.{c}").isNull() & F.col(f"a.{c}").isNotNull(), "filled").when(F.col(f"a.{c}").isNotNull() & ~F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")), "overwritten").alias("change"))
        for c in columns
    ]
    joined = b.join(a, F.col(f"b.{key}") == F.col(f"a.{key}"))
    return joined.select(F.col(f"b.{key}").alias(key), F.explode(F.array(*changes)).alias("c")).select(key, "c.*").filter("change is not null")


def violations(df: DataFrame, key: str, checks: Mapping[str, Column]) -> DataFrame:
    """`(key, check)` for each row that breaks a check (a condition that must not be false)."""
    broken = F.filter(F.array(*[F.when(~c, F.lit(n)) for n, c in checks.items()]), lambda x: x.isNotNull())
    return df.select(key, F.explode(broken).alias("check"))


def replace_children(old: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """Child rows after a delete-and-insert of every parent present in `new`."""
    return old.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new)
