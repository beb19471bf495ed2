"""Best representative of each duplicate group, field by field, in a single aggregation.

Every attribute competes on its own: the maximum of a struct (value present, source priority, timestamp, value)
picks it, so one `groupBy` with map-side combine builds the whole surviving record whatever the group sizes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def history_entries(text: Column) -> Column:
    """Entries of a JSON history: an object's `fights` or a bare list; 0 for null, invalid JSON (also a value with more
    behind it) or no list."""
    ends = F.trim(F.regexp_replace(text, r"^\s+|\s+$", "")).rlike(r"(?s)^(?:\{.*\}|\[.*\])$")
    parsed = F.try_parse_json(F.when(ends, text))
    listed = lambda path: F.try_variant_get(parsed, path, "array<variant>")
    whole = F.substring(F.ltrim(text), 1, 1)
    return F.coalesce(F.when(whole == "[", F.size(listed("$"))).when(whole == "{", F.size(listed("$.fights"))), F.lit(0))


def surviving_records(members: DataFrame, group: str, attributes: Iterable[str], priority: Column | Mapping[str, Column], timestamp: Column) -> DataFrame:
    """One record for each group: of every attribute the value that is present, from the most trusted row,
    then the latest, then the largest. `priority` is one for all attributes, or one for each.

    Blank strings count as missing. Rows with a null group are no members. Attributes missing in all rows stay
    null; repeated rows change nothing; ties fall to the larger value, so the result doesn't depend on order.
    """
    attributes = [a for a in attributes if a != group]
    ranked = members.filter(F.col(f"`{group}`").isNotNull()).select(
        F.col(f"`{group}`").alias("group__"), timestamp.alias("at__"), *[F.col(f"`{a}`").alias(f"v{i}__") for i, a in enumerate(attributes)],
        *([priority[a].alias(f"p{i}__") for i, a in enumerate(attributes)] if isinstance(priority, Mapping) else [priority.alias("p__")]),
    )
    types = dict(ranked.dtypes)
    best = []
    for i, _ in enumerate(attributes):
        value = F.col(f"v{i}__")
        present = value.isNotNull() & (F.trim(value) != "") if types[f"v{i}__"] == "string" else value.isNotNull()
        best.append(F.max(F.struct(present.alias("present"), F.col(f"p{i}__" if isinstance(priority, Mapping) else "p__").alias("priority"), "at__", F.when(present, value).alias("value"))).alias(f"b{i}__"))
    grouped = ranked.groupBy("group__").agg(*best, F.count(F.lit(1)).alias("rows__"))
    return grouped.select(F.col("group__").alias(group), *[F.col(f"b{i}__.value").alias(a) for i, a in enumerate(attributes)], F.col("rows__").alias("n_rows"))


def dominant_rows(members: DataFrame, group: str, id_col: str, respects: Iterable[Column]) -> DataFrame:
    """`(group, id)` of the row that is best in every respect and better than each other row in one at least.

    Nulls are lowest. Every respect is an attribute whose largest value survives (`surviving_records`); a row is the best in
    all when it equals the survivor, and stands alone when no other row does. Groups without such a row don't appear.
    Repeated rows of one id count as one.
    """
    respects = list(respects)
    names = [f"r{i}" for i in range(len(respects))]
    m = members.select(F.col(f"`{group}`").alias("g"), F.col(f"`{id_col}`").alias("i"), *[r.alias(n) for n, r in zip(names, respects)]).filter("g is not null and i is not null")
    best = surviving_records(m, "g", names, {n: F.col(n) for n in names}, F.lit(0)).select(F.col("g").alias("bg"), *[F.col(n).alias(f"b{n}") for n in names])
    equal = F.lit(True)
    for n in names:
        equal = equal & F.col(n).eqNullSafe(F.col(f"b{n}"))
    alone = m.join(best, F.col("g") == F.col("bg")).filter(equal).groupBy("g").agg(F.min("i").alias("i"), F.max("i").alias("last")).filter("i = last")
    return alone.select(F.col("g").alias(group), F.col("i").alias(id_col))
