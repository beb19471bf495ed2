"""Pairwise matches consolidated into groups: minimum labels along edges, with pointer jumping.

Each round every vertex takes the smallest label among itself and its neighbours, the labels are shortened by
pointer jumping until they are roots, and the edges are rewritten between roots. Edges inside one root vanish,
so the edge table shrinks geometrically; the rounds end when no edge is left, that is when no label changes.
Every round's tables are written to the shared checkpoint folder; those of earlier rounds are deleted.

Scale: the minimum is a `groupBy` with map-side combine, so a hub with a third of all edges costs one partial
row per task. Joins look a key up in a table that has each key once; a hot key on the edge side is a skewed
join whose other side is one row, which adaptive execution splits without replicating anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordloom.session import discard, materialize


def _jump(labels: DataFrame) -> DataFrame:
    """Labels `(v, root)` with `root <= v` shortened until no label changes; each jump is written once."""
    while True:
        up = labels.select(F.col("v").alias("root"), F.col("root").alias("up"))
        nearer = F.coalesce("up", "root")
        jumped, seen = materialize(
            labels.join(up, "root", "left").select("v", nearer.alias("root"), (nearer != F.col("root")).alias("moved")), moved=F.max("moved")
        )
        discard(labels)
        labels = jumped.select("v", "root")
        labels._materialized_at = jumped._materialized_at
        if not seen["moved"]:
            return labels


def connected_groups(pairs: DataFrame, left: str, right: str, where: Column | None = None) -> DataFrame:
    """`(id, group_id)` for every id linked to another one, directly or through others; `group_id` is the
    smallest id of the group.

    Pairs count when `where` is true (null counts as false), both sides are present and differ. Repeated and
    reversed pairs change nothing, other columns are ignored, no pair gives an empty result. Ids may be of any
    orderable type.
    """
    used = pairs if where is None else pairs.filter(F.coalesce(where, F.lit(False)))
    a, b = F.col(f"`{left}`"), F.col(f"`{right}`")
    edges, seen = materialize(
        used.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), n=F.count(F.lit(1))
    )
    labels: DataFrame | None = None
    while seen["n"]:
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        nearest = both.groupBy(F.col("e.a").alias("v")).agg(F.min("e.b").alias("least"))
        roots = _jump(materialize(nearest.select("v", F.least("v", "least").alias("root")))[0])
        ends = roots.select(F.col("v").alias("a"), F.col("root").alias("ra"))
        other = roots.select(F.col("v").alias("b"), F.col("root").alias("rb"))
        between = edges.join(ends, "a").join(other, "b").filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        smaller, seen = materialize(between, n=F.count(F.lit(1)))
        discard(edges)
        edges = smaller
        if labels is None:
            labels = roots
        else:
            up = roots.select(F.col("v").alias("root"), F.col("root").alias("up"))
            composed, _ = materialize(labels.join(up, "root", "left").select("v", F.coalesce("up", "root").alias("root")))
            discard(labels)
            discard(roots)
            labels = composed
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("group_id"))
    return labels.select(F.col("v").alias("id"), F.col("root").alias("group_id"))
