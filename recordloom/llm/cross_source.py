"""Entities of two tables without a common key, matched by BM25 over all attributes.

Every record is a bag of terms (names, parts and spellings of names, dates, country, class, record ...). The
inverted index holds the terms of the known records; a query's score for a record is the sum over shared terms.
Any term may look a record up. The `k` best records of a query are exact among those that reach `floor` times the
query's own mass, the weights of its heaviest term of each `group` (by default kind; unknown terms weigh most): the terms of a query are
sorted by weight, and one is essential when it and those after it can still reach the floor. A record that shares no
essential term cannot reach it. As the floor is a share of the query's mass, it means the same at any number of
records, and terms that a third of all records have are too light to look up anything.

A pair matches when each is the other's best within its source (mutual nearest). The confidence is a logistic
function of score, gap to the runner-up and agreeing attributes. It is calibrated on a bounded sample of pairs that an
attribute left out of all these features (`label`) tells apart; what that attribute says of a pair is added as the log
ratio of how often it says so of matches and of others.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordloom.session import checkpoint

CALIBRATION = 20_000
#: A missing attribute makes a record no better match, so its length doesn't count.
K1, B = 1.2, 0.0


def bm25_candidates(known: DataFrame, queries: DataFrame, floor: float, k: int | None, weight: Column, kind: Callable[[Column], Column], apart: Callable[[Column], Column] | None = None, group: Callable[[Column], Column] | None = None, sketches: tuple[str, ...] = (), bits: int = 0) -> DataFrame:
    """`(query, key, score, rest, share, shared, differ)`: the `k` best records (all where `k` is none, more than `k` on equal
    scores) of each query among those that reach `floor` times its mass.

    Both inputs are `(key, terms)` with distinct terms as numbers; `weight` weighs a column `term`, `kind` tells a term's
    kind. `rest` is the score without the terms that `apart` sets apart, `share` the score as a share of
    the mass; `shared` are the kinds of shared terms, `differ` the kinds both have without sharing a term. Records
    without terms match nothing.

    Where both inputs have 64-bit `sketches`, a pair counts only if one of either side differ in at most `bits` bits. That is
    tested where postings meet, before a pair is moved: a condition that must hold anyway saves moving the rest."""
    facts = known.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("terms")).alias("mean")).first()
    n, mean = float(facts["n"] or 0), float(facts["mean"] or 1.0)
    norm = (K1 + 1) / (1 + K1 * (1 - B + B * F.size("terms") / F.lit(mean)))
    index = known.select("key", *sketches, F.explode("terms").alias("term"))
    flat = queries.select("key", F.explode("terms").alias("term"))
    df = index.join(flat.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    found = F.coalesce("df", F.lit(0))
    idf = F.log1p((F.lit(n) - found + 0.5) / (found + 0.5)) * weight
    # The most a term can add: its weight for a record of one term.
    most = (K1 + 1) / (1 + K1 * (1 - B))
    asked = flat.join(df, "term", "left").groupBy("key").agg(F.collect_list(F.struct(idf.alias("w"), "term", F.col("df").isNotNull().alias("known"))).alias("e"))
    group = group or kind
    best_of = lambda name: F.array_max(F.transform(F.filter("e", lambda x: group(x["term"]) == name), lambda x: x["w"]))
    mass = F.aggregate(F.array_distinct(F.transform("e", lambda x: group(x["term"]))), F.lit(0.0), lambda s, name: s + best_of(name))
    rising = F.array_sort(F.transform(F.filter("e", lambda x: x["known"]), lambda x: F.struct(x["w"].alias("w"), x["term"].alias("term"))))
    begun = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<bigint>").alias("terms"))

    def further(s: Column, x: Column) -> Column:
        total = s["sum"] + x["w"] * most
        return F.struct(total.alias("sum"), F.when(total >= floor * F.col("mass"), F.concat(s["terms"], F.array(x["term"]))).otherwise(s["terms"]).alias("terms"))

    q = asked.select(F.col("key").alias("query"), "e", mass.alias("mass")).select("query", "mass", rising.alias("known"))
    q = checkpoint(q.select("query", "mass", F.aggregate("known", begun, further)["terms"].alias("essential"), F.map_from_entries(F.transform("known", lambda x: F.struct(x["term"], x["w"]))).alias("weights")))
    looked_up = q.select("query", F.explode("essential").alias("term"))
    close = F.lit(not sketches)
    if sketches:
        looked_up = looked_up.join(queries.select(F.col("key").alias("query"), *[F.col(c).alias(f"q_{c}") for c in sketches]), "query")
        for c in sketches:
            for other in sketches:
                close = close | F.coalesce(F.bit_count(F.col(f"q_{c}").bitwiseXOR(F.col(other))) <= bits, F.lit(False))
    met = looked_up.join(index, "term").filter(close).select("query", "key").distinct()
    paired = met.join(known.select("key", "terms", norm.alias("norm")), "key").join(q, "query")
    hits = F.filter("terms", lambda t: F.map_contains_key("weights", t))
    total = lambda ts: F.aggregate(ts, F.lit(0.0), lambda s, t: s + F.try_element_at("weights", t)) * F.col("norm")
    scored = paired.withColumn("hits", hits).withColumn("score", total("hits")).filter(F.col("score") >= floor * F.col("mass"))
    kinds = lambda ts: F.array_distinct(F.transform(ts, kind))
    rest = total(F.filter("hits", lambda t: ~apart(t))) if apart is not None else F.col("score")
    both = F.array_intersect(kinds("terms"), kinds(F.map_keys("weights")))
    told = scored.select("query", "key", "score", rest.alias("rest"), (F.col("score") / F.col("mass")).alias("share"), kinds("hits").alias("shared"), F.array_except(both, kinds("hits")).alias("differ"))
    if k is None:
        return told
    return told.withColumn("rank", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).filter(F.col("rank") <= k).drop("rank")


def mutual_best(scored: DataFrame, source: str = "source") -> DataFrame:
    """Pairs of which each is the other's best, with `gap` to the runner-up on either side.

    `scored` is `(query, source, key, score, ...)`; a known record has a best query for each source. Ties have no best.
    """
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    by_key = Window.partitionBy(source, "key").orderBy(F.desc("score"), "query")
    ranked = scored.select(
        "*", F.row_number().over(by_query).alias("rq"), F.lead("score").over(by_query).alias("next_q"), F.row_number().over(by_key).alias("rk"), F.lead("score").over(by_key).alias("next_k")
    )
    gap = F.col("score") - F.greatest(F.coalesce("next_q", F.lit(0.0)), F.coalesce("next_k", F.lit(0.0)))
    return ranked.filter("rq = 1 and rk = 1").withColumn("gap", gap).filter("gap > 0").drop("rq", "rk", "next_q", "next_k")


def fit_logistic(rows: list[tuple[list[float], int]], steps: int = 400, rate: float = 0.3) -> tuple[list[float], list[float], list[float]]:
    """Weights (bias first), means and scales of a logistic model, by gradient descent."""
    if not rows or len({y for _, y in rows}) < 2:
        return [2.0], [], []
    k = len(rows[0][0])
    mean = [sum(x[i] for x, _ in rows) / len(rows) for i in range(k)]
    scale = [math.sqrt(sum((x[i] - mean[i]) ** 2 for x, _ in rows) / len(rows)) or 1.0 for i in range(k)]
    import numpy as np

    x = np.array([[1.0, *((v - m) / s for v, m, s in zip(f, mean, scale))] for f, _ in rows])
    y = np.array([t for _, t in rows], float)
    w = np.zeros(k + 1)
    for _ in range(steps):
        w -= rate * (x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y) + 1e-4 * w)
    return w.tolist(), mean, scale


def calibrated(pairs: DataFrame, features: Mapping[str, Column], label: Column, says: Mapping[str, Column], sample: int = CALIBRATION) -> DataFrame:
    """`pairs` with a `confidence`: a logistic model of `features`, fitted on at most `sample` rows whose `label` is known
    (1 same, 0 different, null unknown; in hash order), and the log ratio of what the labelling attribute `says`.

    `says` are named conditions that exclude one another; one that holds for a pair shifts it by how much more often it
    holds for the sample's likely matches than for the others. Where none holds the model decides alone."""
    named = pairs.select("*", *[c.cast("double").alias(f"f_{n}") for n, c in features.items()], *[F.coalesce(c, F.lit(False)).alias(f"s_{n}") for n, c in says.items()], label.alias("label"))
    rows = named.filter("label is not null").orderBy(F.xxhash64("query", "key")).limit(sample).select(*[f"f_{n}" for n in features], *[f"s_{n}" for n in says], "label").collect()
    x = [[float(r[f"f_{n}"]) for n in features] for r in rows]
    labelled = [(v, int(r["label"])) for v, r in zip(x, rows)]
    # Twice: what is labelled different but looks the same has a wrong label (a wrong birth date) and is left out.
    for _ in range(2):
        w, mean, scale = fit_logistic(labelled)
        of = lambda v: w[0] + sum(wi * (vi - m) / s for vi, wi, m, s in zip(v, w[1:], mean, scale))  # noqa: B023, E731
        likely = [1 / (1 + math.exp(-max(-30.0, min(30.0, of(v))))) for v in x]
        labelled = [(v, int(r["label"])) for v, r, p in zip(x, rows, likely) if r["label"] or p < 0.5]
    logit = F.lit(w[0])
    for n, wi, m, s in zip(features, w[1:], mean, scale):
        logit = logit + F.lit(wi) * (F.col(f"f_{n}") - F.lit(m)) / F.lit(s)
    matches, others = sum(likely) + 1, len(likely) - sum(likely) + 1
    for n in says:
        held = sum(p for p, r in zip(likely, rows) if r[f"s_{n}"]) + 0.5, sum(1 - p for p, r in zip(likely, rows) if r[f"s_{n}"]) + 0.5
        logit = logit + F.when(F.col(f"s_{n}"), math.log(held[0] / matches) - math.log(held[1] / others)).otherwise(0.0)
    return named.withColumn("confidence", F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))).drop(*[f"f_{n}" for n in features], *[f"s_{n}" for n in says], "label")
