"""Record matching: blocking joins, ladders, band joins, overlaps. No operator plans a nested loop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordloom.functions.dates import same_birth
from recordloom.session import checkpoint, materialize


def one_per_key(df: DataFrame, key: Column, id_col: str) -> DataFrame:
    """`(key, id)` with the smallest id of each key, null keys left out."""
    return df.select(key.alias("key"), F.col(id_col).alias("id")).filter("key is not null").groupBy("key").agg(F.min("id").alias("id"))


def match_ladder(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """`(in_id, stored_id, status)` for each incoming `(in_id, key, dob)` against stored `(id, key, dob)`.

    With a birth date: the same name and date, else the only undated one of that name, else the same year within
    90 days, else a new homonym. Without one: the only one of that name, several are ambiguous. No name: new.
    Ambiguous rows get no id. The candidates of a name are aggregated, never listed."""
    undated, any_of = F.col("dob").isNull(), F.col("key").isNotNull()
    names = stored.filter(any_of).groupBy("key").agg(F.count("id").alias("n"), F.count_if(undated).alias("n_undated"), F.min(F.when(undated, F.col("id"))).alias("undated"), F.min("id").alias("any"))
    exact = stored.filter(any_of & ~undated).groupBy("key", "dob").agg(F.min("id").alias("exact"))
    i = incoming.join(names, "key", "left").join(exact, ["key", "dob"], "left")
    # Within 90 days: stored dates of the same name and year; a name holds as many dates as persons.
    open_ = i.filter("dob is not null and exact is null and n_undated = 0").select("in_id", "key", "dob", F.year("dob").alias("y"))
    dated = exact.select("key", F.col("dob").alias("other"), "exact", F.year("dob").alias("y"))
    close = open_.join(dated, ["key", "y"]).filter(same_birth(F.col("dob"), F.col("other"))).groupBy("in_id").agg(F.min("exact").alias("near"))
    facts = i.join(close, "in_id", "left").select("in_id", "dob", F.coalesce("n", F.lit(0)).alias("n"), "exact", F.coalesce("n_undated", F.lit(0)).alias("n_undated"), "undated", "near", "any")
    status = (
        F.when(F.col("n") == 0, "new").when(F.col("dob").isNull(), F.when(F.col("n") == 1, "name_only").otherwise("ambiguous"))
        .when(F.col("exact").isNotNull(), "name_dob").when(F.col("n_undated") == 1, "name_only").when(F.col("n_undated") > 1, "ambiguous")
        .when(F.col("near").isNotNull(), "name_close_dob").otherwise("new_homonym")
    )
    chosen = F.when(F.col("dob").isNull() & (F.col("n") == 1), F.col("any")).when(F.col("dob").isNotNull(), F.coalesce("exact", F.when(F.col("n_undated") == 1, F.col("undated")), F.when(F.col("n_undated") == 0, F.col("near"))))
    return facts.select("in_id", chosen.alias("stored_id"), status.alias("status"))


def token_subset_pairs(left: DataFrame, right: DataFrame, block: str, least: int = 2) -> DataFrame:
    """Pairs `(left_id, right_id)` of `(id, tokens, block)` rows in one block where one token set holds the other
    and they share at least `least` tokens."""
    a, b = left.alias("a"), right.alias("b")
    shared = F.size(F.array_intersect("a.tokens", "b.tokens"))
    joined = a.join(b, (F.col(f"a.{block}") == F.col(f"b.{block}")) & (F.col("a.id") < F.col("b.id")))
    return joined.filter((shared >= least) & (shared == F.least(F.size("a.tokens"), F.size("b.tokens")))).select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"))


def token_candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """`(left_id, right_id, shared)`: pairs of `(id, tokens)` rows that share a token, by an equi-join on tokens."""
    a = left.select(F.col("id").alias("left_id"), F.explode("tokens").alias("token"))
    b = right.select(F.col("id").alias("right_id"), F.explode("tokens").alias("token"))
    return a.join(b, "token").groupBy("left_id", "right_id").agg(F.count(F.lit(1)).alias("shared"))


def token_pair_candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """`(left_id, right_id, shared)`: pairs of `(id, tokens)` rows that share two tokens or more, by an equi-join on pairs of
    tokens, so a given name alone brings no rows together. `id` is unique on each side, `tokens` are distinct. A pair of rows
    is kept where its first two shared tokens meet; nothing is gathered after the join."""

    def sides(df: DataFrame, prefix: str) -> DataFrame:
        t = df.select(F.col("id").alias(f"{prefix}_id"), F.array_sort("tokens").alias(f"{prefix}_t")).filter(F.size(f"{prefix}_t") >= 2)
        t = t.select("*", F.posexplode(f"{prefix}_t").alias("at", "x"))
        return t.select(f"{prefix}_id", f"{prefix}_t", "x", F.explode(F.slice(f"{prefix}_t", F.col("at") + 2, F.size(f"{prefix}_t"))).alias("y"))

    common = F.array_intersect("left_t", "right_t")
    # Two words on either side are the two that met.
    met = sides(left, "left").join(sides(right, "right"), ["x", "y"]).withColumn("common", F.when(F.least(F.size("left_t"), F.size("right_t")) > 2, common))
    first = F.col("common").isNull() | ((F.col("common")[0] == F.col("x")) & (F.col("common")[1] == F.col("y")))
    return met.filter(first).select("left_id", "right_id", F.when(F.col("common").isNull(), 2).otherwise(F.size("common")).cast("long").alias("shared"))


def band_pairs(left: DataFrame, right: DataFrame, left_day: str, right_day: str, days: int = 1) -> DataFrame:
    """Pairs whose dates lie at most `days` apart; one side is exploded over the days, so it is an equi-join."""
    spread = left.withColumn("day__", F.explode(F.sequence(F.date_sub(left_day, days), F.date_add(left_day, days))))
    return spread.join(right, F.col("day__") == F.col(right_day)).drop("day__")


def bout_pairs(bouts: DataFrame, event: str, a: str, b: str) -> DataFrame:
    """Distinct unordered pairs `(event, p, q)` of names longer than three letters."""
    names = bouts.select(F.col(event).alias("event"), F.lower(F.trim(a)).alias("a"), F.lower(F.trim(b)).alias("b")).filter("length(a) > 3 and length(b) > 3")
    return names.select("event", F.least("a", "b").alias("p"), F.greatest("a", "b").alias("q")).distinct()


def pair_overlap(pairs: DataFrame, least: int = 2, ratio: float = 0.5) -> DataFrame:
    """`(left_event, right_event, shared)` of events that share `least` pairs, or `ratio` of the smaller one."""
    sizes = pairs.groupBy("event").agg(F.count(F.lit(1)).alias("n"))
    x, y = pairs.alias("x"), pairs.alias("y")
    shared = x.join(y, (F.col("x.p") == F.col("y.p")) & (F.col("x.q") == F.col("y.q")) & (F.col("x.event") < F.col("y.event")))
    counted = shared.groupBy(F.col("x.event").alias("left_event"), F.col("y.event").alias("right_event")).agg(F.count(F.lit(1)).alias("shared"))
    sized = counted.join(sizes.toDF("left_event", "n1"), "left_event").join(sizes.toDF("right_event", "n2"), "right_event")
    return sized.filter((F.col("shared") >= least) | (F.col("shared") / F.least("n1", "n2") >= ratio)).select("left_event", "right_event", "shared")


def best_per_key(scored: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The row of the highest score for each key, the smaller `tie` on equal scores; an aggregate, no sort."""
    rest = [c for c in scored.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(F.col(score), (-F.col(tie)).alias("t"))).alias("best")
    return scored.groupBy(key).agg(best).select(key, "best.*")


def top_per_key(df: DataFrame, key: str, order: list[Column], n: int, salts: int = 16) -> DataFrame:
    """The first `n` rows of each key in a total order, with `rank`. Ranked within salted parts first, so a key with
    a third of all rows is never sorted by one task whole."""
    salted = df.withColumn("salt__", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    part = salted.withColumn("rank", F.row_number().over(Window.partitionBy(key, "salt__").orderBy(*order))).filter(F.col("rank") <= n).drop("rank", "salt__")
    return part.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rank") <= n)


def current_runs(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """`(key, last_value, run)`: length of the newest run of one value, by three aggregates instead of a window."""
    last = df.groupBy(key).agg(F.max_by(value, order).alias("last_value"))
    joined = df.join(last, key)
    broken = joined.groupBy(key, "last_value").agg(F.max(F.when(~F.col(value).eqNullSafe(F.col("last_value")), F.col(order))).alias("broken_at"))
    kept = df.join(broken, key).filter(F.col("broken_at").isNull() | (F.col(order) > F.col("broken_at")))
    return kept.groupBy(key, "last_value").agg(F.count(F.lit(1)).alias("run"))


def leader_clusters(similar: DataFrame, members: DataFrame) -> DataFrame:
    """`(id, leader)`: greedy clusters in id order, a member joins the smallest earlier leader it is similar to.

    `similar` holds `(left, right)` with left < right. Rounds: a row all of whose smaller neighbours are settled
    is settled next; every round is one aggregate."""
    from recordloom.session import checkpoint

    state = checkpoint(members.select("id").distinct().withColumn("leader", F.lit(None).cast("long")))
    edges = checkpoint(similar.select("left", "right").distinct())
    while True:
        before = state.alias("b")
        near = edges.join(before, F.col("left") == F.col("b.id")).groupBy("right").agg(F.count_if(F.col("b.leader").isNull()).alias("open"), F.min(F.when(F.col("b.leader") == F.col("b.id"), F.col("b.id"))).alias("first"))
        step = state.join(near, state["id"] == near["right"], "left")
        ready = F.col("leader").isNull() & (F.coalesce("open", F.lit(0)) == 0)
        state = checkpoint(step.select("id", F.when(ready, F.coalesce("first", "id")).otherwise(F.col("leader")).alias("leader")))
        if state.filter("leader is null").isEmpty():
            return state


def reach(edges: DataFrame, seeds: DataFrame, rounds: int | None = None) -> DataFrame:
    """`(id, steps)`: every node joined to a row of `seeds` (`id`) by edges, with the fewest edges to one.

    `edges` is `(a, b)`, followed both ways; rows with a null or two equal ends are skipped. Goes on until a round
    meets no new node, or for `rounds`. Each round is a written table.
    """
    e = edges.select("a", "b").filter("a <> b")
    both = checkpoint(e.union(e.select("b", "a")).distinct())
    frontier = checkpoint(seeds.select("id").filter("id is not null").distinct().withColumn("steps", F.lit(0)))
    seen, k = frontier, 0
    while rounds is None or k < rounds:
        k += 1
        met = both.join(frontier.select(F.col("id").alias("a")), "a").select(F.col("b").alias("id")).distinct()
        frontier, told = materialize(met.join(seen.select("id"), "id", "left_anti").withColumn("steps", F.lit(k)), n=F.count(F.lit(1)))
        if not told["n"]:
            break
        seen = seen.unionByName(frontier)
    return seen


def flexible_tokens(a: Column, b: Column) -> Column:
    """Whether two token sets may be one name: the smaller within the larger with two shared, or one token on each side
    that differs, as a beginning (three letters) or by one edit (four)."""
    common, only_a, only_b = F.size(F.array_intersect(a, b)), F.array_except(a, b), F.array_except(b, a)
    x, y = F.try_element_at(only_a, F.lit(1)), F.try_element_at(only_b, F.lit(1))
    least = F.least(F.length(x), F.length(y))
    one = (F.size(only_a) == 1) & (F.size(only_b) == 1) & (((least >= 3) & (x.startswith(y) | y.startswith(x))) | ((least >= 4) & (F.levenshtein(x, y, 1) >= 0)))
    return ((common >= 2) & (common == F.least(F.size(a), F.size(b)))) | F.coalesce(one, F.lit(False))


def same_opponent(a: Column, b: Column) -> Column:
    """Whether two token sets name one opponent: two shared tokens, the smaller within the larger, or one typing error
    beside a shared token."""
    common, only_a, only_b = F.size(F.array_intersect(a, b)), F.array_except(a, b), F.array_except(b, a)
    x, y = F.try_element_at(only_a, F.lit(1)), F.try_element_at(only_b, F.lit(1))
    typo = (F.size(only_a) == 1) & (F.size(only_b) == 1) & (F.least(F.length(x), F.length(y)) >= 4) & (F.levenshtein(x, y, 1) >= 0)
    return (common >= 2) | ((common > 0) & ((common == F.least(F.size(a), F.size(b))) | F.coalesce(typo, F.lit(False))))


def opponents_overlap(a: Column, b: Column) -> Column:
    """Opponents of list `a` (token sets) that meet one of list `b`, each of which is used once, in order."""
    at = F.sequence(F.lit(1), F.size(b))
    begun = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("used"))

    def step(s: Column, mine: Column) -> Column:
        free = F.filter(at, lambda j: ~F.array_contains(s["used"], j) & same_opponent(mine, F.try_element_at(b, j)))
        first = F.try_element_at(free, F.lit(1))
        return F.struct((s["n"] + first.isNotNull().cast("int")).alias("n"), F.when(first.isNotNull(), F.concat(s["used"], F.array(first))).otherwise(s["used"]).alias("used"))

    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.aggregate(a, begun, step)["n"]).otherwise(0)


def name_divergences(weight_a: Column, weight_b: Column, wins_a: Column, wins_b: Column, home_a: Column, home_b: Column) -> Column:
    """How many of class (but for sex), wins (more than three apart) and nationality differ; missing values don't."""
    plain = lambda c: F.trim(F.replace(F.lower(c), F.lit("women's "), F.lit("")))
    no = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return no(plain(weight_a) != plain(weight_b)) + no(F.abs(wins_a - wins_b) > 3) + no(F.lower(home_a) != F.lower(home_b))


def slug_name(name: Column, key: Callable[[Column], Column]) -> Column:
    """What `slug_fit` compares of a name: its key `n`, words of two letters, first and last word, whether there are two."""
    n, parts = key(name), F.split(F.trim(name), r"\s+")
    words = F.filter(F.split(n, " "), lambda w: F.length(w) > 1)
    return F.struct(n.alias("n"), words.alias("words"), key(F.try_element_at(parts, F.lit(1))).alias("first"), key(F.try_element_at(parts, F.lit(-1))).alias("last"), (F.size(parts) >= 2).alias("two"))


def slug_hit(hit: Column, slug: Column, key: Callable[[Column], Column]) -> Column:
    """What `slug_fit` compares of a hit: the keys of its name and slug."""
    return F.struct(key(hit).alias("h"), key(F.replace(slug, F.lit("-"), F.lit(" "))).alias("s"))


def slug_fit(name: Column, hit: Column) -> Column:
    """`slug_score` of a `slug_name` and a `slug_hit`: made once for each row, only compared for each pair."""
    n, words, first, last, two, h, s = name["n"], name["words"], name["first"], name["last"], name["two"], hit["h"], hit["s"]
    inside = lambda x, y: F.coalesce(y.contains(x) & (x != ""), F.lit(False))
    # The first word is looked for before the others: most pairs end there.
    every = lambda y: inside(F.try_element_at(words, F.lit(1)), y) & F.forall(words, lambda w: inside(w, y))
    return (
        F.when(F.coalesce(n, F.lit("")) == "", 0).when((n == h) | (n == s), 100).when(inside(n, h) | inside(h, n) | inside(n, s), 90).when(every(s) | every(h), 80)
        .when(two & ((inside(first, s) & inside(last, s)) | (inside(first, h) & inside(last, h))), 70).when(two & (F.length(last) >= 4) & inside(last, s), 60).otherwise(0)
    )


def slug_score(name: Column, hit: Column, slug: Column, key: Callable[[Column], Column]) -> Column:
    """0 to 100: how well a hit (name and slug) fits a name: the same, within it, all words, first and last word, last
    word of four letters. `key` normalises. Where rows meet many others, make `slug_name` and `slug_hit` before the join."""
    return slug_fit(slug_name(name, key), slug_hit(hit, slug, key))


def best_hits(names: DataFrame, hits: DataFrame, block: str, least: int = 60) -> DataFrame:
    """`(name, hit_id, score)`: the best of the hits `(block, hit, hit_id)` of each name `(block, name, facts)` in its block, the
    smallest id on equal scores; `facts` and `hit` are a `slug_name` and a `slug_hit`. One hash aggregate of numbers."""
    spread = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = names.repartition(spread, block).join(hits.repartition(spread, block), block)
    scored = met.select("name", "hit_id", slug_fit(F.col("facts"), F.col("hit")).alias("score")).filter(F.col("score") >= least)
    marks = (100, 90, 80, 70, 60)
    best = scored.groupBy("name").agg(F.max("score").alias("score"), *[F.min(F.when(F.col("score") == m, F.col("hit_id"))).alias(f"of_{m}") for m in marks])
    of = F.lit(None).cast("long")
    for m in marks:
        of = F.when(F.col("score") == m, F.col(f"of_{m}")).otherwise(of)
    return best.select("name", of.alias("hit_id"), "score")


def nearest_as_of(left: DataFrame, right: DataFrame, key: str, day: str, at: str, id_col: str) -> DataFrame:
    """Rows of `left` with `before` and `after`: the ids and days `(at, id)` of the rows of `right` with the same key nearest on
    either side of their day (equal days count as before; the smaller id on ties). One union and one sort of each key's
    rows instead of all pairs."""
    both = left.withColumn("side__", F.lit(1)).unionByName(right.groupBy(key, F.col(at).alias(day)).agg(F.min(id_col).alias("id__")).withColumn("side__", F.lit(0)), allowMissingColumns=True)
    there = F.when(F.col("side__") == 0, F.struct(F.col(day).alias("at"), F.col("id__").alias("id")))
    w = Window.partitionBy(key).orderBy(day, "side__")
    seen = both.withColumns({
        "before": F.last(there, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "after": F.first(there, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)),
    })
    return seen.filter("side__ = 1").drop("side__", "id__")
