"""Queries over fight histories, duplicate groups and the merges that follow, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import domain, history, text
from recordloom.operators import folds, matching, merge
from recordloom.plans.scalar_queries import AS_OF
from recordloom.session import table


def _f(spark, d):
    return table(spark, d, "fighters")


def _b(spark, d):
    return table(spark, d, "event_fights")


def _fights(c="fight_history"):
    return history.fights(F.col(c))


def _priority(c="fight_history"):
    return domain.history_priority(history.history_source(F.col(c)))


def _by(fights, result, category):
    return F.size(F.filter(fights, lambda x: (F.upper(x["result"]) == result) & (domain.method_category(history.method_of(x)) == category)))


def a1_history_record(spark, d):
    """Wins, losses, draws and no contests of histories whose source decides on the record; null for others and empty ones."""
    f, trusted = _fights(), (_priority() >= 3) & (F.size(_fights()) > 0)
    nc = F.size(F.filter(f, lambda x: F.upper(F.trim(x["result"])).isin("NC", "N/C")))
    return _f(spark, d).select("id", *[F.when(trusted, history.count_results(f, r)).alias(n) for r, n in (("W", "w"), ("L", "l"), ("D", "dr"))], F.when(trusted, nc).alias("nc"))


def a2_method_pivot(spark, d):
    """Results by method over histories: six counters."""
    f = _fights()
    return _f(spark, d).select("id", *[_by(f, r, c).alias(f"{n}_{c}") for r, n in (("W", "won"), ("L", "lost")) for c in ("ko", "sub", "dec")])


def a3_split_decisions(spark, d):
    """Won and lost split decisions of histories, whatever field says so."""
    said = lambda x: F.lower(F.concat_ws(" ", x["method"], x["method_detail"], x["date"], x["event"], x["raw"]))
    n = lambda r: F.size(F.filter(_fights(), lambda x: (F.upper(x["result"]) == r) & said(x).contains("split") & said(x).contains("decision")))
    return _f(spark, d).select("id", n("W").alias("won"), n("L").alias("lost"))


def a5_duplicate_groups(spark, d):
    """Groups of one key and birth date, and groups of one key alone whose key is in no such group."""
    f = _f(spark, d).select("id", "date_of_birth", text.sorted_tokens_key(F.col("name")).alias("key"))
    exact = f.filter("date_of_birth is not null").groupBy("key", "date_of_birth").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id")).filter("n >= 2").withColumn("kind", F.lit("exact"))
    by_name = f.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id")).filter("n >= 2").join(exact.select("key"), "key", "left_anti").select("key", F.lit(None).cast("date").alias("date_of_birth"), "n", "first_id", F.lit("name").alias("kind"))
    return exact.unionByName(by_name)


def a7_quality_score(spark, d):
    return _f(spark, d).select("id", domain.quality_score().alias("score"))


def a8_simple_score(spark, d):
    """The score of a first insertion: 30, ten for each of four columns and five for each of four more, 95 at most."""
    filled = lambda c, n: F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "", n).otherwise(0)
    score = F.lit(30)
    for c, n in (("date_of_birth", 10), ("height_inches", 10), ("reach_inches", 10), ("nationality", 10), ("wins_by_ko_tko", 5), ("finish_rate_int", 5), ("fightmatrix_rating_points", 5), ("last_5_results", 5)):
        score = score + filled(c, n)
    return _f(spark, d).select("id", F.coalesce("data_quality_score", F.least(score, F.lit(95))).alias("stored"), F.least(score, F.lit(95)).alias("score"))


def a14_status_counts(spark, d):
    """Bouts by status, and how many fighters have each of some columns."""
    cols = ("date_of_birth", "nationality", "stance", "reach_inches")
    statuses = _b(spark, d).groupBy(F.concat(F.lit("bouts "), F.coalesce("status", F.lit("none"))).alias("counter")).agg(F.count(F.lit(1)).alias("n"))
    filled = _f(spark, d).agg(*[F.count(c).alias(f"filled {c}") for c in cols]).unpivot([], [f"filled {c}" for c in cols], "counter", "n")
    return statuses.unionByName(filled)


def a15_distinct_entities(spark, d):
    """Distinct persons by key and birth date, and rows."""
    f = _f(spark, d).select(text.sorted_tokens_key(F.col("name")).alias("k"), F.coalesce(F.col("date_of_birth").cast("string"), F.lit("")).alias("b"))
    return f.agg(F.countDistinct("k", "b").alias("persons"), F.countDistinct("k").alias("names"), F.count(F.lit(1)).alias("n"))


def a16_url_union(spark, d):
    """Distinct URLs of documents, profiles' sources and events, by site."""
    packed = _f(spark, d).select(F.explode(F.split("data_source", r"\|")).alias("u")).select(F.trim("u").alias("url"))
    all_ = packed.unionByName(table(spark, d, "documents").select("url")).unionByName(table(spark, d, "mma_events").select(F.col("tapology_url").alias("url")))
    urls = all_.filter("url <> ''").select(F.regexp_replace("url", "/+$", "").alias("url")).distinct()
    return urls.groupBy(domain.url_source(F.col("url")).alias("site")).agg(F.count(F.lit(1)).alias("n"))


def w2_next_streaks(spark, d):
    """Stored streaks after the newest decided bout of each fighter."""
    newest = folds.fighter_results(_b(spark, d)).groupBy("fighter_id").agg(F.max_by("result", "ord").alias("result"))
    return _f(spark, d).join(newest, F.col("id") == F.col("fighter_id")).select("id", history.next_streak(F.coalesce("current_streak", F.lit("")), F.col("result")).alias("streak"))


def w4_insert_positions(spark, d):
    """Where a bout of 2020 would stand in each history, newest first."""
    return _f(spark, d).select("id", history.insert_position(_fights(), F.lit("2020-06-30")).alias("position"), F.size(_fights()).alias("n"))


def w5_clean_histories(spark, d):
    """Histories without repeated and without superseded undated fights: how many stay, and the opponents in order."""
    kept = history.without_duplicates(_fights())
    return _f(spark, d).select("id", F.size(_fights()).alias("n"), F.size(kept).alias("n_kept"), F.array_join(F.transform(kept, lambda x: F.coalesce(x["opponent"], F.lit(""))), "|").alias("opponents"))


def w7_present_bouts(spark, d):
    """Results of decided bouts that the fighter's history does not tell of yet."""
    f = _f(spark, d)
    new = folds.not_present(folds.fighter_results(_b(spark, d)), folds.stored_fights(f))
    return new.select("fighter_id", F.col("ord.id").alias("bout_id"), "result")


def w8_duplicate_keeper(spark, d):
    """The row of each duplicate group that stays: has a Tapology source, score, number of sources, wins, then the smaller id."""
    f = _f(spark, d).withColumn("key", text.sorted_tokens_key(F.col("name")))
    sources = F.size(F.filter(F.split(F.coalesce("data_source", F.lit("")), r"\|"), lambda x: F.trim(x) != ""))
    order = F.struct(F.coalesce(F.col("data_source").contains("tapology"), F.lit(False)).cast("int"), F.coalesce("data_quality_score", F.lit(0)), sources, F.coalesce("record_total_wins", F.lit(0)), -F.col("id"))
    return f.groupBy("key").agg(F.max_by("id", order).alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1")


def w9_event_keepers(spark, d):
    """Of the events of one day and city the one with most winners, then most bouts, then the smaller id."""
    counts = _b(spark, d).groupBy(F.col("event_id").alias("id")).agg(F.count("winner_id").alias("winners"), F.count(F.lit(1)).alias("bouts"))
    e = table(spark, d, "mma_events").filter("date is not null").join(counts, "id", "left")
    order = F.struct(F.coalesce("winners", F.lit(0)), F.coalesce("bouts", F.lit(0)), -F.col("id"))
    return e.groupBy("date", F.lower("city").alias("place")).agg(F.max_by("id", order).alias("keeper"), F.count(F.lit(1)).alias("n"))


# Ordinals of runs in reports.
_ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth")


def w10_told_streaks(spark, d):
    """The first run of wins or losses that a document tells of (`the fifth in a row`)."""
    word = F.regexp_extract("text", r"(?i)the (" + "|".join(_ORDINALS) + r") in a row", 1)
    n = F.array_position(F.array(*[F.lit(w) for w in _ORDINALS]), F.lower(word))
    return table(spark, d, "documents").select("doc_id", F.when(n > 0, n).alias("told"))


def w11_best_division(spark, d):
    """Of the classes of a fighter's bouts, but open ones, that of the highest place on a card; the first name on ties."""
    sides = F.explode(F.array("fighter1_id", "fighter2_id")).alias("fighter_id")
    b = _b(spark, d).filter(F.col("weight_class").isNotNull() & ~F.lower("weight_class").rlike("absolute|open") & F.col("bout_order").isNotNull()).select("weight_class", "bout_order", sides)
    return b.filter("fighter_id is not null").groupBy("fighter_id").agg(F.min(F.struct("bout_order", "weight_class")).alias("b")).select("fighter_id", F.col("b.weight_class").alias("division"), F.col("b.bout_order").alias("place"))


def o3_source_order(spark, d):
    """The sites of each fighter in the order in which they are read."""
    order = {"tapology": 1, "fightmatrix": 2, "underground": 3, "ufc": 4, "ufc_fr": 5}
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    sites = F.array_sort(F.transform(domain.sites_of(F.col("data_source")), lambda s: F.struct(F.element_at(rank, s).alias("r"), s.alias("s"))))
    return _f(spark, d).select("id", F.array_join(F.transform(sites, lambda x: x["s"]), ",").alias("sites"))


def x1_url_sets(spark, d):
    """URLs of listings and of the history: in both, in one only."""
    b = table(spark, d, "event_batches").select(F.col("tapology_url").alias("url"), F.lit(1).alias("b"), F.lit(0).alias("e"))
    e = table(spark, d, "mma_events").select(F.col("tapology_url").alias("url"), F.lit(0).alias("b"), F.lit(1).alias("e"))
    both = b.unionByName(e).filter("url is not null").groupBy("url").agg(F.max("b").alias("b"), F.max("e").alias("e"))
    return both.select("url", F.when((F.col("b") == 1) & (F.col("e") == 1), "both").when(F.col("b") == 1, "listings").otherwise("history").alias("where"))


def x2_pair_overlap(spark, d):
    """Events that share a bout: the same two names. Repeated entries share most of their bouts, rematches one."""
    return matching.pair_overlap(matching.bout_pairs(_b(spark, d), "event_id", "fighter1_name", "fighter2_name"), 1)


def f15_empty_shells(spark, d):
    """Fighters by how much of a shell they are: no history, no birth date, no wins, no losses."""
    zero = lambda c: (F.coalesce(F.col(c), F.lit(0)) == 0).cast("int")
    signs = F.col("fight_history").isNull().cast("int") + F.col("date_of_birth").isNull().cast("int") + zero("record_total_wins") + zero("record_total_losses")
    return _f(spark, d).select("id", signs.alias("signs"), (signs == 4).alias("shell")).filter("signs >= 2")


def f17_homonym_guard(spark, d):
    """Keys of several rows: homonyms where two rows have different numbers of one site, else duplicates."""
    f = _f(spark, d).select(text.sorted_tokens_key(F.col("name")).alias("key"), "id", *[c.alias(k) for k, c in domain.external_ids(F.col("data_source")).items()])
    g = f.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("fightmatrix_id").alias("fm"), F.countDistinct("ufc_id").alias("ufc")).filter("n >= 2")
    return g.select("key", "n", ((F.col("fm") >= 2) | (F.col("ufc") >= 2)).alias("homonyms"))


def u2_title_wins(spark, d):
    """Title bouts won: the stored number, or what the bouts tell if that is more."""
    won = _b(spark, d).filter("is_title_fight and winner_id is not null").groupBy(F.col("winner_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return _f(spark, d).join(won, "id", "left").select("id", F.greatest(F.coalesce("ufc_title_match_win", F.lit(0)), F.coalesce("n", F.lit(0))).alias("title_wins"))


def _twins(spark, d):
    """Stored rows and the next row of the same lower-case words."""
    f = _f(spark, d).withColumn("key", text.sorted_tokens_key(F.col("name")))
    ids = f.groupBy("key").agg(F.min("id").alias("keep"), F.max("id").alias("drop")).filter("keep < drop")
    side = lambda c: f.select([F.col(x).alias(f"{c}_{x}") for x in f.columns])
    return ids.join(side("k"), F.col("keep") == F.col("k_id")).join(side("d"), F.col("drop") == F.col("d_id"))


def u3_ordered_union(spark, d):
    """Sources and notes of two rows of one name, each value once, in order."""
    t = _twins(spark, d)
    return t.select("keep", merge.union_sets(F.col("k_data_source"), F.col("d_data_source")).alias("sources"))


def u4_history_arbitration(spark, d):
    """Whether the second row's history replaces the first one's: the same source always does, else the more trusted, else one
    that isn't shorter."""
    t = _twins(spark, d)
    same = F.coalesce(history.history_source(F.col("k_fight_history")) == history.history_source(F.col("d_fight_history")), F.lit(False))
    n = lambda c: F.size(_fights(c))
    p, q = _priority("d_fight_history"), _priority("k_fight_history")
    return t.filter("d_fight_history is not null").select("keep", "drop", (same | (p > q) | ((p == q) & (n("d_fight_history") >= n("k_fight_history")))).alias("overwrite"))


def u5_scraped_history(spark, d):
    """The history of each name that a scrape keeps: the most trusted source, then the longest, then the first."""
    f = _f(spark, d).filter("fight_history is not null").withColumn("key", text.sorted_tokens_key(F.col("name")))
    return f.groupBy("key").agg(F.max_by("id", F.struct(_priority(), F.size(_fights()), -F.col("id"))).alias("id"))


def u7_record_from_history(spark, d):
    """Records corrected by a trusted history that counts no more bouts than are stored."""
    f, trusted = _fights(), (_priority() >= 3) & (F.size(_fights()) > 0)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    stored = z("record_total_wins") + z("record_total_losses") + z("record_total_draws") + z("record_total_nc")
    told = [history.count_results(f, r) for r in ("W", "L", "D")] + [F.size(F.filter(f, lambda x: F.upper(F.trim(x["result"])).isin("NC", "N/C")))]
    applies = trusted & ((stored == 0) | (told[0] + told[1] + told[2] + told[3] <= stored))
    return _f(spark, d).select("id", *[F.when(applies, t).otherwise(F.col(f"record_total_{n}")).alias(n) for t, n in zip(told, ("wins", "losses", "draws", "nc"))])


def u9_insert_defaults(spark, d):
    """New fighters with the defaults of an insertion and ids that repeat their own."""
    from recordloom.plans.ladder_queries import k4_append_new

    own = F.col("id").cast("string")
    return k4_append_new(spark, d).select("id", "key", own.alias("ufc_id"), own.alias("fightmatrix_id"), own.alias("mma_com_id"), F.lit("M").alias("gender"), F.lit(0).alias("record_total_wins"), F.lit(True).alias("is_active"), F.lit(False).alias("is_ufc_champion"))


def u10_group_merge(spark, d):
    """One row for each key: united sources, first filled values in the order of score, the largest records, the most trusted
    history."""
    f = _f(spark, d).withColumn("key", text.sorted_tokens_key(F.col("name")))
    rank = F.struct((-F.coalesce("data_quality_score", F.lit(-1))).alias("q"), "id")
    merged = merge.group_merge(f, "key", rank, first_of=("nickname", "date_of_birth", "nationality", "stance", "reach_inches", "weight_class_current"), max_of=("record_total_wins", "record_total_losses", "record_total_draws", "record_ufc_wins"), argmax={"fight_history": _priority()})
    urls = f.select("key", F.explode(F.split("data_source", r"\|")).alias("u")).select("key", F.regexp_replace(F.trim("u"), "/+$", "").alias("u")).filter("u <> ''")
    united = urls.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("u")), " | ").alias("data_source"))
    return merged.join(united, "key", "left")


def u11_merge_by_ids(spark, d):
    """Pairs of rows merged by id: filled values of the kept one, else of the other; `Unknown` and 0 are empty; the other's
    name where its source is Tapology; the larger record."""
    t = _twins(spark, d)
    filled = lambda c: F.when(~F.coalesce(F.lower(F.trim(F.col(c))), F.lit("")).isin("", "unknown", "0"), F.col(c))
    first = lambda c: F.coalesce(filled(f"k_{c}"), filled(f"d_{c}"), F.col(f"k_{c}"))
    name = F.when(F.coalesce(F.col("d_data_source").contains("tapology"), F.lit(False)), F.col("d_name")).otherwise(F.col("k_name"))
    most = lambda c: F.nullif(F.greatest(F.coalesce(f"k_{c}", F.lit(0)), F.coalesce(f"d_{c}", F.lit(0))), F.lit(0))
    return t.select("keep", "drop", name.alias("name"), *[first(c).alias(c) for c in ("nickname", "nationality", "stance")], most("record_total_wins").alias("record_total_wins"))


def u12_blank_fill(spark, d):
    """Blank cells of profiles filled from the fighter of the same name."""
    f = _f(spark, d).groupBy(F.lower("name").alias("key")).agg(F.min(F.struct("id", "height_inches", "nationality", "weight_class_current")).alias("f"))
    p = table(spark, d, "source_profiles").join(f, F.lower("full_name") == F.col("key"), "left")
    fill = lambda a, b: F.coalesce(F.nullif(F.trim(F.col(a)), F.lit("")), F.col(b))
    return p.select("profile_id", fill("height_text", "f.height_inches").alias("height"), fill("country_text", "f.nationality").alias("country"), fill("weight_text", "f.weight_class_current").alias("weight"))


def u13_proposals(spark, d):
    """What a profile could add to its fighter without overwriting: one row for each proposal."""
    f = _f(spark, d).select("id", F.lower("name").alias("key"), "nationality", "height_inches", "weight_class_current", "last_fight_date")
    only = f.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n = 1")
    p = table(spark, d, "source_profiles").withColumn("key", F.lower("full_name"))
    pairs = (("nationality", "country_text"), ("height_inches", "height_text"), ("weight_class_current", "weight_text"), ("last_fight_date", "last_bout_date"))
    offers = F.array(*[F.struct(F.lit(a).alias("column"), F.when(F.col(a).isNull(), F.col(b).cast("string")).alias("value")) for a, b in pairs])
    return f.join(only, "key", "left_semi").join(p, "key").select("id", "profile_id", F.explode(offers).alias("o")).select("id", "profile_id", "o.column", "o.value").filter("value is not null")


def u14_violations(spark, d):
    """Rows that break a check, and rows that share a key that must be unique."""
    f = _f(spark, d)
    checks = merge.violations(f, "id", {"gender": F.col("gender").isin("M", "F"), "score": F.col("data_quality_score").between(0, 100), "wins": F.col("record_total_wins") >= 0, "scraped": F.col("last_scraped_at") >= F.col("created_at")})
    keyed = f.filter("date_of_birth is not null").select("id", text.plain_name_key(F.col("name")).alias("key"), "date_of_birth")
    twice = keyed.groupBy("key", "date_of_birth").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    unique = keyed.join(twice, ["key", "date_of_birth"]).select("id", F.lit("unique").alias("check"))
    return checks.unionByName(unique)


def u15_apply_bouts(spark, d):
    """Fighters after all decided bouts that their stored histories do not tell of."""
    return folds.apply_bouts(_f(spark, d), _b(spark, d)).drop("fight_history")


def u16_recount_methods(spark, d):
    """Method counters and finish rate of every fighter, recounted over the cleaned history."""
    kept = history.without_duplicates(_fights())
    f = _f(spark, d).select("id", "record_total_wins", kept.alias("k"))
    won = [_by(F.col("k"), "W", c) for c in ("ko", "sub", "dec")]
    finish = F.when(F.col("record_total_wins") > 0, F.bround((won[0] + won[1]) * 100.0 / F.col("record_total_wins"), 0).cast("int")).otherwise(0)
    return f.select("id", *[w.alias(f"won_{c}") for w, c in zip(won, ("ko", "sub", "dec"))], *[_by(F.col("k"), "L", c).alias(f"lost_{c}") for c in ("ko", "sub", "dec")], finish.alias("finish_rate"))


def u17_backfill(spark, d):
    """All past bouts applied after missing ids were resolved by names that only one fighter has."""
    f = _f(spark, d)
    names = f.groupBy(F.lower("name").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("found")).filter("n = 1")
    b = _b(spark, d).filter(F.col("event_date") <= AS_OF)
    for side in ("fighter1", "fighter2", "winner"):
        one = names.select(F.col("key").alias(f"{side}_key"), F.col("found").alias(f"{side}_found"))
        b = b.join(one, F.when(F.col(f"{side}_id").isNull(), F.lower(f"{side}_name")) == F.col(f"{side}_key"), "left").withColumn(f"{side}_id", F.coalesce(f"{side}_id", f"{side}_found"))
    return folds.apply_bouts(f, b).select("id", "wins", "losses", "draws", "n_history")


def u18_event_merge(spark, d):
    """Events that share bouts with an event of at least as many winners and bouts: what is dropped and what stays."""
    pairs = matching.pair_overlap(matching.bout_pairs(_b(spark, d), "event_id", "fighter1_name", "fighter2_name"), 1)
    counts = _b(spark, d).groupBy("event_id").agg(F.count("winner_id").alias("winners"), F.count(F.lit(1)).alias("bouts"))
    worth = lambda c: counts.select(F.col("event_id").alias(c), F.struct("winners", "bouts", (-F.col("event_id")).alias("i")).alias(f"{c}_w"))
    both = pairs.filter("left_event <> 1").join(worth("left_event"), "left_event").join(worth("right_event"), "right_event")
    better = F.col("left_event_w") > F.col("right_event_w")
    drops = both.select(F.when(better, F.col("right_event")).otherwise(F.col("left_event")).alias("dropped"), F.when(better, F.struct("left_event_w", F.col("left_event").alias("e"))).otherwise(F.struct(F.col("right_event_w").alias("left_event_w"), F.col("right_event").alias("e"))).alias("k"))
    return drops.groupBy("dropped").agg(F.max("k").alias("k")).select("dropped", F.col("k.e").alias("kept"))


QUERIES = {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")}

from recordloom.plans.ladder_queries import ORACLES as _LADDERS  # noqa: E402

_KEY = "trim(regexp_replace(regexp_replace(lower(strip_accents(translate({0}, 'øØłŁ', 'oOlL'))), '[^a-z0-9 ]', '', 'g'), '\\s+', ' ', 'g'))"
_SORTED = f"array_to_string(list_sort(string_split({_KEY}, ' ')), ' ')"
_SRC = "CASE WHEN json_valid({0}) THEN lower(trim(json_extract_string({0}, '$.source'))) END"
_PRIO = "CASE {0} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in domain.HISTORY_PRIORITY.items()) + " ELSE 0 END"
_LIST = "CASE WHEN NOT coalesce(json_valid({0}), false) THEN []::JSON[] WHEN ltrim({0}) LIKE '[%' THEN {0}::JSON::JSON[] WHEN json_type({0}, '$.fights') = 'ARRAY' THEN json_extract({0}, '$.fights')::JSON[] ELSE []::JSON[] END"
_N = f"len({_LIST})"
_OPP = "coalesce(trim(regexp_replace(lower(regexp_replace({0}, '\\s*#\\d+.*$', '')), '[\\s\\x{{00a0}}]+', ' ', 'g')), '')"
_CAT = "CASE WHEN lower({0}) LIKE '%ko%' OR lower({0}) LIKE '%knockout%' THEN 'ko' WHEN lower({0}) LIKE '%sub%' THEN 'sub' WHEN lower({0}) LIKE '%dec%' THEN 'dec' WHEN {0} IS NOT NULL THEN 'other' END"
_FI = f"fi AS (SELECT id, i, e, json_extract_string(e, '$.opponent') op, json_extract_string(e, '$.opponent_id')::BIGINT oid, {_OPP.format(chr(106) + 'son_extract_string(e, ' + chr(39) + '$.opponent' + chr(39) + ')')} o, left(coalesce(json_extract_string(e, '$.event_date'), ''), 10) d, upper(json_extract_string(e, '$.result')) r, coalesce(json_extract_string(e, '$.method'), '') m, json_extract_string(e, '$.date') dt FROM (SELECT id, unnest(l) e, generate_subscripts(l, 1) i FROM (SELECT id, {_LIST.format('fight_history')} l FROM fighters)))"
_CLEAN = f"{_FI}, k1 AS (SELECT *, row_number() OVER (PARTITION BY id, o, d ORDER BY (m = '')::INT, i) rk, min(i) OVER (PARTITION BY id, o, d) pos FROM fi), k2 AS (SELECT *, max((d <> '')::INT) OVER (PARTITION BY id, o) has FROM k1 WHERE rk = 1), kept AS (SELECT * FROM k2 WHERE d <> '' OR has = 0)"
_MET = "coalesce(nullif(trim(m), ''), trim(dt))"
_BY = "count(*) FILTER (r = '{0}' AND " + _CAT.format(_MET) + " = '{1}')"
_SIDES = f"sd AS (SELECT b.id, winner_id, method, event_date, event_id, bout_order, x.f, x.o op, x.q, {_OPP.format('x.o').replace('{', '{{').replace('}', '}}')} o, CASE WHEN winner_id IS NULL THEN 'D' WHEN winner_id = x.f THEN 'W' ELSE 'L' END res FROM {{0}} b, LATERAL (SELECT unnest([fighter1_id, fighter2_id]) f, unnest([fighter2_name, fighter1_name]) o, unnest([fighter2_id, fighter1_id]) q) x WHERE x.f IS NOT NULL AND event_date IS NOT NULL AND (winner_id IS NOT NULL OR lower(method) LIKE '%draw%'))"
_NEW = "n0 AS (SELECT * FROM sd WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.id = sd.f AND ((k.o = sd.o AND sd.o <> '') OR k.oid = sd.q) AND (try_cast(nullif(k.d, '') AS DATE) IS NULL OR abs(datediff('day', try_cast(nullif(k.d, '') AS DATE), sd.event_date)) <= 4))), n1 AS (SELECT *, lag(event_date) OVER (PARTITION BY f, o ORDER BY event_date, event_id, bout_order NULLS FIRST, id) bf FROM n0), nw AS (SELECT * FROM n1 WHERE bf IS NULL OR datediff('day', bf, event_date) > 4)"
_APPLY = f"""u AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY event_date DESC, event_id DESC, bout_order DESC NULLS LAST, id DESC) n FROM nw), c AS (SELECT *, first_value(res) OVER (PARTITION BY f ORDER BY n) top FROM u),
    g AS (SELECT f, count(*) FILTER (res = 'W') w, count(*) FILTER (res = 'L') l, count(*) FILTER (res = 'D') dr, max(event_date) last, any_value(top) top, coalesce(min(n) FILTER (res <> top), count(*) + 1) - 1 run, count(*) nn, list(res ORDER BY n DESC) FILTER (n <= 5) five,
        {', '.join(f"count(*) FILTER (res = '{r}' AND {_CAT.format('method')} = '{k}') {r}{k}" for r in 'WL' for k in ('ko', 'sub', 'dec'))} FROM c GROUP BY f),
    h AS (SELECT id, count(*) nh, {', '.join(f"{_BY.format(r, k)} h{r}{k}" for r in 'WL' for k in ('ko', 'sub', 'dec'))} FROM kept GROUP BY id),
    j AS (SELECT a.*, g.*, h.* EXCLUDE (id), list_filter(list_transform(string_split(coalesce(last_5_results, ''), ','), lambda x: upper(trim(x))), lambda x: x IN ('W', 'L', 'D')) || five fv, upper(regexp_extract(upper(coalesce(current_streak, '')), '^\\s*(\\d+)([WLD])', 2)) sk, try_cast(nullif(regexp_extract(upper(coalesce(current_streak, '')), '^\\s*(\\d+)([WLD])', 1), '') AS INT) sn FROM fighters a JOIN g ON g.f = a.id LEFT JOIN h ON h.id = a.id)"""
_TWINS = f"t AS (SELECT keep, dr, k.*, d.* FROM (SELECT min(id) keep, max(id) dr FROM fighters GROUP BY {_SORTED.format('name')} HAVING min(id) < max(id)) JOIN (SELECT " + ", ".join(f"{c} k_{c}" for c in ("id", "name", "nickname", "nationality", "stance", "record_total_wins", "data_source", "fight_history")) + " FROM fighters) k ON k_id = keep JOIN (SELECT " + ", ".join(f"{c} d_{c}" for c in ("id", "name", "nickname", "nationality", "stance", "record_total_wins", "data_source", "fight_history")) + " FROM fighters) d ON d_id = dr)"
_SITE = "CASE WHEN contains(h, 'fightmatrix') THEN 'fightmatrix' WHEN contains(h, 'tapology') THEN 'tapology' WHEN contains(h, 'underground') THEN 'underground' WHEN contains(h, 'ufc-fr') THEN 'ufc_fr' WHEN contains(h, 'ufc') AND contains(lower(url), '/athlete/') THEN 'ufc'{0} END"
_HOST = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/]*)', 1))"
_SITES = f"st AS (SELECT id, {_SITE.format('')} s FROM (SELECT id, url, {_HOST} h FROM (SELECT id, trim(unnest(string_split(data_source, '|'))) url FROM fighters)))"
_OVERLAP = "p AS (SELECT DISTINCT event_id e, least(lower(trim(fighter1_name)), lower(trim(fighter2_name))) p, greatest(lower(trim(fighter1_name)), lower(trim(fighter2_name))) q FROM event_fights WHERE length(trim(fighter1_name)) > 3 AND length(trim(fighter2_name)) > 3), n AS (SELECT e, count(*) n FROM p GROUP BY 1), ov AS (SELECT x.e AS left_event, y.e AS right_event, count(*) AS shared FROM p x JOIN p y ON x.p = y.p AND x.q = y.q AND x.e < y.e JOIN n n1 ON n1.e = x.e JOIN n n2 ON n2.e = y.e GROUP BY x.e, y.e, n1.n, n2.n HAVING count(*) >= 1 OR count(*) / least(n1.n, n2.n) >= 0.5)"
_NOUNK = "CASE WHEN lower(trim({0})) NOT IN ('', 'unknown', '0') THEN {0} END"


def _points(columns) -> str:
    return " + ".join(f"CASE WHEN trim({c}::VARCHAR) <> '' THEN {p} ELSE 0 END" for c, p in columns)


ORACLES = {
    "a1_history_record": f"WITH {_FI}, g AS (SELECT id, count(*) FILTER (r = 'W') w, count(*) FILTER (r = 'L') l, count(*) FILTER (r = 'D') dr, count(*) FILTER (trim(r) IN ('NC', 'N/C')) nc FROM fi GROUP BY 1) SELECT f.id, w, l, dr, nc FROM fighters f LEFT JOIN g ON g.id = f.id AND {_PRIO.format(_SRC.format('fight_history'))} >= 3",
    "a2_method_pivot": f"WITH {_FI} SELECT f.id, {', '.join(f'coalesce(g.{n}_{c}, 0) AS {n}_{c}' for n in ('won', 'lost') for c in ('ko', 'sub', 'dec'))} FROM fighters f LEFT JOIN (SELECT id, {', '.join(f'{_BY.format(r, c)} {n}_{c}' for r, n in (('W', 'won'), ('L', 'lost')) for c in ('ko', 'sub', 'dec'))} FROM fi GROUP BY 1) g USING (id)",
    "a3_split_decisions": f"WITH {_FI}, s AS (SELECT id, r, lower(concat_ws(' ', json_extract_string(e, '$.method'), json_extract_string(e, '$.method_detail'), json_extract_string(e, '$.date'), json_extract_string(e, '$.event'), json_extract_string(e, '$.raw'))) b FROM fi) SELECT f.id, count(*) FILTER (r = 'W' AND b LIKE '%split%' AND b LIKE '%decision%') AS won, count(*) FILTER (r = 'L' AND b LIKE '%split%' AND b LIKE '%decision%') AS lost FROM fighters f LEFT JOIN s USING (id) GROUP BY 1",
    "a5_duplicate_groups": f"WITH f AS (SELECT id, date_of_birth b, {_SORTED.format('name')} k FROM fighters), x AS (SELECT k, b, count(*) n, min(id) i FROM f WHERE b IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2) SELECT k AS key, b AS date_of_birth, n, i AS first_id, 'exact' AS kind FROM x UNION ALL SELECT k, NULL, count(*), min(id), 'name' FROM f WHERE k NOT IN (SELECT k FROM x) GROUP BY k HAVING count(*) >= 2",
    "a7_quality_score": f"WITH {_SITES}, c AS (SELECT id, count(DISTINCT s) n FROM st GROUP BY 1) SELECT id, least(20 + 8 * least(coalesce(n, 0), 4) + {_points(domain.QUALITY_POINTS)}, 100)::INT AS score FROM fighters LEFT JOIN c USING (id)",
    "a8_simple_score": "SELECT id, coalesce(data_quality_score, s) AS stored, s AS score FROM (SELECT id, data_quality_score, least(30 + " + _points([("date_of_birth", 10), ("height_inches", 10), ("reach_inches", 10), ("nationality", 10), ("wins_by_ko_tko", 5), ("finish_rate_int", 5), ("fightmatrix_rating_points", 5), ("last_5_results", 5)]) + ", 95) s FROM fighters)",
    "a14_status_counts": "SELECT 'bouts ' || coalesce(status, 'none') AS counter, count(*) AS n FROM event_fights GROUP BY 1 UNION ALL SELECT unnest(['filled date_of_birth', 'filled nationality', 'filled stance', 'filled reach_inches']), unnest([count(date_of_birth), count(nationality), count(stance), count(reach_inches)]) FROM fighters",
    "a15_distinct_entities": f"SELECT count(DISTINCT k || '|' || b) AS persons, count(DISTINCT k) AS names, count(*) AS n FROM (SELECT {_SORTED.format('name')} k, coalesce(date_of_birth::VARCHAR, '') b FROM fighters)",
    "a16_url_union": f"WITH u AS (SELECT DISTINCT regexp_replace(url, '/+$', '') url FROM (SELECT trim(unnest(string_split(data_source, '|'))) url FROM fighters UNION ALL SELECT url FROM documents UNION ALL SELECT tapology_url FROM mma_events) WHERE url <> '') SELECT {_SITE.format(chr(32) + 'ELSE ' + chr(39) + 'unknown' + chr(39))} AS site, count(*) AS n FROM (SELECT url, {_HOST} h FROM u) GROUP BY 1",
    "w2_next_streaks": f"WITH {_SIDES.format('event_fights')}, n AS (SELECT f, res FROM (SELECT *, row_number() OVER (PARTITION BY f ORDER BY event_date DESC, event_id DESC, bout_order DESC NULLS LAST, id DESC) k FROM sd) WHERE k = 1) SELECT id, CASE WHEN regexp_extract(upper(coalesce(current_streak, '')), '^\\s*(\\d+)([WLD])', 2) = res THEN (regexp_extract(upper(current_streak), '^\\s*(\\d+)([WLD])', 1)::INT + 1)::VARCHAR ELSE '1' END || res AS streak FROM fighters JOIN n ON f = id",
    "w4_insert_positions": f"WITH {_FI} SELECT f.id, coalesce(max(i) FILTER (d > '2020-06-30'), 0) AS position, count(i) AS n FROM fighters f LEFT JOIN fi USING (id) GROUP BY 1",
    "w5_clean_histories": f"WITH {_CLEAN} SELECT f.id, {_N.format('f.fight_history')} AS n, coalesce(k.n, 0) AS n_kept, coalesce(k.o, '') AS opponents FROM fighters f LEFT JOIN (SELECT id, count(*) n, string_agg(coalesce(op, ''), '|' ORDER BY pos) o FROM kept GROUP BY 1) k USING (id)",
    "w7_present_bouts": f"WITH {_CLEAN}, {_SIDES.format('event_fights')}, {_NEW} SELECT f AS fighter_id, id AS bout_id, res AS result FROM nw",
    "w8_duplicate_keeper": f"SELECT key, arg_max(id, (coalesce(contains(data_source, 'tapology'), false)::INT, coalesce(data_quality_score, 0), len(list_filter(string_split(coalesce(data_source, ''), '|'), lambda x: trim(x) <> '')), coalesce(record_total_wins, 0), -id)) AS keeper, count(*) AS n FROM (SELECT *, {_SORTED.format('name')} key FROM fighters) GROUP BY 1 HAVING count(*) > 1",
    "w9_event_keepers": "WITH c AS (SELECT event_id, count(winner_id) w, count(*) b FROM event_fights GROUP BY 1) SELECT date, lower(city) AS place, arg_max(id, (coalesce(w, 0), coalesce(b, 0), -id)) AS keeper, count(*) AS n FROM mma_events LEFT JOIN c ON event_id = id WHERE date IS NOT NULL GROUP BY 1, 2",
    "w10_told_streaks": "SELECT doc_id, nullif(list_position([" + ", ".join(f"'{w}'" for w in _ORDINALS) + "], lower(regexp_extract(text, '(?i)the (" + "|".join(_ORDINALS) + ") in a row', 1))), 0) AS told FROM documents",
    "w11_best_division": "SELECT f AS fighter_id, weight_class AS division, bout_order AS place FROM (SELECT *, row_number() OVER (PARTITION BY f ORDER BY bout_order, weight_class) k FROM (SELECT weight_class, bout_order, unnest([fighter1_id, fighter2_id]) f FROM event_fights WHERE weight_class IS NOT NULL AND bout_order IS NOT NULL AND NOT regexp_matches(lower(weight_class), 'absolute|open')) WHERE f IS NOT NULL) WHERE k = 1",
    "o3_source_order": f"WITH {_SITES} SELECT f.id, CASE WHEN f.data_source IS NOT NULL THEN coalesce(s, '') END AS sites FROM fighters f LEFT JOIN (SELECT id, string_agg(s, ',' ORDER BY list_position(['tapology', 'fightmatrix', 'underground', 'ufc', 'ufc_fr'], s)) s FROM (SELECT DISTINCT id, s FROM st WHERE s IS NOT NULL) GROUP BY 1) g USING (id)",
    "x1_url_sets": "WITH b AS (SELECT DISTINCT tapology_url u FROM event_batches WHERE tapology_url IS NOT NULL), e AS (SELECT DISTINCT tapology_url u FROM mma_events WHERE tapology_url IS NOT NULL) SELECT u AS url, 'both' AS \"where\" FROM (SELECT u FROM b INTERSECT SELECT u FROM e) UNION ALL SELECT u, 'listings' FROM (SELECT u FROM b EXCEPT SELECT u FROM e) UNION ALL SELECT u, 'history' FROM (SELECT u FROM e EXCEPT SELECT u FROM b)",
    "x2_pair_overlap": f"WITH {_OVERLAP} SELECT * FROM ov",
    "f15_empty_shells": "SELECT id, s AS signs, s = 4 AS shell FROM (SELECT id, (fight_history IS NULL)::INT + (date_of_birth IS NULL)::INT + (coalesce(record_total_wins, 0) = 0)::INT + (coalesce(record_total_losses, 0) = 0)::INT s FROM fighters) WHERE s >= 2",
    "u2_title_wins": "SELECT f.id, greatest(coalesce(ufc_title_match_win, 0), coalesce(n, 0)) AS title_wins FROM fighters f LEFT JOIN (SELECT winner_id, count(*) n FROM event_fights WHERE is_title_fight AND winner_id IS NOT NULL GROUP BY 1) b ON b.winner_id = f.id",
    "u3_ordered_union": f"WITH {_TWINS}, l AS (SELECT keep, list_filter(list_transform(string_split(coalesce(k_data_source, ''), '|') || string_split(coalesce(d_data_source, ''), '|'), lambda x: trim(x)), lambda x: x <> '') l FROM t) SELECT keep, nullif(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' | '), '') AS sources FROM l",
    "u4_history_arbitration": f"WITH {_TWINS} SELECT keep, dr AS drop, coalesce({_SRC.format('k_fight_history')} = {_SRC.format('d_fight_history')}, false) OR {_PRIO.format(_SRC.format('d_fight_history'))} > {_PRIO.format(_SRC.format('k_fight_history'))} OR ({_PRIO.format(_SRC.format('d_fight_history'))} = {_PRIO.format(_SRC.format('k_fight_history'))} AND {_N.format('d_fight_history')} >= {_N.format('k_fight_history')}) AS overwrite FROM t WHERE d_fight_history IS NOT NULL",
    "u5_scraped_history": f"SELECT key, id FROM (SELECT {_SORTED.format('name')} key, id, row_number() OVER (PARTITION BY {_SORTED.format('name')} ORDER BY {_PRIO.format(_SRC.format('fight_history'))} DESC, {_N.format('fight_history')} DESC, id) r FROM fighters WHERE fight_history IS NOT NULL) WHERE r = 1",
    "u7_record_from_history": f"WITH {_FI}, g AS (SELECT id, count(*) FILTER (r = 'W') w, count(*) FILTER (r = 'L') l, count(*) FILTER (r = 'D') dr, count(*) FILTER (trim(r) IN ('NC', 'N/C')) nc FROM fi GROUP BY 1), j AS (SELECT f.*, g.* EXCLUDE (id), g.id IS NOT NULL AND {_PRIO.format(_SRC.format('fight_history'))} >= 3 AND (coalesce(record_total_wins, 0) + coalesce(record_total_losses, 0) + coalesce(record_total_draws, 0) + coalesce(record_total_nc, 0) = 0 OR w + l + dr + nc <= coalesce(record_total_wins, 0) + coalesce(record_total_losses, 0) + coalesce(record_total_draws, 0) + coalesce(record_total_nc, 0)) ok FROM fighters f LEFT JOIN g USING (id)) SELECT id, CASE WHEN ok THEN w ELSE record_total_wins END AS wins, CASE WHEN ok THEN l ELSE record_total_losses END AS losses, CASE WHEN ok THEN dr ELSE record_total_draws END AS draws, CASE WHEN ok THEN nc ELSE record_total_nc END AS nc FROM j",
    "u9_insert_defaults": f"SELECT id, key, id::VARCHAR AS ufc_id, id::VARCHAR AS fightmatrix_id, id::VARCHAR AS mma_com_id, 'M' AS gender, 0 AS record_total_wins, true AS is_active, false AS is_ufc_champion FROM ({_LADDERS['k4_append_new']})",
    "u10_group_merge": f"WITH f AS (SELECT *, {_SORTED.format('name')} key, -coalesce(data_quality_score, -1) q, {_PRIO.format(_SRC.format('fight_history'))} p FROM fighters), u AS (SELECT key, string_agg(u, ' | ' ORDER BY u) s FROM (SELECT DISTINCT key, regexp_replace(trim(u), '/+$', '') u FROM (SELECT key, unnest(string_split(data_source, '|')) u FROM f)) WHERE u <> '' GROUP BY 1) SELECT f.key, {', '.join(f'arg_min({c}, (q, id)) FILTER (trim({c}::VARCHAR) <> {chr(39) * 2}) AS {c}' for c in ('nickname', 'date_of_birth', 'nationality', 'stance', 'reach_inches', 'weight_class_current'))}, {', '.join(f'nullif(max(coalesce({c}, 0)), 0) AS {c}' for c in ('record_total_wins', 'record_total_losses', 'record_total_draws', 'record_ufc_wins'))}, arg_min(fight_history, (-p, q, id)) FILTER (fight_history IS NOT NULL) AS fight_history, any_value(u.s) AS data_source FROM f LEFT JOIN u USING (key) GROUP BY f.key",
    "u11_merge_by_ids": f"WITH {_TWINS} SELECT keep, dr AS drop, CASE WHEN contains(d_data_source, 'tapology') THEN d_name ELSE k_name END AS name, {', '.join(f'coalesce({_NOUNK.format(chr(107) + chr(95) + c)}, {_NOUNK.format(chr(100) + chr(95) + c)}, k_{c}) AS {c}' for c in ('nickname', 'nationality', 'stance'))}, nullif(greatest(coalesce(k_record_total_wins, 0), coalesce(d_record_total_wins, 0)), 0) AS record_total_wins FROM t",
    "u12_blank_fill": "WITH f AS (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY id) r FROM fighters) SELECT profile_id, coalesce(nullif(trim(height_text), ''), height_inches) AS height, coalesce(nullif(trim(country_text), ''), nationality) AS country, coalesce(nullif(trim(weight_text), ''), weight_class_current) AS weight FROM source_profiles p LEFT JOIN f ON r = 1 AND lower(f.name) = lower(p.full_name)",
    "u13_proposals": "WITH f AS (SELECT *, count(*) OVER (PARTITION BY lower(name)) n FROM fighters) SELECT * FROM (SELECT f.id, profile_id, unnest(['nationality', 'height_inches', 'weight_class_current', 'last_fight_date']) AS \"column\", unnest([CASE WHEN nationality IS NULL THEN country_text END, CASE WHEN height_inches IS NULL THEN height_text END, CASE WHEN weight_class_current IS NULL THEN weight_text END, CASE WHEN last_fight_date IS NULL THEN last_bout_date::VARCHAR END]) AS value FROM f JOIN source_profiles p ON lower(p.full_name) = lower(f.name) WHERE n = 1) WHERE value IS NOT NULL",
    "u14_violations": "WITH k AS (SELECT id, count(*) OVER (PARTITION BY lower(regexp_replace(regexp_replace(name, '[^a-zA-Z0-9 ]', '', 'g'), '\\s+', ' ', 'g')), date_of_birth) n FROM fighters WHERE date_of_birth IS NOT NULL) SELECT id, c AS \"check\" FROM (SELECT id, unnest([CASE WHEN NOT (gender IN ('M', 'F')) THEN 'gender' END, CASE WHEN NOT (data_quality_score BETWEEN 0 AND 100) THEN 'score' END, CASE WHEN NOT (record_total_wins >= 0) THEN 'wins' END, CASE WHEN NOT (last_scraped_at >= created_at) THEN 'scraped' END]) c FROM fighters) WHERE c IS NOT NULL UNION ALL SELECT id, 'unique' FROM k WHERE n > 1",
    "u15_apply_bouts": f"WITH {_CLEAN}, {_SIDES.format('event_fights')}, {_NEW}, {_APPLY} SELECT id, coalesce(record_total_wins, 0) + w AS wins, coalesce(record_total_losses, 0) + l AS losses, coalesce(record_total_draws, 0) + dr AS draws, coalesce(record_total_wins, 0) + w + coalesce(record_total_losses, 0) + l + coalesce(record_total_draws, 0) + dr + coalesce(record_total_nc, 0) AS total_fights, {', '.join(f'{r}{k} + coalesce(h{r}{k}, 0) AS {k}_{n}' for r, n in (('W', 'wins'), ('L', 'losses')) for k in ('ko', 'sub', 'dec'))}, greatest(last_fight_date, last) AS last_fight_date, (run + CASE WHEN run = nn AND sk = top THEN coalesce(sn, 0) ELSE 0 END)::VARCHAR || top AS current_streak, array_to_string(fv[greatest(len(fv) - 4, 1):], ',') AS last_5_results, coalesce(nh, 0) + nn AS n_history FROM j",
    "u16_recount_methods": f"WITH {_CLEAN}, g AS (SELECT id, {', '.join(f'{_BY.format(r, c)} {n}_{c}' for r, n in (('W', 'won'), ('L', 'lost')) for c in ('ko', 'sub', 'dec'))} FROM kept GROUP BY 1) SELECT f.id, {', '.join(f'coalesce(g.{n}_{c}, 0) AS {n}_{c}' for n in ('won', 'lost') for c in ('ko', 'sub', 'dec'))}, CASE WHEN record_total_wins > 0 THEN round_even((coalesce(won_ko, 0) + coalesce(won_sub, 0)) * 100.0 / record_total_wins, 0)::INT ELSE 0 END AS finish_rate FROM fighters f LEFT JOIN g USING (id)",
    "u17_backfill": f"WITH nm AS (SELECT lower(name) k, min(id) i FROM fighters GROUP BY 1 HAVING count(*) = 1), bf AS (SELECT b.* REPLACE (coalesce(fighter1_id, x.i) AS fighter1_id, coalesce(fighter2_id, y.i) AS fighter2_id, coalesce(winner_id, z.i) AS winner_id) FROM event_fights b LEFT JOIN nm x ON fighter1_id IS NULL AND x.k = lower(fighter1_name) LEFT JOIN nm y ON fighter2_id IS NULL AND y.k = lower(fighter2_name) LEFT JOIN nm z ON winner_id IS NULL AND z.k = lower(winner_name) WHERE event_date <= DATE '{AS_OF}'), {_CLEAN}, {_SIDES.format('bf')}, {_NEW}, {_APPLY} SELECT id, coalesce(record_total_wins, 0) + w AS wins, coalesce(record_total_losses, 0) + l AS losses, coalesce(record_total_draws, 0) + dr AS draws, coalesce(nh, 0) + nn AS n_history FROM j",
    "u18_event_merge": f"WITH {_OVERLAP}, c AS (SELECT event_id, (count(winner_id), count(*), -event_id) w FROM event_fights GROUP BY 1), b AS (SELECT left_event l, right_event r, x.w lw, y.w rw FROM ov JOIN c x ON x.event_id = left_event JOIN c y ON y.event_id = right_event WHERE left_event <> 1) SELECT dropped, arg_max(kept, w) AS kept FROM (SELECT CASE WHEN lw > rw THEN r ELSE l END dropped, CASE WHEN lw > rw THEN l ELSE r END kept, CASE WHEN lw > rw THEN lw ELSE rw END w FROM b) GROUP BY 1",
    "f17_homonym_guard": "WITH f AS (SELECT " + _SORTED.format("name") + " k, coalesce((list_filter(list_transform(string_split(data_source, '|'), lambda u: regexp_extract(u, '/combattant/[^,]+,(\\d+)', 1)), lambda x: x <> ''))[-1], list_filter(list_transform(string_split(data_source, '|'), lambda u: coalesce(nullif(regexp_extract(u, '/fightcenter/fighters/(\\d+)', 1), ''), nullif(regexp_extract(u, '/athlete/([\\w-]+)', 1), ''))), lambda x: x IS NOT NULL)[1]) u, (list_filter(list_transform(string_split(data_source, '|'), lambda u: regexp_extract(u, '/fighter-profile/[^/]+/(\\d+)', 1)), lambda x: x <> ''))[-1] fm FROM fighters) SELECT k AS key, count(*) AS n, count(DISTINCT fm) >= 2 OR count(DISTINCT u) >= 2 AS homonyms FROM f GROUP BY 1 HAVING count(*) >= 2",
}

#: Columns that are counts in the SQL and sizes of arrays, which are int, in Spark.
_SIZES = {
    "a1_history_record": ("w", "l", "dr", "nc"), "a2_method_pivot": tuple(f"{n}_{c}" for n in ("won", "lost") for c in ("ko", "sub", "dec")), "a3_split_decisions": ("won", "lost"), "w4_insert_positions": ("position", "n"),
    "w5_clean_histories": ("n", "n_kept"), "u7_record_from_history": ("wins", "losses", "draws", "nc"), "u16_recount_methods": tuple(f"{n}_{c}" for n in ("won", "lost") for c in ("ko", "sub", "dec")), "u17_backfill": ("n_history",),
    "u15_apply_bouts": (*(f"{c}_{n}" for n in ("wins", "losses") for c in ("ko", "sub", "dec")), "n_history"),
}
for _name, _columns in _SIZES.items():
    ORACLES[_name] = f"SELECT * REPLACE ({', '.join(f'{c}::INT AS {c}' for c in _columns)}) FROM ({ORACLES[_name]})"
ORACLES["w10_told_streaks"] = f"SELECT doc_id, told::BIGINT AS told FROM ({ORACLES['w10_told_streaks']})"
