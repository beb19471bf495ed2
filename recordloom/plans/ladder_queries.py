"""Queries over match ladders, scores and the sinks that follow them, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import dates, domain, history, text
from recordloom.operators import matching, merge
from recordloom.plans.scalar_queries import AS_OF
from recordloom.session import table
from recordloom.sources import files


def _f(spark, d):
    return table(spark, d, "fighters")


def _p(spark, d):
    return table(spark, d, "source_profiles")


def _words(c):
    return F.array_distinct(F.filter(F.split(text.dedup_name_key(F.col(c)), " "), lambda w: F.length(w) > 1))


def j1_resolve_by_name(spark, d):
    """Missing ids of corners and winners by lower-case name: the smallest id of the name, and how many share it."""
    names = _f(spark, d).groupBy(F.lower("name").alias("key")).agg(F.min("id").alias("found"), F.count(F.lit(1)).alias("namesakes"))
    sides = [F.struct(F.lit(s).alias("side"), F.col(f"{s}_id").alias("id"), F.lower(f"{s}_name").alias("key")) for s in ("fighter1", "fighter2", "winner")]
    b = table(spark, d, "event_fights").select(F.col("id").alias("bout_id"), F.explode(F.array(*sides)).alias("s")).filter("s.id is null and s.key is not null")
    return b.select("bout_id", "s.side", "s.key").join(names, "key").select("bout_id", "side", "found", (F.col("namesakes") == 1).alias("sure"))


def j2_name_dictionary(spark, d):
    """Corners looked up by normalised name; the largest id of a name."""
    index = _f(spark, d).groupBy(text.event_name_key(F.col("name")).alias("key")).agg(F.max("id").alias("found"))
    b = table(spark, d, "event_fights").select(F.col("id").alias("bout_id"), text.event_name_key(F.col("fighter1_name")).alias("key"))
    return b.join(index, "key", "left").select("bout_id", "found")


def j6_source_url_probe(spark, d):
    """Documents of a profile page and the fighter whose sources hold the same profile number."""
    u = _f(spark, d).select("id", F.explode(F.split("data_source", r"\|")).alias("url")).select("id", domain.source_url_key(F.col("url")).alias("k")).filter("k is not null")
    known = u.groupBy("k").agg(F.min("id").alias("fighter_id"))
    docs = table(spark, d, "fighters").select(F.col("id").alias("asked"), F.regexp_replace("photo_url", r"^.*/f/(\d+)\.jpg$", "$1").alias("n"), F.col("data_source"))
    asked = docs.select("asked", domain.source_url_key(F.trim(F.try_element_at(F.split("data_source", r"\|"), F.lit(1)))).alias("k")).filter("k is not null")
    return asked.join(known, "k").select("asked", "k", "fighter_id")


def j8_event_match(spark, d):
    """Each listing's event: by the number in its URL, else within a day by both headliners, else within a day by most of the
    name's words; the nearest date, then the smaller id."""
    number = lambda c: F.nullif(F.regexp_extract(c, r"/events/(\d+)", 1), F.lit(""))
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: F.length(w) > 3))
    pair = lambda c: F.array_sort(F.array(*[F.regexp_extract(F.lower(text.fold_accents(F.col(c))), r"([a-z']+) vs\. (?:[a-z']+ )*?([a-z']+)(?: \d)?$", i) for i in (1, 2)]))
    b = table(spark, d, "event_batches").select("raw_id", number("tapology_url").alias("u"), F.col("date").alias("rd"), words("name").alias("t1"), pair("name").alias("p1"))
    e = table(spark, d, "mma_events").select(F.col("id").alias("event_id"), number("tapology_url").alias("u2"), "date", words("name").alias("t2"), pair("name").alias("p2"))
    by_url = b.join(e, F.col("u") == F.col("u2")).select("raw_id", "event_id", F.lit(1).alias("rank"), F.coalesce(F.abs(F.datediff("rd", "date")), F.lit(0)).alias("gap"))
    near = matching.band_pairs(b.filter("rd is not null"), e, "rd", "date")
    shared = F.size(F.array_intersect("t1", "t2"))
    rank = F.when((F.col("p1") == F.col("p2")) & (F.col("p1")[0] != ""), 2).when((shared >= 2) & (shared / F.least(F.size("t1"), F.size("t2")) >= 0.6), 3)
    by_day = near.select("raw_id", "event_id", rank.alias("rank"), F.abs(F.datediff("rd", "date")).alias("gap")).filter("rank is not null")
    best = by_url.unionByName(by_day).groupBy("raw_id").agg(F.min(F.struct("rank", "gap", "event_id")).alias("b"))
    return best.select("raw_id", "b.event_id", F.col("b.rank").alias("way"))


def j9_listing_match(spark, d):
    """Profiles and fighters that share a key (normalised, sorted, squashed, first and last word), the best by score."""
    keys = lambda c: F.array_distinct(F.array(text.dedup_name_key(F.col(c)), text.sorted_tokens_key(F.col(c)), text.squash_col(F.col(c)), F.concat_ws(" ", F.try_element_at(_words(c), F.lit(1)), F.try_element_at(_words(c), F.lit(-1)))))
    p = _p(spark, d).filter("full_name is not null").select("profile_id", "full_name", F.explode(keys("full_name")).alias("key"))
    f = _f(spark, d).select(F.col("id").alias("fighter_id"), "name", F.explode(keys("name")).alias("key"))
    met = p.join(f, "key").filter("key <> ''").select("profile_id", "full_name", "fighter_id", "name").distinct()
    score = matching.slug_score(F.col("name"), F.col("full_name"), F.lit(None).cast("string"), text.dedup_name_key)
    return matching.best_per_key(met.select("profile_id", "fighter_id", score.alias("score")), "profile_id", "score", "fighter_id")


def j12_same_day_events(spark, d):
    """Listings of one day that share a word of four letters of their name: candidates for one event listed twice."""
    words = F.explode(F.array_distinct(F.filter(F.split(F.lower("name"), "[^a-z0-9]+"), lambda w: F.length(w) > 3)))
    e = table(spark, d, "event_batches").filter("date is not null").select(F.col("raw_id").alias("id"), "date", words.alias("w"))
    a, b = e.alias("a"), e.alias("b")
    met = a.join(b, (F.col("a.date") == F.col("b.date")) & (F.col("a.w") == F.col("b.w")) & (F.col("a.id") < F.col("b.id")))
    return met.groupBy(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id")).agg(F.count(F.lit(1)).alias("shared"))


def m1_match_ladder(spark, d):
    """The batch ladder; a new name with a birth date may still be the one fighter of that date whose words hold the name's."""
    born = dates.any_date(F.col("born_text"))
    inc = _p(spark, d).select(F.col("profile_id").alias("in_id"), F.lower("full_name").alias("key"), born.alias("dob"), _words("full_name").alias("tokens"))
    f = _f(spark, d).select("id", F.lower("name").alias("key"), F.col("date_of_birth").alias("dob"), _words("name").alias("words"))
    climbed = matching.match_ladder(inc.select("in_id", "key", "dob"), f.select("id", "key", "dob"))
    new = climbed.filter("status = 'new'").join(inc, "in_id").filter("dob is not null")
    held = F.size(F.array_intersect("tokens", "words"))
    subset = new.join(f.select("id", "dob", "words"), "dob").filter((held >= 2) & (held == F.least(F.size("tokens"), F.size("words")))).groupBy("in_id").agg(F.min("id").alias("subset"))
    out = climbed.join(subset, "in_id", "left")
    return out.select("in_id", F.coalesce("stored_id", "subset").alias("stored_id"), F.when(F.col("subset").isNotNull(), "dob_subset").otherwise(F.col("status")).alias("status"))


def _typed(spark, d):
    wins = F.regexp_extract("record_text", r"^\s*(\d+)\s*-", 1).try_cast("int")
    return _p(spark, d).select("profile_id", F.lower("full_name").alias("key"), dates.any_date(F.col("born_text")).alias("born"), F.col("weight_text").alias("weight"), wins.alias("wins"), F.col("country_text").alias("home"), _words("full_name").alias("tokens"))


def m2_stored_match(spark, d):
    """The stored ladder: name and date, else the name unless dates or two attributes differ, else date and flexible words."""
    p = _typed(spark, d)
    f = _f(spark, d).select("id", F.lower("name").alias("key"), "date_of_birth", "weight_class_current", "record_total_wins", "nationality", _words("name").alias("words"))
    exact = f.filter("date_of_birth is not null").groupBy("key", F.col("date_of_birth").alias("born")).agg(F.min("id").alias("exact"))
    first = f.groupBy("key").agg(F.min(F.struct("id", "date_of_birth", "weight_class_current", "record_total_wins", "nationality")).alias("n"))
    flexible = p.join(f.select("id", "date_of_birth", "words"), F.col("born") == F.col("date_of_birth")).filter(matching.flexible_tokens(F.col("tokens"), F.col("words"))).groupBy("profile_id").agg(F.min("id").alias("flexible"))
    apart = matching.name_divergences(F.col("weight"), F.col("n.weight_class_current"), F.col("wins"), F.col("n.record_total_wins"), F.col("home"), F.col("n.nationality"))
    skip = F.coalesce(F.col("born") != F.col("n.date_of_birth"), F.lit(False)) | (apart >= 2)
    met = p.join(exact, ["key", "born"], "left").join(first, "key", "left").join(flexible, "profile_id", "left")
    way = F.when(F.col("exact").isNotNull(), "name_dob").when(F.col("n").isNotNull(), F.when(skip, "skip").otherwise("name")).when(F.col("flexible").isNotNull(), "dob_flexible").otherwise("new")
    found = F.coalesce("exact", F.when(F.col("n").isNotNull(), F.when(~skip, F.col("n.id"))).otherwise(F.col("flexible")))
    return met.select("profile_id", found.alias("fighter_id"), way.alias("way"))


def m3_divergences(spark, d):
    """Attributes in which profiles and fighters of one name differ."""
    f = _f(spark, d).select("id", F.lower("name").alias("key"), "weight_class_current", "record_total_wins", "nationality")
    apart = matching.name_divergences(F.col("weight"), F.col("weight_class_current"), F.col("wins"), F.col("record_total_wins"), F.col("home"), F.col("nationality"))
    return _typed(spark, d).join(f, "key").select("profile_id", "id", apart.alias("divergences"))


def m4_flexible_tokens(spark, d):
    """Profiles and fighters of one birth date whose names may be one, by words."""
    f = _f(spark, d).select("id", F.col("date_of_birth").alias("born"), _words("name").alias("words"))
    return _typed(spark, d).join(f, "born").select("profile_id", "id", matching.flexible_tokens(F.col("tokens"), F.col("words")).alias("flexible"))


def _opponents(h):
    return F.filter(F.transform(history.fights(h), lambda f: text.opponent_tokens(f["opponent"])), lambda t: F.size(t) > 0)


def m5_shared_opponents(spark, d):
    """Opponents that fighters of one name share, each used once."""
    f = _f(spark, d).select("id", text.sorted_tokens_key(F.col("name")).alias("key"), _opponents(F.col("fight_history")).alias("o"))
    a, b = f.alias("a"), f.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")))
    return met.select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"), matching.opponents_overlap(F.col("a.o"), F.col("b.o")).alias("shared"))


def m6_corroborated(spark, d):
    """For each fighter the other row that flexible words and a birth date, or both the first and the last bout, confirm;
    dates that differ forbid. Rows meet by what confirms them, never by a word alone."""
    f = _f(spark, d).select("id", _words("name").alias("t"), "date_of_birth", "last_fight_date", "career_debut_date")
    f = f.withColumn("bouts", F.when(F.col("last_fight_date").isNotNull() & F.col("career_debut_date").isNotNull(), F.concat_ws("|", F.lit("b"), "last_fight_date", "career_debut_date")))
    block = F.explode(F.array_compact(F.array("bouts", F.concat(F.lit("d|"), F.col("date_of_birth").cast("string")))))
    keyed = f.select("*", block.alias("block"))
    a, b = keyed.alias("a"), keyed.alias("b")
    met = a.join(b, (F.col("a.block") == F.col("b.block")) & (F.col("a.id") != F.col("b.id"))).filter(matching.flexible_tokens(F.col("a.t"), F.col("b.t")))
    born = F.coalesce(F.col("a.date_of_birth") == F.col("b.date_of_birth"), F.lit(False))
    scored = met.filter(F.coalesce(F.col("a.date_of_birth") == F.col("b.date_of_birth"), F.lit(True))).select(F.col("a.id").alias("id"), F.col("b.id").alias("other"), (F.coalesce(F.col("a.bouts") == F.col("b.bouts"), F.lit(False)).cast("int") * 5 + born.cast("int") * 3).alias("score"))
    return matching.best_per_key(scored.distinct(), "id", "score", "other")


def m7_slug_scores(spark, d):
    """How well the slugs of fighters' pages fit profiles that share their last word."""
    slug = F.regexp_extract("data_source", r"/fightcenter/fighters/\d+-([a-z0-9\-]+)", 1)
    f = _f(spark, d).select("id", "name", slug.alias("slug"), F.try_element_at(_words("name"), F.lit(-1)).alias("last")).filter("slug <> ''")
    p = _p(spark, d).select("profile_id", matching.slug_name(F.col("full_name"), text.dedup_name_key).alias("facts"), F.try_element_at(_words("full_name"), F.lit(-1)).alias("last"))
    f = f.select("id", matching.slug_hit(F.col("name"), F.col("slug"), text.dedup_name_key).alias("hit"), "last")
    # Parts of a fixed number: the pairs, not the small sides, are the work.
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = p.repartition(spread, "last").join(f.repartition(spread, "last"), "last")
    return met.select("profile_id", "id", matching.slug_fit(F.col("facts"), F.col("hit")).alias("score"))


def m8_best_event(spark, d):
    """For each listing the event of the same promotion with the nearest date, the smaller id on ties."""
    b = table(spark, d, "event_batches").filter("date is not null and promotion is not null").select("raw_id", "promotion", "date")
    e = table(spark, d, "mma_events").filter("date is not null and promotion is not null").select(F.col("id").alias("event_id"), "promotion", F.col("date").alias("held"))
    met = matching.nearest_as_of(b, e, "promotion", "date", "held", "event_id")
    gap = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.datediff("date", f"{c}.at")).alias("gap"), F.col(f"{c}.id").alias("event_id")))
    best = F.least(gap("before"), gap("after"))
    return met.select("raw_id", best.alias("b")).filter("b is not null").select("raw_id", "b.event_id", (-F.col("b.gap")).alias("score"))


def m9_enrichment_match(spark, d):
    """Profiles with one fighter of their key, or one with their birth date; not where dates lie over a year apart."""
    p = _p(spark, d).select("profile_id", text.squash_col(F.col("full_name")).alias("key"), dates.any_date(F.col("born_text")).alias("born"))
    f = _f(spark, d).select("id", text.squash_col(F.col("name")).alias("key"), F.col("date_of_birth").alias("dob"))
    facts = f.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("only"), F.min("dob").alias("dob"))
    dated = f.filter("dob is not null").groupBy("key", F.col("dob").alias("born")).agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("same"))
    met = p.join(facts, "key").join(dated, ["key", "born"], "left")
    far = F.coalesce(F.abs(F.datediff("born", "dob")) > 366, F.lit(False))
    found = F.when((F.col("n") == 1) & ~far, F.col("only")).when((F.col("n") > 1) & (F.col("m") == 1), F.col("same"))
    return met.select("profile_id", found.alias("fighter_id")).filter("fighter_id is not null")


def k1_matched_upsert(spark, d):
    """Profiles written to the fighters their ladder names: nationality filled, class refreshed, status of each row."""
    ladder = m1_match_ladder(spark, d).filter("stored_id is not null")
    # A fighter matched by several profiles takes the newest of each attribute.
    p = _p(spark, d).select(F.col("profile_id").alias("in_id"), F.col("country_text").alias("nationality"), F.col("weight_text").alias("weight_class_current"), "source", "scraped_at")
    rows = ladder.join(p, "in_id").groupBy(F.col("stored_id").alias("id")).agg(*[F.max_by(c, F.struct("scraped_at", "in_id")).alias(c) for c in ("nationality", "weight_class_current", "source")])
    old = _f(spark, d).select("id", "nationality", "weight_class_current")
    return merge.upsert(old, rows, "id", ("nationality", "weight_class_current"), "source")


def k3_upsert_by_name(spark, d):
    """Two lists of names merged on the lower-case name: refreshed classes, filled nationalities."""
    old = _f(spark, d).groupBy(F.lower("name").alias("key")).agg(F.min_by("nationality", "id").alias("nationality"), F.min_by("weight_class_current", "id").alias("weight_class_current"))
    new = _p(spark, d).filter("full_name is not null").groupBy(F.lower("full_name").alias("key")).agg(*[F.min_by(c, "profile_id").alias(n) for c, n in (("country_text", "nationality"), ("weight_text", "weight_class_current"), ("source", "source"))])
    return merge.upsert(old, new, "key", ("nationality", "weight_class_current"), "source")


def k4_append_new(spark, d):
    """Names of profiles that no fighter has, numbered on from the largest id in the order of their first profile."""
    f = _f(spark, d)
    new = _p(spark, d).filter("full_name is not null").groupBy(F.lower("full_name").alias("key")).agg(F.min("profile_id").alias("first")).join(f.select(F.lower("name").alias("key")), "key", "left_anti")
    return files.next_ids(new, "first", f.agg(F.max("id")).first()[0] or 0).select("id", "key", "first")


def k5_event_upsert(spark, d):
    """Events after the listings of their URL: name of the first listing, a completed event never upcoming again, the stored URL kept."""
    number = lambda c: F.nullif(F.regexp_extract(c, r"/events/(\d+)", 1), F.lit(""))
    e = table(spark, d, "mma_events").select("id", "name", "status", "tapology_url", number("tapology_url").alias("u"))
    b = table(spark, d, "event_batches").filter(number("tapology_url").isNotNull()).groupBy(number("tapology_url").alias("u")).agg(F.min_by(F.struct("name", "tapology_url", F.when(F.col("date") >= AS_OF, "upcoming").otherwise("completed").alias("status")), "raw_id").alias("n"))
    status = F.when((F.col("status") == "completed") | F.col("n").isNull(), F.col("status")).otherwise(F.col("n.status"))
    return e.join(b, "u", "full_outer").select("id", F.when(F.col("id").isNull(), "INSERT").when(F.col("n").isNotNull(), "UPDATE").otherwise("KEEP").alias("op"), F.coalesce("n.name", "name").alias("name"), status.alias("status"), F.coalesce("tapology_url", "n.tapology_url").alias("url"))


def k7_enrichment(spark, d):
    """Empty nationalities and heights filled from the one profile of the one fighter of a name, its source appended once."""
    p = _p(spark, d).groupBy(F.lower("full_name").alias("key")).agg(F.count(F.lit(1)).alias("np"), F.min(F.struct("profile_id", "country_text", "height_text", "source")).alias("p")).filter("np = 1")
    f = _f(spark, d).select("id", F.lower("name").alias("key"), "nationality", "height_inches", "data_source")
    only = f.groupBy("key").agg(F.count(F.lit(1)).alias("nf")).filter("nf = 1")
    ref = F.concat(F.col("p.source"), F.lit("-"), F.col("p.profile_id").cast("string"))
    packed = F.when(F.col("data_source").isNull(), ref).when(F.col("data_source").contains(F.col("p.source")), F.col("data_source")).otherwise(F.concat("data_source", F.lit(" | "), ref))
    return f.join(only, "key").join(p, "key").select("id", F.coalesce("nationality", "p.country_text").alias("nationality"), F.coalesce("height_inches", "p.height_text").alias("height"), packed.alias("data_source"))


def k8_without_losers(spark, d):
    """Fighters without the rows that lose to another row of their key and birth date, and without empty shells."""
    f = _f(spark, d).withColumn("key", text.dedup_name_key(F.col("name")))
    keepers = f.groupBy("key", "date_of_birth").agg(F.max_by("id", F.struct(F.coalesce("data_quality_score", F.lit(-1)), -F.col("id"))).alias("id"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    shell = F.col("fight_history").isNull() & F.col("date_of_birth").isNull() & zero("record_total_wins") & zero("record_total_losses")
    return f.filter(~shell).join(keepers.select("id"), "id", "left_semi").select("id", "name")


def k9_grouped_url_list(spark, d):
    """Lines of a URL list with a heading for each source: `# source (n)` and its distinct URLs."""
    u = table(spark, d, "documents").filter("url is not null").select("source", F.regexp_replace("url", "/+$", "").alias("line")).distinct()
    heads = u.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select("source", F.lit(0).alias("pos"), F.format_string("# %s (%d)", F.coalesce("source", F.lit("none")), "n").alias("line"))
    return heads.unionByName(u.select("source", F.lit(1).alias("pos"), "line")).orderBy("source", "pos", "line")


def k10_failures(spark, d):
    """Rejected documents as `url<TAB>reason` lines, and how often each reason occurs."""
    t = table(spark, d, "documents")
    reason = F.when(F.coalesce("status", F.lit(0)) != 200, F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("none")))).when(F.length("text") <= 200, "short")
    return t.select(F.concat_ws("\t", "url", reason).alias("line"), reason.alias("reason")).filter("reason is not null").groupBy("line", "reason").agg(F.count(F.lit(1)).alias("n"))


def k11_new_entities(spark, d):
    """Names of profiles that are no fighter's, with the sources that have them."""
    p = _p(spark, d).filter("full_name is not null").withColumn("key", text.squash_col(F.col("full_name")))
    return p.join(_f(spark, d).select(text.squash_col(F.col("name")).alias("key")), "key", "left_anti").groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


def k12_dry_run(spark, d):
    """What an upsert would do, without doing it: rows inserted, updated, kept."""
    from recordloom.plans.merge_queries import _halves

    old, new = _halves(spark, d)
    changed = merge.row_diff(old, new.withColumn("name", F.lit(None).cast("string")), "id", ("nickname", "weight_class_current", "record_total_wins")).select("id").distinct().withColumn("changes", F.lit(True))
    ids = old.select("id", F.lit(True).alias("old")).join(new.select("id", F.lit(True).alias("new")), "id", "full_outer").join(changed, "id", "left")
    op = F.when(F.col("old").isNull(), "INSERT").when(F.coalesce("changes", F.lit(False)), "UPDATE").otherwise("KEEP")
    return ids.groupBy(op.alias("op")).agg(F.count(F.lit(1)).alias("n"))


def k13_row_summary(spark, d):
    """Labelled values of each fighter, cut to 55 letters, for the filled columns."""
    cols = ("nickname", "nationality", "weight_class_current", "stance", "data_source", "fight_history")
    f = _f(spark, d).select("id", *[F.nullif(F.trim(F.substring(c, 1, 55)), F.lit("")).alias(c) for c in cols])
    return f.unpivot(["id"], list(cols), "label", "value").filter("value is not null")


def k14_evolved(spark, d):
    """Bouts of a table that lacks a column, with the column added."""
    old = table(spark, d, "event_fights").select("id", "event_id")
    return files.add_missing_columns(old, {"event_id": "string", "event_date": "date"}).select("id", "event_id", "event_date")


QUERIES = {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")}

from recordloom.plans.classify_queries import _ANY  # noqa: E402
from recordloom.plans.merge_queries import _NEW, _OLD  # noqa: E402

_KEY = "trim(regexp_replace(regexp_replace(lower(strip_accents(translate({0}, 'øØłŁ', 'oOlL'))), '[^a-z0-9 ]', '', 'g'), '\\s+', ' ', 'g'))"
_SQUASH = "regexp_replace(lower(strip_accents(translate({0}, 'øØłŁ', 'oOlL'))), '[^a-z0-9]+', '', 'g')"
_WORDS = f"list_filter(list_distinct_in_order(string_split({_KEY}, ' ')), lambda w: length(w) > 1)".replace("list_distinct_in_order", "list_distinct")
_SPLIT = f"list_filter(string_split({_KEY}, ' '), lambda w: length(w) > 1)"
_FLEX = "((len(list_intersect({a}, {b})) >= 2 AND len(list_intersect({a}, {b})) = least(len({a}), len({b}))) OR coalesce(len(list_filter({a}, lambda q: NOT list_contains({b}, q))) = 1 AND len(list_filter({b}, lambda q: NOT list_contains({a}, q))) = 1 AND ((least(length({x}), length({y})) >= 3 AND (starts_with({x}, {y}) OR starts_with({y}, {x}))) OR (least(length({x}), length({y})) >= 4 AND levenshtein({x}, {y}) <= 1)), false))"


def _flex(a: str, b: str) -> str:
    only = lambda p, q: f"(list_filter({p}, lambda q: NOT list_contains({q}, q))[1])"
    return _FLEX.format(a=a, b=b, x=only(a, b), y=only(b, a))


_EVENT_KEY = "trim(regexp_replace(lower(strip_accents(translate(regexp_replace(regexp_replace(regexp_replace({0}, '\\([^)]*\\)', ' ', 'g'), '[\\x{{27}}’‘`´]', '', 'g'), '[.\\-]', ' ', 'g'), 'øØłŁ', 'oOlL'))), '[\\s\\x{{00a0}}]+', ' ', 'g'))"
_SRC = "CASE WHEN regexp_matches(u, '/fighter-profile/[^/]+/\\d+') THEN 'fm:' || regexp_extract(u, '/fighter-profile/[^/]+/(\\d+)', 1) WHEN regexp_matches(u, '/fightcenter/fighters/\\d+') THEN 'tap:' || regexp_extract(u, '/fightcenter/fighters/(\\d+)', 1) WHEN regexp_matches(u, '/combattant/[^,]+,\\d+') THEN 'ufr:' || regexp_extract(u, '/combattant/[^,]+,(\\d+)', 1) END"
_DIV = "(coalesce(trim(replace(lower({w}), 'women''s ', '')) <> trim(replace(lower({f}.weight_class_current), 'women''s ', '')), false)::INT + coalesce(abs({n} - {f}.record_total_wins) > 3, false)::INT + coalesce(lower({h}) <> lower({f}.nationality), false)::INT)"
_TYPED = f"SELECT profile_id, lower(full_name) k, {_ANY} born, weight_text w, try_cast(nullif(regexp_extract(record_text, '^\\s*(\\d+)\\s*-', 1), '') AS INT) n, country_text h, {_WORDS.format('full_name')} t FROM source_profiles"
_LADDER = f"""i AS (SELECT profile_id in_id, lower(full_name) k, {_ANY} dob, {_WORDS.format('full_name')} t FROM source_profiles),
    g AS (SELECT i.in_id, i.dob, any_value(i.t) t, count(f.id) n, min(f.id) FILTER (f.date_of_birth = i.dob) ex, count(f.id) FILTER (f.date_of_birth IS NULL) nu, min(f.id) FILTER (f.date_of_birth IS NULL) u,
        min(f.id) FILTER (year(f.date_of_birth) = year(i.dob) AND abs(datediff('day', f.date_of_birth, i.dob)) <= 90) nr, min(f.id) a FROM i LEFT JOIN fighters f ON lower(f.name) = i.k GROUP BY 1, 2),
    c AS (SELECT in_id, dob, t, CASE WHEN dob IS NULL THEN CASE WHEN n = 1 THEN a END WHEN ex IS NOT NULL THEN ex WHEN nu = 1 THEN u WHEN nu = 0 THEN nr END AS stored_id,
        CASE WHEN n = 0 THEN 'new' WHEN dob IS NULL THEN CASE WHEN n = 1 THEN 'name_only' ELSE 'ambiguous' END WHEN ex IS NOT NULL THEN 'name_dob' WHEN nu = 1 THEN 'name_only' WHEN nu > 1 THEN 'ambiguous' WHEN nr IS NOT NULL THEN 'name_close_dob' ELSE 'new_homonym' END AS status FROM g),
    s AS (SELECT in_id, min(id) sub FROM c JOIN (SELECT id, date_of_birth, {_WORDS.format('name')} w FROM fighters) f ON c.status = 'new' AND f.date_of_birth = c.dob WHERE len(list_intersect(t, w)) >= 2 AND len(list_intersect(t, w)) = least(len(t), len(w)) GROUP BY 1),
    l AS (SELECT in_id, coalesce(stored_id, sub) AS stored_id, CASE WHEN sub IS NOT NULL THEN 'dob_subset' ELSE status END AS status FROM c LEFT JOIN s USING (in_id))"""
_PAIR = "list_sort([regexp_extract(lower(strip_accents(translate({0}, 'øØłŁ', 'oOlL'))), '([a-z'']+) vs\\. (?:[a-z'']+ )*?([a-z'']+)(?: \\d)?$', 1), regexp_extract(lower(strip_accents(translate({0}, 'øØłŁ', 'oOlL'))), '([a-z'']+) vs\\. (?:[a-z'']+ )*?([a-z'']+)(?: \\d)?$', 2)])"
_TOK = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda x: length(x) > 3))"
_NUM = "nullif(regexp_extract({0}, '/events/(\\d+)', 1), '')"
_SCORE = "CASE WHEN coalesce(n, '') = '' THEN 0 WHEN n = h OR n = s THEN 100 WHEN coalesce(contains(h, n), false) OR (h <> '' AND contains(n, h)) OR coalesce(contains(s, n), false) THEN 90 WHEN len(w) > 0 AND (len(list_filter(w, lambda x: coalesce(contains(s, x), false))) = len(w) OR len(list_filter(w, lambda x: contains(h, x))) = len(w)) THEN 80 WHEN len(p) >= 2 AND ((a <> '' AND z <> '' AND coalesce(contains(s, a) AND contains(s, z), false)) OR (a <> '' AND z <> '' AND contains(h, a) AND contains(h, z))) THEN 70 WHEN len(p) >= 2 AND length(z) >= 4 AND coalesce(contains(s, z), false) THEN 60 ELSE 0 END"
_KEYS = f"list_distinct([{_KEY}, array_to_string(list_sort(string_split({_KEY}, ' ')), ' '), {_SQUASH}, concat_ws(' ', ({_SPLIT})[1], ({_SPLIT})[-1])])"
ORACLES = {
    "j9_listing_match": f"WITH p AS (SELECT profile_id, {_KEY.format('full_name')} h, unnest({_KEYS.format('full_name')}) k FROM source_profiles WHERE full_name IS NOT NULL), f AS (SELECT id, {_KEY.format('name')} n, {_SPLIT.format('name')} w, regexp_split_to_array(trim(name), '\\s+') p, {_KEY.format('regexp_split_to_array(trim(name), chr(92) || chr(115) || chr(43))[1]')} a, {_KEY.format('regexp_split_to_array(trim(name), chr(92) || chr(115) || chr(43))[-1]')} z, NULL::VARCHAR s, unnest({_KEYS.format('name')}) k FROM fighters), m AS (SELECT DISTINCT profile_id, id, {_SCORE} score FROM p JOIN f USING (k) WHERE k <> '') SELECT profile_id, id AS fighter_id, score FROM (SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY score DESC, id) r FROM m) WHERE r = 1",
    "k12_dry_run": f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT CASE WHEN o.id IS NULL THEN 'INSERT' WHEN coalesce(n.nickname IS NOT NULL AND n.nickname IS DISTINCT FROM o.nickname, false) OR coalesce(n.weight_class_current IS NOT NULL AND n.weight_class_current IS DISTINCT FROM o.weight_class_current, false) OR coalesce(n.record_total_wins IS NOT NULL AND n.record_total_wins IS DISTINCT FROM o.record_total_wins, false) THEN 'UPDATE' ELSE 'KEEP' END AS op, count(*) AS n FROM o FULL OUTER JOIN n ON o.id = n.id GROUP BY 1",
    "j1_resolve_by_name": "WITH s AS (SELECT id, unnest(['fighter1', 'fighter2', 'winner']) side, unnest([fighter1_id, fighter2_id, winner_id]) i, unnest([lower(fighter1_name), lower(fighter2_name), lower(winner_name)]) k FROM event_fights) SELECT s.id AS bout_id, side, f.id AS found, n = 1 AS sure FROM s JOIN (SELECT lower(name) k, min(id) id, count(*) n FROM fighters GROUP BY 1) f USING (k) WHERE i IS NULL",
    "j2_name_dictionary": f"SELECT b.id AS bout_id, f.id AS found FROM event_fights b LEFT JOIN (SELECT {_EVENT_KEY.format('name')} k, max(id) id FROM fighters GROUP BY 1) f ON f.k = {_EVENT_KEY.format('fighter1_name')}",
    "j6_source_url_probe": f"WITH u AS (SELECT id, {_SRC} k FROM (SELECT id, unnest(string_split(data_source, '|')) u FROM fighters)), a AS (SELECT id, {_SRC} k FROM (SELECT id, string_split(data_source, '|')[1] u FROM fighters)) SELECT a.id AS asked, a.k, g.f AS fighter_id FROM a JOIN (SELECT k, min(id) f FROM u WHERE k IS NOT NULL GROUP BY 1) g USING (k)",
    "j8_event_match": f"WITH b AS (SELECT raw_id, {_NUM.format('tapology_url')} u, date, {_TOK.format('name')} t, {_PAIR.format('name')} p FROM event_batches), e AS (SELECT id, {_NUM.format('tapology_url')} u, date, {_TOK.format('name')} t, {_PAIR.format('name')} p FROM mma_events), m AS (SELECT raw_id, id, 1 r, coalesce(abs(datediff('day', b.date, e.date)), 0) g FROM b JOIN e USING (u) UNION ALL SELECT raw_id, id, CASE WHEN b.p = e.p AND b.p[1] <> '' THEN 2 WHEN len(list_intersect(b.t, e.t)) >= 2 AND len(list_intersect(b.t, e.t)) / least(len(b.t), len(e.t)) >= 0.6 THEN 3 END, abs(datediff('day', b.date, e.date)) FROM b JOIN e ON e.date BETWEEN b.date - 1 AND b.date + 1) SELECT raw_id, id AS event_id, r AS way FROM (SELECT *, row_number() OVER (PARTITION BY raw_id ORDER BY r, g, id) k FROM m WHERE r IS NOT NULL) WHERE k = 1",
    "j12_same_day_events": f"WITH e AS (SELECT raw_id id, date, unnest({_TOK.format('name')}) w FROM event_batches WHERE date IS NOT NULL) SELECT a.id AS left_id, b.id AS right_id, count(*) AS shared FROM e a JOIN e b ON a.date = b.date AND a.w = b.w AND a.id < b.id GROUP BY 1, 2",
    "m1_match_ladder": f"WITH {_LADDER} SELECT * FROM l",
    "m2_stored_match": f"WITH p AS ({_TYPED}), f AS (SELECT *, lower(name) k, {_WORDS.format('name')} t FROM fighters), x AS (SELECT p.profile_id, min(f.id) ex FROM p JOIN f ON f.k = p.k AND f.date_of_birth = p.born GROUP BY 1), n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id) r FROM f) WHERE r = 1), fl AS (SELECT p.profile_id, min(f.id) fl FROM p JOIN f ON f.date_of_birth = p.born WHERE {_flex('p.t', 'f.t')} GROUP BY 1), m AS (SELECT p.profile_id, ex, n.id nid, fl, coalesce(p.born <> n.date_of_birth, false) OR {_DIV.format(w='p.w', n='p.n', h='p.h', f='n')} >= 2 skip FROM p LEFT JOIN x USING (profile_id) LEFT JOIN n ON n.k = p.k LEFT JOIN fl USING (profile_id)) SELECT profile_id, coalesce(ex, CASE WHEN nid IS NOT NULL THEN CASE WHEN NOT skip THEN nid END ELSE fl END) AS fighter_id, CASE WHEN ex IS NOT NULL THEN 'name_dob' WHEN nid IS NOT NULL THEN CASE WHEN skip THEN 'skip' ELSE 'name' END WHEN fl IS NOT NULL THEN 'dob_flexible' ELSE 'new' END AS way FROM m",
    "m3_divergences": f"WITH p AS ({_TYPED}) SELECT p.profile_id, f.id, {_DIV.format(w='p.w', n='p.n', h='p.h', f='f')} AS divergences FROM p JOIN fighters f ON lower(f.name) = p.k",
    "m4_flexible_tokens": f"WITH p AS ({_TYPED}), f AS (SELECT id, date_of_birth, {_WORDS.format('name')} t FROM fighters) SELECT profile_id, id, {_flex('p.t', 'f.t')} AS flexible FROM p JOIN f ON f.date_of_birth = p.born",
    "m6_corroborated": f"WITH f AS (SELECT *, {_WORDS.format('name')} t FROM fighters), s AS (SELECT a.id, b.id AS other, coalesce(a.last_fight_date = b.last_fight_date AND a.career_debut_date = b.career_debut_date, false)::INT * 5 + coalesce(a.date_of_birth = b.date_of_birth, false)::INT * 3 AS score FROM f a JOIN f b ON a.id <> b.id AND (a.date_of_birth = b.date_of_birth OR (a.last_fight_date = b.last_fight_date AND a.career_debut_date = b.career_debut_date)) WHERE coalesce(a.date_of_birth = b.date_of_birth, true) AND {_flex('a.t', 'b.t')}) SELECT id, other, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) r FROM s) WHERE r = 1",
    "m7_slug_scores": f"WITH f AS (SELECT id, {_KEY.format('name')} h, {_KEY.format('replace(sl, chr(45), chr(32))')} s, {_SPLIT.format('name')}[-1] l FROM (SELECT id, name, nullif(regexp_extract(data_source, '/fightcenter/fighters/\\d+-([a-z0-9\\-]+)', 1), '') sl FROM fighters) WHERE sl IS NOT NULL), p AS (SELECT profile_id, {_KEY.format('full_name')} n, {_SPLIT.format('full_name')} w, regexp_split_to_array(trim(full_name), '\\s+') p, {_KEY.format('regexp_split_to_array(trim(full_name), chr(92) || chr(115) || chr(43))[1]')} a, {_KEY.format('regexp_split_to_array(trim(full_name), chr(92) || chr(115) || chr(43))[-1]')} z FROM source_profiles) SELECT profile_id, id, {_SCORE} AS score FROM p JOIN f ON f.l = p.w[-1]",
    "m8_best_event": "SELECT raw_id, event_id, score FROM (SELECT b.raw_id, e.id event_id, (-abs(datediff('day', e.date, b.date)))::INT score, row_number() OVER (PARTITION BY raw_id ORDER BY abs(datediff('day', e.date, b.date)), e.id) r FROM event_batches b JOIN mma_events e USING (promotion) WHERE b.date IS NOT NULL AND e.date IS NOT NULL) WHERE r = 1",
    "m9_enrichment_match": f"WITH p AS (SELECT profile_id, {_SQUASH.format('full_name')} k, {_ANY} born FROM source_profiles), f AS (SELECT id, {_SQUASH.format('name')} k, date_of_birth dob FROM fighters), g AS (SELECT k, count(*) n, min(id) o, min(dob) dob FROM f GROUP BY 1), h AS (SELECT k, dob, count(*) m, min(id) s FROM f WHERE dob IS NOT NULL GROUP BY 1, 2) SELECT * FROM (SELECT profile_id, CASE WHEN n = 1 AND NOT coalesce(abs(datediff('day', born, g.dob)) > 366, false) THEN o WHEN n > 1 AND m = 1 THEN s END AS fighter_id FROM p JOIN g USING (k) LEFT JOIN h ON h.k = p.k AND h.dob = p.born) WHERE fighter_id IS NOT NULL",
    "k1_matched_upsert": f"WITH {_LADDER}, m AS (SELECT stored_id id, arg_max(country_text, (scraped_at, in_id)) c, arg_max(weight_text, (scraped_at, in_id)) w, arg_max(source, (scraped_at, in_id)) s FROM l JOIN source_profiles p ON p.profile_id = l.in_id WHERE stored_id IS NOT NULL GROUP BY 1), r AS (SELECT stored_id id, p.country_text c, p.weight_text w, p.source s, row_number() OVER (PARTITION BY stored_id ORDER BY scraped_at DESC NULLS LAST, in_id DESC) k FROM l JOIN source_profiles p ON p.profile_id = l.in_id WHERE stored_id IS NOT NULL) SELECT f.id, CASE WHEN s IN ('ufc', 'ufc_fr') THEN coalesce(c, nationality) ELSE coalesce(nationality, c) END AS nationality, coalesce(w, weight_class_current) AS weight_class_current FROM fighters f LEFT JOIN r ON r.id = f.id AND r.k = 1",
    "k3_upsert_by_name": "WITH o AS (SELECT lower(name) k, nationality n, weight_class_current w FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY id) r FROM fighters) WHERE r = 1), p AS (SELECT lower(full_name) k, country_text n, weight_text w, source s FROM (SELECT *, row_number() OVER (PARTITION BY lower(full_name) ORDER BY profile_id) r FROM source_profiles WHERE full_name IS NOT NULL) WHERE r = 1) SELECT coalesce(o.k, p.k) AS key, CASE WHEN p.s IN ('ufc', 'ufc_fr') THEN coalesce(p.n, o.n) ELSE coalesce(o.n, p.n) END AS nationality, coalesce(p.w, o.w) AS weight_class_current FROM o FULL OUTER JOIN p ON o.k = p.k",
    "k4_append_new": "WITH n AS (SELECT lower(full_name) k, min(profile_id) f FROM source_profiles WHERE full_name IS NOT NULL AND lower(full_name) NOT IN (SELECT lower(name) FROM fighters) GROUP BY 1) SELECT (SELECT max(id) FROM fighters) + row_number() OVER (ORDER BY f) AS id, k AS key, f AS first FROM n",
    "k5_event_upsert": f"WITH b AS (SELECT * FROM (SELECT {_NUM.format('tapology_url')} u, name, tapology_url t, CASE WHEN date >= DATE '{AS_OF}' THEN 'upcoming' ELSE 'completed' END s, row_number() OVER (PARTITION BY {_NUM.format('tapology_url')} ORDER BY raw_id) r FROM event_batches) WHERE r = 1 AND u IS NOT NULL), e AS (SELECT *, {_NUM.format('tapology_url')} u FROM mma_events) SELECT e.id, CASE WHEN e.id IS NULL THEN 'INSERT' WHEN b.u IS NOT NULL THEN 'UPDATE' ELSE 'KEEP' END AS op, coalesce(b.name, e.name) AS name, CASE WHEN e.status = 'completed' OR b.u IS NULL THEN e.status ELSE b.s END AS status, coalesce(e.tapology_url, b.t) AS url FROM e FULL OUTER JOIN b ON e.u = b.u",
    "k7_enrichment": "WITH p AS (SELECT lower(full_name) k, min(profile_id) i, min(country_text) c, min(height_text) h, min(source) s FROM source_profiles GROUP BY 1 HAVING count(*) = 1), f AS (SELECT *, lower(name) k, count(*) OVER (PARTITION BY lower(name)) n FROM fighters) SELECT id, coalesce(nationality, c) AS nationality, coalesce(height_inches, h) AS height, CASE WHEN data_source IS NULL THEN s || '-' || i WHEN contains(data_source, s) THEN data_source ELSE data_source || ' | ' || s || '-' || i END AS data_source FROM f JOIN p USING (k) WHERE n = 1",
    "k8_without_losers": f"WITH f AS (SELECT *, row_number() OVER (PARTITION BY {_KEY.format('name')}, date_of_birth ORDER BY coalesce(data_quality_score, -1) DESC, id) r FROM fighters) SELECT id, name FROM f WHERE r = 1 AND NOT (fight_history IS NULL AND date_of_birth IS NULL AND coalesce(record_total_wins, 0) = 0 AND coalesce(record_total_losses, 0) = 0)",
    "k9_grouped_url_list": "WITH u AS (SELECT DISTINCT source, regexp_replace(url, '/+$', '') line FROM documents WHERE url IS NOT NULL) SELECT source, 0 AS pos, '# ' || coalesce(source, 'none') || ' (' || count(*) || ')' AS line FROM u GROUP BY source UNION ALL SELECT source, 1, line FROM u",
    "k10_failures": "WITH t AS (SELECT url, CASE WHEN coalesce(status, 0) <> 200 THEN 'status ' || coalesce(status::VARCHAR, 'none') WHEN length(text) <= 200 THEN 'short' END AS reason FROM documents) SELECT concat_ws(chr(9), url, reason) AS line, reason, count(*) AS n FROM t WHERE reason IS NOT NULL GROUP BY 1, 2",
    "k11_new_entities": f"SELECT {_SQUASH.format('full_name')} AS key, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources FROM source_profiles WHERE full_name IS NOT NULL AND {_SQUASH.format('full_name')} NOT IN (SELECT {_SQUASH.format('name')} FROM fighters) GROUP BY 1",
    "k13_row_summary": "SELECT id, l AS label, trim(left(v, 55)) AS value FROM (SELECT id, unnest(['nickname', 'nationality', 'weight_class_current', 'stance', 'data_source', 'fight_history']) l, unnest([nickname, nationality, weight_class_current, stance, data_source, fight_history]) v FROM fighters) WHERE trim(left(v, 55)) <> ''",
    "k14_evolved": "SELECT id, event_id, NULL::DATE AS event_date FROM event_fights",
}
