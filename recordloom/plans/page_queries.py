"""Queries over sources, pages and incremental rules, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import dates, domain, history, measures, text
from recordloom.operators import extraction, matching
from recordloom.plans.classify_queries import PROMOTIONS
from recordloom.plans.scalar_queries import AS_OF
from recordloom.session import table
from recordloom.sources import files
from recordloom.streaming.ingest import backoff_seconds, failure_breaker


def _docs(spark, d):
    return table(spark, d, "documents")


def _p(spark, d):
    return table(spark, d, "source_profiles")


def s6_page_outcomes(spark, d):
    """Fetched pages by outcome: failed, blocked (challenge, home page or next to no text), or usable."""
    t = _docs(spark, d)
    head = F.lower(F.concat_ws(" ", "title", F.substring("text", 1, 4000)))
    home = F.coalesce(F.col("url").rlike(r"^https?://[^/]+(?:/fightcenter)?/?$"), F.lit(False))
    blocked = home | head.rlike("just a moment|access denied|are you human|removed by its owner") | (F.length(F.trim(F.regexp_replace("text", r"\s+", " "))) < 60)
    outcome = F.when(F.col("text").isNull() | ~F.coalesce(F.col("status") == 200, F.lit(False)), "FAIL").when(blocked, "BLOCKED").otherwise("OK")
    return t.groupBy("source", outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def s7_site_pages(spark, d):
    """Usable pages of one site."""
    t = _docs(spark, d).filter("status = 200 and length(text) > 500")
    return t.filter(F.col("source") == "ufc_fr").select("doc_id", "url", "title")


def s8_json_rows(spark, d):
    """Rows of a JSON source under a schema: numbers of the event stream by type and day."""
    r = table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), F.from_json("props", "k bigint, missing string").alias("j"))
    return r.groupBy("event_type", "day").agg(F.sum("j.k").alias("sum_k"), F.count("j.missing").alias("n_missing"))


def s9_dereferenced(spark, d):
    """Listings with the event their URL refers to, each event looked up once."""
    number = lambda c: F.nullif(F.regexp_extract(c, r"/events/(\d+)", 1), F.lit(""))
    documents = table(spark, d, "mma_events").select(number("tapology_url").alias("url"), F.col("name").alias("body"), F.struct("updated_at", "id").alias("fetched_at")).filter("url is not null")
    items = table(spark, d, "event_batches").select("raw_id", number("tapology_url").alias("ref"))
    return files.dereference(documents, items, "ref").select("raw_id", "ref", "body")


def s11_url_list(spark, d):
    """Distinct URLs of a list with several a line and comments, with the first line that has them."""
    lines = table(spark, d, "fighters").select(F.col("id").alias("line"), F.concat(F.regexp_replace("data_source", r"\|", " "), F.lit("/ # row "), F.col("id").cast("string")).alias("value"))
    return files.url_list(lines, "line", "value").select("url", F.col("first.line").alias("line"))


def s13_source_blocks(spark, d):
    """Blocks of packed fields with the site that each comes from."""
    blocks = files.explode_blob(table(spark, d, "fighters"), "id", "data_source", r"\|")
    return blocks.groupBy(domain.url_source(F.col("block")).alias("site"), "pos").agg(F.count(F.lit(1)).alias("n"))


def s14_newest_nonempty(spark, d):
    """The newest page with text of each source, the larger id on equal times."""
    t = _docs(spark, d).filter("source is not null and length(trim(text)) > 0")
    return t.groupBy("source").agg(F.max_by(F.struct("doc_id", "fetched_at"), F.struct("fetched_at", "doc_id")).alias("b")).select("source", "b.doc_id")


def s15_listing_links(spark, d):
    """Distinct profile pages that fields and pages link to, by number."""
    packed = table(spark, d, "fighters").select(F.col("data_source").alias("t")).unionByName(_docs(spark, d).select(F.concat_ws(" ", "url", "text").alias("t")))
    links = packed.select(F.explode(F.regexp_extract_all("t", F.lit(r"/fightcenter/(?:fighters/)?(\d+-[a-z0-9\-]+)"), 1)).alias("slug"))
    return links.groupBy("slug").agg(F.count(F.lit(1)).alias("n"))


def s16_page_grid(spark, d):
    """Pages of 25 events of each promotion, no further than its last page, with the first event on each."""
    e = table(spark, d, "mma_events").filter("promotion is not null")
    grid = e.groupBy("promotion").agg(F.ceil(F.count(F.lit(1)) / 25).alias("last_page"))
    return grid.select("promotion", "last_page", F.explode(F.sequence(F.lit(1).cast("long"), F.least("last_page", F.lit(50)))).alias("page"))


def s17_best_hits(spark, d):
    """For each fighter the best hit of a search for its name among profiles that share its last word."""
    last = lambda c: F.try_element_at(F.split(c, " "), F.lit(-1))
    f = table(spark, d, "fighters").select("id", "name")
    names = f.select("name").distinct().select("name", matching.slug_name(F.col("name"), text.dedup_name_key).alias("facts")).withColumn("w", last(F.col("facts.n"))).filter("w <> ''")
    # A score sees the key of a profile's name only: of one key the smallest id can win.
    hit = matching.slug_hit(F.col("full_name"), F.lit(None).cast("string"), text.dedup_name_key)
    p = _p(spark, d).select("profile_id", hit.alias("hit")).groupBy("hit").agg(F.min("profile_id").alias("hit_id")).withColumn("w", last(F.col("hit.h")))
    return f.join(matching.best_hits(names, p, "w"), "name").select("id", F.col("hit_id").alias("profile_id"), "score")


def s19_opponent_network(spark, d):
    """Fighters joined by any number of bouts to one with a fightmatrix_id, with the fewest steps."""
    b = table(spark, d, "event_fights").select(F.col("fighter1_id").alias("a"), F.col("fighter2_id").alias("b"))
    return matching.reach(b, table(spark, d, "fighters").filter("fightmatrix_id is not null").select("id"))


def e1_parser_dispatch(spark, d):
    """Rows that the parser of each source's kind of page finds."""
    t = _docs(spark, d)
    found = [(n, rows(t, "doc_id", "text").select("doc_id")) for n, rows in (("ranking", extraction.rank_rows), ("report", extraction.report_rows), ("french", extraction.french_rows))]
    union = None
    for name, rows in found:
        part = rows.select("doc_id", F.lit(name).alias("parser"))
        union = part if union is None else union.unionByName(part)
    return union.join(t.select("doc_id", "source"), "doc_id").groupBy("source", "parser").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("doc_id").alias("n_docs"))


def e2_text_sources(spark, d):
    """What kind of page a pasted text is."""
    c = F.col("text")
    kind = F.when(c.rlike(r"(?m)^\d+\. [^\n]+ \d+-\d+-\d+\s*$"), "ranking").when(c.rlike(r" met [^\n]+ at [^\n]+ of round \d"), "report").when(c.rlike(r" a battu [^\n]+ du round \d"), "french").when(F.length(c) < 80, "headline").otherwise("prose")
    return _docs(spark, d).select("doc_id", kind.alias("kind"))


def e3_labels(spark, d):
    """Values of the labels that remarks give (`Coach: ...`)."""
    lines = F.regexp_replace("notes", r"\s*[|;\n]\s*", "\n")
    return table(spark, d, "fighters").select("id", *[extraction.labelled_value(lines, label).alias(label.lower().replace(" ", "_")) for label in ("Coach", "Strong point")])


def e4_ranking_rows(spark, d):
    return extraction.rank_rows(_docs(spark, d), "doc_id", "text")


def e5_report_rows(spark, d):
    return extraction.report_rows(_docs(spark, d), "doc_id", "text")


def e6_scorecards(spark, d):
    """Scores of the judges and the size of the crowd that a report gives."""
    rows = extraction.match_rows(_docs(spark, d), "doc_id", "text", r"judges had it (\d+-\d+), (\d+-\d+) and (\d+-\d+)(?:[^.\n]*crowd of (\d+))?", ["j1", "j2", "j3", "crowd"], ("judges had it ",))
    return rows.withColumn("crowd", F.col("crowd").try_cast("int"))


def e7_origins(spark, d):
    """Where and with what a fighter began, from a sentence of a profile."""
    return extraction.match_rows(_docs(spark, d), "doc_id", "text", r"Born in ([^.\n,]+), ([^.\n,]+?) began with ([^.\n,]+?) at the age of (\d+)", ["place", "name", "sport", "age"], ("Born in ",)).withColumn("age", F.col("age").try_cast("int"))


def e8_divisions(spark, d):
    """Sizes of divisions: class, promotion, fighters under contract and how many more than before."""
    rows = extraction.match_rows(_docs(spark, d), "doc_id", "text", r"The ([a-z' ]+?) division at ([^.\n]+?) now has (\d+) contracted fighters, (\d+) more than in ([A-Z][a-z]+)", ["division", "promotion", "fighters", "more", "month"], (" division at ",))
    return rows.withColumns({"fighters": F.col("fighters").try_cast("int"), "more": F.col("more").try_cast("int"), "division": domain.class_casing(F.col("division"))})


def e9_profile_fields(spark, d):
    """Typed columns of free-text profiles."""
    h = F.col("height_text")
    cm = F.regexp_extract(h, r"^(\d{3})\s*cm$", 1).try_cast("double")
    inches = F.coalesce(measures.feet_to_inches(h), F.regexp_extract(h, r"^(\d{2})\s*in$", 1).try_cast("int"), F.round(cm / 2.54).cast("int"))
    r = F.col("record_text")
    return _p(spark, d).select("profile_id", inches.alias("inches"), domain.class_name(F.col("weight_text")).alias("class"), dates.any_date(F.col("born_text")).alias("born"), *[measures.record_part(r, i).alias(n) for i, n in ((1, "wins"), (2, "losses"), (3, "draws"))])


def e10_event_meta(spark, d):
    """Event of a page: name by title or slug, first date, venue and city, promotion, status."""
    slug = F.regexp_replace(F.regexp_extract("url", r"/(?:\d+-)?([^/?#]+)/?(?:[?#].*)?$", 1), "-", " ")
    name = F.coalesce(F.nullif(F.trim(F.regexp_replace("title", r"\s*\|.*$", "")), F.lit("")), F.nullif(slug, F.lit("")))
    place = r" at ([A-Z][^.\n,]*?) in ([A-Z][^.\n,]*?) on \d"
    day = dates.date_in_text(F.col("text"))
    part = lambda i: F.nullif(F.regexp_extract("text", place, i), F.lit(""))
    return _docs(spark, d).select("doc_id", name.alias("name"), day.alias("day"), part(1).alias("venue"), part(2).alias("city"), domain.promotion_of(name, F.col("text"), PROMOTIONS).alias("promotion"), domain.event_status(day, F.lit(AS_OF).cast("date")).alias("status"))


def e11_leads(spark, d):
    """What stands before the list or the scores of a page."""
    return _docs(spark, d).select("doc_id", F.length(extraction.section(F.col("text"), r"(?m)^1\. |The judges had it")).alias("n_lead"))


def e12_card_cascade(spark, d):
    """Bouts of a page by the first strategy that finds any: reports, French reports, else the names of the title."""
    t = _docs(spark, d)
    a, b = extraction.corner_names(F.col("title"))
    rows = [("report", extraction.report_rows(t, "doc_id", "text")), ("french", extraction.french_rows(t, "doc_id", "text")), ("title", t.select("doc_id", F.lit(0).alias("pos"), a.alias("a"), b.alias("b")).filter("b is not null"))]
    all_ = None
    for i, (name, r) in enumerate(rows):
        part = r.select("doc_id", "pos", "a", "b", F.lit(i).alias("rank"), F.lit(name).alias("strategy"))
        all_ = part if all_ is None else all_.unionByName(part)
    first = all_.groupBy("doc_id").agg(F.min("rank").alias("rank"))
    return all_.join(first, ["doc_id", "rank"]).select("doc_id", "strategy", "pos", "a", "b")


def e13_corner_names(spark, d):
    a, b = extraction.corner_names(F.col("name"))
    return table(spark, d, "event_batches").select("raw_id", a.alias("a"), b.alias("b"))


def e14_french_rows(spark, d):
    return extraction.french_rows(_docs(spark, d), "doc_id", "text")


def e15_history_rows(spark, d):
    """Fights of JSON histories as rows, the oldest first, with a flag for title bouts."""
    f = table(spark, d, "fighters").select("id", F.posexplode(F.reverse(history.fights(F.col("fight_history")))).alias("pos", "f"))
    return f.select("id", (F.col("pos") + 1).alias("bout_order"), F.upper("f.result").alias("result"), "f.opponent", "f.method", F.coalesce(F.lower("f.event").rlike("title|championship"), F.lit(False)).alias("is_title"))


def e16_multi_source(spark, d):
    """One row for each name from the profiles of all sources: every column from the first source, in order, that has it."""
    rank = F.when(F.col("source") == "ufc", 2).otherwise(1)
    p = _p(spark, d).filter("full_name is not null").withColumn("key", text.squash_col(F.col("full_name")))
    first = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(rank.alias("r"), "profile_id"))).alias(c) for c in ("country_text", "height_text", "weight_text", "record_text")]
    return p.groupBy("key").agg(*first, F.count(F.lit(1)).alias("n"))


def e17_derived(spark, d):
    """Derived columns in their fixed order, later ones from earlier ones."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    day = F.lit(AS_OF).cast("date")
    f = table(spark, d, "fighters")
    f = f.withColumns({"age": dates.age(F.col("date_of_birth"), day), "days_inactive": F.coalesce("days_inactive", dates.days_since(F.col("last_fight_date"), day))})
    f = f.withColumn("active", domain.is_active(F.col("days_inactive")))
    f = f.withColumn("league", F.when(F.col("active"), domain.league_of_event(F.try_element_at(history.fights(F.col("fight_history")), F.lit(1))["event"])))
    f = f.withColumns({f"other_{p}": F.coalesce(f"record_other_{p}", F.greatest(z(f"record_total_{p}") - z(f"record_ufc_{p}"), F.lit(0))) for p in ("wins", "losses", "draws")})
    f = f.withColumn("fights", F.coalesce("total_fights", z("record_total_wins") + z("record_total_losses") + z("record_total_draws")))
    f = f.withColumn("win_pct", F.coalesce("win_percentage_int", measures.percent(z("record_total_wins"), F.col("fights"))))
    f = f.withColumn("origin", F.coalesce("weight_class_origin", "weight_class_current"))
    f = f.withColumn("sex", F.when(domain.gender_of(F.col("weight_class_current")) == "F", "F").otherwise(F.col("gender")))
    f = f.withColumn("champion", F.when(F.col("ufc_official_rank") == 0, True).otherwise(F.coalesce("is_ufc_champion", F.when(F.col("ufc_official_rank") > 0, False))))
    f = f.withColumn("title_wins", F.when(F.coalesce("champion", F.lit(False)), F.greatest(z("ufc_title_match_win"), F.lit(1))).otherwise(z("ufc_title_match_win")))
    return f.select("id", F.when(F.col("age").between(15, 90), F.col("age")).alias("age"), "days_inactive", "active", "league", "other_wins", "other_losses", "other_draws", "fights", "win_pct", "origin", "sex", "champion", "title_wins")


def w12_paired_mentions(spark, d):
    """Names beside each `met` of a text, with the first method told before the next one: nearest on either side, each method used
    once."""
    parts = F.split(F.col("text"), " met ")
    pairs = F.posexplode(F.transform(F.slice(parts, 2, F.size(parts)), lambda x, i: F.struct(F.element_at(parts, i + 1).alias("before"), x.alias("after")))).alias("pos", "m")
    t = _docs(spark, d).filter(F.col("text").contains(" met ")).select("doc_id", pairs)
    found = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    return t.select("doc_id", "pos", found("m.before", r"([A-Z][^.\n,]{2,60})$").alias("a"), found("m.after", r"^([^.\n,]{3,60}?) at ").alias("b"), found("m.after", r"ended by ([^\n]+?) at \d+:\d\d").alias("method"))


def r2_name_ledger(spark, d):
    """Fighters left to do when the names of some profiles have been done, whatever their case and marks."""
    done = _p(spark, d).filter("source = 'ufc'").select(text.squash_col(F.col("full_name")).alias("key"))
    return table(spark, d, "fighters").select("id", text.squash_col(F.col("name")).alias("key")).join(done, "key", "left_anti").select("id")


def r3_batch_visibility(spark, d):
    """Profiles of a batch in order: known by a stored name, by an earlier profile of the batch, or new."""
    p = _p(spark, d).filter("full_name is not null").select("profile_id", text.squash_col(F.col("full_name")).alias("key"))
    stored = table(spark, d, "fighters").groupBy(text.squash_col(F.col("name")).alias("key")).agg(F.min("id").alias("stored"))
    first = p.groupBy("key").agg(F.min("profile_id").alias("first"))
    seen = p.join(stored, "key", "left").join(first, "key")
    status = F.when(F.col("stored").isNotNull(), "stored").when(F.col("first") < F.col("profile_id"), "batch").otherwise("new")
    return seen.select("profile_id", status.alias("status"), F.coalesce("stored", F.when(F.col("first") < F.col("profile_id"), F.col("first"))).alias("match_id"))


def r4_failure_runs(spark, d):
    """Longest run of failed fetches of each source in order of fetching."""
    t = _docs(spark, d).filter("source is not null").select("source", "doc_id", (F.coalesce("status", F.lit(0)) != 200).alias("failed"))
    return failure_breaker(t, "source", "doc_id", "failed", 1)


def r5_backoff(spark, d):
    """Waiting time before the next try of every failed page, by the tries of its URL so far."""
    t = _docs(spark, d).filter("url is not null and coalesce(status, 0) <> 200").groupBy("url").agg(F.count(F.lit(1)).alias("tries"))
    return t.select("url", backoff_seconds(F.col("tries")).alias("wait"), backoff_seconds(F.col("tries"), 10, 300).alias("search_wait"))


def r6_reprocessing(spark, d):
    """Listings to process: unknown URLs, and known ones that are past; known upcoming ones wait."""
    number = lambda c: F.nullif(F.regexp_extract(c, r"/events/(\d+)", 1), F.lit(""))
    known = table(spark, d, "mma_events").select(number("tapology_url").alias("u"), F.lit(True).alias("known")).filter("u is not null").distinct()
    b = table(spark, d, "event_batches").select("raw_id", "date", number("tapology_url").alias("u")).join(known, "u", "left")
    action = F.when(F.col("known").isNull(), "new").when(F.coalesce(F.col("date") <= "2024-06-30", F.lit(False)), "again").otherwise("skip")
    return b.select("raw_id", action.alias("action"))


def r9_accepted_merges(spark, d):
    """Pairs to merge, split into accepted and rejected before anything is written: a row is merged once, the better pair first."""
    m = table(spark, d, "fighter_matches").filter("is_match and left_id <> right_id and left_id is not null and right_id is not null")
    pairs = m.groupBy(F.least("left_id", "right_id").alias("keep"), F.greatest("left_id", "right_id").alias("drop")).agg(F.max("score").alias("score"))
    best = pairs.groupBy("drop").agg(F.max_by("keep", F.struct(F.coalesce("score", F.lit(-1.0)), -F.col("keep"))).alias("best"))
    return pairs.join(best, "drop").select("keep", "drop", (F.col("keep") == F.col("best")).alias("accepted"))


def r10_recent_events(spark, d):
    """Events of the 30 days before and the 60 days after a day."""
    day = F.lit("2025-06-30").cast("date")
    return table(spark, d, "mma_events").filter(F.col("date").between(F.date_sub(day, 30), F.date_add(day, 60))).select("id", "date")


QUERIES = {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")}

from recordloom.plans.classify_queries import _ANY, _FIGHTS, _FOLD, _HEAD, _IN_TEXT, _LEAGUE, ORACLES as _CLASSES  # noqa: E402
from recordloom.plans.history_queries import _FI, _HOST, _SITE  # noqa: E402
from recordloom.plans.ladder_queries import _KEY, _NUM, _SCORE, _SPLIT, _SQUASH  # noqa: E402

_Q = "'"


def _rows(pattern: str, names: list[str], table_: str = "documents", key: str = "doc_id") -> str:
    """A relation of the groups of a pattern, one row a match."""
    p = pattern.replace("'", "''")
    lists = ", ".join(f"regexp_extract_all(text, '{p}', {i + 1}) g{i}" for i in range(len(names)))
    return f"(SELECT {key}, (generate_subscripts(g0, 1) - 1)::INT AS pos, {', '.join(f'unnest(g{i}) AS {n}' for i, n in enumerate(names))} FROM (SELECT {key}, {lists} FROM {table_}))"


_RANKS = _rows(extraction.RANK_LINE, ["place", "name", "wins", "losses", "draws"])
_REPORTS = _rows(extraction.REPORT, ["a", "b", "venue", "city", "day", "division", "method", "time", "round"])
_FRENCH = _rows(extraction.FRENCH_REPORT, ["a", "b", "venue", "city", "day", "method", "time", "round"])
_DAY = "try_strptime(replace(day, ',', ''), '%-d %B %Y')::DATE AS day, round::INT AS round"
_CORNERS = "(SELECT {0}, CASE WHEN len(p) > 1 THEN trim(p[1]) END AS a, trim(regexp_replace(p[2], '\\s+\\d$|\\s+[|\\-]\\s.*$', '', 'g')) AS b FROM (SELECT {0}, [x[1]] || CASE WHEN len(x) > 1 THEN [substr(t, length(x[1]) + length(regexp_extract(t, '(?i)\\s+vs?\\.?\\s+')) + 1)] ELSE [] END p FROM (SELECT {0}, t, regexp_split_to_array(t, '(?i)\\s+vs?\\.?\\s+') x FROM (SELECT {0}, regexp_replace({1}, '^[^:]*:\\s*', '') t FROM {2}))))"
_PROMO = "coalesce(" + ", ".join(f"CASE WHEN regexp_matches({w}, '{p}') THEN '{k}' END" for w in ("name", "left(text, 150)") for k, p in PROMOTIONS) + ")"
_LABEL = "nullif(trim(CASE WHEN regexp_extract(n, '(?im)^\\s*{0}\\s*:?[ \\t]+(\\S.*)$', 1) <> '' THEN regexp_extract(n, '(?im)^\\s*{0}\\s*:?[ \\t]+(\\S.*)$', 1) ELSE regexp_extract(n, '(?im)^\\s*{0}\\s*:?\\s*\\n\\s*(\\S.*)$', 1) END), '')"
_PART = "CASE WHEN regexp_matches(record_text, '^\\s*\\d+\\s*-\\s*\\d+') THEN coalesce(try_cast(nullif(regexp_extract(record_text, '^\\s*(\\d+)\\s*-\\s*(\\d+)(?:\\s*-\\s*(\\d+))?', {0}), '') AS INT), 0) END"
_CLASS = _CLASSES["t10_class_names"].split(" AS class_name FROM ")
ORACLES = {
    "s6_page_outcomes": "SELECT source, CASE WHEN text IS NULL OR NOT coalesce(status = 200, false) THEN 'FAIL' WHEN coalesce(regexp_matches(url, '^https?://[^/]+(?:/fightcenter)?/?$'), false) OR regexp_matches(lower(concat_ws(' ', title, left(text, 4000))), 'just a moment|access denied|are you human|removed by its owner') OR length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) < 60 THEN 'BLOCKED' ELSE 'OK' END AS outcome, count(*) AS n FROM documents GROUP BY 1, 2",
    "s7_site_pages": "SELECT doc_id, url, title FROM documents WHERE status = 200 AND length(text) > 500 AND source = 'ufc_fr'",
    "s8_json_rows": "SELECT event_type, ts::DATE AS day, sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS sum_k, count(json_extract_string(props, '$.missing')) AS n_missing FROM events GROUP BY 1, 2",
    "s9_dereferenced": f"WITH e AS (SELECT u, name FROM (SELECT {_NUM.format('tapology_url')} u, name, row_number() OVER (PARTITION BY {_NUM.format('tapology_url')} ORDER BY updated_at DESC, id DESC) r FROM mma_events) WHERE r = 1 AND u IS NOT NULL) SELECT raw_id, {_NUM.format('tapology_url')} AS ref, e.name AS body FROM event_batches b LEFT JOIN e ON e.u = {_NUM.format('b.tapology_url')}",
    "s11_url_list": "SELECT regexp_replace(w, '/+$', '') AS url, min(id) AS line FROM (SELECT id, unnest(regexp_split_to_array(trim(regexp_replace(regexp_replace(data_source, '\\|', ' ', 'g') || '/ # row ' || id, '(^|\\s)#.*$', '')), '\\s+')) w FROM fighters) WHERE regexp_matches(w, '^https?://') GROUP BY 1",
    "s13_source_blocks": f"WITH b AS (SELECT trim(b) url, p FROM (SELECT unnest(l) b, generate_subscripts(l, 1) - 1 p FROM (SELECT string_split(data_source, '|') l FROM fighters))) SELECT {_SITE.format(' ELSE ' + _Q + 'unknown' + _Q)} AS site, p::INT AS pos, count(*) AS n FROM (SELECT url, p, {_HOST} h FROM b WHERE url <> '') GROUP BY 1, 2",
    "s14_newest_nonempty": "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY fetched_at DESC NULLS LAST, doc_id DESC) r FROM documents WHERE source IS NOT NULL AND length(trim(text)) > 0) WHERE r = 1",
    "s15_listing_links": "SELECT slug, count(*) AS n FROM (SELECT unnest(regexp_extract_all(t, '/fightcenter/(?:fighters/)?(\\d+-[a-z0-9\\-]+)', 1)) slug FROM (SELECT data_source t FROM fighters UNION ALL SELECT concat_ws(' ', url, text) FROM documents)) GROUP BY 1",
    "s16_page_grid": "WITH g AS (SELECT promotion, ceil(count(*) / 25.0)::BIGINT l FROM mma_events WHERE promotion IS NOT NULL GROUP BY 1) SELECT promotion, l AS last_page, unnest(range(1, least(l, 50) + 1)) AS page FROM g",
    "s17_best_hits": f"WITH f AS (SELECT id, {_KEY.format('name')} n, {_SPLIT.format('name')} w, string_split({_KEY.format('name')}, ' ')[-1] l, regexp_split_to_array(trim(name), '\\s+') p, {_KEY.format('regexp_split_to_array(trim(name), chr(92) || chr(115) || chr(43))[1]')} a, {_KEY.format('regexp_split_to_array(trim(name), chr(92) || chr(115) || chr(43))[-1]')} z FROM fighters), p AS (SELECT profile_id, {_KEY.format('full_name')} h, NULL::VARCHAR s, string_split({_KEY.format('full_name')}, ' ')[-1] l FROM source_profiles), s AS (SELECT id, profile_id, {_SCORE} AS score FROM f JOIN p ON f.l = p.l AND f.l <> '') SELECT id, profile_id, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, profile_id) r FROM s WHERE score >= 60) WHERE r = 1",
    "s19_opponent_network": "WITH RECURSIVE e AS (SELECT fighter1_id a, fighter2_id b FROM event_fights WHERE fighter1_id <> fighter2_id UNION SELECT fighter2_id, fighter1_id FROM event_fights WHERE fighter1_id <> fighter2_id), r(id, steps) AS (SELECT id, 0 FROM fighters WHERE fightmatrix_id IS NOT NULL UNION SELECT e.b, r.steps + 1 FROM r JOIN e ON e.a = r.id WHERE r.steps < 40) SELECT id, min(steps)::INT AS steps FROM r GROUP BY 1",
    "e1_parser_dispatch": f"WITH u AS (SELECT doc_id, 'ranking' parser FROM {_RANKS} UNION ALL SELECT doc_id, 'report' FROM {_REPORTS} UNION ALL SELECT doc_id, 'french' FROM {_FRENCH}) SELECT source, parser, count(*) AS n_rows, count(DISTINCT doc_id) AS n_docs FROM u JOIN documents USING (doc_id) GROUP BY 1, 2",
    "e2_text_sources": "SELECT doc_id, CASE WHEN regexp_matches(text, '(?m)^\\d+\\. [^\\n]+ \\d+-\\d+-\\d+\\s*$') THEN 'ranking' WHEN regexp_matches(text, ' met [^\\n]+ at [^\\n]+ of round \\d') THEN 'report' WHEN regexp_matches(text, ' a battu [^\\n]+ du round \\d') THEN 'french' WHEN length(text) < 80 THEN 'headline' ELSE 'prose' END AS kind FROM documents",
    "e3_labels": f"SELECT id, {_LABEL.format('Coach')} AS coach, {_LABEL.format('Strong point')} AS strong_point FROM (SELECT id, regexp_replace(notes, '\\s*[|;\\n]\\s*', chr(10), 'g') n FROM fighters)",
    "e4_ranking_rows": f"SELECT doc_id, pos, name, place::INT AS place, wins::INT AS wins, losses::INT AS losses, draws::INT AS draws FROM {_RANKS}",
    "e5_report_rows": f"SELECT doc_id, pos, a, b, venue, city, division, method, time, {_DAY} FROM {_REPORTS}",
    "e6_scorecards": f"SELECT doc_id, pos, j1, j2, j3, try_cast(nullif(crowd, '') AS INT) AS crowd FROM {_rows('judges had it (' + chr(92) + 'd+-' + chr(92) + 'd+), (' + chr(92) + 'd+-' + chr(92) + 'd+) and (' + chr(92) + 'd+-' + chr(92) + 'd+)(?:[^.' + chr(92) + 'n]*crowd of (' + chr(92) + 'd+))?', ['j1', 'j2', 'j3', 'crowd'])}",
    "e7_origins": "SELECT doc_id, pos, place, name, sport, age::INT AS age FROM " + _rows(r"Born in ([^.\n,]+), ([^.\n,]+?) began with ([^.\n,]+?) at the age of (\d+)", ["place", "name", "sport", "age"]),
    "e8_divisions": "SELECT doc_id, pos, regexp_replace(array_to_string(list_transform(string_split(lower(trim(division)), ' '), lambda w: upper(w[1]) || w[2:]), ' '), '^Women(?:s|[''’][Ss])?\\b', 'Women''s') AS division, promotion, fighters::INT AS fighters, more::INT AS more, month FROM " + _rows(r"The ([a-z' ]+?) division at ([^.\n]+?) now has (\d+) contracted fighters, (\d+) more than in ([A-Z][a-z]+)", ["division", "promotion", "fighters", "more", "month"]),
    "e9_profile_fields": f"WITH c AS ({_CLASSES['t10_class_names']}) SELECT p.profile_id, coalesce(CASE WHEN regexp_matches(height_text, '^\\s*\\d+''\\s*\\d+') THEN regexp_extract(height_text, '^\\s*(\\d+)''\\s*(\\d+)', 1)::INT * 12 + regexp_extract(height_text, '^\\s*(\\d+)''\\s*(\\d+)', 2)::INT END, try_cast(nullif(regexp_extract(height_text, '^(\\d{{2}})\\s*in$', 1), '') AS INT), round(try_cast(nullif(regexp_extract(height_text, '^(\\d{{3}})\\s*cm$', 1), '') AS DOUBLE) / 2.54)::INT) AS inches, c.class_name AS class, {_ANY} AS born, {_PART.format(1)} AS wins, {_PART.format(2)} AS losses, {_PART.format(3)} AS draws FROM source_profiles p JOIN c USING (profile_id)",
    "e10_event_meta": f"WITH m AS (SELECT doc_id, text, coalesce(nullif(trim(regexp_replace(title, '\\s*\\|.*$', '')), ''), nullif(replace(regexp_extract(url, '/(?:\\d+-)?([^/?#]+)/?(?:[?#].*)?$', 1), '-', ' '), '')) name, {_IN_TEXT.format('text')} AS day FROM documents) SELECT doc_id, name, day, nullif(regexp_extract(text, ' at ([A-Z][^.\\n,]*?) in ([A-Z][^.\\n,]*?) on \\d', 1), '') AS venue, nullif(regexp_extract(text, ' at ([A-Z][^.\\n,]*?) in ([A-Z][^.\\n,]*?) on \\d', 2), '') AS city, {_PROMO} AS promotion, CASE WHEN day >= DATE '{AS_OF}' THEN 'upcoming' WHEN day IS NOT NULL THEN 'completed' END AS status FROM m",
    "e11_leads": "SELECT doc_id, length(trim(regexp_split_to_array(text, '(?m)^1\\. |The judges had it')[1]))::INT AS n_lead FROM documents",
    "e12_card_cascade": f"WITH u AS (SELECT doc_id, pos, a, b, 0 r, 'report' strategy FROM {_REPORTS} UNION ALL SELECT doc_id, pos, a, b, 1, 'french' FROM {_FRENCH} UNION ALL SELECT doc_id, 0, a, b, 2, 'title' FROM {_CORNERS.format('doc_id', 'title', 'documents')} WHERE b IS NOT NULL) SELECT doc_id, strategy, pos, a, b FROM (SELECT *, min(r) OVER (PARTITION BY doc_id) f FROM u) WHERE r = f",
    "e13_corner_names": f"SELECT raw_id, a, b FROM {_CORNERS.format('raw_id', 'name', 'event_batches')}",
    "e14_french_rows": f"SELECT doc_id, pos, a, b, venue, city, method, time, {_DAY} FROM {_FRENCH}",
    "e15_history_rows": f"WITH {_FI} SELECT id, (max(i) OVER (PARTITION BY id) - i + 1)::INT AS bout_order, r AS result, op AS opponent, json_extract_string(e, '$.method') AS method, coalesce(regexp_matches(lower(json_extract_string(e, '$.event')), 'title|championship'), false) AS is_title FROM fi",
    "e16_multi_source": f"SELECT key, {', '.join(f'arg_min({c}, (r, profile_id)) FILTER ({c} IS NOT NULL) AS {c}' for c in ('country_text', 'height_text', 'weight_text', 'record_text'))}, count(*) AS n FROM (SELECT *, {_SQUASH.format('full_name')} key, CASE WHEN source = 'ufc' THEN 2 ELSE 1 END r FROM source_profiles WHERE full_name IS NOT NULL) GROUP BY 1",
    "e17_derived": f"WITH a AS (SELECT *, (2026 - year(date_of_birth) - CASE WHEN (3, 1) < (month(date_of_birth), day(date_of_birth)) THEN 1 ELSE 0 END)::INT y, coalesce(days_inactive, datediff('day', last_fight_date, DATE '{AS_OF}')::INT) di, {_HEAD.format(_FIGHTS.format('event'))} h, coalesce(total_fights, coalesce(record_total_wins, 0) + coalesce(record_total_losses, 0) + coalesce(record_total_draws, 0)) tf, CASE WHEN ufc_official_rank = 0 THEN true ELSE coalesce(is_ufc_champion, CASE WHEN ufc_official_rank > 0 THEN false END) END ch FROM fighters) SELECT id, CASE WHEN y BETWEEN 15 AND 89 THEN y END AS age, di AS days_inactive, NOT coalesce(di > 1095, false) AS active, CASE WHEN NOT coalesce(di > 1095, false) THEN {_LEAGUE} END AS league, {', '.join(f'coalesce(record_other_{p}, greatest(coalesce(record_total_{p}, 0) - coalesce(record_ufc_{p}, 0), 0)) AS other_{p}' for p in ('wins', 'losses', 'draws'))}, tf AS fights, coalesce(win_percentage_int, CASE WHEN tf > 0 THEN round_even(coalesce(record_total_wins, 0) * 100.0 / tf, 0)::INT END) AS win_pct, coalesce(weight_class_origin, weight_class_current) AS origin, CASE WHEN regexp_matches(lower(weight_class_current), 'women|female|feminin') THEN 'F' ELSE gender END AS sex, ch AS champion, CASE WHEN coalesce(ch, false) THEN greatest(coalesce(ufc_title_match_win, 0), 1) ELSE coalesce(ufc_title_match_win, 0) END AS title_wins FROM a",
    "w12_paired_mentions": "SELECT doc_id, (i - 2)::INT AS pos, nullif(regexp_extract(p[i - 1], '([A-Z][^.\\n,]{2,60})$', 1), '') AS a, nullif(regexp_extract(p[i], '^([^.\\n,]{3,60}?) at ', 1), '') AS b, nullif(regexp_extract(p[i], 'ended by ([^\\n]+?) at \\d+:\\d\\d', 1), '') AS method FROM (SELECT doc_id, p, unnest(range(2, len(p) + 1)) i FROM (SELECT doc_id, string_split(text, ' met ') p FROM documents WHERE contains(text, ' met ')))",
    "r2_name_ledger": f"SELECT id FROM fighters WHERE {_SQUASH.format('name')} NOT IN (SELECT {_SQUASH.format('full_name')} FROM source_profiles WHERE source = 'ufc' AND full_name IS NOT NULL)",
    "r3_batch_visibility": f"WITH p AS (SELECT profile_id, {_SQUASH.format('full_name')} k FROM source_profiles WHERE full_name IS NOT NULL), s AS (SELECT {_SQUASH.format('name')} k, min(id) i FROM fighters GROUP BY 1), f AS (SELECT *, min(profile_id) OVER (PARTITION BY k) f FROM p) SELECT profile_id, CASE WHEN i IS NOT NULL THEN 'stored' WHEN f < profile_id THEN 'batch' ELSE 'new' END AS status, coalesce(i, CASE WHEN f < profile_id THEN f END) AS match_id FROM f LEFT JOIN s USING (k)",
    "r4_failure_runs": "WITH t AS (SELECT source, coalesce(status, 0) <> 200 f, sum((coalesce(status, 0) = 200)::INT) OVER (PARTITION BY source ORDER BY doc_id) g FROM documents WHERE source IS NOT NULL) SELECT source, max(n) AS longest FROM (SELECT source, g, count(*) n FROM t WHERE f GROUP BY 1, 2) GROUP BY 1",
    "r5_backoff": "SELECT url, least(120 * pow(2, count(*) - 1), 1800)::INT AS wait, least(10 * pow(2, count(*) - 1), 300)::INT AS search_wait FROM documents WHERE url IS NOT NULL AND coalesce(status, 0) <> 200 GROUP BY 1",
    "r6_reprocessing": f"SELECT raw_id, CASE WHEN e.u IS NULL THEN 'new' WHEN coalesce(date <= DATE '2024-06-30', false) THEN 'again' ELSE 'skip' END AS action FROM event_batches b LEFT JOIN (SELECT DISTINCT {_NUM.format('tapology_url')} u FROM mma_events) e ON e.u = {_NUM.format('b.tapology_url')}",
    "r9_accepted_merges": "WITH p AS (SELECT least(left_id, right_id) k, greatest(left_id, right_id) d, max(score) s FROM fighter_matches WHERE is_match AND left_id <> right_id GROUP BY 1, 2) SELECT k AS keep, d AS drop, row_number() OVER (PARTITION BY d ORDER BY coalesce(s, -1) DESC, k) = 1 AS accepted FROM p",
    "r10_recent_events": "SELECT id, date FROM mma_events WHERE date BETWEEN DATE '2025-06-30' - 30 AND DATE '2025-06-30' + 60",
}
