"""Queries over classifiers and normalisers of URLs, names, dates, methods and classes, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import dates, domain, history, measures, text
from recordloom.plans.scalar_queries import AS_OF
from recordloom.session import table

#: Promotions of the test tables, by what names them.
PROMOTIONS = (("GRANITE", r"(?i)\b(?:gfc|granite fighting)"), ("HARBOR", r"(?i)\b(?:hcl|harbor cage)"), ("KESTREL", r"(?i)\b(?:kcs|kestrel combat)"))


def f2_external_ids(spark, d):
    return table(spark, d, "fighters").select("id", *[c.alias(k) for k, c in domain.external_ids(F.col("data_source")).items()])


def f4_garbage_names(spark, d):
    """Profiles and corners by whether their name is none."""
    names = table(spark, d, "source_profiles").select(F.col("full_name").alias("name")).unionByName(table(spark, d, "event_fights").select(F.col("fighter1_name").alias("name")))
    return names.groupBy(domain.is_garbage_name(F.col("name")).alias("garbage")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("name").alias("names"))


def f5_pro_bouts(spark, d):
    """Bouts that count: five conditions, the event's name as the last of them."""
    e = table(spark, d, "mma_events").select(F.col("id").alias("event_id"), F.col("name").alias("event_name"))
    b = table(spark, d, "event_fights").join(e, "event_id", "left")
    none = F.lit(None).cast("string")
    return b.filter(domain.is_pro_bout(F.col("weight_class"), F.col("status"), none, F.col("method_detail"), F.col("event_name"))).select("id", "event_id", "bout_order")


def f6_sport_codes(spark, d):
    """Sport codes in capitals, by source."""
    docs = table(spark, d, "documents").select("source", domain.sport_code(F.concat_ws(" ", "title", "text")).alias("code"))
    return docs.groupBy("source", "code").agg(F.count(F.lit(1)).alias("n"))


def f8_past_events(spark, d):
    """Events to process again: dated, past, since a day, of one promotion; oldest first."""
    past = F.col("date").isNotNull() & (F.col("date") <= AS_OF) & (F.col("date") >= "2020-01-01")
    return table(spark, d, "mma_events").filter(past & F.lower("promotion").contains("granite")).select("id", "date").orderBy("date", "id")


def f10_numeric_slugs(spark, d):
    u = table(spark, d, "mma_events").select("tapology_url").unionByName(table(spark, d, "event_batches").select("tapology_url"))
    return u.filter(F.col("tapology_url").rlike(r"/fightcenter/events/\d+-.+")).distinct()


def f12_completed_bouts(spark, d):
    """Bouts of completed events that have a date that isn't in the future."""
    e = table(spark, d, "mma_events").filter((F.col("status") == "completed") & (F.col("date") <= AS_OF)).select(F.col("id").alias("event_id"))
    return table(spark, d, "event_fights").select("id", "event_id").join(e, "event_id", "left_semi")


def f16_authoritative_histories(spark, d):
    return table(spark, d, "fighters").select("id", F.coalesce(history.history_source(F.col("fight_history")) == "tapology", F.lit(False)).alias("is_tapology"))


def f18_real_urls(spark, d):
    """URL columns without data URIs."""
    f = table(spark, d, "fighters")
    return f.select("id", *[domain.real_url(F.when(F.col("id") % 3 == 0, F.concat(F.lit("DATA:image/png;"), c)).otherwise(F.col(c))).alias(c) for c in ("photo_url", "photo_thumbnail_url")])


def n1_match_keys(spark, d):
    return table(spark, d, "source_profiles").select("profile_id", text.name_key(F.col("full_name")).alias("key"))


def n2_card_keys(spark, d):
    return table(spark, d, "event_fights").select("id", text.event_name_key(F.col("fighter2_name")).alias("key"))


def n8_name_tokens(spark, d):
    joined = lambda a: F.array_join(F.array_sort(a), " ")
    return table(spark, d, "event_fights").select("id", joined(text.opponent_tokens(F.col("fighter1_name"))).alias("tokens"))


def n10_folded(spark, d):
    return table(spark, d, "source_profiles").select("profile_id", F.lower(text.fold_accents(F.col("full_name"))).alias("folded"))


def n13_absolute_urls(spark, d):
    path = F.regexp_extract("url", r"^https?://[^/]+(/.*)$", 1)
    return table(spark, d, "documents").filter("url is not null").select("doc_id", text.absolute_url(F.concat(path, F.lit("/")), "https://site.example/").alias("absolute"))


def t2_first_match(spark, d):
    """The first of three date spellings that a document has."""
    patterns = (r"(\d{4}-\d{2}-\d{2})", r"([A-Z][a-z]+ \d{1,2}, \d{4})", r"(\d{1,2} [A-Z][a-z]+,? \d{4})")
    return table(spark, d, "documents").select("doc_id", text.first_match(F.col("text"), patterns).alias("found"))


def t3_leagues(spark, d):
    return table(spark, d, "mma_events").select("id", domain.league_of_event(F.trim("name")).alias("league"))


def t4_current_leagues(spark, d):
    """League of the newest bout of fighters who are active."""
    newest = F.try_element_at(history.fights(F.col("fight_history")), F.lit(1))["event"]
    return table(spark, d, "fighters").select("id", F.when(F.col("is_active"), domain.league_of_event(newest)).alias("league"))


def t5_promotions(spark, d):
    pages = table(spark, d, "documents").select("doc_id", domain.promotion_of(F.col("title"), F.col("text"), PROMOTIONS).alias("promotion"))
    return pages.filter("promotion is not null")


def t6_event_names(spark, d):
    """Names of listings without a slug in capitals before them and without a subtitle behind them."""
    return table(spark, d, "event_batches").select("raw_id", text.without_subtitle(text.without_repeated_slug(F.trim("name"))).alias("clean"))


def t7_methods(spark, d):
    m = F.col("method")
    return table(spark, d, "event_fights").groupBy(domain.method_name(m).alias("by_name"), domain.method_name_of_text(m).alias("by_text")).agg(F.count(F.lit(1)).alias("n"))


def t9_sections(spark, d):
    return table(spark, d, "event_fights").groupBy("card_section", domain.card_section(F.col("card_section")).alias("section")).agg(F.count(F.lit(1)).alias("n"))


def t10_class_names(spark, d):
    """Classes of weights as profiles write them."""
    return table(spark, d, "source_profiles").select("profile_id", domain.class_name(F.col("weight_text")).alias("class_name"))


def t11_class_casing(spark, d):
    return table(spark, d, "fighters").filter("weight_class_current is not null").select("id", domain.class_casing(F.lower("weight_class_current")).alias("cased"))


def t12_countries(spark, d):
    """Entry of the country list for a free text: spelled so, but for capitals, or among its words; the lower id on ties."""
    listed = table(spark, d, "canonical_values").filter("field = 'nationality'").select("canon_id", F.lower("canon_name").alias("word"), "canon_name")
    p = table(spark, d, "source_profiles").filter("country_text is not null").select("profile_id", "country_text")
    words = F.split(F.lower("country_text"), "[^a-z]+")
    runs = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))
    grams = F.flatten(F.array(*map(runs, (1, 2, 3))))
    looked_up = p.select("*", F.explode(F.array_union(F.array(F.lower("country_text")), grams)).alias("word")).join(listed, "word")
    rank = F.when(F.col("country_text") == F.col("canon_name"), 0).when(F.lower("country_text") == F.col("word"), 1).otherwise(2)
    return looked_up.groupBy("profile_id").agg(F.min(F.struct(rank.alias("r"), "canon_id")).alias("b")).select("profile_id", F.col("b.canon_id").alias("canon_id"), F.col("b.r").alias("way"))


def t13_birth_countries(spark, d):
    return table(spark, d, "source_profiles").select("profile_id", domain.birth_country(F.col("country_text")).alias("country"))


def t14_english_countries(spark, d):
    return table(spark, d, "source_profiles").filter("country_text is not null").select("profile_id", domain.english_country(F.col("country_text")).alias("country"))


def t15_first_sports(spark, d):
    return table(spark, d, "documents").select("doc_id", domain.first_sport(F.col("text")).alias("sport"))


def t16_styles(spark, d):
    f = table(spark, d, "fighters")
    return f.select("id", domain.stance_name(F.col("stance")).alias("stance"), domain.fighting_style(F.col("wins_by_ko_tko"), F.col("wins_by_submission"), F.col("wins_by_decision"), F.col("first_sport")).alias("style"))


def t17_event_status(spark, d):
    return table(spark, d, "mma_events").select("id", domain.event_status(F.col("date"), F.lit("2025-01-01").cast("date")).alias("status"))


def d1_dates(spark, d):
    return table(spark, d, "source_profiles").select("profile_id", dates.to_date(F.col("born_text")).alias("born"))


def d4_french_dates(spark, d):
    """Dates in French pages."""
    return table(spark, d, "documents").filter("lang = 'fr'").select("doc_id", dates.french_date(F.col("text")).alias("day"))


def d5_listed_dates(spark, d):
    """Dates that profiles give year first."""
    spelled = F.concat_ws(" · ", F.lit("•"), F.date_format(dates.any_date(F.col("born_text")), "yyyy MMM d"), "record_text")
    return table(spark, d, "source_profiles").select("profile_id", dates.listed_date(F.coalesce(F.when(F.col("profile_id") % 2 == 0, F.col("born_text")), spelled)).alias("born"))


def d6_iso_days(spark, d):
    """Days of times written with a zone."""
    written = F.when(F.col("id") % 2 == 0, F.date_format("created_at", "yyyy-MM-dd'T'HH:mm'Z'")).otherwise(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ssXXX"))
    return table(spark, d, "mma_events").select("id", dates.iso_date(written).alias("day"))


def d8_close_births(spark, d):
    """Profiles and fighters of one name whose birth dates lie in one year and at most 90 days apart."""
    p = table(spark, d, "source_profiles").select("profile_id", F.lower("full_name").alias("key"), dates.any_date(F.col("born_text")).alias("born"))
    f = table(spark, d, "fighters").select("id", F.lower("name").alias("key"), "date_of_birth")
    return p.join(f, "key").filter(dates.same_birth(F.col("born"), F.col("date_of_birth"))).select("profile_id", "id")


def d9_dates_in_text(spark, d):
    return table(spark, d, "documents").select("doc_id", dates.date_in_text(F.col("text")).alias("day"))


def d10_last_bout_dates(spark, d):
    """Date of the newest bout in a history: its own, else the one its event's name holds."""
    newest = F.try_element_at(history.fights(F.col("fight_history")), F.lit(1))
    return table(spark, d, "fighters").select("id", F.coalesce(dates.to_date(newest["event_date"]), dates.to_date(newest["date"]), dates.date_in_text(newest["event"])).alias("last_bout"))


def am1_percents(spark, d):
    """Win percent of decided bouts and of all bouts, finish percent of wins; halves to even."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    w, rest = z("record_total_wins"), z("record_total_losses") + z("record_total_draws")
    return table(spark, d, "fighters").select(
        "id", measures.percent(w, w + rest).alias("win_pct"), measures.percent(w, w + rest + z("record_total_nc")).alias("win_pct_of_all"), measures.percent(z("wins_by_ko_tko") + z("wins_by_submission"), w).alias("finish_pct")
    )


def am4_metric_sizes(spark, d):
    """Heights in centimetres as feet and inches, and as inches with one decimal."""
    cm = F.regexp_extract("height_text", r"^(\d{3}(?:\.\d+)?)\s*cm$", 1).try_cast("double")
    return table(spark, d, "source_profiles").select("profile_id", measures.cm_to_feet(cm).alias("feet"), measures.cm_to_inches(cm).alias("inches"))


def am5_active(spark, d):
    return table(spark, d, "fighters").select("id", domain.is_active(F.col("days_inactive")).alias("active"))


def am6_champions(spark, d):
    """Rank 0 is the champion; other ranks deny it only where nothing is known; a champion has won a title bout."""
    champion = F.when(F.col("ufc_official_rank") == 0, True).otherwise(F.coalesce("is_ufc_champion", F.when(F.col("ufc_official_rank") > 0, False)))
    wins = F.coalesce("ufc_title_match_win", F.lit(0))
    return table(spark, d, "fighters").select("id", champion.alias("champion"), F.when(F.coalesce(champion, F.lit(False)), F.greatest(wins, F.lit(1))).otherwise(wins).alias("title_wins"))


QUERIES = {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")}

_FOLD = "lower(strip_accents(translate({0}, 'øØłŁ', 'oOlL')))"
_IDS = "list_filter(list_transform(string_split(data_source, '|'), lambda u: regexp_extract(u, '{0}', 1)), lambda x: x <> '')"
_FIGHTS = "CASE WHEN NOT coalesce(json_valid(fight_history), false) THEN NULL WHEN ltrim(fight_history) LIKE '[%' THEN json_extract_string(fight_history, '$[0].{0}') ELSE json_extract_string(fight_history, '$.fights[0].{0}') END"
_BORN = "regexp_replace(born_text, '^born ', '', 'i')"
_ANY = f"coalesce(CASE WHEN regexp_full_match({_BORN}, '\\d{{4}}-\\d{{2}}-\\d{{2}}.*') THEN try_strptime(left({_BORN}, 10), '%Y-%m-%d') END, CASE WHEN regexp_full_match({_BORN}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN try_strptime({_BORN}, '%d/%m/%Y') END, CASE WHEN regexp_full_match({_BORN}, '\\d{{4}}\\.\\d{{2}}\\.\\d{{2}}') THEN try_strptime({_BORN}, '%Y.%m.%d') END, CASE WHEN regexp_full_match({_BORN}, '\\d{{8}}') THEN try_strptime({_BORN}, '%Y%m%d') END, CASE WHEN regexp_full_match({_BORN}, '[A-Z][a-z]{{2}} \\d{{1,2}}, \\d{{4}}') THEN try_strptime({_BORN}, '%b %-d, %Y') END, CASE WHEN regexp_full_match({_BORN}, '[A-Z][a-z]{{3,}} \\d{{1,2}}, \\d{{4}}') THEN try_strptime({_BORN}, '%B %-d, %Y') END, CASE WHEN regexp_full_match({_BORN}, '\\d{{1,2}} [A-Z][a-z]{{3,}} \\d{{4}}') THEN try_strptime({_BORN}, '%-d %B %Y') END)::DATE"
_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_IN_TEXT = f"coalesce(try_strptime(replace(nullif(regexp_extract({{0}}, '((?:{_MONTHS}) \\d{{{{1,2}}}}, \\d{{{{4}}}})', 1), ''), ',', ''), '%B %-d %Y'), try_strptime(replace(nullif(regexp_extract({{0}}, '(\\d{{{{1,2}}}} (?:{_MONTHS}),? \\d{{{{4}}}})', 1), ''), ',', ''), '%-d %B %Y'), try_strptime(nullif(regexp_extract({{0}}, '\\b(\\d{{{{2}}}}\\.\\d{{{{2}}}}\\.\\d{{{{4}}}})\\b', 1), ''), '%m.%d.%Y'), try_strptime(nullif(regexp_extract({{0}}, '(\\d{{{{4}}}}-\\d{{{{2}}}}-\\d{{{{2}}}})', 1), ''), '%Y-%m-%d'))::DATE"
_LEAGUE = "CASE WHEN coalesce(h, '') = '' THEN NULL WHEN regexp_matches(h, '(?i)\\b(?:ufc|dwcs|tuf)\\b|contender series|the ultimate fighter') THEN 'UFC' WHEN regexp_matches(h, '(?i)\\bpfl\\b|^professional fighters league$') THEN 'PFL' WHEN len(regexp_split_to_array(h, '\\s+')) > 2 OR regexp_matches(h, '(?i)\\b(?:" + "|".join(w.replace(" ", "\\s+") for w in domain.ORGANISATION_WORDS) + ")\\b') THEN h END"
_HEAD = "regexp_replace(regexp_extract(trim(regexp_replace({0}, '(?i)\\s+(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday|Mon|Tue|Wed|Thu|Fri|Sat|Sun)\\b.*$', '')), '(?i)^\\s*(.+?)\\s*(?:\\s\\d|\\svs\\b|[-:]|$)', 1), '^[ \\-:|.,]+|[ \\-:|.,]+$', '', 'g')"


def _case(column: str, pairs) -> str:
    return " ".join(f"WHEN {column.format(k)} THEN '{v}'" for k, v in pairs)


ORACLES = {
    "f2_external_ids": f"SELECT id, coalesce(({_IDS.format('/combattant/[^,]+,(\\d+)')})[-1], list_filter(list_transform(string_split(data_source, '|'), lambda u: coalesce(nullif(regexp_extract(u, '/fightcenter/fighters/(\\d+)', 1), ''), nullif(regexp_extract(u, '/athlete/([\\w-]+)', 1), ''))), lambda x: x IS NOT NULL)[1]) AS ufc_id, ({_IDS.format('/fighter-profile/[^/]+/(\\d+)')})[-1] AS fightmatrix_id, ({_IDS.format('underground[^/]*/f/([^/;?]+)')})[-1] AS mma_com_id FROM fighters",
    "f4_garbage_names": "SELECT coalesce(length(name) > 80 OR regexp_matches(lower(name), '\\.(com|net|org|fr|example|invalid)\\b|just a moment|not found|access denied|error \\d|cloudflare'), true) AS garbage, count(*) AS n, count(DISTINCT name) AS names FROM (SELECT full_name AS name FROM source_profiles UNION ALL SELECT fighter1_name FROM event_fights) GROUP BY 1",
    "f5_pro_bouts": "SELECT b.id, event_id, bout_order FROM event_fights b LEFT JOIN mma_events e ON e.id = b.event_id WHERE lower(coalesce(weight_class, '')) NOT LIKE '%amateur%' AND lower(trim(coalesce(b.status, ''))) NOT IN ('cancelled', 'canceled') AND lower(coalesce(method_detail, '')) NOT LIKE '%exhibition%' AND NOT (" + " OR ".join(f"contains(lower(coalesce(e.name, '')), '{m.replace(chr(39), chr(39) * 2)}')" for m in domain.OTHER_SPORTS) + ")",
    "f6_sport_codes": "SELECT source, nullif(regexp_extract(concat_ws(' ', title, text), '\\b(" + "|".join(domain.SPORT_CODES) + ")\\b', 1), '') AS code, count(*) AS n FROM documents GROUP BY 1, 2",
    "f8_past_events": f"SELECT id, date FROM mma_events WHERE date <= DATE '{AS_OF}' AND date >= DATE '2020-01-01' AND promotion ILIKE '%granite%' ORDER BY date, id",
    "f10_numeric_slugs": "SELECT DISTINCT tapology_url FROM (SELECT tapology_url FROM mma_events UNION ALL SELECT tapology_url FROM event_batches) WHERE regexp_matches(tapology_url, '/fightcenter/events/\\d+-.+')",
    "f12_completed_bouts": f"SELECT id, event_id FROM event_fights WHERE event_id IN (SELECT id FROM mma_events WHERE status = 'completed' AND date <= DATE '{AS_OF}')",
    "f16_authoritative_histories": "SELECT id, coalesce(CASE WHEN json_valid(fight_history) THEN lower(trim(json_extract_string(fight_history, '$.source'))) = 'tapology' END, false) AS is_tapology FROM fighters",
    "f18_real_urls": "SELECT id, CASE WHEN id % 3 <> 0 THEN photo_url END AS photo_url, CASE WHEN id % 3 <> 0 THEN photo_thumbnail_url END AS photo_thumbnail_url FROM fighters",
    "n1_match_keys": f"SELECT profile_id, trim(regexp_replace(regexp_replace({_FOLD.format('regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(full_name, $$\\([^)]*\\)$$, $$ $$, $$g$$), $$[\"“”«»][^\"“”«»]*[\"“”«»]$$, $$ $$, $$g$$), $$[\\x{27}’‘`´]$$, $$$$, $$g$$), $$\\b([A-Za-z])\\.\\s*([A-Za-z])\\.$$, $$\\1\\2 $$, $$g$$), $$[.\\-]$$, $$ $$, $$g$$)')}, '\\bsaint\\b', 'st', 'g'), '[\\s\\x{{00a0}}]+', ' ', 'g')) AS key FROM source_profiles",
    "n2_card_keys": f"SELECT id, trim(regexp_replace({_FOLD.format('regexp_replace(regexp_replace(regexp_replace(fighter2_name, $$\\([^)]*\\)$$, $$ $$, $$g$$), $$[\\x{27}’‘`´]$$, $$$$, $$g$$), $$[.\\-]$$, $$ $$, $$g$$)')}, '[\\s\\x{{00a0}}]+', ' ', 'g')) AS key FROM event_fights",
    "n8_name_tokens": f"SELECT id, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(regexp_replace({_FOLD.format('regexp_replace(fighter1_name, $$#\\d+.*$$ || chr(36), $$$$)')}, '[^a-z0-9 ]', ' ', 'g'), ' +'), lambda w: length(w) >= 3))), ' ') AS tokens FROM event_fights",
    "n10_folded": f"SELECT profile_id, {_FOLD.format('full_name')} AS folded FROM source_profiles",
    "n13_absolute_urls": "SELECT doc_id, regexp_replace('https://site.example' || regexp_extract(url, '^https?://[^/]+(/.*)$', 1) || '/', '/+$', '') AS absolute FROM documents WHERE url IS NOT NULL",
    "t2_first_match": "SELECT doc_id, coalesce(nullif(regexp_extract(text, '(\\d{4}-\\d{2}-\\d{2})', 1), ''), nullif(regexp_extract(text, '([A-Z][a-z]+ \\d{1,2}, \\d{4})', 1), ''), nullif(regexp_extract(text, '(\\d{1,2} [A-Z][a-z]+,? \\d{4})', 1), '')) AS found FROM documents",
    "t3_leagues": f"SELECT id, {_LEAGUE} AS league FROM (SELECT id, {_HEAD.format('trim(name)')} h FROM mma_events)",
    "d8_close_births": f"SELECT profile_id, id FROM (SELECT profile_id, lower(full_name) k, {_ANY} b FROM source_profiles) p JOIN fighters f ON lower(f.name) = k WHERE year(b) = year(date_of_birth) AND abs(datediff('day', b, date_of_birth)) <= 90",
    "t4_current_leagues": f"SELECT id, CASE WHEN is_active THEN {_LEAGUE} END AS league FROM (SELECT id, is_active, {_HEAD.format(_FIGHTS.format('event'))} h FROM fighters)",
    "t5_promotions": "SELECT * FROM (SELECT doc_id, coalesce(" + ", ".join(f"CASE WHEN regexp_matches({w}, '{p}') THEN '{k}' END" for w in ("title", "left(text, 150)") for k, p in PROMOTIONS) + ") AS promotion FROM documents) WHERE promotion IS NOT NULL",
    "t6_event_names": "WITH w AS (SELECT raw_id, trim(name) n, regexp_split_to_array(trim(name), '\\s+') w FROM event_batches), p AS (SELECT *, list_transform(w, lambda x: rtrim(lower(x), '.:')) p, len(w) k FROM w), h AS (SELECT *, list_max(list_filter(range(1, greatest(k // 2, 1) + 1), lambda h: p[1:h] = p[h + 1:2 * h])) h FROM p), s AS (SELECT raw_id, trim(regexp_replace(CASE WHEN k >= 4 AND h IS NOT NULL THEN array_to_string(w[h + 1:], ' ') ELSE n END, '(?i)\\s*(?:[|│].*|\\b(?:Muay\\s+Thai|Kickboxing|K-?1|Boxing|MMA|Grappling|Wrestling)\\s+(?:&|Event\\b|Combat\\b).*)$', '')) s FROM h) SELECT raw_id, CASE WHEN length(s) > 60 THEN array_to_string(regexp_split_to_array(s, '\\s+')[1:6], ' ') ELSE s END AS clean FROM s",
    "t7_methods": "SELECT CASE WHEN coalesce(method, '') = '' THEN NULL " + _case("upper(method) = '{0}'", domain.METHOD_NAMES.items()) + " ELSE method END AS by_name, CASE WHEN coalesce(method, '') = '' THEN NULL WHEN lower(method) LIKE '%ko%' THEN 'KO/TKO' WHEN lower(method) LIKE '%sub%' THEN 'SUB' WHEN lower(method) LIKE '%dec%' THEN 'DEC' WHEN lower(method) LIKE '%draw%' THEN 'DRAW' WHEN lower(method) LIKE '%dq%' OR lower(method) LIKE '%disqual%' THEN 'DQ' WHEN lower(method) LIKE '%no contest%' OR lower(method) = 'nc' THEN 'NC' ELSE upper(method) END AS by_text, count(*) AS n FROM event_fights GROUP BY 1, 2",
    "t9_sections": "SELECT card_section, CASE WHEN lower(card_section) LIKE '%early%' THEN 'Early Prelims' WHEN lower(card_section) LIKE '%prelim%' THEN 'Prelims' ELSE 'Main Card' END AS section, count(*) AS n FROM event_fights GROUP BY 1, 2",
    "t10_class_names": f"SELECT profile_id, CASE WHEN s IS NULL THEN NULL {_case('p = {0!r}', [(str(k), v) for k, v in domain.CLASS_OF_POUNDS.items()])} {_case('lower(s) = lower({0!r})', domain.CLASS_ABBREVIATIONS.items())} {_case('regexp_matches(f, {0!r})', [(f'^poids {k}s?' + chr(92) + 'b', v) for k, v in domain.FRENCH_CLASSES.items()]).replace(chr(92) * 2, chr(92))} WHEN s LIKE 'W %' THEN 'Women''s ' || s[3:] ELSE s END AS class_name FROM (SELECT profile_id, s, regexp_extract(s, '(?i)^(\\d{{3}})\\s*(?:lbs?)?$', 1) p, {_FOLD.format('s')} f FROM (SELECT profile_id, trim(regexp_replace(weight_text, '(?i)^(?:UFC|ONE|PFL)\\s+', '')) s FROM source_profiles))",
    "t11_class_casing": "SELECT id, regexp_replace(array_to_string(list_transform(string_split(lower(trim(weight_class_current)), ' '), lambda w: upper(w[1]) || w[2:]), ' '), '^Women(?:s|[''’][Ss])?\\b', 'Women''s') AS cased FROM fighters WHERE weight_class_current IS NOT NULL",
    "t12_countries": "WITH p AS (SELECT profile_id, country_text c, regexp_split_to_array(lower(country_text), '[^a-z]+') w FROM source_profiles WHERE country_text IS NOT NULL), g AS (SELECT profile_id, c, lower(c) word FROM p UNION SELECT profile_id, c, array_to_string(w[i:i + n - 1], ' ') FROM p, (SELECT unnest(range(1, 30)) i), (SELECT unnest([1, 2, 3]) n) WHERE i <= greatest(len(w) - n + 1, 1)), m AS (SELECT profile_id, canon_id, CASE WHEN c = canon_name THEN 0 WHEN lower(c) = word THEN 1 ELSE 2 END r FROM g JOIN canonical_values v ON v.field = 'nationality' AND lower(canon_name) = word) SELECT profile_id, canon_id, r::INT AS way FROM (SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY r, canon_id) k FROM m) WHERE k = 1",
    "t13_birth_countries": "SELECT profile_id, CASE WHEN l = '' OR length(l) > 50 OR lower(l) IN ('n/a', 'none') OR NOT regexp_matches(l, '^[\\p{L}\\s\\-.]+$') THEN NULL WHEN lower(l) IN (" + ", ".join(f"'{s}'" for s in domain.US_STATES) + ") THEN 'United States' ELSE l END AS country FROM (SELECT profile_id, trim(string_split(country_text, ',')[-1]) l FROM source_profiles)",
    "t14_english_countries": f"SELECT profile_id, CASE {_case(_FOLD.format('trim(country_text)') + ' = {0!r}', domain.FRENCH_COUNTRIES.items())} ELSE country_text END AS country FROM source_profiles WHERE country_text IS NOT NULL",
    "t15_first_sports": "SELECT doc_id, CASE WHEN text IS NULL THEN NULL " + " ".join(f"WHEN regexp_matches({_FOLD.format('text')}, '{p}') THEN '{k}'" for k, p in domain.SPORT_PATTERNS) + " END AS sport FROM documents",
    "t16_styles": f"WITH f AS (SELECT id, stance, lower(coalesce(first_sport, '')) sp, coalesce(wins_by_ko_tko, 0)::DOUBLE k, coalesce(wins_by_submission, 0)::DOUBLE s, coalesce(wins_by_decision, 0)::DOUBLE d FROM fighters), g AS (SELECT *, k + s + d n FROM f) SELECT id, CASE WHEN length(stance) < 25 THEN CASE {_case(_FOLD.format('trim(stance)') + ' = {0!r}', domain.STANCES.items())} ELSE stance END END AS stance, CASE WHEN n < 3 THEN NULL WHEN (k + s) / n >= 0.7 AND k / n >= 0.15 AND s / n >= 0.15 THEN 'Finisher' WHEN k / n >= 0.4 THEN 'Striker' WHEN s / n >= 0.35 THEN 'Grappler' WHEN regexp_matches(sp, 'wrestl|lutte|sambo|judo') AND d / n >= 0.35 THEN 'Wrestler' WHEN d / n >= 0.55 THEN 'Grinder' WHEN k >= s AND k >= d THEN 'Striker' WHEN s >= k AND s >= d THEN 'Grappler' ELSE 'Grinder' END AS style FROM g",
    "t17_event_status": "SELECT id, CASE WHEN date >= DATE '2025-01-01' THEN 'upcoming' WHEN date IS NOT NULL THEN 'completed' END AS status FROM mma_events",
    "d1_dates": "SELECT profile_id, CASE WHEN regexp_full_match(left(born_text, 10), '\\d{4}-\\d{2}-\\d{2}') THEN try_cast(left(born_text, 10) AS DATE) END AS born FROM source_profiles",
    "d4_french_dates": f"WITH f AS (SELECT doc_id, {_FOLD.format('text')} t FROM documents WHERE lang = 'fr'), g AS (SELECT doc_id, regexp_extract(t, '(\\d{{1,2}})(?:er)?\\s+({'|'.join(dates.FRENCH_MONTHS)})\\s+(\\d{{4}})', ['d', 'm', 'y']) x FROM f) SELECT doc_id, CASE WHEN x.m <> '' THEN try_cast(x.y || '-' || lpad(list_position([{', '.join(repr(m) for m in dates.FRENCH_MONTHS)}], x.m)::VARCHAR, 2, '0') || '-' || lpad(x.d, 2, '0') AS DATE) END AS day FROM g",
    "d5_listed_dates": f"SELECT profile_id, CASE WHEN profile_id % 2 = 0 AND born_text IS NOT NULL THEN try_strptime(nullif(regexp_extract(born_text, '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), ''), '%Y-%m-%d')::DATE ELSE {_ANY} END AS born FROM source_profiles",
    "d6_iso_days": "SELECT id, (created_at AT TIME ZONE 'UTC')::DATE AS day FROM mma_events",
    "d9_dates_in_text": f"SELECT doc_id, {_IN_TEXT.format('text')} AS day FROM documents",
    "d10_last_bout_dates": f"WITH f AS (SELECT id, {_FIGHTS.format('event_date')} e, {_FIGHTS.format('date')} d, {_FIGHTS.format('event')} n FROM fighters) SELECT id, coalesce(CASE WHEN regexp_full_match(left(e, 10), '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast(left(e, 10) AS DATE) END, CASE WHEN regexp_full_match(left(d, 10), '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast(left(d, 10) AS DATE) END, {_IN_TEXT.format('n')}) AS last_bout FROM f",
    "am1_percents": "SELECT id, CASE WHEN t > 0 THEN round_even(w * 100.0 / t, 0)::INT END AS win_pct, CASE WHEN t + nc > 0 THEN round_even(w * 100.0 / (t + nc), 0)::INT END AS win_pct_of_all, CASE WHEN w > 0 THEN round_even(f * 100.0 / w, 0)::INT END AS finish_pct FROM (SELECT id, coalesce(record_total_wins, 0)::DOUBLE w, (coalesce(record_total_wins, 0) + coalesce(record_total_losses, 0) + coalesce(record_total_draws, 0))::DOUBLE t, coalesce(record_total_nc, 0)::DOUBLE nc, (coalesce(wins_by_ko_tko, 0) + coalesce(wins_by_submission, 0))::DOUBLE f FROM fighters)",
    "am4_metric_sizes": "SELECT profile_id, CASE WHEN c IS NOT NULL THEN (round(c / 2.54)::INT // 12)::VARCHAR || '''' || (round(c / 2.54)::INT % 12)::VARCHAR || '\"' END AS feet, round_even(c / 2.54, 1) AS inches FROM (SELECT profile_id, try_cast(nullif(regexp_extract(height_text, '^(\\d{3}(?:\\.\\d+)?)\\s*cm$', 1), '') AS DOUBLE) c FROM source_profiles)",
    "am5_active": "SELECT id, NOT coalesce(days_inactive > 1095, false) AS active FROM fighters",
    "am6_champions": "SELECT id, c AS champion, CASE WHEN coalesce(c, false) THEN greatest(w, 1) ELSE w END AS title_wins FROM (SELECT id, CASE WHEN ufc_official_rank = 0 THEN true ELSE coalesce(is_ufc_champion, CASE WHEN ufc_official_rank > 0 THEN false END) END c, coalesce(ufc_title_match_win, 0) w FROM fighters)",
}
