"""Queries over scans, predicates, scalar functions and extraction, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import dates, domain, history, measures, text
from recordloom.session import table

AS_OF = "2026-03-01"


def s2_pruned_scan(spark, d):
    return table(spark, d, "fighters").filter(F.col("data_quality_score") > 90).select("id", "name", "date_of_birth")


def s3_key_lookup(spark, d):
    """Fighters looked up by the ids of title bout winners."""
    ids = table(spark, d, "event_fights").filter("is_title_fight").select(F.col("winner_id").alias("id"))
    return table(spark, d, "fighters").select("id", "name").join(ids, "id", "left_semi")


def s4_accepted_documents(spark, d):
    return table(spark, d, "documents").filter("status = 200 and length(text) > 500").select("doc_id", "url")


def s5_real_content(spark, d):
    head = F.lower(F.concat_ws(" ", "title", F.substring("text", 1, 4000)))
    return table(spark, d, "documents").filter(~head.rlike("just a moment|page not found|access denied|are you human")).select("doc_id")


def s10_events_of_years(spark, d):
    e = table(spark, d, "mma_events").filter(F.col("date").between("2019-06-01", "2021-05-31"))
    return e.groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def s18_source_urls(spark, d):
    """Distinct URLs of the profiles of one site, from the pipe-separated fields."""
    u = table(spark, d, "fighters").select(F.explode(F.split("data_source", r"\|")).alias("url")).select(F.trim("url").alias("url"))
    return u.filter(F.col("url").contains("tapology")).distinct()


def f1_url_source(spark, d):
    return table(spark, d, "documents").select("doc_id", domain.url_source(F.col("url")).alias("site"))


def f3_source_keys(spark, d):
    u = table(spark, d, "fighters").select("id", F.explode(F.split("data_source", r"\|")).alias("url"))
    return u.select("id", domain.source_url_key(F.col("url")).alias("source_key")).filter("source_key is not null").distinct()


def f7_promotion_filter(spark, d):
    return table(spark, d, "mma_events").filter(F.upper("promotion").rlike("GRANITE|HARBOR|KESTREL")).select("id", "promotion")


def f9_missing_source(spark, d):
    return table(spark, d, "fighters").filter(F.coalesce(~F.lower("data_source").contains("tapology"), F.lit(True)) & F.col("is_active")).select("id", "name")


def n3_dedup_keys(spark, d):
    return table(spark, d, "fighters").select("id", text.dedup_name_key(F.col("name")).alias("key"))


def n4_sorted_keys(spark, d):
    return table(spark, d, "fighters").select("id", text.sorted_tokens_key(F.col("name")).alias("key"))


def n5_plain_keys(spark, d):
    return table(spark, d, "fighters").select("id", text.plain_name_key(F.col("name")).alias("key"))


def n6_squashed(spark, d):
    return table(spark, d, "fighters").select("id", text.squash_col(F.col("name")).alias("key"))


def n9_opponent_keys(spark, d):
    return table(spark, d, "event_fights").select("id", text.opponent_key(F.col("fighter1_name")).alias("key"))


def n11_nicknames(spark, d):
    return table(spark, d, "source_profiles").select("profile_id", text.nickname_of(F.col("full_name")).alias("nick"), text.name_without_nickname(F.col("full_name")).alias("bare"))


def n12_slugs(spark, d):
    return table(spark, d, "mma_events").filter("tapology_url is not null").select("id", text.url_slug(F.col("tapology_url")).alias("slug_of_url"))


def t1_near_surnames(spark, d):
    """Pairs of fighters of one birth date whose names are at most two edits apart."""
    f = table(spark, d, "fighters").filter("date_of_birth is not null").select("id", F.lower("name").alias("n"), "date_of_birth")
    a, b = f.alias("a"), f.alias("b")
    on = (F.col("a.date_of_birth") == F.col("b.date_of_birth")) & (F.col("a.id") < F.col("b.id"))
    return a.join(b, on).filter(F.levenshtein("a.n", "b.n", 2) >= 0).select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"))


def t8_method_categories(spark, d):
    m = F.col("method")
    return table(spark, d, "event_fights").groupBy(domain.method_category(m).alias("category"), domain.method_category_exact(m).alias("exact")).agg(F.count(F.lit(1)).alias("n"))


def t10_weight_classes(spark, d):
    return table(spark, d, "event_fights").select("id", domain.weight_class_of(F.col("weight_lbs")).alias("class_of_limit"), domain.gender_of(F.col("weight_class")).alias("gender"))


def d2_any_date(spark, d):
    return table(spark, d, "source_profiles").select("profile_id", dates.any_date(F.col("born_text")).alias("born"))


def d7_ages(spark, d):
    as_of = F.lit(AS_OF).cast("date")
    return table(spark, d, "fighters").filter("date_of_birth is not null").select("id", dates.age(F.col("date_of_birth"), as_of).alias("years"), dates.days_since(F.col("last_fight_date"), as_of).alias("idle_days"))


def am3_heights(spark, d):
    inches = measures.feet_to_inches(F.col("height_inches"))
    return table(spark, d, "fighters").filter("height_inches is not null").select("id", inches.alias("inches"), measures.inches_to_feet(inches).alias("feet"), measures.reach_inches(F.col("reach_inches")).alias("reach"))


def am8_record_parts(spark, d):
    r = F.col("record_text")
    return table(spark, d, "source_profiles").select("profile_id", *[measures.record_part(r, i).alias(n) for i, n in ((1, "w"), (2, "l"), (3, "dr"))])


def h1_history_entries(spark, d):
    h = F.col("fight_history")
    return table(spark, d, "fighters").select("id", F.size(history.fights(h)).alias("n_fights"), history.history_source(h).alias("source"))


QUERIES = {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__}

_KEY = "trim(regexp_replace(regexp_replace(lower(strip_accents(translate({0}, 'øØłŁ', 'oOlL'))), '[^a-z0-9 ]', '', 'g'), '\\s+', ' ', 'g'))"
_HOST = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/]*)', 1))"
_BORN = "regexp_replace(born_text, '^born ', '', 'i')"
ORACLES = {
    "s2_pruned_scan": "SELECT id, name, date_of_birth FROM fighters WHERE data_quality_score > 90",
    "s3_key_lookup": "SELECT id, name FROM fighters WHERE id IN (SELECT winner_id FROM event_fights WHERE is_title_fight)",
    "s4_accepted_documents": "SELECT doc_id, url FROM documents WHERE status = 200 AND length(text) > 500",
    "s5_real_content": "SELECT doc_id FROM documents WHERE NOT regexp_matches(lower(concat_ws(' ', title, left(text, 4000))), 'just a moment|page not found|access denied|are you human')",
    "s10_events_of_years": "SELECT year(date)::INT AS year, count(*) AS n FROM mma_events WHERE date BETWEEN DATE '2019-06-01' AND DATE '2021-05-31' GROUP BY 1",
    "s18_source_urls": "SELECT DISTINCT trim(u) AS url FROM (SELECT unnest(string_split(data_source, '|')) u FROM fighters) WHERE contains(u, 'tapology')",
    "f1_url_source": f"SELECT doc_id, CASE WHEN url IS NULL THEN NULL WHEN contains({_HOST}, 'fightmatrix') THEN 'fightmatrix' WHEN contains({_HOST}, 'tapology') THEN 'tapology' WHEN contains({_HOST}, 'underground') THEN 'underground' WHEN contains({_HOST}, 'ufc-fr') THEN 'ufc_fr' WHEN contains({_HOST}, 'ufc') AND contains(lower(url), '/athlete/') THEN 'ufc' ELSE 'unknown' END AS site FROM documents",
    "f3_source_keys": "SELECT DISTINCT id, k AS source_key FROM (SELECT id, CASE WHEN regexp_matches(u, '/fighter-profile/[^/]+/\\d+') THEN 'fm:' || regexp_extract(u, '/fighter-profile/[^/]+/(\\d+)', 1) WHEN regexp_matches(u, '/fightcenter/fighters/\\d+') THEN 'tap:' || regexp_extract(u, '/fightcenter/fighters/(\\d+)', 1) WHEN regexp_matches(u, '/combattant/[^,]+,\\d+') THEN 'ufr:' || regexp_extract(u, '/combattant/[^,]+,(\\d+)', 1) END k FROM (SELECT id, unnest(string_split(data_source, '|')) u FROM fighters)) WHERE k IS NOT NULL",
    "f7_promotion_filter": "SELECT id, promotion FROM mma_events WHERE regexp_matches(upper(promotion), 'GRANITE|HARBOR|KESTREL')",
    "f9_missing_source": "SELECT id, name FROM fighters WHERE coalesce(NOT contains(lower(data_source), 'tapology'), true) AND is_active",
    "n3_dedup_keys": f"SELECT id, {_KEY.format('name')} AS key FROM fighters",
    "n4_sorted_keys": f"SELECT id, array_to_string(list_sort(string_split({_KEY.format('name')}, ' ')), ' ') AS key FROM fighters",
    "n5_plain_keys": "SELECT id, lower(regexp_replace(regexp_replace(name, '[^a-zA-Z0-9 ]', '', 'g'), '\\s+', ' ', 'g')) AS key FROM fighters",
    "n6_squashed": "SELECT id, regexp_replace(lower(strip_accents(translate(name, 'øØłŁ', 'oOlL'))), '[^a-z0-9]+', '', 'g') AS key FROM fighters",
    "n9_opponent_keys": "SELECT id, trim(regexp_replace(lower(regexp_replace(fighter1_name, '\\s*#\\d+.*$', '')), '[\\s\\x{00a0}]+', ' ', 'g')) AS key FROM event_fights",
    "n11_nicknames": "SELECT profile_id, nullif(trim(CASE WHEN regexp_extract(full_name, '[\"“]([^\"”]+)[\"”]', 1) <> '' THEN regexp_extract(full_name, '[\"“]([^\"”]+)[\"”]', 1) ELSE regexp_extract(full_name, '\\(([^)]+)\\)', 1) END), '') AS nick, trim(regexp_replace(regexp_replace(regexp_replace(full_name, '[\"“][^\"”]*[\"”]', ' ', 'g'), '\\([^)]*\\)', ' ', 'g'), '[\\s\\x{00a0}]+', ' ', 'g')) AS bare FROM source_profiles",
    "n12_slugs": "SELECT id, regexp_extract(regexp_replace(regexp_replace(tapology_url, '[?#].*$', ''), '/+$', ''), '([^/]*)$', 1) AS slug_of_url FROM mma_events WHERE tapology_url IS NOT NULL",
    "t1_near_surnames": "SELECT a.id AS left_id, b.id AS right_id FROM fighters a JOIN fighters b ON a.date_of_birth = b.date_of_birth AND a.id < b.id WHERE levenshtein(lower(a.name), lower(b.name)) <= 2",
    "t8_method_categories": "SELECT CASE WHEN lower(method) LIKE '%ko%' OR lower(method) LIKE '%knockout%' THEN 'ko' WHEN lower(method) LIKE '%sub%' THEN 'sub' WHEN lower(method) LIKE '%dec%' THEN 'dec' WHEN method IS NOT NULL THEN 'other' END AS category, CASE WHEN upper(trim(method)) IN ('KO/TKO', 'KO', 'TKO') THEN 'ko' WHEN upper(trim(method)) = 'SUBMISSION' THEN 'sub' WHEN upper(trim(method)) = 'DECISION' THEN 'dec' WHEN method IS NOT NULL THEN 'other' END AS exact, count(*) AS n FROM event_fights GROUP BY 1, 2",
    "t10_weight_classes": "SELECT id, CASE WHEN weight_lbs <= 0 THEN NULL WHEN weight_lbs <= 105 THEN 'Atomweight' WHEN weight_lbs <= 115 THEN 'Strawweight' WHEN weight_lbs <= 125 THEN 'Flyweight' WHEN weight_lbs <= 135 THEN 'Bantamweight' WHEN weight_lbs <= 145 THEN 'Featherweight' WHEN weight_lbs <= 155 THEN 'Lightweight' WHEN weight_lbs <= 170 THEN 'Welterweight' WHEN weight_lbs <= 185 THEN 'Middleweight' WHEN weight_lbs <= 205 THEN 'Light Heavyweight' WHEN weight_lbs <= 265 THEN 'Heavyweight' END AS class_of_limit, CASE WHEN regexp_matches(lower(weight_class), 'women|female|feminin') THEN 'F' WHEN weight_class IS NOT NULL THEN 'M' END AS gender FROM event_fights",
    "d2_any_date": f"SELECT profile_id, coalesce(CASE WHEN regexp_full_match({_BORN}, '\\d{{4}}-\\d{{2}}-\\d{{2}}.*') THEN try_strptime(left({_BORN}, 10), '%Y-%m-%d') END, CASE WHEN regexp_full_match({_BORN}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN try_strptime({_BORN}, '%d/%m/%Y') END, CASE WHEN regexp_full_match({_BORN}, '\\d{{4}}\\.\\d{{2}}\\.\\d{{2}}') THEN try_strptime({_BORN}, '%Y.%m.%d') END, CASE WHEN regexp_full_match({_BORN}, '\\d{{8}}') THEN try_strptime({_BORN}, '%Y%m%d') END, CASE WHEN regexp_full_match({_BORN}, '[A-Z][a-z]{{2}} \\d{{1,2}}, \\d{{4}}') THEN try_strptime({_BORN}, '%b %-d, %Y') END, CASE WHEN regexp_full_match({_BORN}, '[A-Z][a-z]{{3,}} \\d{{1,2}}, \\d{{4}}') THEN try_strptime({_BORN}, '%B %-d, %Y') END, CASE WHEN regexp_full_match({_BORN}, '\\d{{1,2}} [A-Z][a-z]{{3,}} \\d{{4}}') THEN try_strptime({_BORN}, '%-d %B %Y') END)::DATE AS born FROM source_profiles",
    "d7_ages": f"SELECT id, CASE WHEN y > 10 AND y < 90 THEN y END AS years, datediff('day', last_fight_date, DATE '{AS_OF}')::INT AS idle_days FROM (SELECT *, (2026 - year(date_of_birth) - CASE WHEN (3, 1) < (month(date_of_birth), day(date_of_birth)) THEN 1 ELSE 0 END)::INT y FROM fighters WHERE date_of_birth IS NOT NULL)",
    "am3_heights": "SELECT id, i AS inches, (i // 12)::VARCHAR || '''' || (i % 12)::VARCHAR || '\"' AS feet, try_cast(nullif(regexp_extract(reach_inches, '(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS reach FROM (SELECT *, CASE WHEN regexp_matches(height_inches, '^\\s*\\d+''\\s*\\d+') THEN regexp_extract(height_inches, '^\\s*(\\d+)''\\s*(\\d+)', 1)::INT * 12 + regexp_extract(height_inches, '^\\s*(\\d+)''\\s*(\\d+)', 2)::INT END i FROM fighters WHERE height_inches IS NOT NULL)",
    "am8_record_parts": "SELECT profile_id, regexp_extract(record_text, '^\\s*(\\d+)\\s*-\\s*(\\d+)', 1)::INT AS w, regexp_extract(record_text, '^\\s*(\\d+)\\s*-\\s*(\\d+)', 2)::INT AS l, coalesce(try_cast(nullif(regexp_extract(record_text, '^\\s*(\\d+)\\s*-\\s*(\\d+)(?:\\s*-\\s*(\\d+))?', 3), '') AS INT), 0) AS dr FROM source_profiles WHERE regexp_matches(record_text, '^\\s*\\d+\\s*-\\s*\\d+') UNION ALL SELECT profile_id, NULL, NULL, NULL FROM source_profiles WHERE NOT coalesce(regexp_matches(record_text, '^\\s*\\d+\\s*-\\s*\\d+'), false)",
    "h1_history_entries": "SELECT id, CASE WHEN NOT coalesce(json_valid(fight_history), false) THEN 0 WHEN ltrim(fight_history) LIKE '[%' THEN json_array_length(fight_history) WHEN ltrim(fight_history) LIKE '{%' THEN coalesce(json_array_length(fight_history, '$.fights'), 0) ELSE 0 END::INT AS n_fights, CASE WHEN json_valid(fight_history) THEN lower(trim(json_extract_string(fight_history, '$.source'))) END AS source FROM fighters",
}
