"""Classifiers over URLs, methods, weight classes and event names."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

# Site marker in a URL and the source it stands for, in order of test.
SOURCE_MARKERS = (("fightmatrix", "fightmatrix"), ("tapology", "tapology"), ("underground", "underground"), ("ufc-fr", "ufc_fr"), ("ufc", "ufc"))
# Upper limits of weight classes in pounds.
WEIGHT_LIMITS = ((105, "Atomweight"), (115, "Strawweight"), (125, "Flyweight"), (135, "Bantamweight"), (145, "Featherweight"), (155, "Lightweight"), (170, "Welterweight"), (185, "Middleweight"), (205, "Light Heavyweight"), (265, "Heavyweight"))
# Trust in the source of a fight history.
HISTORY_PRIORITY = {"tapology": 4, "ufcstats+scrape": 3, "ufcstats": 3, "event_scrape": 3, "ufc_fr": 2, "ufc": 2, "fightmatrix": 2, "underground": 1}


def url_source(url: Column) -> Column:
    """Source of a URL by its host; `ufc` needs an athlete page."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/]*)", 1))
    out = F.when(url.isNull(), F.lit(None).cast("string"))
    for marker, source in SOURCE_MARKERS:
        hit = host.contains(marker)
        out = out.when(hit & F.lower(url).contains("/athlete/") if source == "ufc" else hit, source)
    return out.otherwise("unknown")


def source_url_key(url: Column) -> Column:
    """Key `source:id` of a profile URL, null for other URLs."""
    fm = F.regexp_extract(url, r"/fighter-profile/[^/]+/(\d+)", 1)
    tap = F.regexp_extract(url, r"/fightcenter/fighters/(\d+)", 1)
    ufr = F.regexp_extract(url, r"/combattant/[^,]+,(\d+)", 1)
    return F.when(fm != "", F.concat(F.lit("fm:"), fm)).when(tap != "", F.concat(F.lit("tap:"), tap)).when(ufr != "", F.concat(F.lit("ufr:"), ufr))


def method_category(method: Column) -> Column:
    """`ko`, `sub`, `dec` or `other` by what the method's text contains."""
    m = F.lower(method)
    return F.when(m.contains("ko") | m.contains("knockout"), "ko").when(m.contains("sub"), "sub").when(m.contains("dec"), "dec").when(m.isNotNull(), "other")


def method_category_exact(method: Column) -> Column:
    """The same categories for whole method names only."""
    m = F.upper(F.trim(method))
    return F.when(m.isin("KO/TKO", "KO", "TKO"), "ko").when(m == "SUBMISSION", "sub").when(m == "DECISION", "dec").when(m.isNotNull(), "other")


def weight_class_of(pounds: Column) -> Column:
    """Class of a limit in pounds, null beyond the heaviest."""
    out = F.when(pounds <= 0, F.lit(None).cast("string"))
    for limit, name in WEIGHT_LIMITS:
        out = out.when(pounds <= limit, name)
    return out


def gender_of(weight_class: Column) -> Column:
    return F.when(F.lower(weight_class).rlike("women|female|feminin"), "F").when(weight_class.isNotNull(), "M")


# Words that name an organisation, and brands whose events belong to a parent.
ORGANISATION_WORDS = (
    "FC", "MMA", "UFC", "PFL", "ONE", "KSW", "RIZIN", "BKFC", "ACA", "ACB", "WEC", "LFA", "TUF", "EMC", "CFP", "MFC", "Championship", "Fighting", "League", "Tournament", "Series", "Cagefighting", "Combat",
    "Promotion", "Warriors", "Bellator", "PRIDE", "Strikeforce", "Invicta", "Octagon", "Oktagon", "Cage", "Arena", "Affliction", "DREAM", "Shooto", "Maktub", "Brave", "Eagle", "Ares", "HXMMA",
    "Hexagone", "DWCS", "Contender", "Future", "Katana", "Curitiba", "Brazilian", "Big Shot",
)
PARENT_BRANDS = (("UFC", r"(?i)\b(?:ufc|dwcs|tuf)\b|contender series|the ultimate fighter"), ("PFL", r"(?i)\bpfl\b|^professional fighters league$"))
_WEEKDAY = r"(?i)\s+(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday|Mon|Tue|Wed|Thu|Fri|Sat|Sun)\b.*$"


def league_of_event(event: Column) -> Column:
    """Promotion part of an event name without a weekday behind it: what stands before its number, `vs`, a dash or a
    colon, as its parent brand; null where that is one or two words of which none names an organisation."""
    s = F.trim(F.regexp_replace(event, _WEEKDAY, ""))
    head = F.regexp_replace(F.regexp_extract(s, r"(?i)^\s*(.+?)\s*(?:\s\d|\svs\b|[-:]|$)", 1), r"^[ \-:|.,]+|[ \-:|.,]+$", "")
    out = F.when(F.coalesce(head, F.lit("")) == "", F.lit(None).cast("string"))
    for brand, pattern in PARENT_BRANDS:
        out = out.when(head.rlike(pattern), brand)
    known = head.rlike(r"(?i)\b(?:" + "|".join(w.replace(" ", r"\s+") for w in ORGANISATION_WORDS) + r")\b")
    return out.when((F.size(F.split(head, r"\s+")) > 2) | known, head)


def history_priority(source: Column) -> Column:
    out = F.lit(0)
    for name, priority in HISTORY_PRIORITY.items():
        out = F.when(F.lower(F.trim(source)) == name, priority).otherwise(out)
    return out


def is_garbage_name(name: Column) -> Column:
    """Names that are none: too long, domains, error markers."""
    return F.coalesce((F.length(name) > 80) | F.lower(name).rlike(r"\.(com|net|org|fr|example|invalid)\b|just a moment|not found|access denied|error \d|cloudflare"), F.lit(True))


# Markers of other sports in event names, and sport codes on cards.
OTHER_SPORTS = ("kickboxing", "muay thai", "muaythai", "glory", "wgp", "kunlun", "wako", "superkombat", "it's showtime", "k-1", "enfusion", "shootboxing", "wu lin feng", "lion fight", "quintet")
SPORT_CODES = ("MMA", "QMMA", "KB", "BOX", "MT", "WR", "BJJ", "JD", "SM", "SAM", "K1", "K-1")


def sport_code(text: Column) -> Column:
    """The first sport code in capitals, null without one."""
    return F.nullif(F.regexp_extract(text, r"\b(" + "|".join(SPORT_CODES) + r")\b", 1), F.lit(""))


def is_pro_bout(division: Column, status: Column, sport: Column, kind: Column, event_name: Column) -> Column:
    """Bouts that count: not amateur, not cancelled, of no other sport, no exhibition; the event's name decides on the
    sport only where the bout has none. Missing values don't exclude."""
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    other = F.lit(False)
    for marker in OTHER_SPORTS:
        other = other | low(event_name).contains(marker)
    return ~low(division).contains("amateur") & ~low(status).isin("cancelled", "canceled") & low(sport).isin("", "mma") & ~low(kind).contains("exhibition") & ~((low(sport) == "") & other)


def external_ids(packed: Column) -> dict[str, Column]:
    """Ids of a person at the sites in a pipe-separated field: the last FightMatrix and the last forum id; the last id of the
    French site, else the first of the other two sites."""
    urls = F.split(packed, r"\|")
    last = lambda p: F.try_element_at(F.filter(F.transform(urls, lambda u: F.regexp_extract(u, p, 1)), lambda x: x != ""), F.lit(-1))
    either = F.transform(urls, lambda u: F.coalesce(F.nullif(F.regexp_extract(u, r"/fightcenter/fighters/(\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(u, r"/athlete/([\w-]+)", 1), F.lit(""))))
    return {
        "ufc_id": F.coalesce(last(r"/combattant/[^,]+,(\d+)"), F.try_element_at(F.filter(either, lambda x: x.isNotNull()), F.lit(1))),
        "fightmatrix_id": last(r"/fighter-profile/[^/]+/(\d+)"),
        "mma_com_id": last(r"underground[^/]*/f/([^/;?]+)"),
    }


def real_url(url: Column) -> Column:
    """The URL, null for data URIs."""
    return F.when(~F.lower(url).startswith("data:"), url)


# Names of methods in results.
METHOD_NAMES = {"KO/TKO": "KO/TKO", "TKO": "TKO", "KO": "KO", "SUBMISSION": "SUB", "SUB": "SUB", "DEC": "DEC", "DECISION": "DEC", "DQ": "DQ", "NO CONTEST": "NC", "NC": "NC", "DRAW": "DRAW"}


def method_name(method: Column) -> Column:
    """Short name of a whole method; unknown ones stay as they are."""
    out = F.when(F.coalesce(method, F.lit("")) == "", F.lit(None).cast("string"))
    for name, short in METHOD_NAMES.items():
        out = out.when(F.upper(method) == name, short)
    return out.otherwise(method)


def method_name_of_text(result: Column) -> Column:
    """Short name of a method by what its text contains; unknown ones in capitals."""
    n = F.lower(result)
    out = F.when(F.coalesce(result, F.lit("")) == "", F.lit(None).cast("string")).when(n.contains("ko"), "KO/TKO").when(n.contains("sub"), "SUB").when(n.contains("dec"), "DEC").when(n.contains("draw"), "DRAW")
    return out.when(n.contains("dq") | n.contains("disqual"), "DQ").when(n.contains("no contest") | (n == "nc"), "NC").otherwise(F.upper(result))


def card_section(label: Column) -> Column:
    low = F.lower(label)
    return F.when(low.contains("early"), "Early Prelims").when(low.contains("prelim"), "Prelims").otherwise("Main Card")


# Limits in pounds with a class of their own, abbreviations, and French names without accents.
CLASS_OF_POUNDS = {105: "Atomweight", 108: "Atomweight", 112: "Strawweight", 115: "Strawweight", 125: "Flyweight", 135: "Bantamweight", 145: "Featherweight", 155: "Lightweight", 165: "Super Lightweight", 170: "Welterweight", 175: "Super Welterweight", 185: "Middleweight", 205: "Light Heavyweight", 225: "Cruiserweight", 265: "Heavyweight"}
CLASS_ABBREVIATIONS = {"Light HW": "Light Heavyweight", "HeavyW": "Heavyweight", "MiddleW": "Middleweight", "WelterW": "Welterweight", "LightW": "Lightweight", "FeatherW": "Featherweight", "BantamW": "Bantamweight", "StrawW": "Strawweight", "AtomW": "Atomweight", "FlyW": "Flyweight"}
FRENCH_CLASSES = {"paille": "Strawweight", "mouche": "Flyweight", "coq": "Bantamweight", "plume": "Featherweight", "mi-moyen": "Welterweight", "mi-lourd": "Light Heavyweight", "leger": "Lightweight", "moyen": "Middleweight", "lourd": "Heavyweight"}


def class_name(text: Column) -> Column:
    """Class of a free text: a limit in pounds, an abbreviation, a French name or a leading `W `; else the text."""
    from recordloom.functions.text import fold_accents

    s = F.trim(F.regexp_replace(text, r"(?i)^(?:UFC|ONE|PFL)\s+", ""))
    pounds = F.regexp_extract(s, r"(?i)^(\d{3})\s*(?:lbs?)?$", 1)
    out = F.when(s.isNull(), F.lit(None).cast("string"))
    for limit, name in CLASS_OF_POUNDS.items():
        out = out.when(pounds == str(limit), name)
    for short, name in CLASS_ABBREVIATIONS.items():
        out = out.when(F.lower(s) == short.lower(), name)
    french = F.lower(fold_accents(s))
    for word, name in FRENCH_CLASSES.items():
        out = out.when(french.rlike(rf"^poids {word}s?\b"), name)
    return out.when(s.startswith("W "), F.concat(F.lit("Women's "), F.substring(s, 3, 100))).otherwise(s)


def class_casing(text: Column) -> Column:
    """Words with capitals, and `Women` with its apostrophe."""
    return F.regexp_replace(F.initcap(F.trim(text)), r"^Women(?:s|['’][Ss])?\b", "Women's")


# States whose name or abbreviation ends an American address.
US_STATES = ("alabama", "alaska", "arizona", "arkansas", "california", "colorado", "connecticut", "delaware", "florida", "hawaii", "idaho", "illinois", "indiana", "iowa", "kansas", "kentucky", "louisiana", "maine", "maryland", "massachusetts", "michigan", "minnesota", "mississippi", "missouri", "montana", "nebraska", "nevada", "new hampshire", "new jersey", "new mexico", "new york", "north carolina", "north dakota", "ohio", "oklahoma", "oregon", "pennsylvania", "rhode island", "south carolina", "south dakota", "tennessee", "texas", "utah", "vermont", "virginia", "washington", "west virginia", "wisconsin", "wyoming")


def birth_country(text: Column) -> Column:
    """Country at the end of a place of birth; states of the United States stand for it, texts that are no name give null."""
    last = F.trim(F.element_at(F.split(text, ","), -1))
    plain = F.when((last == "") | (F.length(last) > 50) | F.lower(last).isin("n/a", "none") | ~last.rlike(r"^[\p{L}\s\-.]+$"), F.lit(None).cast("string"))
    return plain.when(F.lower(last).isin(*US_STATES), "United States").otherwise(last)


# French names of countries.
FRENCH_COUNTRIES = {"allemagne": "Germany", "angleterre": "England", "argentine": "Argentina", "australie": "Australia", "autriche": "Austria", "belgique": "Belgium", "bresil": "Brazil", "cameroun": "Cameroon", "canada": "Canada", "chine": "China", "coree du sud": "South Korea", "espagne": "Spain", "etats-unis": "United States", "france": "France", "georgie": "Georgia", "irlande": "Ireland", "italie": "Italy", "japon": "Japan", "mexique": "Mexico", "nouvelle-zelande": "New Zealand", "pays-bas": "Netherlands", "pologne": "Poland", "royaume-uni": "United Kingdom", "russie": "Russia", "suede": "Sweden", "suisse": "Switzerland"}


def english_country(text: Column) -> Column:
    """English name of a country written in French; other texts as they are."""
    from recordloom.functions.text import fold_accents

    key = F.lower(fold_accents(F.trim(text)))
    names = F.create_map(*[F.lit(x) for pair in FRENCH_COUNTRIES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, key), text)


def flag_emoji(iso2: Column) -> Column:
    """Flag of a two-letter country code, null for anything else."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.upper(iso2).rlike("^[A-Z]{2}$"), F.translate(F.upper(iso2), letters, "".join(chr(0x1F1E6 + i) for i in range(26))))


# Sports and what names them in English and French texts, in order of test.
SPORT_PATTERNS = (("Wrestling", r"\b(?:lutte(?:ur)?|wrestl(?:ing|er)|grappling)\b"), ("Boxing", r"\b(?:boxe(?:ur)?|boxing|boxer)\b"), ("Judo", r"\bjudo(?:ka)?\b"), ("Kickboxing", r"\bkickbox(?:ing|eur)?\b"), ("Karate", r"\bkarate(?:ka)?\b"), ("Taekwondo", r"\btaekwondo\b"), ("Muay Thai", r"\bmuay.?thai\b"), ("Sambo", r"\bsambo\b"), ("BJJ", r"\bjiu.?jitsu|bjj\b"), ("Football", r"\bfootball americain|american football\b"), ("Basketball", r"\bbasketball\b"), ("Swimming", r"\bnatation|swimming\b"), ("Soccer", r"\bfootball\b"))


def first_sport(text: Column) -> Column:
    """The first sport of the ordered list that a text names."""
    from recordloom.functions.text import fold_accents

    low, out = F.lower(fold_accents(text)), F.when(text.isNull(), F.lit(None).cast("string"))
    for sport, pattern in SPORT_PATTERNS:
        out = out.when(low.rlike(pattern), sport)
    return out


# Stances in English and French.
STANCES = {"orthodox": "Orthodox", "southpaw": "Southpaw", "switch": "Switch", "open stance": "Open Stance", "orthodoxe": "Orthodox", "gauchere": "Southpaw", "gaucher": "Southpaw", "sud": "Southpaw", "ambidextre": "Switch"}


def stance_name(text: Column) -> Column:
    """English name of a stance; unknown ones under 25 letters as they are, longer texts give null."""
    from recordloom.functions.text import fold_accents

    key = F.lower(fold_accents(F.trim(text)))
    names = F.create_map(*[F.lit(x) for pair in STANCES.items() for x in pair])
    return F.when(F.length(text) < 25, F.coalesce(F.try_element_at(names, key), text))


def fighting_style(ko: Column, sub: Column, dec: Column, sport: Column) -> Column:
    """Style by the shares of win methods, from three wins on; null below."""
    ko, sub, dec = (F.coalesce(c, F.lit(0)) for c in (ko, sub, dec))
    n = F.nullif(ko + sub + dec, F.lit(0))
    grappling = F.lower(F.coalesce(sport, F.lit(""))).rlike("wrestl|lutte|sambo|judo")
    out = F.when(F.coalesce(n, F.lit(0)) < 3, F.lit(None).cast("string")).when(((ko + sub) / n >= 0.7) & (ko / n >= 0.15) & (sub / n >= 0.15), "Finisher").when(ko / n >= 0.4, "Striker").when(sub / n >= 0.35, "Grappler")
    return out.when(grappling & (dec / n >= 0.35), "Wrestler").when(dec / n >= 0.55, "Grinder").when((ko >= sub) & (ko >= dec), "Striker").when((sub >= ko) & (sub >= dec), "Grappler").otherwise("Grinder")


def promotion_of(name: Column, text: Column, patterns: Iterable[tuple[str, str]], head: int = 150) -> Column:
    """The first promotion of `(promotion, pattern)` whose pattern is in an event's name, else in the head of its page."""
    patterns = list(patterns)
    return F.coalesce(*[F.when(where.rlike(p), promotion) for where in (name, F.substring(text, 1, head)) for promotion, p in patterns])


def event_status(day: Column, as_of: Column) -> Column:
    return F.when(day.isNull(), F.lit(None).cast("string")).when(day >= as_of, "upcoming").otherwise("completed")


def is_active(days_inactive: Column) -> Column:
    """Inactive after three years without a bout; active where nothing is known."""
    return ~F.coalesce(days_inactive > 1095, F.lit(False))


# The points of a filled column, the base, and the points of a site and the most sites that count.
QUALITY_POINTS = (
    ("date_of_birth", 6), ("nationality", 3), ("nickname", 2), ("height_inches", 5), ("reach_inches", 5), ("stance", 4), ("first_sport", 4), ("ufc_official_rank", 3), ("photo_url", 2),
    ("photo_thumbnail_url", 2), ("fight_history", 6), ("career_debut_date", 2), ("last_fight_date", 2), ("fightmatrix_rating_points", 5), ("fightmatrix_540_metric", 2), ("wins_by_ko_tko", 2),
)
QUALITY_BASE, QUALITY_SITE, QUALITY_SITES = 20, 8, 4


def sites_of(packed: Column) -> Column:
    """Distinct known sites of a pipe-separated field of URLs."""
    return F.array_distinct(F.filter(F.transform(F.split(packed, r"\|"), lambda u: url_source(F.trim(u))), lambda x: x != "unknown"))


def quality_score(columns: Callable[[str], Column] = F.col) -> Column:
    """Completeness of a row, 0 to 100, by sites and filled columns; blank strings are missing."""
    score = F.lit(QUALITY_BASE) + QUALITY_SITE * F.least(F.coalesce(F.size(sites_of(columns("data_source"))), F.lit(0)), F.lit(QUALITY_SITES))
    for c, points in QUALITY_POINTS:
        score = score + F.when(F.trim(columns(c).cast("string")) != "", points).otherwise(0)
    return F.least(score, F.lit(100))
