"""Free-entered values mapped to a canonical list by a symmetric-delete dictionary.

The dictionary holds the surfaces of every canonical entry (names, codes and generated variants), each under
all its deletions of up to `max_edits` letters. A value's own deletions meet those of any surface within that
edit distance; the meeting surfaces are ranked by weighted Damerau-Levenshtein distance, then by how often the
entry itself occurs in the data. Values near no surface, or that name something known to lie outside the list,
are reported as misses (entry 0).

The dictionary is kept in blocks of at most `MAX_SURFACES` surfaces, one block for any list of some thousand entries. A
block gives evidence (`Block.evidence`), and the entry is chosen from that of all blocks together, so the answer does not
depend on how the list is cut. One block is sent to the executors, and values are mapped where they lie, once for each
distinct value of a batch, so hot values cost nothing. Of several blocks one at a time is sent and looked up by the distinct
values; their evidence is written, brought together for each value, and joined back.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recordloom.functions.text import fold, squash
from recordloom.session import checkpoint

MAX_SURFACES = 100_000
_MEMO = 200_000
_MISS = (99.0, 0)

#: Words that may stand before an entry without being part of it.
_LEADS = ("team", "born in", "from", "the", "official", "promotion:", "by", "nationality:", "country:", "representing")
_LEAD = re.compile(r"^(?:" + "|".join(map(re.escape, _LEADS)) + r")(?=\s)\s*", re.I)
_VOWELS = frozenset("aeiouy")


def damerau(a: str, b: str, limit: float = 3.0) -> float:
    """Weighted Damerau-Levenshtein distance: doubled letters, transpositions and vowel swaps cost less than 1."""
    if a == b:
        return 0.0
    before, row = [], [float(j) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [float(i)]
        for j, y in enumerate(b, 1):
            drop = before[j] + (0.7 if i > 1 and a[i - 2] == x else 1.0)
            add = row[j - 1] + (0.7 if j > 1 and b[j - 2] == y else 1.0)
            swap = before[j - 1] + (0.0 if x == y else 0.9 if x in _VOWELS and y in _VOWELS else 1.0)
            best = min(drop, add, swap)
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2] and x != y:
                best = min(best, older[j - 2] + 0.8)
            row.append(best)
        if min(row) > limit:
            return limit + 1
    return row[-1]


def deletions(word: str, edits: int) -> set[str]:
    found = level = {word}
    for _ in range(edits):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        found = found | level
    return found


def allowed_edits(length: int) -> int:
    """Edits a value of so many letters may hold."""
    return 0 if length < 3 else 1 if length < 10 else 2


@dataclass
class Block:
    """A block of the dictionary of one field."""

    exact: dict[str, tuple[float, int]] = field(default_factory=dict)
    near: dict[str, tuple[str, ...]] = field(default_factory=dict)
    owner: dict[str, tuple[float, int]] = field(default_factory=dict)
    words: list[tuple[tuple[str, ...], int]] = field(default_factory=list)
    initials: dict[tuple[str, ...], list[tuple[tuple[str, ...], int]]] = field(default_factory=dict)
    squashed: list[tuple[str, int]] = field(default_factory=list)
    outside: frozenset[str] = frozenset()
    frequency: dict[int, int] = field(default_factory=dict)
    names: set[str] = field(default_factory=set)

    def candidates(self, key: str) -> Iterator[str]:
        edits = allowed_edits(len(key))
        seen = set()
        for d in deletions(key, edits):
            for surface in self.near.get(d, ()):
                if surface not in seen:
                    seen.add(surface)
                    yield surface

    def _shortened(self, value: str) -> set[int]:
        """The entries each of whose words the value's words shorten, or that begin with a value that ends in a stop."""
        given = [w.strip(".") for w in re.split(r"[\s_\-]+", fold(value).lower()) if w.strip(".")]
        if value.rstrip().endswith(".") and len(key := squash(value)) >= 6:
            at = bisect_left(self.squashed, (key, -1))
            begun = set()
            while at < len(self.squashed) and self.squashed[at][0].startswith(key):
                begun.add(self.squashed[at][1])
                at += 1
            if begun:
                return begun
        if "." not in value and len(given) < 2:
            return set()
        alike = self.initials.get(tuple(g[0] for g in given), ())
        return {owner for words, owner in alike if any(g != w for g, w in zip(given, words)) and any(len(g) > 1 for g in given) and all(_shortens(g, w) for g, w in zip(given, words))}

    def evidence(self, forms: list[str]) -> Iterator[tuple[int, int, bool, float, int, int]]:
        """What the block says of a value's forms, best stage and form first: `(stage, form, shortened, cost, -frequency, entry)`.
        Stage 0 is a surface as it stands (entry 0: known to lie outside), stage 1 a near or shortened one."""
        for i, form in enumerate(forms):
            k = squash(form)
            if k in self.outside:
                yield 0, i, False, -1.0, 0, 0
            elif k in self.exact:
                cost, entry = self.exact[k]
                yield 0, i, False, cost, -self.frequency.get(entry, 0), entry
        for i, form in enumerate(forms):
            k = squash(form)
            for surface in self.candidates(k):
                penalty, entry = self.owner[surface]
                edits = min(allowed_edits(len(k)), allowed_edits(len(surface)))
                distance = damerau(k, surface, edits)
                if distance <= edits:
                    yield 1, i, False, distance + penalty, -self.frequency.get(entry, 0), entry
            for entry in self._shortened(form):
                yield 1, i, True, 0.5, -self.frequency.get(entry, 0), entry


def chosen(evidence: Iterable[tuple[int, int, bool, float, int, int]]) -> tuple[float, int]:
    """(cost, entry) from the evidence of all blocks: of the first stage and form that has any the cheapest, then the more
    frequent entry. A value that shortens several entries shortens none."""
    by_form: dict[tuple[int, int], list] = {}
    for stage, form, shortened, *rank in evidence:
        by_form.setdefault((stage, form), []).append((shortened, tuple(rank)))
    for (stage, _), found in sorted(by_form.items()):
        shortened = {r[2] for s, r in found if s}
        ranks = [r for s, r in found if not s or len(shortened) == 1]
        if ranks:
            cost, _, entry = min(ranks)
            return (cost + stage, entry) if entry else (0.0, 0)
    return _MISS


def look_up(blocks: list[Block], value: str) -> tuple[float, int]:
    """(cost, entry) of a value; entry 0 at the highest cost for a miss, cost 0 for one known to lie outside."""
    if not squash(value):
        return _MISS
    forms = list(_forms(value))
    if len(blocks) != 1:
        return chosen(e for b in blocks for e in b.evidence(forms))
    # Of one block evidence comes in order: what follows the first form that decides is not asked for.
    held: list = []
    for e in blocks[0].evidence(forms):
        if held and e[:2] != held[-1][:2] and (found := chosen(held)) != _MISS:
            return found
        held.append(e)
    return chosen(held)


def _shortens(short: str, word: str) -> bool:
    if word.startswith(short):
        return True
    if len(short) < 3 or short[0] != word[0] or short[-1] != word[-1]:
        return False
    rest = iter(word)
    return all(c in rest for c in short)


def _forms(value: str) -> Iterator[str]:
    """The value as it stands, or what follows its last comma (a place within it); then without brackets, codes,
    numbers and leading words around it."""
    value = value.strip()
    head, comma, last = value.rpartition(",")
    if comma and head.strip() and last.strip():
        yield from _forms(last)
        return
    yield value
    bare = re.sub(r"[\(\[].*?[\)\]]", " ", value).strip()
    if bare and bare != value:
        yield bare
    base = bare or value
    while (m := _LEAD.match(base)) and base[m.end() :].strip():
        base = base[m.end() :].strip()
        yield base
    parts = [p.strip() for p in re.split(r"\s[/|\-–]\s", base) if p.strip()]
    if len(parts) > 1:
        yield parts[0]
    if m := re.match(r"^(.*\S)\s+#?\d+$", base):
        yield m.group(1)


Variants = Callable[[str, str | None], Iterable[tuple[str, float, bool]]]


def build_blocks(
    entries: Iterable[tuple[int, str, str | None]], variants: Variants, outside: Iterable[str] = (), frequency: dict[int, int] | None = None, size: int = MAX_SURFACES
) -> Iterator[Block]:
    """Blocks of at most `size` surfaces from entries `(id, name, code)`.

    `variants(name, code)` gives further surfaces `(text, cost, may hold typos)`; where two entries claim a
    surface the cheaper and then the more frequent one has it.
    """
    frequency = frequency or {}
    block, filled = None, 0
    for entry, name, code in entries:
        if block is None or filled >= size:
            if block:
                yield _sealed(block)
            block, filled = Block(outside=frozenset(map(squash, outside)), frequency=frequency), 0
        block.names.add(name)
        block.words.append((tuple(w for w in re.split(r"[\s_\-]+", fold(name).lower()) if w), entry))
        surfaces = [(name, 0.0, True), *([(code, 0.1, False)] if code else []), *variants(name, code)]
        for text, cost, typos in surfaces:
            key = squash(text)
            if not key:
                continue
            claim = (cost, entry)
            if key not in block.exact or (cost, -frequency.get(entry, 0)) < (block.exact[key][0], -frequency.get(block.exact[key][1], 0)):
                block.exact[key] = claim
                filled += 1
            if typos and len(key) >= 4 and (key not in block.owner or cost < block.owner[key][0]):
                block.owner[key] = claim
    if block:
        yield _sealed(block)


def _sealed(block: Block) -> Block:
    near: dict[str, list[str]] = {}
    for surface in block.owner:
        for d in deletions(surface, allowed_edits(len(surface))):
            near.setdefault(d, []).append(surface)
    block.near = {k: tuple(v) for k, v in near.items()}
    for words, owner in block.words:
        block.initials.setdefault(tuple(w[0] for w in words), []).append((words, owner))
    block.squashed = sorted(("".join(map(squash, words)), owner) for words, owner in block.words)
    return block


def map_values(df: DataFrame, id_col: str, values: dict[str, list[Block]], out_id: str = "record_id", out_entry: str = "canon_id", skip_exact: bool = True) -> DataFrame:
    """`(field, record_id, canon_id)` for each non-null value of the columns of `values`, 0 where none is meant.

    Values that are exactly an entry's name are left out unless `skip_exact` is false. Blank values are misses; repeated rows give repeated results; other columns are ignored.
    """
    id_type = df.schema[id_col].dataType
    spark = df.sparkSession
    schema = T.StructType([T.StructField("field", T.StringType()), T.StructField(out_id, id_type), T.StructField(out_entry, T.LongType())])
    slim = df.select(F.col(f"`{id_col}`").alias("key"), *[F.col(f"`{c}`").cast("string").alias(c) for c in values])
    if any(len(bs) > 1 for bs in values.values()):
        return _mapped_by_blocks(slim, values, skip_exact).select("field", F.col("key").alias(out_id), F.col("entry").alias(out_entry))
    blocks = spark.sparkContext.broadcast(values)

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[tuple[str, str], int] = {}
        for batch in batches:
            out = []
            for c, bs in blocks.value.items():
                part = batch[["key", c]].dropna(subset=[c])
                for v in part[c].unique():
                    if (c, v) not in memo:
                        if len(memo) > _MEMO:
                            memo.clear()
                        exact = skip_exact and any(v in b.names for b in bs)
                        memo[c, v] = -1 if exact else look_up(bs, v)[1]
                found = part[c].map({v: memo[c, v] for v in part[c].unique()}).astype("int64")
                out.append(pd.DataFrame({"field": c, out_id: part["key"], out_entry: found})[found >= 0])
            yield pd.concat(out).astype({"field": object}) if out else pd.DataFrame({"field": [], out_id: [], out_entry: []})

    return slim.mapInPandas(mapped, schema)


_EVIDENCE = "field string, value string, stage int, form int, shortened boolean, cost double, rare bigint, entry bigint"


def _mapped_by_blocks(slim: DataFrame, values: dict[str, list[Block]], skip_exact: bool) -> DataFrame:
    """`(field, key, entry)` with one block sent at a time; -2 marks values that are exactly a name."""
    sides = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in values])
    said = checkpoint(slim.select("key", F.explode(sides).alias("v")).select("key", "v.*").filter("value is not null"))
    distinct = checkpoint(said.select("field", "value").distinct())
    evidence = None
    for c, bs in values.items():
        for b in bs:
            sent = slim.sparkSession.sparkContext.broadcast(b)

            def tell(batches: Iterator[pd.DataFrame], c=c, sent=sent) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    rows = [(c, v, *e) for v in batch["value"] if squash(v) for e in sent.value.evidence(list(_forms(v)))]
                    rows += [(c, v, -1, 0, False, 0.0, 0, -2) for v in batch["value"] if skip_exact and v in sent.value.names]
                    yield pd.DataFrame(rows, columns=["field", "value", "stage", "form", "shortened", "cost", "rare", "entry"], dtype=object)

            part = checkpoint(distinct.filter(F.col("field") == c).mapInPandas(tell, _EVIDENCE))
            sent.destroy()
            evidence = part if evidence is None else evidence.unionByName(part)

    @F.pandas_udf(T.LongType())
    def choose(lists: pd.Series) -> pd.Series:
        return pd.Series([-2 if any(e["entry"] == -2 for e in x) else chosen((e["stage"], e["form"], e["shortened"], e["cost"], e["rare"], e["entry"]) for e in x)[1] for x in lists], dtype="int64")

    # A value has a few rows of evidence, however often it is entered.
    told = evidence.groupBy("field", "value").agg(F.collect_list(F.struct("stage", "form", "shortened", "cost", "rare", "entry")).alias("e")).select("field", "value", choose("e").alias("entry"))
    return said.join(told, ["field", "value"], "left").select("field", "key", F.coalesce("entry", F.lit(0)).alias("entry")).filter("entry >= 0")


# The adjective of each nationality.
DEMONYMS = {
    "Brazil": "Brazilian", "United States": "American", "France": "French", "Germany": "German", "Spain": "Spanish", "Portugal": "Portuguese",
    "Italy": "Italian", "Poland": "Polish", "Czech Republic": "Czech", "Austria": "Austrian", "Australia": "Australian", "New Zealand": "New Zealander",
    "Netherlands": "Dutch", "Belgium": "Belgian", "Switzerland": "Swiss", "Sweden": "Swedish", "Norway": "Norwegian", "Finland": "Finnish",
    "Denmark": "Danish", "Ireland": "Irish", "United Kingdom": "British", "Russia": "Russian", "Ukraine": "Ukrainian", "Georgia": "Georgian",
    "Armenia": "Armenian", "Kazakhstan": "Kazakh", "Uzbekistan": "Uzbek", "Turkey": "Turkish", "Japan": "Japanese", "South Korea": "South Korean",
    "China": "Chinese", "Thailand": "Thai", "Philippines": "Filipino", "Mexico": "Mexican", "Canada": "Canadian", "Argentina": "Argentine",
    "Chile": "Chilean", "Peru": "Peruvian", "Dominican Republic": "Dominican", "Cuba": "Cuban", "Nigeria": "Nigerian", "Cameroon": "Cameroonian",
    "South Africa": "South African", "Morocco": "Moroccan", "Iran": "Iranian", "Iraq": "Iraqi", "Slovakia": "Slovak", "Slovenia": "Slovenian",
    "Romania": "Romanian", "Hungary": "Hungarian",
}
# Further names of countries in use, in Latin letters.
OTHER_NAMES = {
    "United States": "USA, US, U.S., U.S.A., America, United States of America", "United Kingdom": "UK, Great Britain, Britain, England, Scotland, Wales",
    "Netherlands": "Holland, The Netherlands", "Russia": "Rossiya, Russian Federation", "Kazakhstan": "Qazaqstan", "Armenia": "Hayastan",
    "Georgia": "Sakartvelo", "Japan": "Nippon, Nihon", "South Korea": "Korea, Hanguk, Daehan Minguk, Republic of Korea, Korea Republic",
    "China": "PR China, Zhongguo, P.R. China, People's Republic of China", "Thailand": "Prathet Thai, Muang Thai", "Philippines": "Pilipinas",
    "Iraq": "Al-Iraq, Irak", "Morocco": "Al-Maghrib", "Iran": "Persia, Islamic Republic of Iran", "Ukraine": "Ukraina, Ukrayina",
    "Uzbekistan": "O'zbekiston", "New Zealand": "Aotearoa, NZ", "South Africa": "Suid-Afrika, RSA", "Czech Republic": "Czechia, Ceska republika",
    "Turkey": "Turkiye", "Ireland": "Eire", "Switzerland": "Schweiz, Suisse, Svizzera",
}
_LANGUAGES = ("en", "fr", "es", "pt", "de", "it", "nl")


def country_tables(spark: SparkSession, entries: Iterable[tuple[int, str, str | None]]) -> tuple[Variants, list[str]]:
    """Surfaces of countries from the locale data of the JVM, and the names of all countries outside the list.

    A country is found by its three-letter code or its English name; its surfaces are its names in some
    languages and its own, its codes and its adjective.
    """
    names, codes = _jvm_countries(spark)
    by_english = {v[0]: k for k, v in names.items()}
    by_code = {c: k for k, c in codes.items()}
    iso = {name: by_code.get(code or "") or by_english.get(name) for _, name, code in entries}
    known = {k for k in iso.values() if k}

    def variants(name: str, code: str | None) -> Iterator[tuple[str, float, bool]]:
        if country := iso.get(name):
            yield codes[country], 0.1, False
            for text in names[country]:
                yield text, 0.2, True
        if name in DEMONYMS:
            yield DEMONYMS[name], 0.2, True
        for text in OTHER_NAMES.get(name, "").split(", "):
            yield text, 0.2, len(text) > 5

    mine = {squash(t) for _, name, code in entries for t in (name, *(v[0] for v in variants(name, code)))}
    return variants, [t for k, v in names.items() if k not in known for t in v if squash(t) not in mine]


@cache
def _country_cache() -> dict:
    return {}


def _jvm_countries(spark: SparkSession) -> tuple[dict[str, list[str]], dict[str, str]]:
    kept = _country_cache()
    if not kept:
        jvm = spark._jvm.java.util.Locale
        languages = [jvm.forLanguageTag(x) for x in _LANGUAGES]
        own: dict[str, list[str]] = {}
        for available in jvm.getAvailableLocales():
            if m := re.fullmatch(r"([a-z]{2,3})_([A-Z]{2})", available.toString()):
                own.setdefault(m.group(2), []).append(m.group(1))
        names, codes = {}, {}
        for country in jvm.getISOCountries():
            place = jvm("", country)
            codes[country] = place.getISO3Country()
            spoken = [place.getDisplayCountry(x) for x in languages]
            if len(own.get(country, ())) <= 8:
                spoken += [place.getDisplayCountry(jvm.forLanguageTag(x)) for x in own.get(country, ())]
            names[country] = list(dict.fromkeys(spoken))
        kept["names"], kept["codes"] = names, codes
    return kept["names"], kept["codes"]


# Base word of a weight class, its limit in pounds, its abbreviation, its French name.
WEIGHTS = (
    ("Atomweight", 105, "AW", "atome"), ("Strawweight", 115, "SW", "paille"), ("Flyweight", 125, "FLW", "mouche"), ("Bantamweight", 135, "BW", "coq"),
    ("Featherweight", 145, "FTW", "plume"), ("Lightweight", 155, "LW", "leger"), ("Welterweight", 170, "WW", "mi-moyen"), ("Middleweight", 185, "MW", "moyen"),
    ("Light Heavyweight", 205, "LHW", "mi-lourd"), ("Heavyweight", 265, "HW", "lourd"),
)
_WOMEN, _MEN = ("Women's", "Womens", "Women", "Woman", "Female", "W", "Ladies", "F"), ("Men's", "Mens", "Men", "Male", "M", "")


def weight_variants(names: Iterable[str]) -> Variants:
    """Surfaces of weight classes: sex words, abbreviations, plurals, limits in pounds and kilograms, French names."""
    names = set(names)

    def variants(name: str, code: str | None) -> Iterator[tuple[str, float, bool]]:
        women = name.startswith("Women's ")
        base = name.removeprefix("Women's ")
        for word, pounds, short, french in WEIGHTS:
            if word != base:
                continue
            kilos = f"{pounds * 0.45359237:.1f}"
            bodies = [word, word + "s", word.replace("weight", "wt"), short, word.replace("weight", ""), f"{pounds}lb", f"{pounds}lbs", f"{pounds} pounds", f"{kilos}kg", str(pounds)]
            bodies += [f"{w}{s}{l}" for w in (word, word.replace("weight", "wt")) for s in (pounds,) for l in ("", "lb", "lbs")]
            bodies += [f"{word}{kilos}kg", f"{short}{pounds}"]
            alone = women and word not in names
            for lead in (*_WOMEN, *([""] if alone else [])) if women else _MEN:
                for body in bodies:
                    if lead or body != word.replace("weight", ""):
                        yield lead + body, 0.1, body == word and len(lead) > 4 or not lead and body == word
            for tail in (("femmes", "feminin", "femme", "feminins", "f", "w"), ("", "hommes", "masculin", "h", "m"))[not women]:
                yield f"poids {french} {tail}", 0.1, not tail

    return variants


def promotion_variants(name: str, code: str | None) -> Iterator[tuple[str, float, bool]]:
    """Surfaces of a promotion: its initials and its name with its code."""
    if code:
        yield name + code, 0.1, False
        yield code + name, 0.1, False
    initials = "".join(w[0] for w in name.split() if w[0].isupper())
    if len(initials) >= 3:
        yield initials, 0.3, False
