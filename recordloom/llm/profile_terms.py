"""Terms of persons for the cross-source index, from typed or stored attributes."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordloom.llm.batch_dedup import letter_bits
from recordloom.llm.person_names import formal_names, halves, read_name

_MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
#: Kinds of terms; a term is a 64-bit hash whose low six bits are the kind.
KINDS = ("whole", "full", "pre", "suf", "init", "surname", "nick", "born", "bornym", "bornmd", "bornyd", "bornset", "country", "class", "height", "record", "bout")
TERMS = T.StructType([T.StructField("key", T.LongType()), T.StructField("terms", T.ArrayType(T.LongType())), T.StructField("dated", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in ("s1", "s2", "s3")]])
#: Sketches of a name: letters of the surnames it may hold. Surnames two edits apart differ in at most four bits.
SKETCHES, SKETCH_BITS = ("s1", "s2", "s3"), 4


def term_code(term: str) -> int:
    code = xxhash.xxh3_64_intdigest(term) & ~63 | KINDS.index(term.partition("=")[0])
    return code - (1 << 64) if code >> 63 else code


def term_kind(term: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), (term.bitwiseAND(F.lit(63)) + 1).cast("int"))


def read_dates(text: str | None) -> list[datetime.date]:
    """The dates a free text may mean; day and month swapped where both orders are possible."""
    if not text:
        return []
    s = text.lower()
    found: list[tuple[int, int, int]] = []
    if m := re.search(r"(\d{4})[.\-/ ](\d{1,2})[.\-/ ](\d{1,2})", s):
        found.append((int(m[1]), int(m[2]), int(m[3])))
    elif m := re.search(r"(?<!\d)(\d{1,2})[.\-/ ](\d{1,2})[.\-/ ](\d{4})", s):
        found += [(int(m[3]), int(m[2]), int(m[1])), (int(m[3]), int(m[1]), int(m[2]))]
    elif m := re.search(r"(?<!\d)(\d{4})(\d\d)(\d\d)(?!\d)", s):
        found.append((int(m[1]), int(m[2]), int(m[3])))
    elif m := re.search(r"(\d{1,2})(?:st|nd|rd|th)?\s+([a-z]{3})[a-z]*\.?,?\s+(\d{4})", s):
        found.append((int(m[3]), _MONTHS.get(m[2], 0), int(m[1])))
    elif m := re.search(r"([a-z]{3})[a-z]*\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})", s):
        found.append((int(m[3]), _MONTHS.get(m[1], 0), int(m[2])))
    out = []
    for y, mo, d in found:
        try:
            out.append(datetime.date(y, mo, d))
        except ValueError:
            pass
    return list(dict.fromkeys(out))


def read_inches(text: str | None) -> int | None:
    """A height in inches from feet and inches, inches, or centimetres."""
    if not text:
        return None
    if m := re.search(r"(\d)\s*['’′]\s*(\d{1,2})", text):
        return int(m[1]) * 12 + int(m[2])
    if m := re.search(r"(\d+(?:\.\d+)?)\s*(cm|in|\"|m\b)?", text):
        v = float(m[1])
        if m[2] == "cm" or v > 100:
            return round(v / 2.54)
        if m[2] == "m" and v < 3:
            return round(v * 100 / 2.54)
        return round(v) if 40 < v < 100 else None
    return None


def name_terms(text: str | None, nickname: str | None, givens: frozenset[str], parts: dict, query: bool) -> set[str]:
    """Name terms: whole names, surnames with an initial, either half of a surname with the given name (for a query also
    the halves of surnames a letter shorter or longer: one error leaves one half), nicknames."""
    n = read_name(text, givens)
    if n is None:
        return set()
    out = {f"whole={n.whole}"}
    nick = "".join(c for c in (nickname or "").lower() if c.isalnum())
    for given, surname in n.readings or [("", n.whole)]:
        for g in {given, *formal_names(given, parts)}:
            if len(g) > 1:
                out.add(f"full={g} {surname}")
                n_ = len(surname)
                for h in {n_ // 2, (n_ - 1) // 2, (n_ + 1) // 2} if query else {n_ // 2}:
                    if h > 1:
                        out |= {f"pre={g} {surname[:h]}", f"suf={g} {surname[-h:]}"}
        out.add(f"init={given[:1]} {surname}")
        out.add(f"surname={surname}")
        if nick:
            out.add(f"nick={nick} {surname}")
    if not nick and n.nickname and len(n.words) > 1:
        out.add(f"nick={n.nickname} {n.words[-1]}")
    return out


def surname_sketches(text: str | None, givens: frozenset[str]) -> list[int | None]:
    """Letter sets of the surnames of a name's readings and of its last word; two names `may_be_same` accepts have two that
    differ in at most `SKETCH_BITS` bits."""
    n = read_name(text, givens)
    if n is None:
        return [None] * 3
    found = list(dict.fromkeys([s for _, s in n.readings[:2]] + n.words[-1:])) or [n.whole]
    return ([letter_bits(w) for w in found] + [None] * 3)[:3]


def person_terms(df: DataFrame, pivots: list[str], countries: Callable[[], Callable[[str], int]], weights: Callable[[], Callable[[str], int]], query: bool) -> DataFrame:
    """`(key, terms, dated, *SKETCHES)`, the coded terms, whether a birth date was read and the `surname_sketches`, of rows `(key, name, nickname, born, country, height, weight, record, last)`, all but `key`
    strings; attributes that are missing or unreadable have no term."""
    givens, parts = frozenset(g.replace("-", "").replace("'", "") for g in pivots), halves(pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        country, weight, memo = countries(), weights(), {}

        def known(kind, f, text):
            if (kind, text) not in memo:
                if len(memo) > 200_000:
                    memo.clear()
                memo[kind, text] = f(text)
            return memo[kind, text]

        for batch in batches:
            keys, terms, dated, sketches = [], [], [], []
            for key, name, nick, born, home, height, wc, record, last in zip(*[batch[c] for c in ("key", "name", "nickname", "born", "country", "height", "weight", "record", "last")]):
                t = name_terms(name, nick, givens, parts, query)
                born_at = read_dates(born)
                for d in born_at:
                    t |= {f"born={d}", f"bornym={d:%Y-%m}", f"bornmd={d:%m-%d}", f"bornyd={d:%Y-%d}", f"bornset={d.year}-{min(d.month, d.day)}-{max(d.month, d.day)}"}
                if home and (c := known("c", country, home)):
                    t.add(f"country={c}")
                if wc and (c := known("w", weight, wc)):
                    t.add(f"class={c}")
                if (i := read_inches(height)) is not None:
                    t.add(f"height={i}")
                if record and (m := re.match(r"\s*(\d+)\s*-\s*(\d+)(?:\s*-\s*(\d+))?", record)):
                    t.add(f"record={int(m[1])}-{int(m[2])}-{int(m[3] or 0)}")
                for d in read_dates(last)[:1]:
                    t |= {f"bout={d}"}
                keys.append(key)
                terms.append([term_code(x) for x in t])
                dated.append(bool(born_at))
                sketches.append(surname_sketches(name, givens))
            yield pd.DataFrame({"key": pd.Series(keys, dtype="int64"), "terms": pd.Series(terms, dtype=object), "dated": pd.Series(dated, dtype=bool), **{c: pd.Series([x[i] for x in sketches], dtype="Int64") for i, c in enumerate(SKETCHES)}})

    picked = df.select(F.col("key").cast("long"), *[F.col(c).cast("string") for c in ("name", "nickname", "born", "country", "height", "weight", "record", "last")])
    return picked.mapInPandas(run, TERMS)
