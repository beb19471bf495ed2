"""Text folding as Column functions, with the same rules in plain Python for use inside Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column, functions as F

_NOT_ASCII = re.compile(r"[^\x00-\x7f]+")
#: Letters that Unicode doesn't decompose, as text.
_UNDECOMPOSED = {"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ı": "i", "ß": "s", "æ": "a", "Æ": "A", "œ": "o", "Œ": "O", "ð": "d", "Ð": "D", "þ": "t", "Þ": "T"}


@cache
def _fold_table() -> tuple[str, str]:
    """Source and target of `translate`: every accented Latin letter and its base, then marks to delete."""
    source, target = list(_UNDECOMPOSED), list(_UNDECOMPOSED.values())
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = [c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c)]
        if letter not in _UNDECOMPOSED and len(base) == 1 and base[0] != letter and base[0].isascii():
            source.append(letter)
            target.append(base[0])
    marks = [chr(c) for c in [*range(0x300, 0x370), 0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF]]
    return "".join(source) + "".join(marks), "".join(target)


@cache
def _fold_map() -> dict[int, str | None]:
    source, target = _fold_table()
    return {ord(c): target[i] if i < len(target) else None for i, c in enumerate(source)}


def fold_accents(text: Column) -> Column:
    """Latin letters without accents, without combining marks and invisible characters; stays in the JVM."""
    source, target = _fold_table()
    return F.translate(text, source, target)


def fold(text: str) -> str:
    """`fold_accents` for one Python string."""
    return text if text.isascii() else _NOT_ASCII.sub(_fold_run, text)


def _fold_run(m: re.Match) -> str:
    return m.group().translate(_fold_map())


def squash(text: str) -> str:
    """Lower case letters and digits only."""
    return "".join(c for c in fold(text).lower() if c.isalnum())


def squash_col(text: Column) -> Column:
    """`squash` as a Column (ASCII letters and digits)."""
    return F.regexp_replace(F.lower(fold_accents(text)), "[^a-z0-9]+", "")


def _squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[\\s\u00a0]+", " "))


def name_key(name: Column) -> Column:
    """Match key of a name: nicknames in brackets or quotes dropped, initials joined, hyphens and stops blank,
    `saint` as `st`, accents folded, lower case."""
    s = F.regexp_replace(name, r"\([^)]*\)", " ")
    s = F.regexp_replace(s, "[\"“”«»][^\"“”«»]*[\"“”«»]", " ")
    s = F.regexp_replace(s, "['’‘`´]", "")
    s = F.regexp_replace(s, r"\b([A-Za-z])\.\s*([A-Za-z])\.", "$1$2 ")
    s = F.regexp_replace(s, r"[.\-]", " ")
    s = F.lower(fold_accents(s))
    return _squeezed(F.regexp_replace(s, r"\bsaint\b", "st"))


def event_name_key(name: Column) -> Column:
    """Key of names on event cards: brackets dropped, apostrophes deleted, stops and hyphens blank, folded."""
    s = F.regexp_replace(F.regexp_replace(name, r"\([^)]*\)", " "), "['’‘`´]", "")
    return _squeezed(F.lower(fold_accents(F.regexp_replace(s, r"[.\-]", " "))))


def dedup_name_key(name: Column) -> Column:
    """Key of the duplicate finder: folded, everything but letters, digits and blanks deleted."""
    return _squeezed(F.regexp_replace(F.lower(fold_accents(name)), "[^a-z0-9 ]", ""))


def sorted_tokens_key(name: Column) -> Column:
    """`dedup_name_key` with its words in order, so reversed names meet."""
    return F.array_join(F.array_sort(F.split(dedup_name_key(name), " ")), " ")


def plain_name_key(name: Column) -> Column:
    """Lower case letters, digits and blanks; accented letters are deleted, not folded."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, "[^a-zA-Z0-9 ]", ""), r"\s+", " "))


def name_tokens(name: Column, least: int = 2) -> Column:
    """Distinct words of at least `least` letters of the match key."""
    return F.array_distinct(F.filter(F.split(name_key(name), " "), lambda w: F.length(w) >= least))


def opponent_key(name: Column) -> Column:
    """Opponent without rank (` #4 ...`), lower case, single blanks."""
    return _squeezed(F.lower(F.regexp_replace(name, r"\s*#\d+.*$", "")))


def nickname_of(name: Column) -> Column:
    """Nickname in quotes or brackets, null where there is none."""
    found = F.coalesce(F.regexp_extract(name, "[\"“]([^\"”]+)[\"”]", 1), F.lit(""))
    bracket = F.regexp_extract(name, r"\(([^)]+)\)", 1)
    return F.nullif(F.trim(F.when(found != "", found).otherwise(bracket)), F.lit(""))


def name_without_nickname(name: Column) -> Column:
    """Name without the part `nickname_of` reads."""
    return _squeezed(F.regexp_replace(F.regexp_replace(name, "[\"“][^\"”]*[\"”]", " "), r"\([^)]*\)", " "))


def url_slug(url: Column) -> Column:
    """Last path segment of a URL, without query and fragment."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", "")
    return F.regexp_extract(path, "([^/]*)$", 1)


def absolute_url(path: Column, base: str) -> Column:
    """Absolute form of a path, without slashes at its end."""
    return F.regexp_replace(F.when(path.startswith("/"), F.concat(F.lit(base.rstrip("/")), path)).otherwise(path), "/+$", "")


def opponent_tokens(name: Column) -> Column:
    """Distinct words of three letters or more of an opponent without rank."""
    bare = F.regexp_replace(F.lower(fold_accents(F.regexp_replace(name, r"#\d+.*$", ""))), "[^a-z0-9 ]", " ")
    return F.array_distinct(F.filter(F.split(bare, " +"), lambda w: F.length(w) >= 3))


def first_match(text: Column, patterns: Iterable[str]) -> Column:
    """First group of the first pattern that occurs in a text, null where none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns])


def without_repeated_slug(name: Column) -> Column:
    """An event name without the capitals before it that say its beginning again (`GFC 7 GFC 7: A vs. B`); the longest
    such beginning goes, names under four words stay."""
    words = F.split(name, r"\s+")
    plain = F.transform(words, lambda w: F.rtrim(F.lower(w), F.lit(".:")))
    n = F.size(words)
    halves = F.filter(F.sequence(F.lit(1), F.greatest(F.floor(n / 2), F.lit(1)).cast("int")), lambda h: F.slice(plain, 1, h) == F.slice(plain, h + 1, h))
    longest = F.array_max(halves)
    return F.when((n >= 4) & longest.isNotNull(), F.array_join(F.slice(words, longest + 1, n), " ")).otherwise(name)


def without_subtitle(name: Column) -> Column:
    """An event name without what stands behind a bar and without a discipline before `Event`; the first six words of
    names over 60 letters."""
    s = F.trim(F.regexp_replace(name, r"(?i)\s*(?:[|│].*|\b(?:Muay\s+Thai|Kickboxing|K-?1|Boxing|MMA|Grappling|Wrestling)\s+(?:&|Event\b|Combat\b).*)$", ""))
    return F.when(F.length(s) > 60, F.array_join(F.slice(F.split(s, r"\s+"), 1, 6), " ")).otherwise(s)
