"""Tolerant dates, ages and date distances."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# French months.
FRENCH_MONTHS = ("janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre")
_FORMATS = (r"^\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"), (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"), (r"^\d{4}\.\d{2}\.\d{2}$", "yyyy.MM.dd"), (r"^\d{8}$", "yyyyMMdd"), (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"), (r"^[A-Z][a-z]{3,} \d{1,2}, \d{4}$", "MMMM d, yyyy"), (r"^\d{1,2} [A-Z][a-z]{3,} \d{4}$", "d MMMM yyyy")


def to_date(text: Column) -> Column:
    """Date of the first ten characters in ISO form, else null."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def any_date(text: Column) -> Column:
    """Date of a text in one of the known formats (day before month where both are numbers), else null."""
    s = F.trim(F.regexp_replace(text, r"(?i)^born\s+", ""))
    found = None
    for pattern, form in _FORMATS:
        picked = F.when(s.rlike(pattern), F.try_to_date(F.substring(s, 1, 10) if form == "yyyy-MM-dd" else s, form))
        found = picked if found is None else F.coalesce(found, picked)
    return found


def french_date(text: Column) -> Column:
    """Date such as `29 septembre 1988`, anywhere in the text, else null."""
    from recordloom.functions.text import fold_accents

    s = F.lower(fold_accents(text))
    pattern = r"(\d{1,2})(?:er)?\s+(" + "|".join(FRENCH_MONTHS) + r")\s+(\d{4})"
    month = F.array_position(F.array(*[F.lit(m) for m in FRENCH_MONTHS]), F.regexp_extract(s, pattern, 2))
    iso = F.concat_ws("-", F.regexp_extract(s, pattern, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(s, pattern, 1), 2, "0"))
    return F.when(s.rlike(pattern), F.try_to_date(iso, "yyyy-MM-dd"))


def age(born: Column, as_of: Column, low: int = 10, high: int = 90) -> Column:
    """Completed years by comparing month and day; null outside (low, high)."""
    before = F.struct(F.month(as_of), F.dayofmonth(as_of)) < F.struct(F.month(born), F.dayofmonth(born))
    years = F.year(as_of) - F.year(born) - before.cast("int")
    return F.when((years > low) & (years < high), years)


def days_since(day: Column, as_of: Column) -> Column:
    return F.datediff(as_of, day)


def within_days(a: Column, b: Column, days: int) -> Column:
    """Whether two dates lie at most `days` apart; null where one is missing."""
    return F.abs(F.datediff(a, b)) <= days


def same_birth(a: Column, b: Column) -> Column:
    """Same year and at most 90 days apart."""
    return (F.year(a) == F.year(b)) & within_days(a, b, 90)


def listed_date(text: Column) -> Column:
    """Date of `2016 Apr 10` or an ISO date, bullets and text around it ignored; else null."""
    spaced = F.try_to_date(F.regexp_extract(text, r"(\d{4} [A-Z][a-z]{2} \d{1,2})", 1), "yyyy MMM d")
    return F.coalesce(F.try_to_date(F.regexp_extract(text, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd"), spaced)


def iso_date(text: Column) -> Column:
    """Day (UTC) of an ISO 8601 time with or without a zone; else null."""
    zoned = F.regexp_replace(text, "Z$", "+00:00")
    return F.coalesce(F.try_to_timestamp(zoned), F.try_to_timestamp(zoned, F.lit("yyyy-MM-dd'T'HH:mmXXX"))).cast("date")


# Months in English.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def date_in_text(text: Column) -> Column:
    """The first `Month D, YYYY` or `D Month, YYYY` of a text, else its first `MM.DD.YYYY`, else its first ISO date."""
    names = "|".join(m.title() for m in MONTHS)
    english = F.regexp_replace(F.regexp_extract(text, rf"((?:{names}) \d{{1,2}}, \d{{4}})", 1), ",", "")
    other = F.regexp_replace(F.regexp_extract(text, rf"(\d{{1,2}} (?:{names}),? \d{{4}})", 1), ",", "")
    dotted = F.try_to_date(F.regexp_extract(text, r"\b(\d{2}\.\d{2}\.\d{4})\b", 1), "MM.dd.yyyy")
    return F.coalesce(F.try_to_date(english, "MMMM d yyyy"), F.try_to_date(other, "d MMMM yyyy"), dotted, F.try_to_date(F.regexp_extract(text, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd"))
