"""Records, rates, heights and reaches."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def record_part(record: Column, part: int) -> Column:
    """Wins, losses or draws (1, 2, 3) of `W-L-D`; a missing draw is 0, an unreadable record null."""
    pattern = r"^\s*(\d+)\s*-\s*(\d+)(?:\s*-\s*(\d+))?"
    return F.when(record.rlike(pattern), F.coalesce(F.expr("int(0)") + F.nullif(F.regexp_extract(record, pattern, part), F.lit("")).try_cast("int"), F.lit(0)))


def percent(part: Column, whole: Column) -> Column:
    """Whole percent rounded half to even; null where the whole is not positive."""
    return F.when(whole > 0, F.bround(part * 100.0 / whole, 0).cast("int"))


def feet_to_inches(text: Column) -> Column:
    """Inches of `5'7"`."""
    pattern = r"^\s*(\d+)'\s*(\d+)"
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1).cast("int") * 12 + F.regexp_extract(text, pattern, 2).cast("int"))


def inches_to_feet(inches: Column) -> Column:
    """`f'i"'` of inches, with carry."""
    whole = F.round(inches).cast("int")
    return F.when(inches.isNotNull(), F.concat((F.floor(whole / 12)).cast("int").cast("string"), F.lit("'"), (whole % 12).cast("string"), F.lit('"')))


def cm_to_feet(cm: Column) -> Column:
    return inches_to_feet(cm / 2.54)


def cm_to_inches(cm: Column) -> Column:
    """Inches rounded half to even to one decimal."""
    return F.bround(cm / 2.54, 1)


def reach_inches(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+(?:\.\d+)?)", 1).try_cast("double")
