"""Pages to rows: flattened HTML, labelled values, tables, event pages, event JSON, bout cards."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordloom.functions.dates import any_date, french_date

_BLOCKS = frozenset("p br div li ul ol tr table h1 h2 h3 h4 h5 h6 dt dd section article header footer".split())


class _Flat(HTMLParser):
    """Text with a line for each block, and the cells of every table row."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        if tag in _BLOCKS:
            self.parts.append("\n")
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self.cell = []

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style") and self.hidden > 0
        if tag in ("td", "th") and self.cell is not None and self.rows:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None
        if tag in _BLOCKS or tag in ("td", "th"):
            self.parts.append("\n" if tag in _BLOCKS else "\t")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            if self.cell is not None:
                self.cell.append(data)


def flatten(body: str | None) -> tuple[str, list[list[str]]]:
    """Lines of text and table rows of an HTML body; broken markup is read as far as it goes."""
    if not body:
        return "", []
    p = _Flat()
    p.feed(body)
    p.close()
    lines = (" ".join(x.split()) for x in html.unescape("".join(p.parts)).split("\n"))
    return "\n".join(x for x in lines if x), [r for r in p.rows if any(r)]


def flat_pages(documents: DataFrame, id_col: str, body: str) -> DataFrame:
    """`(id, text, rows)`: flattened text and table rows of HTML bodies; null bodies give empty ones."""
    schema = T.StructType([T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("text", T.StringType()), T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType())))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [flatten(x) for x in b["body"]]
            yield pd.DataFrame({id_col: b["key"], "text": pd.Series([t for t, _ in found], dtype=object), "rows": pd.Series([r for _, r in found], dtype=object)})

    return documents.select(F.col(id_col).alias("key"), F.col(body).alias("body")).mapInPandas(run, schema)


def labelled_value(text: Column, label: str) -> Column:
    """What follows `label:` on its line, or stands on the next line; null without the label."""
    same = F.regexp_extract(text, rf"(?im)^\s*{re.escape(label)}\s*:?[ \t]+(\S.*)$", 1)
    below = F.regexp_extract(text, rf"(?im)^\s*{re.escape(label)}\s*:?\s*\n\s*(\S.*)$", 1)
    return F.nullif(F.trim(F.when(same != "", same).otherwise(below)), F.lit(""))


def event_meta(pages: DataFrame) -> DataFrame:
    """`(*, name, event_date, venue, location)` of event pages `(url, title, text)`: the title, else the slug names
    the event; dates in ISO, English or French form."""
    iso = F.try_to_date(F.regexp_extract("text", r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    dotted = F.regexp_extract("text", r"\b(\d{2})\.(\d{2})\.(\d{4})\b", 0)
    english = F.regexp_extract("text", r"([A-Z][a-z]{2,8} \d{1,2}, \d{4})", 1)
    slug = F.regexp_replace(F.regexp_extract("url", r"/(?:\d+-)?([^/?#]+)/?(?:[?#].*)?$", 1), "-", " ")
    title = F.nullif(F.trim(F.regexp_replace("title", r"\s*[|–-]\s*(?:Results|Tapology|MMA.*)$", "")), F.lit(""))
    day = F.coalesce(iso, any_date(english), F.try_to_date(dotted, "MM.dd.yyyy"), french_date(F.col("text")))
    return pages.withColumns({"name": F.coalesce(title, F.initcap(slug)), "event_date": day, "venue": labelled_value(F.col("text"), "Venue"), "location": labelled_value(F.col("text"), "Location")})


BOUT = "struct<order:int,winner:boolean,name:string>"
EVENT_JSON = f"struct<id:string,name:string,date:string,competitions:array<struct<segment:string,status:string,method:string,competitors:array<{BOUT}>>>>"


def bouts_of_json(documents: DataFrame, body: str) -> DataFrame:
    """`(event, event_date, bout_order, card_section, fighter1_name, fighter2_name, winner_name, method)` of event
    JSON; the list is last bout first, corners go by `order`. Corrupt bodies give no row."""
    e = documents.select(F.from_json(body, EVENT_JSON).alias("e")).filter("e.id is not null")
    bouts = e.select(F.col("e.name").alias("event"), F.try_to_date(F.substring("e.date", 1, 10), "yyyy-MM-dd").alias("event_date"), F.posexplode(F.reverse("e.competitions")).alias("pos", "c"))
    corner = F.array_sort("c.competitors")
    at = lambda i: F.try_element_at(corner, F.lit(i))["name"]
    winner = F.try_element_at(F.filter("c.competitors", lambda x: F.coalesce(x["winner"], F.lit(False))), F.lit(1))["name"]
    return bouts.select("event", "event_date", (F.col("pos") + 1).alias("bout_order"), F.col("c.segment").alias("card_section"), at(1).alias("fighter1_name"), at(2).alias("fighter2_name"), winner.alias("winner_name"), F.col("c.method").alias("method"))


def card_bouts(pages: DataFrame, id_col: str, text: str) -> DataFrame:
    """`(id, strategy, pos, a, b)`: bouts of a card's text by the first strategy that finds any: `A vs. B` lines,
    else lines with a result badge `W A / L B`."""
    versus = F.regexp_extract_all(text, F.lit(r"(?im)^\s*(?:\d+\.\s*)?([\p{L}][^\n]{1,60}?\s+vs?\.?\s+[^\n]{2,60}?)\s*$"), 1)
    badges = F.regexp_extract_all(text, F.lit(r"(?m)^\s*(W\s+[\p{L}][^\n/]{1,60}?\s*/\s*L\s+[^\n]{2,60}?)\s*$"), 1)
    chosen = F.when(F.size(versus) > 0, F.struct(F.lit("versus").alias("s"), versus.alias("l"))).otherwise(F.struct(F.lit("badges").alias("s"), badges.alias("l")))
    lines = pages.select(id_col, chosen.alias("x")).select(id_col, F.col("x.s").alias("strategy"), F.posexplode("x.l").alias("pos", "line"))
    parts = F.split("line", r"(?i)\s+vs?\.?\s+|\s*/\s*L\s+", 2)
    clean = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"^W\s+(?=\S+ )", ""), r"\s*#\d+.*$", ""))
    return lines.select(id_col, "strategy", "pos", F.when(F.col("strategy") == "badges", clean(parts[0])).otherwise(F.trim(parts[0])).alias("a"), F.trim(parts[1]).alias("b"))


def match_rows(pages: DataFrame, id_col: str, text: str, pattern: str, names: list[str], needs: tuple[str, ...] = ()) -> DataFrame:
    """`(id, pos, *names)`: one row for each place of a text that a pattern fits, its groups as columns. Null texts and
    texts without a match have none. `needs` are strings every match holds: texts without them aren't searched.

    The text is searched once, for whole matches; the groups are read from these."""
    searched = pages.select(id_col, F.col(text).alias("text__"))
    for part in needs:
        searched = searched.filter(F.col("text__").contains(part))
    found = searched.select(id_col, F.posexplode(F.regexp_extract_all("text__", F.lit(pattern), 0)).alias("pos", "match__"))
    return found.select(id_col, "pos", *[F.regexp_extract("match__", pattern, i + 1).alias(n) for i, n in enumerate(names)])


#: A line of a ranking: place, name and record.
RANK_LINE = r"(?m)^(\d+)\. ([^\n]+?) (\d+)-(\d+)-(\d+)\s*$"
#: A sentence of a report on a bout, in English and in French.
REPORT = r"([A-Z\p{L}][^.\n,]{2,60}?) met ([^.\n,]{3,60}?) at ([^.\n,]+?) in ([^.\n,]+?) on (\d{1,2} [A-Z][a-z]+,? \d{4}), and the ([^.\n,]+?) bout ended by ([^\n]+?) at (\d+:\d\d) of round (\d)"
FRENCH_REPORT = r"([A-Z\p{L}][^.\n,]{2,60}?) a battu ([^.\n,]{3,60}?) au ([^.\n,]+?) de ([^.\n,]+?) le (\d{1,2} [A-Z][a-z]+,? \d{4}), par ([^\n]+?) à (\d+:\d\d) du round (\d)"


def rank_rows(pages: DataFrame, id_col: str, text: str) -> DataFrame:
    """`(id, pos, place, name, wins, losses, draws)` of the ranking lines of texts."""
    rows = match_rows(pages, id_col, text, RANK_LINE, ["place", "name", "wins", "losses", "draws"])
    return rows.select(id_col, "pos", "name", *[F.col(c).try_cast("int").alias(c) for c in ("place", "wins", "losses", "draws")])


def report_rows(pages: DataFrame, id_col: str, text: str) -> DataFrame:
    """`(id, pos, a, b, venue, city, day, method, time, round)` of the bouts that English sentences report, the winner unknown."""
    rows = match_rows(pages, id_col, text, REPORT, ["a", "b", "venue", "city", "day", "division", "method", "time", "round"], (" met ", " bout ended by "))
    return rows.withColumns({"day": F.try_to_date(F.replace("day", F.lit(","), F.lit("")), "d MMMM yyyy"), "round": F.col("round").try_cast("int")})


def french_rows(pages: DataFrame, id_col: str, text: str) -> DataFrame:
    """The same of French sentences; `a` is the winner."""
    rows = match_rows(pages, id_col, text, FRENCH_REPORT, ["a", "b", "venue", "city", "day", "method", "time", "round"], (" a battu ", " du round "))
    return rows.withColumns({"day": F.try_to_date(F.replace("day", F.lit(","), F.lit("")), "d MMMM yyyy"), "round": F.col("round").try_cast("int")})


def corner_names(title: Column) -> tuple[Column, Column]:
    """The two names of a title `EVENT: A vs. B 2`, without what stands before a colon and the number of a rematch."""
    bout = F.regexp_replace(title, r"^[^:]*:\s*", "")
    parts = F.split(bout, r"(?i)\s+vs?\.?\s+", 2)
    b = F.trim(F.regexp_replace(F.try_element_at(parts, F.lit(2)), r"\s+\d$|\s+[|\-]\s.*$", ""))
    return F.when(b.isNotNull(), F.trim(F.try_element_at(parts, F.lit(1)))), b


def section(text: Column, end: str) -> Column:
    """What stands before the first place an end marker (a pattern) fits; the whole text where none does."""
    return F.trim(F.try_element_at(F.split(text, end, 2), F.lit(1)))
