"""Several values packed in one text field: choose each field's dialect by minimum description length.

A dialect is a set of separators together with the way values are protected (double quotes with doubled or
escaped quotes, backslash escapes, a bracketed array). Every field is cut into atoms at every separator it
could have; a dialect joins the atoms that its separators do not part. The description length of a parse is

    separators of the dialect + per value the code of its head + per separator the code of standing between
    or inside values + the letters of heads that stand inside another value

where a value's head is its label (`Team:`) or scheme and host (`https://www.site.example`). The codes come
from one distributed count over all fields (first pass, parsed with a prior code); the second pass parses each
field with its cheapest dialect. The remaining characters of a value cost the same in every dialect and are
left out. Both passes are narrow: no row is shuffled, only the aggregated code table is.

The code table holds the heads of at least one value in `1 / MAX_HEADS`, hence at most `MAX_HEADS` heads for
each column; rarer heads get the escape code. That is the bound on what is sent to the executors.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordloom.session import checkpoint

#: A head is kept when at least one value in so many has it; bounds the broadcast code table.
MAX_HEADS = 4096
#: Parses remembered by the signature of a field, per Python worker.
MEMO = 50_000

#: The character a separator begins with, and its kind; a blank parts values only before a scheme.
_KINDS = {
    "|": "bar", "｜": "widebar", ";": "semicolon", "；": "semicolon", ",": "comma", "，": "comma", "、": "comma",
    "•": "bullet", "·": "bullet", "\n": "line", "\r": "line", "\t": "tab", "<": "br", "/": "slash", " ": "blank",
}
_SEPARATORS = tuple(dict.fromkeys(_KINDS.values()))
_CUT = re.compile(
    r"\\.|[|｜;；,，、•·\r\n\t]|<br\s*/?>|(?<=\s)/+(?=\s)"
    r"|(?<![|｜;；,，、•·<>\s]) +(?=\"?[A-Za-z][A-Za-z0-9+.\-]*://)",
    re.I | re.S,
)
_QUOTED = re.compile(r'\s*"((?:[^"\\]|""|\\.)*)"', re.S)
_HEAD = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]*://[^/\s?#]*|[^\W\d_][^:,;|\"]{0,30}:(?=\s)")
_ESCAPED = re.compile(r'\\([,;|/"\\•｜])')
_BRACKETS = {"[": "]", "{": "}", "(": ")"}
_RARE, _NONE = "rare", "none"
_SPLIT_QUOTED = 24.0
_LITERAL = 4.0
_PER_SEPARATOR = 2.0

Atom = tuple[str | None, str, str, str, bool]  # separator before (kind, text), value, raw text, quoted


def _unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def _inner(text: str) -> tuple[str, bool]:
    """The text without an enclosing bracket pair that holds the whole field."""
    close = _BRACKETS.get(text[:1])
    if close and len(text) > 1 and text.endswith(close):
        inside = text[1:-1]
        if text[0] not in inside or text[0] != "(":
            return inside.strip(), True
    return text, False


def _json_items(text: str) -> list[str] | None:
    if not (text.startswith("[") and text.endswith("]")):
        return None
    try:
        found = json.loads(text)
    except ValueError:
        return None
    if not all(isinstance(x, (str, int, float)) or x is None for x in found):
        return None
    return [x if isinstance(x, str) else "" if x is None else json.dumps(x) for x in found]


def _atoms(text: str) -> list[Atom]:
    out: list[Atom] = []
    kind, raw_sep, start = None, "", 0
    quotes = '"' in text
    cuts = _CUT.finditer(text)
    while True:
        value = None
        if quotes and (m := _QUOTED.match(text, start)):
            end = m.end()
            cut = next((c for c in cuts if c.start() >= end), None)
            if not text[end : cut.start() if cut else len(text)].strip():
                value = _unescape(m.group(1).replace('""', '"')).strip()
            else:
                cuts = _CUT.finditer(text, start)
        quoted = value is not None
        if not quoted:
            cut = next((c for c in cuts if c.group()[0] != "\\"), None)
        raw = text[start : cut.start()] if cut else text[start:]
        out.append((kind, raw_sep, value if quoted else _unescape(raw).strip(), raw, quoted))
        if cut is None:
            return out
        raw_sep = cut.group()
        kind, start = _KINDS[raw_sep[0]], cut.end()


def _head(value: str) -> str:
    m = _HEAD.match(value)
    return m.group().lower() if m else _NONE


class CodeTable:
    """Code lengths in bits of one column's heads and separators."""

    def __init__(self, counts: dict[str, int] | None = None):
        counts = counts or {}
        heads = {k[2:]: n for k, n in counts.items() if k.startswith("h:")}
        inside = {k[2:]: n for k, n in counts.items() if k.startswith("i:")}
        between = {k[2:]: n for k, n in counts.items() if k.startswith("s:")}
        values = sum(heads.values())
        self.learned = values > 0
        if not self.learned:
            self.head = {_NONE: 12.0, _RARE: 3.0}
            self.inside = {k: 2.0 if k == "comma" else 4.0 for k in _SEPARATORS}
            self.between = {k: 1.0 for k in _SEPARATORS}
            return
        total = values + len(heads) + 2
        self.head = {k: -math.log2((n + 0.5) / total) for k, n in heads.items()}
        self.head.setdefault(_NONE, -math.log2(0.5 / total))
        self.head[_RARE] = self.head.get(_RARE, -math.log2(0.5 / total)) + 4.0
        used = sum(between.values()) + len(_SEPARATORS)
        self.inside = {k: -math.log2(min(0.5, (inside.get(k, 0) + 0.5) / (values + 1))) for k in _SEPARATORS}
        self.between = {k: -math.log2((between.get(k, 0) + 0.5) / used) for k in _SEPARATORS}

    def bits(self, head: str) -> float:
        return self.head.get(head, self.head[_RARE])


def _best(signature: tuple, code: CodeTable) -> tuple[frozenset, bool]:
    """The cheapest dialect: its separators, and whether they part only before a known head."""
    kinds = sorted({s[0] for s in signature[1:]})
    best, chosen = math.inf, (frozenset(), False)
    for mask in range(1 << len(kinds)):
        separators = frozenset(k for i, k in enumerate(kinds) if mask >> i & 1)
        for lenient in (False, True) if separators else (False,):
            bits = _PER_SEPARATOR * len(separators) + 3.0 * lenient
            open_value = False
            value_quoted = False
            for k, head, quoted, empty in signature:
                if k is not None:
                    cuts = k in separators and (not lenient or head != _NONE or empty or quoted)
                    if cuts:
                        bits += code.between[k]
                        open_value = False
                    else:
                        bits += code.inside[k]
                        if head != _NONE:
                            bits += _LITERAL * len(head)
                        if quoted or value_quoted:
                            bits += _SPLIT_QUOTED
                if not open_value and not empty:
                    bits += code.bits(head)
                    open_value, value_quoted = True, quoted
                elif not open_value and empty and k is None:
                    value_quoted = False
                    open_value = len(signature) > 1 and signature[1][0] not in separators
                    if open_value:
                        bits += code.bits(_NONE)
            if bits < best - 1e-9:
                best, chosen = bits, (separators, lenient)
    return chosen


def _clean(value: str) -> str:
    """An item without blanks and without quotes or brackets that enclose it whole."""
    value = value.strip()
    while len(value) > 1:
        if value[0] == value[-1] == '"' and '"' not in value[1:-1]:
            value = value[1:-1].strip()
        elif value[0] in "[{" and value[-1] == _BRACKETS[value[0]] and value[0] not in value[1:]:
            value = value[1:-1].strip()
        else:
            break
    return value


class FieldParser:
    """Parses the fields of one column; remembers the dialect of each signature."""

    def __init__(self, code: CodeTable | None = None):
        self.code = code or CodeTable()
        self.memo: dict[tuple, tuple[frozenset, bool]] = {}

    def parse(self, text: str, counts: Counter | None = None) -> list[str]:
        text = text.strip()
        if not text:
            return []
        listed = _json_items(text)
        if listed is not None:
            items = [_clean(x) if x.strip()[:1] in '"[{' else x.strip() for x in listed]
            items = [x for x in items if x]
            if counts is not None:
                counts.update("h:" + _head(x) for x in items)
            return items
        text, _ = _inner(text)
        atoms = _atoms(text)
        heads = [_head(a[2]) if a[2] else _NONE for a in atoms]
        signature = tuple((a[0], h, a[4], not a[2]) for a, h in zip(atoms, heads))
        chosen = self.memo.get(signature)
        if chosen is None:
            chosen = _best(signature, self.code)
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[signature] = chosen
        separators, lenient = chosen
        items: list[str] = []
        current: list[str] | None = None
        single = True
        for (kind, raw_sep, value, raw, quoted), head in zip(atoms, heads):
            cuts = kind is None or kind in separators and (not lenient or head != _NONE or not value or quoted)
            if counts is not None and kind is not None:
                counts[("s:" if cuts else "i:") + kind] += 1
            if cuts:
                if current is not None:
                    items.append("".join(current) if single else _clean("".join(current)))
                current, single = [value], quoted
            else:
                current += [raw_sep, _unescape(raw) if not quoted else raw]
                single = False
        items.append("".join(current) if single else _clean("".join(current)))
        items = [x for x in (i.strip() for i in items) if x]
        if counts is not None:
            counts.update("h:" + _head(x) for x in items)
        return items


def fit_codes(df: DataFrame, columns: Iterable[str]) -> dict[str, dict[str, int]]:
    """Counts behind the code table of each column, over all rows: heads, separators between and inside values.

    At most `MAX_HEADS` heads a column come back (those of at least one value in `MAX_HEADS`), plus two counts
    for each of the ten separators.
    """
    columns = list(columns)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parsers = {c: FieldParser() for c in columns}
        seen: dict[str, Counter] = {c: Counter() for c in columns}

        def flush() -> pd.DataFrame:
            rows = [(c, k, n) for c in columns for k, n in seen[c].items()]
            for c in columns:
                seen[c].clear()
            return pd.DataFrame(rows, columns=["field", "code", "n"], dtype=object)

        for batch in batches:
            for c in columns:
                parse, into = parsers[c].parse, seen[c]
                for text in batch[c]:
                    if text:
                        parse(text, into)
            if sum(map(len, seen.values())) > 100_000:
                yield flush()
        yield flush()

    counted = checkpoint(
        df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
        .mapInPandas(count, "field string, code string, n bigint")
        .groupBy("field", "code")
        .agg(F.sum("n").alias("n"))
    )
    is_head = F.col("code").startswith("h:")
    totals = counted.filter(is_head).groupBy("field").agg(F.sum("n").alias("total"))
    kept = (
        counted.join(F.broadcast(totals), "field", "left")
        .withColumn("code", F.when(is_head & (F.col("n") * MAX_HEADS < F.col("total")), F.lit("h:" + _RARE)).otherwise(F.col("code")))
        .groupBy("field", "code")
        .agg(F.sum("n").alias("n"))
    )
    out: dict[str, dict[str, int]] = {c: {} for c in columns}
    for row in kept.collect():
        out[row["field"]][row["code"]] = row["n"]
    return out


def split_packed(df: DataFrame, id_col: str, columns: Iterable[str], codes: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """One row for each value packed in `columns`: `(id_col, field, pos, item)`, `pos` from 1.

    Null and blank fields give no rows, empty values take no position, repeated values count each, rows of `df`
    that repeat an id give their values again. Other columns are ignored, whatever their names. A field without
    any separator is one value. `codes` are those of `fit_codes`; by default they are fitted on `df` itself.
    """
    columns = list(columns)
    codes = fit_codes(df, columns) if codes is None else codes
    id_type = df.schema[id_col].dataType

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parsers = [(c, FieldParser(CodeTable(codes.get(c)))) for c in columns]
        for batch in batches:
            ids, fields, pos, items = [], [], [], []
            for c, parser in parsers:
                for key, text in zip(batch["key"], batch[c]):
                    if text:
                        found = parser.parse(text)
                        ids += [key] * len(found)
                        fields += [c] * len(found)
                        pos += range(1, len(found) + 1)
                        items += found
            yield pd.DataFrame({id_col: pd.Series(ids, dtype=batch["key"].dtype), "field": pd.Series(fields, dtype=object), "pos": pos, "item": pd.Series(items, dtype=object)})

    out = T.StructType([T.StructField(id_col, id_type), T.StructField("field", T.StringType()), T.StructField("pos", T.IntegerType()), T.StructField("item", T.StringType())])
    slim = df.select(F.col(f"`{id_col}`").alias("key"), *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return slim.mapInPandas(split, out)


def count_distinct_items(column: Column, codes: dict[str, int]) -> Column:
    """Number of distinct values packed in a text column (0 for null), parsed like `split_packed`."""

    @F.pandas_udf(T.IntegerType())
    def distinct(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        parser = FieldParser(CodeTable(codes))
        for batch in texts:
            yield pd.Series([len(set(parser.parse(t))) if t else 0 for t in batch], dtype="int32")

    return distinct(column)
