"""Texts cut off by a field limit or in transfer.

1. Per source the histogram of lengths, once in characters and once in UTF-8 bytes, is tested for spikes: a
   length far more frequent than the lengths around it is a limit. Byte limits cut back to a whole character, so
   the few lengths below one belong to it.
2. A text is open when it doesn't end in terminal punctuation (after closing quotes, brackets and tags), ends in
   a mark of omission, or ends inside a tag, an entity or a character.
3. An open text at a limit is cut unless its end is a usual one. An open text elsewhere (a broken transfer) is cut
   when its last word is the beginning of another word or when texts nearly always go on after its last words.
   What is usual is told by an end model: over how the last one to five words of a position go on in the texts.

The end model is counted over the positions of all distinct texts (copies count once). Every text is taken apart once, into
a written table; only the contexts that open texts end in are counted, and they reach those texts by joins, as do the words
that an open text's last word begins. Histograms, limits and decisions cover all rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from recordloom.functions.text import fold
from recordloom.session import checkpoint

MIN_SEEN = 3
#: Places of the filter through which contexts go before they are joined to those asked for; it lets others pass, never fewer.
_SLOTS = 1 << 22
#: An open last line that so many texts share is a way to sign off, not a cut.
USUAL = 5
_ORDERS = 5
_RARE_BELOW = 5

_TOKEN = re.compile(r"\n|https?://\S+|\d+(?:[.,:/\-]\d+)*|\w+(?:['’\-]\w+)*|[^\w\s]")
_DIGITS = re.compile(r"\d+")
_TAG = re.compile(r"<[A-Za-z/!][^<>]{0,200}>")
_BLOCK = re.compile(r"</?(?:p|br|div|li|ul|ol|h\d|tr|td|table)\b[^<>]*>", re.I)
_ENTITY = re.compile(r"&(?:#\d+|#x[0-9a-fA-F]+|[A-Za-z]+);")
_OPEN_END = re.compile(r"(?:<[A-Za-z/!]?[^<>\s]{0,20}|</?[A-Za-z]+ [^<>]{0,80}|&#?[A-Za-z0-9]{0,8}|�+)$")
_OMISSION = re.compile(r"\s*(?:\[?(?:\.\.\.|…|&hellip;|&#8230;)\]?|\(\.\.\.\)|\[…\])+\s*$", re.I)
_LAST_TAG = re.compile(_TAG.pattern + r"\s*$")
_BRACKETS = ")]"
_CLOSERS = "\"'”’»)]}*_ \t\r\n"
# Words whose stop doesn't end a sentence.
_ABBREVIATIONS = frozenset("vs v st jr sr mr mrs ms dr no mt ft".split())
_ELIDED = re.compile(r"(?<![^\W\d_])(?:[cdjlmnst]|qu)['’]$", re.I)
_CONTINUES = frozenset(",;([{<&-–/")
_TERMINAL = frozenset(".!?")
_START = "<s>"
# Between words and between sentences of a text taken apart; no token holds them.
_WORD, _SENTENCE = "\x1f", "\x1e"


def _plain(text: str) -> str:
    """The text without markup: block tags are line breaks, entities the characters they stand for."""
    if "<" in text:
        text = _TAG.sub("", _BLOCK.sub("\n", text))
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m.group()), text)
    return text


def _without_omission(text: str) -> tuple[str, bool]:
    """The text without closing tags and marks of omission at its end; whether there were such marks."""
    bare = text.rstrip()
    while (m := _LAST_TAG.search(bare)) and m.start() > 0:
        bare = bare[: m.start()].rstrip()
    m = _OMISSION.search(bare)
    return (bare[: m.start()].rstrip(), True) if m else (bare, False)


def _sentences(text: str) -> Iterator[tuple[list[str], bool]]:
    """Tokens of each sentence or line, and whether it is closed by punctuation, a bracket or a line break."""
    words: list[str] = []
    tokens = _TOKEN.findall(fold(_plain(text)).lower())
    for t in tokens:
        if t == "\n":
            if words:
                yield words, True
                words = []
        elif t in _TERMINAL:
            abbreviated = t == "." and words and (words[-1] in _ABBREVIATIONS or len(words[-1]) == 1 and words[-1].isalpha())
            if words and not abbreviated:
                yield words, True
                words = []
        elif words or t not in _CLOSERS:
            words.append(_DIGITS.sub("0", t) if t[0].isdigit() or "/" in t else t)
    if words:
        yield words, words[-1] in _BRACKETS and words[0] in "(["


def _key(words: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(words)) - (1 << 63)


_FIRST, _NEXT, _MIX, _ALL = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(_MIX)
    return x ^ x >> np.uint64(29)


def _context_keys(hashes: list[int]) -> Iterator[int]:
    """Keys of the last one, two, ... words of a sequence, as signed numbers; as `_counted` makes them."""
    h = 0
    for k, t in enumerate(reversed(hashes[-_ORDERS:])):
        h = (t * _FIRST if k == 0 else h * _NEXT + t) & _ALL
        h = (h ^ h >> 31) * _MIX & _ALL
        h ^= h >> 29
        yield h - (1 << 64) if h >> 63 else h


def _counted(sentences: list[tuple[list[str], bool]], hashed: Callable[[str], int], wanted: np.ndarray) -> pd.DataFrame:
    """How often each context of one to `_ORDERS` words occurs in sentences `(words, whole)` and how often it ends one; the
    last position of a sentence that isn't whole is no position. Contexts whose place isn't `wanted` are left out."""
    sizes = np.array([len(w) + 1 for w, _ in sentences], np.int64)
    words = [x for w, _ in sentences for x in (_START, *w)]
    t = np.fromiter(map(hashed, words), np.uint64, len(words))
    place = np.arange(len(t)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    last = place == np.repeat(sizes - 1, sizes)
    usable = (place > 0) & (~last | np.repeat(np.array([whole for _, whole in sentences]), sizes))
    keys, ends = [], []
    with np.errstate(over="ignore"):
        h = _mixed(t * np.uint64(_FIRST))
        for k in range(_ORDERS):
            held = usable & (place >= k) & wanted[(h & np.uint64(_SLOTS - 1)).astype(np.int64)]
            keys.append(h[held])
            ends.append(last[held])
            h[k + 1 :] = _mixed(h[k + 1 :] * np.uint64(_NEXT) + t[: len(t) - k - 1])
    found, at, n = np.unique(np.concatenate(keys).view(np.int64), return_inverse=True, return_counts=True)
    return pd.DataFrame({"k": found, "e": np.bincount(at, np.concatenate(ends), len(found)).astype("int64"), "n": n.astype("int64")})


def _class(word: str, frequent: frozenset[str]) -> str:
    """The word, or a sign for words too rare to count."""
    return word if word in frequent else "<r>" if word[0].isalpha() else word


def _asked_contexts(words: list[str], frequent: frozenset[str]) -> list[int]:
    """Keys of the contexts that a text ends in, the shortest first."""
    classes = [_class(w, frequent) for w in words[-_ORDERS:]]
    padded = [_START, *classes] if len(words) < _ORDERS else classes
    return list(_context_keys([xxhash.xxh3_64_intdigest(w) for w in padded]))


def _end_rate(seen: dict[int, tuple[int, int]], own: int) -> tuple[float | None, float | None]:
    """Shares of ends after the longest context seen without the text itself and after the last word alone; None where none
    was seen. `seen` has ends and positions by the place of a context in `_asked_contexts`."""
    rate = alone = None
    for n in range(_ORDERS):
        ends, total = seen.get(n, (0, 0))
        if total - own >= 2:
            rate = max(0, ends - own) / (total - own)
            alone = rate if n == 0 else alone
        elif n > 0:
            break
    return rate, alone


READ = "h bigint, s string, closed boolean, evidence string, omitted boolean"


def read_texts(texts: DataFrame, column: str = "text") -> DataFrame:
    """`(h, s, closed, evidence, omitted)` of each distinct text: its sentences, whether the last is closed, what tells that it is
    cut if no other text must be asked (empty for a whole one, null where the end model decides)."""
    hashed = texts.select(F.col(f"`{column}`").alias("t")).filter("t is not null").select(F.xxhash64("t").alias("h"), "t")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for h, text in zip(batch["h"], batch["t"]):
                bare, omitted = _without_omission(text)
                found = list(_sentences(bare))
                evidence = _told(text, bare, omitted, found)
                out.append((h, _SENTENCE.join(_WORD.join(w) for w, _ in found), bool(found) and found[-1][1], evidence, omitted))
            yield pd.DataFrame(out, columns=["h", "s", "closed", "evidence", "omitted"])

    return checkpoint(hashed.groupBy("h").agg(F.first("t").alias("t")).mapInPandas(read, READ))


def _taken(s: str, closed: bool) -> list[tuple[list[str], bool]]:
    """The sentences of a text of `read_texts`."""
    found = [x.split(_WORD) for x in s.split(_SENTENCE)] if s else []
    return [(w, closed or i < len(found) - 1) for i, w in enumerate(found)]


def _vocabulary(read: DataFrame) -> DataFrame:
    """`(w, n, alpha)`: how often each word occurs, but for last words of open texts."""

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        told = lambda: pd.DataFrame({"w": list(seen), "n": list(seen.values()), "alpha": [w[0].isalpha() for w in seen]})
        for batch in batches:
            for s, closed in zip(batch["s"], batch["closed"]):
                for sentence, whole in _taken(s, closed):
                    seen.update(sentence if whole else sentence[:-1])
                if len(seen) > 200_000:
                    yield told()
                    seen.clear()
        if seen:
            yield told()

    counted = read.select("s", "closed").mapInPandas(words, "w string, n bigint, alpha boolean")
    return checkpoint(counted.groupBy("w", "alpha").agg(F.sum("n").alias("n")))


def _contexts(read: DataFrame, asked: DataFrame, frequent: frozenset[str]) -> DataFrame:
    """`(k, e, n)`: ends and positions of the contexts `asked` for (and of some others), over all texts."""
    last, single = F.substring_index("s", _SENTENCE, -1), ~F.contains("s", F.lit(_SENTENCE))

    def endings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"k": [_key([_class(w, frequent) for w in x.split(_WORD)]) for x in batch["last"]]}, dtype="int64")

    closings = read.filter(~F.col("closed") & ~single & (F.col("s") != "")).select(last.alias("last")).mapInPandas(endings, "k bigint")
    usual = frozenset(closings.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= USUAL).select("k").toPandas()["k"])
    wanted = np.zeros(_SLOTS, bool)
    wanted[asked.select(F.explode("keys").alias("k")).select(F.col("k").bitwiseAND(_SLOTS - 1).cast("int").alias("p")).distinct().toPandas()["p"].to_numpy(np.int64)] = True
    sent = read.sparkSession.sparkContext.broadcast((frequent, usual, wanted))

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, usual, wanted = sent.value
        memo: dict[str, int] = {}

        def hashed(w: str) -> int:
            h = memo.get(w)
            if h is None:
                h = memo[w] = xxhash.xxh3_64_intdigest(w if w == _START else _class(w, frequent))
            return h

        held, size = [], 0
        for batch in batches:
            for s, closed in zip(batch["s"], batch["closed"]):
                found = _taken(s, closed)
                for sentence, whole in found:
                    held.append((sentence, whole or len(found) == 1 or _key([_class(w, frequent) for w in sentence]) in usual))
                    size += len(sentence)
                if size > 300_000:
                    yield _counted(held, hashed, wanted)
                    held, size = [], 0
                    memo.clear()
        if held:
            yield _counted(held, hashed, wanted)

    seen = read.select("s", "closed").mapInPandas(contexts, "k bigint, e bigint, n bigint")
    return seen.groupBy("k").agg(F.sum("e").alias("e"), F.sum("n").alias("n")).filter(F.col("n") >= MIN_SEEN)


def _begun(vocabulary: DataFrame, words: DataFrame) -> DataFrame:
    """`(w, begins)`: whether each of `words` is the beginning of words far more often than a word of its own."""
    lengths = [r[0] for r in words.select(F.length("w").alias("l")).distinct().collect()] or [0]
    at = F.explode(F.filter(F.array(*map(F.lit, sorted(lengths))), lambda n: (n > 0) & (n <= F.length("v"))))
    begins = vocabulary.filter("alpha").select(F.col("w").alias("v"), "n").select("v", "n", at.alias("at")).select(F.substring("v", F.lit(1), F.col("at")).alias("w"), "n", (F.length("v") == F.col("at")).alias("whole"))
    counts = begins.groupBy("w").agg(F.sum("n").alias("begun"), F.sum(F.when(F.col("whole"), F.col("n")).otherwise(0)).alias("alone"))
    told = (F.col("begun") > F.col("alone")) & (F.col("alone") <= 0.02 * F.col("begun"))
    return counts.join(words, "w").select("w", told.alias("begins"))


def judged_texts(texts: DataFrame, column: str = "text") -> DataFrame:
    """`(h, free, held)` of each distinct text that is cut: what tells it away from a limit, and whether it is cut at one."""
    read = read_texts(texts, column)
    vocabulary = _vocabulary(read)
    frequent = frozenset(vocabulary.filter(F.col("n") >= _RARE_BELOW).select("w").toPandas()["w"])
    last, single = F.substring_index("s", _SENTENCE, -1), ~F.contains("s", F.lit(_SENTENCE))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(sentences: pd.Series) -> pd.Series:
        return sentences.map(lambda x: _asked_contexts(x.split(_WORD), frequent))

    asked = checkpoint(read.filter("evidence is null").select("h", F.substring_index(last, _WORD, -1).alias("w"), single.alias("single"), "omitted", keys(last).alias("keys")))
    seen = asked.select("h", F.posexplode("keys").alias("i", "k")).join(_contexts(read, asked, frequent), "k").groupBy("h").agg(F.collect_list(F.struct("i", "e", "n")).alias("seen"))
    facts = asked.drop("keys").join(seen, "h", "left").join(_begun(vocabulary, asked.select("w").distinct()), "w", "left")

    @F.pandas_udf("free string, held boolean")
    def decided(begins: pd.Series, seen: pd.Series, single: pd.Series, omitted: pd.Series) -> pd.DataFrame:
        out = []
        for b, found, s, o in zip(begins, seen, single, omitted):
            rate, alone = _end_rate({} if found is None else {x["i"]: (x["e"], x["n"]) for x in found}, int(s))
            if b:
                out.append(("word", True))
                continue
            held = rate is None or rate < 0.4
            if o:
                free = "mark" if held else None
            elif s:
                free = "model" if rate is not None and rate < 0.1 and alone is not None and alone < 0.02 else None
            else:
                free = "model" if rate is not None and rate < 0.1 else None
            out.append((free, held))
        return pd.DataFrame(out, columns=["free", "held"])

    by_model = facts.select("h", decided(F.coalesce("begins", F.lit(False)), "seen", "single", "omitted").alias("d")).select("h", "d.free", "d.held").filter("held or free is not null")
    return by_model.unionByName(read.filter("evidence <> ''").select("h", F.col("evidence").alias("free"), F.lit(True).alias("held")))


def length_limits(texts: DataFrame, source: str = "source", column: str = "text", near: int = 24, least: int = 5, factor: float = 5.0, shortest: int = 64) -> DataFrame:
    """`(source, unit, length, n)`: lengths that stand out of the histogram around them.

    A length is a limit when it holds at least `least` rows and `factor` times the mean of the `near` lengths on
    either side (plus one); limits under `shortest` aren't looked for. One aggregation over all rows; the windows run over the small histograms.
    """
    t = texts.select(F.col(f"`{source}`").alias("source"), F.col(f"`{column}`").alias("t")).filter("t is not null")
    lengths = t.select("source", F.explode(F.array(*[F.struct(F.lit(u).alias("unit"), f("t").alias("length")) for u, f in (("chars", F.char_length), ("bytes", F.octet_length))])).alias("l"))
    histogram = lengths.groupBy("source", "l.unit", "l.length").agg(F.count(F.lit(1)).alias("n"))
    around = Window.partitionBy("source", "unit").orderBy("length").rangeBetween(-near, near)
    beside = Window.partitionBy("source", "unit").orderBy("length").rangeBetween(-3, 3)
    tested = histogram.withColumn("usual", (F.sum("n").over(around) - F.sum("n").over(beside)) / (2.0 * near - 6)).withColumn("peak", F.max("n").over(beside))
    return tested.filter((F.col("length") >= shortest) & (F.col("n") >= USUAL) & (F.col("n") == F.col("peak")) & (F.col("n") >= factor * (F.col("usual") + 1))).select("source", "unit", "length", "n")


#: What tells that a text is cut: an open end at a limit, an end inside a tag, entity or character, the beginning of a word, a
#: mark that something follows (omission, comma, elision), or words after which texts go on.
EVIDENCE = ("limit", "open", "word", "mark", "model")


def _told(text: str, bare: str, omitted: bool, found: list[tuple[list[str], bool]]) -> str | None:
    """What tells that a text is cut, empty for a whole one, None where other texts must tell. `bare`, `omitted` and `found` are
    what `_without_omission` and `_sentences` say of it."""
    shown = text.rstrip()
    if not shown:
        return ""
    if _OPEN_END.search(shown) and not _ENTITY.search(shown[-12:]):
        return "open"
    if shown.count("<p>") > shown.count("</p>"):
        return "open"
    closed = bare.rstrip(_CLOSERS)
    if not closed:
        return ""
    if closed[-1] in _TERMINAL and not omitted:
        word = re.search(r"([^\W\d_]+)\.$", closed[-40:].lower())
        return "mark" if word and word.group(1) in ("vs", "st") and len(bare) - len(closed) == 0 else ""
    if not found:
        return ""
    words, balanced = found[-1]
    if balanced and not omitted:
        return ""
    return "mark" if words[-1] in _CONTINUES or _ELIDED.search(bare) else None


def truncated_texts(texts: DataFrame, id_col: str, source: str = "source", column: str = "text") -> DataFrame:
    """`(id, source, evidence)` for each row whose text is not null: which of `EVIDENCE` tells that it is cut, null for a whole one.

    Empty texts are whole; a null source is a source of its own; copies are judged alike; repeated rows give
    repeated results; other columns are ignored.
    """
    limits = length_limits(texts, source, column)
    chars = limits.filter("unit = 'chars'").select(F.col("source").alias("s"), F.col("length").alias("c"), F.lit(True).alias("at_chars"))
    reach = F.explode(F.sequence(F.col("length") - 3, F.col("length")))
    octets = limits.filter("unit = 'bytes'").select(F.col("source").alias("s2"), reach.alias("b")).distinct().withColumn("at_bytes", F.lit(True))
    t = texts.select(F.col(f"`{id_col}`").alias("key"), F.col(f"`{source}`").alias("source"), F.col(f"`{column}`").alias("t")).filter("t is not null")
    rows = t.select("key", "source", F.xxhash64("t").alias("h"), F.char_length("t").alias("n_chars"), F.octet_length("t").alias("n_bytes"))
    judged = (
        rows.join(chars, F.col("source").eqNullSafe(F.col("s")) & (F.col("n_chars") == F.col("c")), "left")
        .join(octets, F.col("source").eqNullSafe(F.col("s2")) & (F.col("n_bytes") == F.col("b")), "left")
        .select("key", "source", "h", (F.coalesce("at_chars", F.lit(False)) | F.coalesce("at_bytes", F.lit(False))).alias("at_limit"))
        .join(judged_texts(texts, column), "h", "left")
    )
    evidence = F.when(F.col("at_limit"), F.when(F.col("held"), "limit")).otherwise(F.col("free"))
    return judged.select(F.col("key").alias(id_col), "source", evidence.alias("evidence"))
