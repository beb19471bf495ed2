"""Evaluation texts leaking into a corpus, found by winnowing.

Texts become words (markup, entities, case, accents, punctuation and line breaks don't matter); every run of
`GRAM` words is hashed, and of every `WINDOW` neighbouring hashes the smallest is kept. Two texts that share a
span of at least `GRAM + WINDOW - 1` words therefore share a fingerprint. Fingerprints of corpus and test texts
are joined, and each pair that meets is extended by a local alignment of words, which tolerates changed and
inserted words. A pair leaks when the aligned run covers the wanted share of the test text.

The join is a lookup on the executors, and no corpus row moves. At most about `BROADCAST_FINGERPRINTS` test fingerprints
(some 100 MB) are sent at once: a larger test set is taken in blocks, each looked up in a pass of its own over the corpus.
Fingerprints that a third of all texts have cost a lookup each, and no pair of texts leaves the task that finds it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from recordloom.functions.text import fold
from recordloom.session import checkpoint

GRAM = 4
WINDOW = 4
BROADCAST_FINGERPRINTS = 1_000_000
#: Words of the test text a run must cover, as a share; short of two fifths by a word cut at either end.
SHARE = 0.39
#: Share of a run's words that must be the test text's own; similar sentences of one author stay below.
MATCHED = 0.8
_BLOCK = re.compile(r"</?(?:p|br|div|li|ul|ol|h\d|tr|td|table|blockquote)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[A-Za-z/!][^<>]{0,300}>")
_HYPHENATED = re.compile(r"(?<=[^\W\d_])[-‐]\s*\n\s*(?=[^\W\d_])")
_LINK = re.compile(r"\]\([^()\s]{1,300}\)")
_SPLIT = re.compile(r"[\s/|—–…]+")
#: What stays of ASCII: lower case letters and digits; the bars between words are blanks.
_BLANKS = bytes.maketrans(b"/|\x1c\x1d\x1e\x1f", b"      ")
_DROPPED = bytes(c for c in range(128) if not (48 <= c < 58 or 97 <= c < 123 or c in b" /|\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"))
#: What UTF-8 read as a one-byte encoding looks like.
_MISREAD = re.compile(r"[ÃÂÅÄ][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]")


def _repair(m: re.Match) -> str:
    for encoding in ("cp1252", "latin-1"):
        try:
            return m.group().encode(encoding).decode("utf-8")
        except UnicodeError:
            pass
    return m.group()


def words_of(text: str) -> list[str]:
    """The words of a text without markup, case, accents and punctuation."""
    for _ in range(2):
        if "&" in text:
            text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub("", _BLOCK.sub(" ", text))
    if "](" in text:
        text = _LINK.sub("]", text)
    if _MISREAD.search(text):
        text = _MISREAD.sub(_repair, text)
    text = fold(text)
    if "\n" in text:
        text = _HYPHENATED.sub("", text)
    text = text.lower()
    if not text.isascii():
        text = _SPLIT.sub(" ", text)
    return text.encode("ascii", "ignore").translate(_BLANKS, _DROPPED).decode("ascii").split()


def _hashes(words: list[str], memo: dict[str, int]) -> np.ndarray:
    if len(memo) > 500_000:
        memo.clear()
    for w in words:
        if w not in memo:
            memo[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter((memo[w] for w in words), np.uint64, len(words))


def winnow(h: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a sequence of word hashes and their positions; a short text keeps its smallest one."""
    n = len(h) - gram + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        g = np.zeros(n, np.uint64)
        for i in range(gram):
            g = (g * np.uint64(0x9E3779B97F4A7C15)) ^ h[i : i + n]
            g ^= g >> np.uint64(29)
            g *= np.uint64(0xBF58476D1CE4E5B9)
    if n <= window:
        kept = np.array([int(np.argmin(g))])
    else:
        views = np.lib.stride_tricks.sliding_window_view(g, window)
        kept = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    return g[kept].view(np.int64), kept


def aligned_run(doc: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Best local alignment of two word sequences: (words of the item in the run, of these matched).

    A match counts 1, a changed, missing or inserted word -1; the run with the highest score is taken.
    """
    n, m = len(doc), len(item)
    score, start, matched = np.zeros(n + 1), np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    best, run = 0.0, (0, 0)
    steps = np.arange(n + 1)
    for j in range(m):
        equal = doc == item[j]
        diagonal = score[:-1] + np.where(equal, 1.0, -1.0)
        new = np.concatenate([[0.0], diagonal])
        begun = np.concatenate([[j + 1], np.where(score[:-1] > 0, start[:-1], j)])
        hits = np.concatenate([[0], np.where(score[:-1] > 0, matched[:-1], 0) + equal])
        skip = score - 1.0
        better = skip > new
        new, begun, hits = np.where(better, skip, new), np.where(better, start, begun), np.where(better, matched, hits)
        reach = np.maximum.accumulate(new + steps)
        inserted = reach - steps
        further = inserted > new
        if further.any():
            origin = np.maximum.accumulate(np.where(new + steps >= reach, steps, 0))
            new, begun, hits = np.where(further, inserted, new), np.where(further, begun[origin], begun), np.where(further, hits[origin], hits)
        dead = new <= 0
        score, start, matched = np.where(dead, 0.0, new), np.where(dead, j + 1, begun), np.where(dead, 0, hits)
        top = int(score.argmax())
        if score[top] > best:
            best, run = float(score[top]), (j + 1 - int(start[top]), int(matched[top]))
    return run


def _pairs(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:]


def wanted_pairs(size: int, share: float) -> tuple[int, float]:
    """The shortest stretch of pairs of a test text of `size` words that a leak can lie on, and how many of them it keeps."""
    span = max(1, int(share * size) - 1)
    return span, (2 * MATCHED - 1) * span - 2


def may_leak(doc_pairs: set[int], item_pairs: list[int], size: int, share: float) -> bool:
    """Whether a run of the wanted length can exist, from neighbouring words that the two texts share.

    A changed word costs a run two of its pairs, so a run with `MATCHED` of its words in place keeps at least
    `2 * MATCHED - 1` of its pairs, and some stretch of the shortest wanted length holds that density.
    """
    span, least = wanted_pairs(size, share)
    shared = [x in doc_pairs for x in item_pairs]
    held = most = sum(shared[:span])
    for gone, come in zip(shared, shared[span:]):
        held += come - gone
        most = max(most, held)
    return most >= least


class TestSet:
    """Test texts as word hashes, with the positions of their fingerprints."""

    def __init__(self, ids: list, texts: list[str]):
        memo: dict[str, int] = {}
        self.ids = ids
        self.words = [_hashes(words_of(t), memo) for t in texts]
        self.pairs = [_pairs(w).tolist() for w in self.words]
        self.sets = [set(p) for p in self.pairs]
        self.index: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(self.words):
            for k, p in zip(*winnow(w)):
                self.index.setdefault(int(k), []).append((i, int(p)))

    def hits(self, h: np.ndarray) -> dict[int, tuple[int, int]]:
        """For each test text that shares a fingerprint: the first and last place in the document it may span."""
        found: dict[int, tuple[int, int]] = {}
        for k, p in zip(*winnow(h)):
            for i, q in self.index.get(int(k), ()):
                size = len(self.words[i])
                a, b = max(0, int(p) - q - size // 4 - 8), min(len(h), int(p) + size - q + size // 4 + 8)
                x = found.get(i)
                found[i] = (min(a, x[0]), max(b, x[1])) if x else (a, b)
        return found

    def leaks(self, h: np.ndarray, share: float) -> Iterator[tuple[int, int, int, int]]:
        near = self.hits(h)
        doc_pairs = set(_pairs(h).tolist()) if near else set()
        for i, (a, b) in near.items():
            item = self.words[i]
            repeated = len(self.pairs[i]) - len(self.sets[i])
            if len(doc_pairs & self.sets[i]) + repeated < wanted_pairs(len(item), share)[1]:
                continue
            if not may_leak(doc_pairs, self.pairs[i], len(item), share):
                continue
            run, matched = aligned_run(h[a:b], item)
            if run >= share * len(item) and matched >= MATCHED * run:
                yield i, run, matched, len(item)


def leaked_items(corpus: DataFrame, corpus_id: str, corpus_text: str, tests: DataFrame, test_id: str, test_text: str, share: float = SHARE, limit: int = BROADCAST_FINGERPRINTS) -> DataFrame:
    """`(corpus_id, test_id, run_words, matched_words, test_words)` for each leak of a test text into a document.

    Null and wordless texts leak nothing and are leaked into by nothing; texts shorter than `GRAM` words have no
    fingerprint. Repeated documents and repeated test texts count each; other columns are ignored.
    """
    spark = corpus.sparkSession
    t = tests.select(F.col(f"`{test_id}`").alias("item"), F.col(f"`{test_text}`").alias("t")).filter("t is not null")
    d = corpus.select(F.col(f"`{corpus_id}`").alias("doc"), F.col(f"`{corpus_text}`").alias("t")).filter("t is not null")
    types = dict(doc=corpus.schema[corpus_id].dataType, item=tests.schema[test_id].dataType)
    ends = [T.StructField(c, T.IntegerType()) for c in ("run_words", "matched_words", "test_words")]
    schema = T.StructType([T.StructField("doc", types["doc"]), T.StructField("item", types["item"]), *ends])
    size = t.agg(F.sum(F.char_length("t"))).first()[0] or 0
    passes = max(1, -(-size // (4 * limit)))

    def finder(sent):
        def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            memo: dict[str, int] = {}
            known = sent.value
            for batch in batches:
                out = [(doc, known.ids[i], run, matched, n) for doc, text in zip(batch["doc"], batch["t"]) for i, run, matched, n in known.leaks(_hashes(words_of(text), memo), share)]
                yield pd.DataFrame(out, columns=["doc", "item", "run_words", "matched_words", "test_words"], dtype=object)

        return find

    found = None
    for n in range(passes):
        rows = t.filter(F.pmod(F.xxhash64("item", "t"), F.lit(passes)) == n).collect()
        sent = spark.sparkContext.broadcast(TestSet([r["item"] for r in rows], [r["t"] for r in rows]))
        part = d.mapInPandas(finder(sent), schema)
        if passes > 1:
            # Written before the next block of test texts is sent, so one block at a time is held.
            part = checkpoint(part)
            sent.destroy()
        found = part if found is None else found.unionByName(part)
    return found.select(F.col("doc").alias(corpus_id), F.col("item").alias(test_id), "run_words", "matched_words", "test_words")
