"""Operators of the llm subpackage against brute force, with nulls, empty tables, ties and clashing names."""

import datetime
import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import batch_dedup, canonical, components, cross_source, leakage, mixture, name_variants, person_names, profile_terms, survivorship, truncation


def test_components_match_union_find(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300), rng.random() < 0.7) for _ in range(250)] + [(i, i + 1, True) for i in range(1000, 1060)] + [(5000, 5000 + i, True) for i in range(1, 80)]
    rows = [(a, b, ok, "x") for a, b, ok in pairs] + [(1, None, True, "x"), (None, 2, True, "x"), (7, 7, True, "x"), (8, 9, None, "x")] + [(pairs[0][1], pairs[0][0], True, "x")]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b, ok, _ in rows:
        if ok and a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    df = spark.createDataFrame(rows, "l long, r long, id boolean, group_id string")
    got = {r["id"]: r["group_id"] for r in components.connected_groups(df, "l", "r", F.col("id")).collect()}
    sizes = Counter(find(x) for x in root)
    assert got == {x: find(x) for x in root if sizes[find(x)] > 1}
    assert components.connected_groups(df.limit(0), "l", "r", F.col("id")).count() == 0


def test_survivors_and_dominant_rows(spark):
    rng = random.Random(2)
    rows = [(g, i, rng.choice([None, 1, 2, 3]), rng.choice([None, 0, 1]), rng.choice([None, "", "v", "w"])) for i, g in enumerate(rng.choice([1, 2, 3, 4, None]) for _ in range(60))]
    df = spark.createDataFrame(rows, "g long, id long, a int, b int, v string")
    got = {(r["g"], r["id"]) for r in survivorship.dominant_rows(df, "g", "id", [F.col("a"), F.col("b")]).collect()}
    key = lambda r: tuple(-1 if x is None else x for x in r[2:4])
    want = set()
    for g in (1, 2, 3, 4):
        m = [r for r in rows if r[0] == g]
        want |= {(g, r[1]) for r in m if all(all(p >= q for p, q in zip(key(r), key(o))) and key(r) != key(o) for o in m if o is not r)}
    assert got == want
    best = {r["g"]: r for r in survivorship.surviving_records(df, "g", ["v", "a"], F.coalesce("a", F.lit(0)), F.col("b")).collect()}
    for g in (1, 2, 3, 4):
        filled = [r for r in rows if r[0] == g and r[4]]
        top = max(filled, key=lambda r: (r[2] or 0, -1 if r[3] is None else r[3], r[4])) if filled else None
        assert best[g]["v"] == (top[4] if top else None)
    assert survivorship.surviving_records(df.limit(0), "g", ["v"], F.lit(1), F.lit(1)).count() == 0


@pytest.mark.parametrize(("raw", "n"), [(None, 0), ("", 0), ("{", 0), ("null", 0), ('{"count": 9}', 0), ('{"fights": [1, 1]}', 2), ("[1]", 1), ('{"fights": [1]} x', 0), ('{"fights": [NaN]}', 0)])
def test_history_entries(spark, raw, n):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(survivorship.history_entries(F.col("t"))).first()[0] == n


def test_damerau_and_dictionary(spark):
    assert canonical.damerau("abcd", "abdc") == 0.8 and canonical.damerau("abc", "abc") == 0 and canonical.damerau("brazil", "brazzil") == 0.7
    entries = [(1, "Brazil", "BRA"), (2, "Nigeria", None), (3, "Dominican Republic", None), (4, "United States", "USA"), (5, "Iran", "IRN"), (6, "Iraq", None)]
    variants, outside = canonical.country_tables(spark, entries)
    block = next(canonical.build_blocks(entries, variants, outside))
    for raw, want in {"Brésil": 1, "brazilian": 1, "Bra zil": 1, "Niger": 0, "Nigéria": 2, "Dominica": 0, "Dominican Rep.": 3, "Mont X, Georgia, USA": 4, "Iarn": 5, "Iarq": 6, "185 cm": 0, "-": 0, "Team United States": 4, "x" * 5000: 0}.items():
        assert canonical.look_up([block], raw)[1] == want, raw
    df = spark.createDataFrame([(1, "Brazil", "a"), (2, "brasil", "b"), (3, None, "c"), (4, "", "d"), (2, "brasil", "b")], "id long, home string, field string")
    got = canonical.map_values(df, "id", {"home": [block]})
    assert sorted((r["record_id"], r["canon_id"]) for r in got.collect()) == [(2, 1), (2, 1), (4, 0)]
    halves = list(canonical.build_blocks(entries, variants, outside, size=5))
    assert len(halves) > 1
    for raw in ("Brésil", "brazilian", "Bra zil", "Niger", "Nigéria", "Dominican Rep.", "Mont X, Georgia, USA", "Iarn", "Iarq", "Ira", "Irak", "U. States", "-"):
        assert canonical.look_up(halves, raw)[1] == canonical.look_up([block], raw)[1], raw
    assert sorted((r["record_id"], r["canon_id"]) for r in canonical.map_values(df, "id", {"home": halves}).collect()) == [(2, 1), (2, 1), (4, 0)]
    assert canonical.map_values(df.limit(0), "id", {"home": [block]}).count() == 0


def test_metric_pairs_are_exact(spark):
    """Every pair within the radius, short and common names too, and few cells for a query."""
    rng = random.Random(4)
    givens, letters = ["anna", "boris", "carlos", "daniela", "emilio"], "aeiklmnor"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    known = [(str(i), rng.choice([*givens, word(5), word(1)]), word(rng.randint(1, 8))) for i in range(150)] + [("e", "", "kim"), ("f", "bo", "x" * 3000)]

    def typo(s):
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(s) + 1)
            s = rng.choice([s[:i] + s[i + 1 :], s[:i] + rng.choice(letters) + s[i:], s[:i] + rng.choice(letters) + s[i + 1 :]])
        return s

    asked = [(f"q{i}", typo(g), typo(s)) for i, (_, g, s) in enumerate(known)]
    frame = lambda rows: spark.createDataFrame([(k, "name", g, s, False) for k, g, s in rows], "key string, kind string, given string, surname string, junior boolean")
    rows = name_variants.metric_pairs(frame(asked + asked[:5]), frame(known)).collect()
    got = {(r["query"], r["key"]): r["g"] + r["s"] for r in rows}
    lev = lambda a, b: person_names._edits(a, b, 2)
    want = {(q, k): d for q, g, s in asked for k, h, t in known if (d := lev(g, h) + lev(s, t)) <= 2}
    assert got == want and len(rows) == len(got)
    kept = {(r["query"], r["key"]) for r in name_variants.misspellings(spark.createDataFrame(rows), givens).collect()}
    names = {k: (g, s) for k, g, s in known}
    common = lambda g, h: g != h and g in givens and h in givens
    assert kept == {(q, k) for q, g, s in asked for k, (h, t) in names.items() if (q, k) in want and not common(g, h) and (g == h or min(len(g), len(h)) > 1) and (s == t or min(len(s), len(t)) > 3)}
    assert name_variants.metric_pairs(frame(asked).limit(0), frame(known)).count() == 0


@pytest.mark.parametrize(
    ("raw", "reading"),
    [("Malekike, Ivan", ("ivan", "malekike")), ("ROSSI Anna", ("anna", "rossi")), ("T.Fenin", ("t", "fenin")), ("Borok, T.", ("t", "borok")), ("Emre D. Polo", ("emre", "polo")), ("Ann van Dyk Jr. #3 Lightweight", ("ann", "vandyk")), ('Jo "Salt" Kim (ESP)', ("jo", "kim")), ("Łukasz Ó'Néill *", ("lukasz", "oneill"))],
)
def test_name_readings(raw, reading):
    assert person_names.read_name(raw, frozenset({"anna", "ivan"})).readings[0] == reading


@pytest.mark.parametrize("raw", [None, "", "TBA", "?", "To be announced", "Opponent TBA", "***", "123"])
def test_placeholders(raw):
    assert person_names.read_name(raw) is None


def test_name_candidates(spark):
    known = spark.createDataFrame([(1, "Anna Rossi", "Salt"), (2, "Boris Ivanov", None), (3, "Rossi, B.", None), (4, None, None)], "id long, name string, nickname string")
    typed = spark.createDataFrame([("ROSSI Anna",), ("Anna Rosssi",), ("Salt Rossi",), ("B. Ivanov",), ("AnnaRossi",), ("Zed Nobody",), (None,)], "name string")
    pivots = ["anna", "boris"]
    got = name_variants.name_candidates(name_variants.read_names(typed.filter("name is not null"), "name", "name", pivots), name_variants.read_names(known, "id", "name", pivots, nickname="nickname"), pivots)
    assert {(r["query"], r["key"]) for r in got.collect()} == {("ROSSI Anna", "1"), ("Anna Rosssi", "1"), ("Salt Rossi", "1"), ("B. Ivanov", "2"), ("AnnaRossi", "1")}


def test_listings_and_fingerprints(spark, tmp_path):
    block = next(canonical.build_blocks([(401, "Granite Fighting Championship", "GFC"), (402, "Harbor Cage League", "HCL")], canonical.promotion_variants))
    find = lambda t: canonical.look_up([block], t)[1]
    read = lambda n, p=None: batch_dedup.read_listing(n, p, None, None, find)[:5]
    assert read("GFC 281: Beliloveno vs. Vikuvoveno") == ("c401", 281, "beliloveno", "vikuvoveno", None)
    assert read("GFC281 Granite Fighting Championship 281") == ("c401", 281, None, None, None)
    assert read("HCL Fight Night: A Bcd VS. E Fgh 2 - Town | Results") == ("c402", None, "bcd", "fgh", 2)
    assert read("Ann Lee vs. Bo Kim", "Harbor Cage League 7") == ("c402", 7, "kim", "lee", None)
    assert read(None) == (None, None, None, None, None)
    d = datetime.date
    schema = "id long, name string, promotion string, date date, url string"
    history = spark.createDataFrame([(1, "GFC 1: Alpha vs. Bravo", None, d(2020, 1, 1), "https://t.example/events/77-x")], schema)
    rows = [(1, "Granite Fighting Championship 1", None, d(2020, 3, 1), None), (2, "x", None, None, "http://t.example/events/77"), (3, "HCL 5: Carlo vs. Delta", None, d(2021, 1, 1), None), (4, "hcl 5", None, d(2021, 1, 1), None), (5, "HCL 6: Carlo vs. Delta", None, d(2021, 1, 2), None), (6, None, None, None, None), (7, "hcl 5", None, d(2021, 1, 1), None), (8, "GFC Fight Night: Alpha vs. Bravo 2", None, d(2020, 1, 2), None)]
    facts = lambda df, kind: batch_dedup.listings(df, kind, "id", "name", "promotion", "date", "url", lambda: find)
    store = batch_dedup.Store(spark, f"{tmp_path}/store")
    assert store.versions() == [] and store.tables().count() == 0
    store.accept(facts(history, "event"))
    got = batch_dedup.check_batch(store, facts(spark.createDataFrame(rows, schema), "raw"))
    assert {tuple(r) for r in got.collect()} == {(1, "event", 1), (2, "event", 1), (4, "raw", 3), (7, "raw", 3)}
    assert batch_dedup.check_batch(store, facts(spark.createDataFrame([], schema), "raw")).count() == 0


def test_an_edit_changes_at_most_two_letter_bits():
    rng = random.Random(21)
    differs = lambda a, b: ((batch_dedup.letter_bits(a) ^ batch_dedup.letter_bits(b)) & (1 << 64) - 1).bit_count()
    for _ in range(500):
        w = "".join(rng.choice("aeinorstlkz1é") for _ in range(rng.randint(2, 24)))
        i = rng.randrange(len(w))
        assert differs(w, w[:i] + w[i + 1 :]) <= 1 and differs(w, w[:i] + "q" + w[i + 1 :]) <= 2 and differs(w, w[i:] + w[:i]) == 0


def test_batches_one_by_one_give_the_same_as_one_pass(spark, tmp_path):
    """History is read once; later batches meet it in the store only, also where a headliner is misspelled."""
    read = spark.sparkContext.accumulator(0)

    def find():
        def promoter(text):
            read.add(1)
            return {"gfc": 401, "hcl": 402}.get(text.lower(), 0)

        return promoter

    rng, d = random.Random(22), datetime.date(2020, 1, 1)
    word = lambda: "".join(rng.choice("aeiklmnorst") for _ in range(rng.randint(6, 9)))
    cards = [(rng.choice(["GFC", "HCL"]), i, word().title(), word().title(), d + datetime.timedelta(days=23 * i)) for i in range(40)]
    name = lambda p, n, a, b: rng.choice([f"{p} {n}", f"{p}: {a} vs. {b}", f"{p} {n}: {b} vs {a}", f"{p}: {a[:3]}x{a[4:]} vs. {b[:-2]}{b[-1]}"])
    schema = "id long, name string, promotion string, date date, url string"
    history = spark.createDataFrame([(i, f"{p} {n}: {a} vs. {b}", None, day, None) for i, (p, n, a, b, day) in enumerate(cards[:25])], schema)
    rows = [(1000 + k, name(*cards[i][:4]), None, cards[i][4] + datetime.timedelta(days=rng.choice([0, 0, 60])), None) for k, i in enumerate(rng.randrange(40) for _ in range(90))]
    facts = lambda df, kind: batch_dedup.listings(df, kind, "id", "name", "promotion", "date", "url", find)
    store, once = batch_dedup.Store(spark, f"{tmp_path}/a"), batch_dedup.Store(spark, f"{tmp_path}/b")
    store.accept(facts(history, "event"))
    at_first = read.value
    got = []
    for part in (rows[:45], rows[45:]):
        got += [tuple(r) for r in batch_dedup.check_batch(store, facts(spark.createDataFrame(part, schema), "raw")).collect()]
        store.compact()
    once.accept(facts(history, "event"))
    whole = {tuple(r) for r in batch_dedup.check_batch(once, facts(spark.createDataFrame(rows, schema), "raw")).collect()}
    assert at_first > 0 and store.facts().filter("kind = 'event'").count() == 25
    known = {r[0]: (r[1], r[2]) for r in got}
    assert {r[0] for r in whole} >= known.keys() and all((k, *v) in whole or v[0] == "raw" for k, v in known.items())
    assert {r for r in whole if r[1] == "event"} == {(1000 + k, "event", n) for k, (_, text, *_) in enumerate(rows) for n in [next(i for i, c in enumerate(cards) if c[4] in (rows[k][3], rows[k][3] - datetime.timedelta(days=60)) and (c[2][:3] in text or c[3][:3] in text or text == f"{c[0]} {c[1]}"))] if n < 25}


@pytest.mark.parametrize("floor", [0.0, 0.1, 0.3, 0.6])
def test_bm25_best_match_brute_force(spark, floor):
    rng = random.Random(6)
    terms = lambda: sorted({int(40 * rng.random() ** 2) for _ in range(8)})
    known, asked = {i: terms() for i in range(80)}, {i: sorted({*terms(), 100 + i}) for i in range(40)}
    frame = lambda d: spark.createDataFrame([(k, v) for k, v in d.items()] + [(999, [])], "key long, terms array<long>")
    n, mean = 81, sum(map(len, known.values())) / 81
    df = Counter(t for v in known.values() for t in v)
    k1, b = cross_source.K1, cross_source.B
    idf = lambda t: float(np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)))
    score = lambda q, k: sum(map(idf, set(asked[q]) & set(known[k]))) * (k1 + 1) / (1 + k1 * (1 - b + b * len(known[k]) / mean))
    want = {}
    for q in asked:
        mass = sum(map(idf, asked[q]))  # here each term is a kind of its own
        fit = {k: score(q, k) for k in known if set(asked[q]) & set(known[k]) and score(q, k) >= floor * mass}
        third = sorted(fit.values())[-3] if len(fit) > 2 else 0.0
        want |= {(q, k): s for k, s in fit.items() if s >= third - 1e-9}
    rows = cross_source.bm25_candidates(frame(known), frame(asked), floor, 3, F.lit(1.0), lambda t: t.cast("string"), lambda t: t == 3).collect()
    got = {(r["query"], r["key"]): r for r in rows}
    assert got.keys() == want.keys() and all(abs(r["score"] - want[p]) < 1e-9 for p, r in got.items())
    assert all((r["score"] > r["rest"]) == ("3" in r["shared"]) and not set(r["shared"]) & set(r["differ"]) for r in rows)
    empty = spark.createDataFrame([], "key long, terms array<long>")
    assert cross_source.bm25_candidates(empty, frame(asked), 0.1, 3, F.lit(1.0), lambda t: t).count() == 0
    assert cross_source.bm25_candidates(frame(known), empty, 0.1, 3, F.lit(1.0), lambda t: t).count() == 0


@pytest.mark.parametrize("typed", ["Rafael Ranokuvsen", "R. Ranokvsen", "Rafxel Ranokvsen", "Rafael Raxoukvxen"])
@pytest.mark.parametrize("dated", [True, False])
def test_misspelled_names_are_candidates(spark, typed, dated):
    """Attributes other than the name look up the index too."""
    columns = "key long, name string, nickname string, born string, country string, height string, weight string, record string, last string"
    row = lambda key, name: (key, name, None, "1990-03-07" if dated else None, None, "180 cm", None, "7-3-0", None)
    others = [(i, f"Pavel Other{i:03d}", None, f"19{60 + i % 40}-01-11", None, "170 cm", None, f"{i}-0-0", None) for i in range(10, 200)]
    find = lambda: lambda text: 0
    terms = lambda rows, query: profile_terms.person_terms(spark.createDataFrame(rows, columns), ["rafael"], find, find, query)
    known, asked = terms([row(1, "Rafael Ranoukvsen"), *others], False), terms([row(2, typed)], True)
    got = cross_source.bm25_candidates(known, asked, 0.1, 5, F.lit(0.5), profile_terms.term_kind)
    assert (2, 1) in {(r["query"], r["key"]) for r in got.collect()}


def test_confidence_uses_the_label_only_as_a_label(spark):
    rng = random.Random(10)
    rows = []
    for i in range(600):
        same = rng.random() < 0.5
        agrees = None if rng.random() < 0.3 else int(same) if rng.random() < 0.95 else 0
        rows.append((i, i, rng.gauss(4.0 if same else 0.0, 1.0), agrees, same))
    df = spark.createDataFrame(rows, "query long, key long, rest double, agrees int, same boolean")
    got = cross_source.calibrated(df, {"rest": F.col("rest")}, F.col("agrees"), {"same": F.col("agrees") == 1, "apart": F.col("agrees") == 0}).collect()
    assert sum((r["confidence"] >= 0.5) == r["same"] for r in got) > 0.95 * len(got)
    assert all(r["confidence"] > 0.5 for r in cross_source.calibrated(df.limit(0).unionByName(df.filter("agrees is null")), {"rest": F.col("rest")}, F.col("agrees"), {}).collect())


def test_mutual_best_and_confidence(spark):
    rows = [(1, "a", 10, 9.0), (1, "a", 11, 5.0), (2, "a", 10, 8.0), (3, "b", 10, 7.0), (4, "a", 12, 3.0), (4, "a", 13, 3.0)]
    got = {(r["query"], r["key"]) for r in cross_source.mutual_best(spark.createDataFrame(rows, "query long, source string, key long, score double")).collect()}
    assert got == {(1, 10), (3, 10)}
    rng = random.Random(9)
    w, _, _ = cross_source.fit_logistic([([x := rng.gauss(0, 1)], int(x > 0)) for _ in range(400)])
    assert w[1] > 1


def test_winnowing_finds_every_long_shared_span(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(50))) for i in range(12)] + [(98, None), (99, "")]
    docs, want = [(0, None), (1, ""), (2, "short")], set()
    for k in range(60):
        i = rng.randrange(12)
        w, size, at = items[i][1].split(), rng.choice([8, 12, 24, 40, 50]), 0
        at = rng.randint(0, 50 - size)
        span = w[at : at + size]
        if size >= 24 and k % 2:
            span = [*span[:9], word(), *span[10:]]
        text = " ".join([*(word() for _ in range(30)), *span, *(word() for _ in range(30))])
        text = text.upper().replace(" ", ",\n", 3) if k % 3 == 0 else f"<p>{text}</p>".replace(" ", " <b>x</b>" if False else " ")
        docs.append((100 + k, text))
        if size >= 24:
            want.add((100 + k, i))
    corpus = spark.createDataFrame([(a, b, "t") for a, b in docs], "doc_id long, text string, item string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    for limit in (10**6, 300):
        got = leakage.leaked_items(corpus, "doc_id", "text", tests, "item_id", "text", limit=limit)
        assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    assert leakage.leaked_items(corpus.limit(0), "doc_id", "text", tests, "item_id", "text").count() == 0


def test_winnow_guarantee():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 50, 400).astype(np.uint64)
    for size in (leakage.GRAM + leakage.WINDOW - 1, 20):
        for at in range(0, 300, 7):
            b = np.concatenate([rng.integers(60, 90, 20), a[at : at + size], rng.integers(60, 90, 20)]).astype(np.uint64)
            assert set(leakage.winnow(a)[0].tolist()) & set(leakage.winnow(b)[0].tolist())


def test_mixture_keeps_shares_and_caps(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, 0, rng.randint(1, 400)])) for i in range(900)]
    docs = spark.createDataFrame(rows, "id long, source string, size long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("none", 0.2, 2)], "source string, target_share double, max_repeats int")
    mixed = mixture.mix_sources(docs, "id", "source", "size", targets)
    got = {r["id"]: r for r in mixed.collect()}
    assert len(got) == sum(r[1] in ("a", "b") for r in rows) and {r["copies"] for r in mixture.mix_sources(docs, "id", "source", "size", targets).collect()} <= {0, 1, 2, 3}
    assert all(r["copies"] <= {"a": 1, "b": 3}[r["source"]] for r in got.values())
    shares = {r["source"]: r for r in mixture.mixture_shares(mixed, "source", "size", targets).collect()}
    total = sum(r["tokens"] for r in shares.values())
    assert abs(shares["a"]["tokens"] - 0.625 * total) <= 800 and shares["none"]["tokens"] == 0
    again = {r["id"]: r["copies"] for r in mixture.mix_sources(docs.repartition(3), "id", "source", "size", targets).collect()}
    assert abs(sum(again[r[0]] * (r[2] or 0) for r in rows if r[1] == "b") - shares["b"]["tokens"]) <= 400
    assert mixture.mix_sources(docs.limit(0), "id", "source", "size", targets).count() == 0


def test_pair_off_is_fair():
    hits = Counter()
    for seed in range(600):
        out, at, left = mixture.pair_off([1, 2, 3], [10, 20, 30], [0.5, 0.25, 0.4], seed)
        held = sum(s * o for s, o in zip([10, 20, 30], out)) + (left * [10, 20, 30][at] if at >= 0 else 0)
        assert abs(held - 22) < 1e-6
        for i, o in enumerate(out):
            hits[i] += o + (left if i == at else 0)
    assert all(abs(hits[i] / 600 - p) < 0.08 for i, p in enumerate([0.5, 0.25, 0.4]))


def test_truncation(spark):
    rng = random.Random(10)
    people, verbs = ["Anna Rossi", "Boris Ivanov", "Carla Diaz", "Dan Smith"], ["won the final round", "left the old arena early", "spoke with every judge", "trained near the harbor"]
    sentence = lambda: f"{rng.choice(people)} {rng.choice(verbs)} in {rng.choice(['March', 'April', 'May'])}."
    rows = []
    for i in range(600):
        text = " ".join(sentence() for _ in range(rng.randint(2, 9)))
        cut = len(text) > 160 and i % 2 == 0
        text = text[:160] if cut else text
        rows.append((i, "s1", text, cut and not text.endswith((".", ". "))))
    rows += [(1000, "s1", None, None), (1001, "s1", "", False), (1002, None, "Anna Rossi won the final round in May.", False), (1003, "s1", "Anna Rossi won the final round in May. Boris Ivanov left the old ar", True), (1004, "s1", "Anna Rossi won the final round in May. Boris Iv&#3", True)]
    df = spark.createDataFrame(rows, "id long, source string, text string, truncated boolean")
    limits = {(r["unit"], r["length"]) for r in truncation.length_limits(df).collect()}
    assert ("chars", 160) in limits
    got = {r["id"]: r["evidence"] is not None for r in truncation.truncated_texts(df, "id").collect()}
    assert 1000 not in got
    wrong = [r for r in rows if r[3] is not None and got[r[0]] != r[3]]
    assert len(wrong) <= 6, wrong[:5]
    assert truncation.truncated_texts(df.limit(0), "id").count() == 0


def test_queries_have_oracles_of_known_names():
    from recordloom.llm import queries

    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert {f"p{n}_found" for n in (1, 3, 4, 5, 6, 7, 8, 10)} <= set(queries.QUERIES)


def test_keys_of_a_name_are_bounded(spark):
    """However many known given names lie near a query's, it makes the same keys; one edit in each word is met."""
    frame = lambda rows: spark.createDataFrame([(k, "name", g, s, False) for k, g, s in rows], "key string, kind string, given string, surname string, junior boolean")
    near = [f"carlo{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    known = [(f"k{i}", g, "ferreira") for i, g in enumerate(near)]
    got = {r["key"] for r in name_variants.metric_pairs(frame([("q", "carlos", "ferreiro")]), frame(known)).collect()}
    assert got == {k for k, g, _ in known if person_names._edits(g, "carlos", 1) <= 1}
    assert len(name_variants.name_keys("carlos", "ferreiro", True)) <= 60 and len(name_variants.name_keys("carlos", "ferreira", False)) <= 22
    words = ["".join(w) for n in range(5) for w in itertools.product("ab", repeat=n)]
    assert all(set(name_variants.half_keys(a)) & set(name_variants.half_keys(b)) for a in words for b in words if person_names._edits(a, b, 1) <= 1)


def test_truncation_asks_all_texts(spark):
    """Words of one text among more than the 20,000 that a sample would hold tell where another breaks off."""
    letters = "abcdefghij"
    word = lambda i: "xo" + "".join(letters[int(c)] for c in f"{i:02}") + "qu"
    rows = [(i, f"Row {i} was won.") for i in range(25_000)] + [(30_000 + i, f"Here {word(i)}est came first.") for i in range(40)] + [(40_000 + i, f"He stood up. Then number {i} met {word(i)}") for i in range(40)]
    df = spark.createDataFrame([(i, "a", t) for i, t in rows], "id long, source string, text string")
    got = {r["id"]: r["evidence"] for r in truncation.truncated_texts(df, "id").collect() if r["evidence"] is not None}
    assert got == {40_000 + i: "word" for i in range(40)}
