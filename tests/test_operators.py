"""Merges, matching, folds, sources and streams on small tables."""

import datetime
import random
import shutil

from pyspark.sql import functions as F

from recordloom.operators import extraction, folds, matching, merge
from recordloom.plans import ladder_queries, matching_queries
from recordloom.sources import files
from recordloom.streaming import ingest


def test_upsert_policies(spark):
    old = spark.createDataFrame([(1, "A", None, "x", None), (2, "B", "n", None, True)], "id int, name string, nickname string, stance string, is_verified boolean")
    new = spark.createDataFrame([(1, "Z", "m", "y", True, "tapology"), (3, "C", "k", "z", None, "ufc")], "id int, name string, nickname string, stance string, is_verified boolean, source string")
    got = {r["id"]: tuple(r)[1:] for r in merge.upsert(old, new, "id", ["name", "nickname", "stance", "is_verified"], "source").collect()}
    assert got == {1: ("A", "m", "x", True), 2: ("B", "n", None, True), 3: ("C", "k", "z", None)}
    again = merge.upsert(merge.upsert(old, new, "id", ["name", "nickname", "stance", "is_verified"], "source"), new, "id", ["name", "nickname", "stance", "is_verified"], "source")
    assert {r["id"]: tuple(r)[1:] for r in again.collect()} == got


def test_union_sets(spark):
    df = spark.createDataFrame([("A | B", "B | C"), (None, " A "), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(merge.union_sets(F.col("a"), F.col("b"))).collect()] == ["A | B | C", "A", None]


def test_record_chain(spark):
    cols = [f"record_{k}_{p}" for k in ("total", "ufc", "other") for p in ("wins", "losses", "draws")]
    df = spark.createDataFrame([(19, 8, 0, 8, 6, 0, None, None, None), (1, 0, None, 3, 0, None, 0, 0, 0)], ", ".join(f"{c} int" for c in cols))
    a, b = merge.record_chain(df).collect()
    assert (a["record_other_wins"], a["record_other_losses"], a["total_fights"]) == (11, 2, 27)
    assert (b["record_total_wins"], b["record_other_wins"], b["total_fights"]) == (3, 0, 3)


def test_violations_ignore_nulls(spark):
    df = spark.createDataFrame([(1, "M", 5), (2, "X", None), (3, None, 101)], "id int, g string, s int")
    got = merge.violations(df, "id", {"g": F.col("g").isin("M", "F"), "s": F.col("s").between(0, 100)}).collect()
    assert {(r["id"], r["check"]) for r in got} == {(2, "g"), (3, "s")}


def test_match_ladder(spark):
    d = datetime.date
    stored = spark.createDataFrame([(1, "a", d(1990, 1, 1)), (2, "b", None), (3, "c", None), (4, "c", None), (5, "e", d(1990, 5, 1)), (6, "f", d(1980, 1, 1)), (7, "f", d(1981, 1, 1))], "id int, key string, dob date")
    inc = [(1, "a", d(1990, 1, 1)), (2, "b", d(1991, 1, 1)), (3, "c", d(1991, 1, 1)), (4, "zz", None), (5, "e", d(1990, 6, 1)), (6, "e", d(1999, 1, 1)), (7, "f", None), (8, None, None), (9, "a", None)]
    got = {r["in_id"]: (r["stored_id"], r["status"]) for r in matching.match_ladder(spark.createDataFrame(inc, "in_id int, key string, dob date"), stored).collect()}
    assert got == {1: (1, "name_dob"), 2: (2, "name_only"), 3: (None, "ambiguous"), 4: (None, "new"), 5: (5, "name_close_dob"), 6: (None, "new_homonym"), 7: (None, "ambiguous"), 8: (None, "new"), 9: (1, "name_only")}


def test_runs_and_top(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(5), i, rng.choice("WL")) for i in range(300)] + [(9, i, "W") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    want = {}
    for k in {r[0] for r in rows}:
        vs = [v for kk, _, v in sorted(rows, key=lambda r: r[1]) if kk == k][::-1]
        want[k] = (vs[0], next((i for i, v in enumerate(vs) if v != vs[0]), len(vs)))
    assert {r["k"]: (r["last_value"], r["run"]) for r in matching.current_runs(df, "k", "o", "v").collect()} == want
    top = matching.top_per_key(df, "k", [F.desc("o")], 3).collect()
    assert {(r["k"], r["rank"]): r["o"] for r in top} == {(k, i): o for k in want for i, o in enumerate(sorted((o for kk, o, _ in rows if kk == k), reverse=True)[:3], 1)}


def test_leader_clusters_match_the_greedy_fold(spark):
    rng = random.Random(5)
    n = 40
    edges = {(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.05}
    leaders, want = [], {}
    for i in range(n):
        want[i] = next((x for x in leaders if (x, i) in edges), i)
        if want[i] == i:
            leaders.append(i)
    pairs = spark.createDataFrame(sorted(edges), "left long, right long")
    got = matching.leader_clusters(pairs, spark.range(n))
    assert {r["id"]: r["leader"] for r in got.collect()} == want


def test_no_nested_loops(spark):
    e = spark.createDataFrame([(1, datetime.date(2020, 1, 1))], "id int, d date")
    plan = matching.band_pairs(e, e.toDF("id2", "d2"), "d", "d2")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_two_header_csv_and_url_list(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿group,,other\nname,age,city\nA, 3 ,\nB\nname,age,city\n\"C\nD\",4,x\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_two_header_csv(spark, str(tmp_path / "t.csv")).collect()] == [("A", "3", None), ("B", None, None), ("name", "age", "city"), ("C\nD", "4", "x")]
    (tmp_path / "u.txt").write_text("# head\nhttps://a.example/x/ https://b.example/y # label\nhttps://a.example/x\n\nnone\n")
    got = files.read_url_list(spark, str(tmp_path / "u.txt")).orderBy("first").collect()
    assert [r["url"] for r in got] == ["https://a.example/x", "https://b.example/y"]


def test_snapshots_and_stream(spark, tmp_path):
    schema = "id long, name string, nickname string, source string, arrived long"
    spark.createDataFrame([(1, "A", None, "ufc", 1), (1, "A", "k", "ufc", 2)], schema).write.parquet(str(tmp_path / "in"))
    target = files.Snapshots(spark, str(tmp_path / "state"))
    run = lambda: ingest.merge_stream(ingest.read_new_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema), target, "id", ["name", "nickname"], "source", str(tmp_path / "ck")).awaitTermination()
    run()
    assert [tuple(r) for r in target.read().collect()] == [(1, "A", "k")] and target.versions() == [1]
    run()
    assert target.versions() == [1]
    spark.createDataFrame([(2, "B", None, "ufc", 3)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert target.versions()[-1] == 2 and target.read().count() == 2
    assert [target.has(t) for t in ("x", "never")] == [False, False]
    target.commit(target.read(), tag="x")
    assert target.has("x") and target.versions()[-1] == 3
    shutil.rmtree(tmp_path / "ck" / "commits")  # as if the stream died after the merge, before its own commit
    run()
    assert target.versions()[-1] == 3


def test_extraction(spark):
    body = "<html><script>x</script><p>Venue: Hall<br>Other</p><table><tr><th>Height</th><td>5'7\"</td></tr></table><p>broken"
    df = spark.createDataFrame([(1, body), (2, None)], "id int, body string")
    got = {r["id"]: r for r in extraction.flat_pages(df, "id", "body").collect()}
    assert got[1]["rows"] == [["Height", "5'7\""]] and got[2]["text"] == ""
    line = spark.createDataFrame([(got[1]["text"],)], "t string").select(extraction.labelled_value(F.col("t"), "Venue")).first()[0]
    assert line == "Hall"
    event = '{"id":"1","name":"E","date":"2020-02-03T00:00Z","competitions":[{"segment":"main","competitors":[{"order":2,"winner":true,"name":"B"},{"order":1,"winner":false,"name":"A"}]},{"segment":"prelim","competitors":[{"order":1,"name":"C"}]}]}'
    rows = extraction.bouts_of_json(spark.createDataFrame([(event,), ("{bad",), (None,)], "body string"), "body").orderBy("bout_order").collect()
    assert [(r["bout_order"], r["fighter1_name"], r["fighter2_name"], r["winner_name"]) for r in rows] == [(1, "C", None, None), (2, "A", "B", "B")]
    card = spark.createDataFrame([(1, "Main\n1. Ann Lee vs. Bo Kim\nC D v E F"), (2, "W Ann Lee / L Bo Kim"), (3, None)], "id int, t string")
    assert {(r["id"], r["strategy"], r["a"], r["b"]) for r in extraction.card_bouts(card, "id", "t").collect()} == {(1, "versus", "Ann Lee", "Bo Kim"), (1, "versus", "C D", "E F"), (2, "badges", "Ann Lee", "Bo Kim")}


def test_next_ids(spark):
    got = files.next_ids(spark.range(100).select((F.lit(99) - F.col("id")).alias("o")), "o", 7).collect()
    assert {(r["o"], r["id"]) for r in got} == {(i, i + 8) for i in range(100)}


def test_reach_goes_on_until_the_frontier_is_empty(spark):
    rng = random.Random(19)
    pairs = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(i, i + 1) for i in range(200, 212)] + [(400, 401), (7, 7), (None, 3), (3, None)]
    seeds, graph = [1, 2, 200, 999, None], {}
    for a, b in pairs:
        if a is not None and b is not None:
            graph.setdefault(a, set()).add(b)
            graph.setdefault(b, set()).add(a)
    want, frontier, k = {}, {x for x in seeds if x is not None}, 0
    while frontier:
        want |= dict.fromkeys(frontier, k)
        frontier, k = {y for x in frontier for y in graph.get(x, ())} - want.keys(), k + 1
    edges, roots = spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame([(x,) for x in seeds], "id long")
    got = [(r["id"], r["steps"]) for r in matching.reach(edges, roots).collect()]
    assert sorted(got) == sorted(want.items()) and want[212] == 12
    assert {r["id"] for r in matching.reach(edges, roots, 2).collect()} == {x for x, n in want.items() if n <= 2}
    assert matching.reach(edges, roots.limit(0)).count() == 0


def test_applying_bouts_twice_changes_nothing(spark):
    d = datetime.date
    columns = "id long, record_total_wins int, record_total_losses int, record_total_draws int, record_total_nc int, last_fight_date date, current_streak string, last_5_results string, fight_history string"
    stored = '{"source":"tapology","fights":[{"result":"W","opponent":"Old #3 HW","event_date":"2020-01-10","method":"KO"},{"result":"W","opponent":"Legacy","date":"Submission"}]}'
    fighters = spark.createDataFrame([(1, 2, 0, 0, 1, d(2020, 1, 10), "2W", "W,W", stored), (2, None, None, None, None, None, None, None, None), (3, 1, 1, 0, 0, None, None, None, "{bad")], columns)
    bout = lambda i, a, b, na, nb, w, day, m="KO": (i, 7, 1, a, b, na, nb, w, m, day)
    bouts = [bout(1, 1, 2, "One", "Two", 1, d(2021, 1, 1)), bout(2, 1, None, "One", "old", 1, d(2020, 1, 12)), bout(3, 2, 1, "Two", "One", 1, d(2021, 1, 3)), bout(4, 1, 3, "One", "Three", None, d(2021, 5, 1), "Draw")]
    bouts += [bout(5, 3, 1, "Three", "One", 3, d(2020, 6, 1), "Sub"), bout(6, 3, 2, "Three", "Two", None, d(2020, 7, 1)), bout(7, 1, None, "One", "Legacy", 1, d(2019, 1, 1)), bout(8, None, None, "x", "y", None, d(2020, 1, 1)), bout(9, 1, 3, "One", "Three", 1, None)]
    df = spark.createDataFrame(bouts, "id long, event_id long, bout_order int, fighter1_id long, fighter2_id long, fighter1_name string, fighter2_name string, winner_id long, method string, event_date date")
    once = {r["id"]: r for r in folds.apply_bouts(fighters, df).collect()}
    one = once[1]
    assert (one["wins"], one["losses"], one["draws"], one["total_fights"], one["current_streak"], one["last_5_results"], one["n_history"]) == (3, 1, 1, 6, "1D", "W,W,L,W,D", 5)
    assert (one["ko_wins"], one["sub_wins"], one["sub_losses"], one["last_fight_date"]) == (2, 1, 1, d(2021, 5, 1))
    assert (once[2]["losses"], once[2]["current_streak"], once[2]["n_history"]) == (1, "1L", 1) and once[3]["wins"] == 2
    after = fighters.drop("fight_history").join(spark.createDataFrame([(i, r["fight_history"]) for i, r in once.items()], "id long, fight_history string"), "id")
    assert folds.apply_bouts(after, df).count() == 0
    assert folds.apply_bouts(fighters, df.limit(0)).count() == 0


def test_failure_runs_match_brute_force(spark):
    rng = random.Random(8)
    rows = [(k, i * rng.choice([1, 1, 3]) + 1000 * k, rng.random() < 0.6) for k in range(4) for i in range(120)]
    rows = list({(k, o): (k, o, f) for k, o, f in rows}.values()) + [(9, 5, True), (9, 25, True), (9, 45, True), (8, 1, None)]
    want = {}
    for k in {r[0] for r in rows}:
        best = n = 0
        for _, _, f in sorted(r for r in rows if r[0] == k):
            n = n + 1 if f else 0
            best = max(best, n)
        want[k] = best
    got = {r["k"]: r["longest"] for r in ingest.failure_breaker(spark.createDataFrame(rows, "k int, o long, f boolean"), "k", "o", "f", 1, span=10).collect()}
    assert got == {k: n for k, n in want.items() if n}


def test_opponents_and_tokens(spark):
    sets = [({"ann", "lee"}, {"ann", "lee", "mary"}), ({"chris", "kim"}, {"christopher", "kim"}), ({"bandoui", "ali"}, {"bandaoui", "ali"}), ({"kim"}, {"kim"}), ({"abc", "xyz"}, {"abd", "xyw"}), (set(), {"a"})]
    df = spark.createDataFrame([(i, sorted(a), sorted(b)) for i, (a, b) in enumerate(sets)], "i int, a array<string>, b array<string>")
    assert [r[0] for r in df.select(matching.flexible_tokens(F.col("a"), F.col("b")), "i").orderBy("i").collect()] == [True, True, True, False, False, False]
    lists = spark.createDataFrame([([["ann", "lee"], ["ann", "lee"], ["bo", "kim"]], [["ann", "lee", "x"], ["kim"]]), ([], [["a"]]), (None, [["a"]])], "a array<array<string>>, b array<array<string>>")
    assert [r[0] for r in lists.select(matching.opponents_overlap(F.col("a"), F.col("b"))).collect()] == [2, 0, 0]


def test_nearest_as_of(spark):
    rng = random.Random(11)
    day = lambda: datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randrange(60))
    left = [(i, rng.choice("ab"), day()) for i in range(40)] + [(99, "zz", day())]
    right = [(i, rng.choice("ab"), day()) for i in range(25)]
    got = matching.nearest_as_of(spark.createDataFrame(left, "i int, k string, d date"), spark.createDataFrame(right, "id int, k string, at date"), "k", "d", "at", "id").collect()
    for r in got:
        mine = [(abs((r["d"] - at).days), i) for i, k, at in right if k == r["k"]]
        sides = [(abs((r["d"] - s["at"]).days), s["id"]) for s in (r["before"], r["after"]) if s]
        assert min(sides, default=None) == min(mine, default=None)
    assert len(got) == 41


def test_slug_scores(spark):
    from recordloom.functions.text import dedup_name_key

    rows = [("Ann Lee", "Ann Lee", None, 100), ("Ann Lee", None, "ann-lee", 100), ("Ann Lee", "Mary Ann Lee", None, 90), ("Ann Lee", "Ann Q Lee", None, 80), ("Ann Karimi", "x", "b-karimi", 60), ("", "x", None, 0), (None, "x", None, 0)]
    df = spark.createDataFrame(rows, "n string, h string, s string, want int")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", matching.slug_score(F.col("n"), F.col("h"), F.col("s"), dedup_name_key)).collect())


def test_sources_and_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("u1", "old", 1), ("u1", "new", 2), ("u2", None, 1)], "url string, body string, fetched_at int")
    items = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, None), (4, "u9")], "i int, ref string")
    assert {(r["i"], r["body"]) for r in files.dereference(docs, items, "ref").collect()} == {(1, "new"), (2, None), (3, None), (4, None)}
    blob = spark.createDataFrame([(1, "a /// b ///  /// c"), (2, None), (3, "")], "i int, t string")
    assert [(r["i"], r["pos"], r["block"]) for r in files.explode_blob(blob, "i", "t").orderBy("i", "pos").collect()] == [(1, 0, "a"), (1, 1, "b"), (1, 3, "c")]
    maps = spark.createDataFrame([("<loc>https://x.example/events/1-a</loc><loc>https://x.example/p</loc>",), (None,)], "body string")
    assert [r["url"] for r in files.sitemap_urls(maps, "/events/").collect()] == ["https://x.example/events/1-a"]
    files.write_url_list(spark.createDataFrame([("b", 2), ("a", 1)], "url string, o int"), "url", "o", str(tmp_path / "urls"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "urls")).collect()] == ["a", "b"]
    files.write_failures(spark.createDataFrame([("u", "CONFLICT")], "url string, reason string"), str(tmp_path / "bad"))
    assert spark.read.text(str(tmp_path / "bad")).first()["value"] == "u\tCONFLICT"
    assert files.add_missing_columns(items, {"i": "string", "x": "date"}).dtypes == [("i", "int"), ("ref", "string"), ("x", "date")]
    assert [r[0] for r in spark.range(1, 7).select(ingest.backoff_seconds(F.col("id"))).collect()] == [120, 240, 480, 960, 1800, 1800]


def test_page_rows(spark):
    text = "Head\n1. Ann Lee 3-2-1\n2. Bo Kim 0-0-0\nAnn Lee met Bo Kim at Big Hall in Old Town on 3 April, 2020, and the women's flyweight bout ended by arm bar at 1:23 of round 2."
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string")
    assert [(r["id"], r["place"], r["name"], r["wins"]) for r in extraction.rank_rows(df, "id", "t").orderBy("place").collect()] == [(1, 1, "Ann Lee", 3), (1, 2, "Bo Kim", 0)]
    r = extraction.report_rows(df, "id", "t").collect()
    assert [(x["a"], x["b"], x["venue"], x["city"], str(x["day"]), x["division"], x["method"], x["time"], x["round"]) for x in r] == [("Ann Lee", "Bo Kim", "Big Hall", "Old Town", "2020-04-03", "women's flyweight", "arm bar", "1:23", 2)]
    titles = spark.createDataFrame([("GFC 7: Ann Lee vs. Bo Kim 2",), ("No names",), (None,)], "t string")
    assert [tuple(x) for x in titles.select(*extraction.corner_names(F.col("t"))).collect()] == [("Ann Lee", "Bo Kim"), (None, None), (None, None)]


def test_windowed_counts_wait_for_late_rows(spark, tmp_path):
    at = lambda m: datetime.datetime(2024, 1, 1, 10, m)
    spark.createDataFrame([(at(5), "a"), (at(50), "a"), (at(7), "b"), (None, "b")], "ts timestamp, kind string").write.parquet(str(tmp_path / "in"))
    counted = ingest.windowed_counts(ingest.read_new_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema), "ts", "kind", "30 minutes")
    counted.writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert {(r["start"].minute, r["kind"], r["n"]) for r in spark.table("windows").collect()} == {(0, "a", 1), (30, "a", 1), (0, "b", 1)}


def test_token_pairs_meet_once(spark):
    """Rows that share two words or more, each pair once; a given name that all rows have brings no rows together."""
    rng = random.Random(7)
    words = ["anna", "boris", "silva", "souza", "lopez", "kovac"]
    rows = lambda: [(i, sorted(rng.sample(words, rng.randint(0, 5)), key=lambda _: rng.random())) for i in range(60)] + [(98, None), (99, [])]
    left, right = rows(), rows()
    frame = lambda x: spark.createDataFrame(x, "id long, tokens array<string>")
    found = matching.token_pair_candidates(frame(left), frame(right))
    want = sorted((i, j, n) for i, a in left for j, b in right if (n := len(set(a or ()) & set(b or ()))) >= 2)
    assert sorted(map(tuple, found.collect())) == want and dict(found.dtypes)["shared"] == "bigint"
    hot = lambda n: frame([(i, ["anna", f"{n}word{i}"]) for i in range(300)])
    assert matching.token_pair_candidates(hot("a"), hot("b")).count() == 0
    plan = matching_queries.j7_token_candidates(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_slug_keys_are_made_before_the_join(spark):
    """Names are normalised once for each row: no pair of rows folds accents or takes names apart."""
    plan = ladder_queries.m7_slug_scores(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Join")]
    assert "translate(" not in above and "split(" not in above and "regexp" not in above


def test_best_hits_equal_all_pairs(spark):
    """The best of all pairs of a block, ties by the smallest id; names and keys that repeat are compared once."""
    from recordloom.functions.text import dedup_name_key

    rng = random.Random(11)
    name = lambda: rng.choice(["Ann", "ann", "Án", "B.", "", "Mary Ann"]) + " " + rng.choice(["Lee", "lee", "Le", "Q Lee", "-"])
    names = spark.createDataFrame([(n,) for n in {name() for _ in range(80)}], "name string").select("name", matching.slug_name(F.col("name"), dedup_name_key).alias("facts"), F.lit("w").alias("w"))
    kept = ["Mary Ann Q Lee", "Lee Ann", "B. Le", "mary ann lee", "Ann Lee", "ANN LEE", "Bo Lee"]
    hits = spark.createDataFrame([(i, rng.choice(kept)) for i in range(60)], "hit_id long, text string")
    none = F.lit(None).cast("string")
    pairs = names.crossJoin(hits).select("name", "hit_id", matching.slug_score(F.col("name"), F.col("text"), none, dedup_name_key).alias("score"))
    want = {}
    for r in pairs.filter("score >= 60").collect():
        want[r["name"]] = max(want.get(r["name"], (0, 0)), (r["score"], -r["hit_id"]))
    got = matching.best_hits(names, hits.select("hit_id", matching.slug_hit(F.col("text"), none, dedup_name_key).alias("hit"), F.lit("w").alias("w")), "w")
    assert {r["name"]: (r["score"], -r["hit_id"]) for r in got.collect()} == want and len({s for s, _ in want.values()}) >= 3
