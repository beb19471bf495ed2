"""Golden cases of scalar functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from recordloom.functions import dates, domain, history, measures, text


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "key"),
    [('Tatsuro Taira ("The Best")', "tatsuro taira"), ("Sean O'Malley", "sean omalley"), ("T. J. Dillashaw", "tj dillashaw"), ("Georges St-Pierre", "georges st pierre"), ("Saint Preux", "st preux"), ("José Łukasz", "jose lukasz"), (None, None), ("", "")],
)
def test_name_key(spark, raw, key):
    assert one(spark, raw, text.name_key) == key


@pytest.mark.parametrize(("raw", "bare", "nick"), [('Manel "Starboy" Kape', "Manel Kape", "Starboy"), ("Tatsuro Taira (The Best)", "Tatsuro Taira", "The Best"), ("Plain Name", "Plain Name", None)])
def test_nicknames(spark, raw, bare, nick):
    assert one(spark, raw, text.name_without_nickname) == bare
    assert one(spark, raw, text.nickname_of) == nick


def test_sorted_tokens(spark):
    assert one(spark, "Michael Chandler", text.sorted_tokens_key) == one(spark, "Chandler, Michael", text.sorted_tokens_key)


def test_fold_agrees_with_python(spark):
    for raw in ("Ünïcödé Čřž", "Ørsted Łódź", "été", "so­ft", "plain"):
        assert one(spark, raw, text.fold_accents) == text.fold(raw)


@pytest.mark.parametrize(
    ("raw", "day"),
    [("29 septembre 1988", datetime.date(1988, 9, 29)), ("Samedi 6 juin 2026", datetime.date(2026, 6, 6)), ("1er août 2020", datetime.date(2020, 8, 1)), ("31 février 2020", None), ("nothing", None), (None, None)],
)
def test_french_dates(spark, raw, day):
    assert one(spark, raw, dates.french_date) == day


@pytest.mark.parametrize(
    ("raw", "day"),
    [("born June 8, 1981", datetime.date(1981, 6, 8)), ("Nov 28, 1994", datetime.date(1994, 11, 28)), ("12 September 1977", datetime.date(1977, 9, 12)), ("03/06/1990", datetime.date(1990, 6, 3)), ("1984.09.01", datetime.date(1984, 9, 1)), ("19830101", datetime.date(1983, 1, 1)), ("1983-13-01", None), ("", None)],
)
def test_any_date(spark, raw, day):
    assert one(spark, raw, dates.any_date) == day


def test_age_compares_month_and_day(spark):
    row = spark.sql("select date'2000-02-29' b, date'2023-02-28' d").select(dates.age(F.col("b"), F.col("d")).alias("a")).first()
    assert row["a"] == 22


def test_percent_rounds_half_even(spark):
    assert spark.range(1).select(measures.percent(F.lit(1), F.lit(8)).alias("p")).first()["p"] == 12
    assert spark.range(1).select(measures.percent(F.lit(1), F.lit(0)).alias("p")).first()["p"] is None


def test_heights(spark):
    assert one(spark, "5'11\"", measures.feet_to_inches) == 71
    assert one(spark, 182.88, measures.cm_to_feet, "double") == "6'0\""


def test_records(spark):
    assert one(spark, "19-8", lambda c: measures.record_part(c, 3)) == 0
    assert one(spark, "19-8-2", lambda c: measures.record_part(c, 3)) == 2
    assert one(spark, "x", lambda c: measures.record_part(c, 1)) is None


@pytest.mark.parametrize(("raw", "league"), [("UFC 326 Holloway vs. Oliveira 2", "UFC"), ("Bellator 300 - Main", "Bellator"), ("Rousey vs. Carano", None), ("HCL Fight Night: A vs. B", "HCL Fight Night"), ("PFL Europe 3", "PFL"), ("Ares FC 12 Saturday, March 7th 2026", "Ares FC"), (None, None), ("", None)])
def test_league(spark, raw, league):
    assert one(spark, raw, domain.league_of_event) == league


def test_method_categories(spark):
    assert one(spark, "TKO (Punches) Round 1", domain.method_category) == "ko"
    assert one(spark, "TKO (Punches) Round 1", domain.method_category_exact) == "other"


@pytest.mark.parametrize(("raw", "n"), [(None, 0), ("", 0), ("null", 0), ("{bad", 0), ("[]", 0), ('[{"result":"W"}]', 1), ('{"fights":[{"result":"W"},{"result":"L"}]}', 2), ('{"fights":{}}', 0), ("[object Object]", 0)])
def test_history_shapes(spark, raw, n):
    assert one(spark, raw, lambda c: F.size(history.fights(c))) == n


def test_streak_and_last(spark):
    df = spark.createDataFrame([(["W", "W", "L", "W"],), (["D", "W"],), ([],), (None,)], "r array<string>")
    assert [r["s"] for r in df.select(history.current_streak(F.col("r")).alias("s")).collect()] == ["2W", None, None, None]
    assert df.select(history.last_results(F.col("r"), 3).alias("l")).first()["l"] == "L,W,W"


def test_history_duplicates(spark):
    raw = '[{"opponent":"Pavlovich #4 HW","method":"KO"},{"opponent":"Pavlovich","event_date":"2020-01-01"},{"opponent":"Pavlovich","event_date":"2020-01-01","method":"KO"},{"opponent":"Other"}]'
    found = one(spark, raw, lambda c: history.without_duplicates(history.fights(c)))
    assert [(f["opponent"], f["event_date"], f["method"]) for f in found] == [("Pavlovich", "2020-01-01", "KO"), ("Other", None, None)]


@pytest.mark.parametrize(
    ("raw", "want", "f"),
    [
        ("GFC 7 GFC 7: Ann vs. Bo", "GFC 7: Ann vs. Bo", text.without_repeated_slug), ("A B", "A B", text.without_repeated_slug), (None, None, text.without_repeated_slug),
        ("ONE 5 Muay Thai Event x", "ONE 5", text.without_subtitle), ("ONE 5 | MMA", "ONE 5", text.without_subtitle),
        ("SUBMISSION", "SUB", domain.method_name), ("Odd", "Odd", domain.method_name), ("", None, domain.method_name), ("no contest", "NC", domain.method_name_of_text),
        ("W Strawweight", "Women's Strawweight", domain.class_name), ("170 lbs", "Welterweight", domain.class_name), ("Poids mi-moyens", "Welterweight", domain.class_name), ("LightW", "Lightweight", domain.class_name), (None, None, domain.class_name),
        ("women bantamweight", "Women's Bantamweight", domain.class_casing), ("Town, Ohio", "United States", domain.birth_country), ("x, n/a", None, domain.birth_country), ("x, C0untry", None, domain.birth_country),
        ("Bresil", "Brazil", domain.english_country), ("fr", "\U0001f1eb\U0001f1f7", domain.flag_emoji), ("fra", None, domain.flag_emoji), ("Il vient du karaté", "Karate", domain.first_sport),
        ("Gauchère", "Southpaw", domain.stance_name), ("x" * 40, None, domain.stance_name), ("DATA:image/png", None, domain.real_url), ("... Dec 12 QMMA", "QMMA", domain.sport_code),
    ],
)
def test_classifiers(spark, raw, want, f):
    assert one(spark, raw, f) == want


@pytest.mark.parametrize(("raw", "day"), [("• 2016 Apr 10 •", "2016-04-10"), ("2016-04-10 x", "2016-04-10"), ("10 April", None), (None, None)])
def test_listed_dates(spark, raw, day):
    assert str(one(spark, raw, dates.listed_date)) == str(day)


@pytest.mark.parametrize(("raw", "day"), [("on April 3, 2020 or 2019-01-01", "2020-04-03"), ("le 3 April, 2020", "2020-04-03"), ("04.03.2020", "2020-04-03"), ("none", None), ("February 31, 2020", None)])
def test_dates_in_text(spark, raw, day):
    assert str(one(spark, raw, dates.date_in_text)) == str(day)


@pytest.mark.parametrize(("raw", "day"), [("1990-05-06T07:08Z", "1990-05-06"), ("1990-05-06T23:08:01-05:00", "1990-05-07"), ("x", None), (None, None)])
def test_iso_days(spark, raw, day):
    assert str(one(spark, raw, dates.iso_date)) == str(day)


def test_insertion_and_streaks(spark):
    h = '[{"event_date":"2021-01-01"},{"opponent":"undated"},{"event_date":"2020-01-01"},{"event_date":"2019-01-01"}]'
    at = lambda day: one(spark, h, lambda c: history.insert_position(history.fights(c), F.lit(day)))
    assert [at(d) for d in ("2022-01-01", "2020-06-01", "2019-06-01", "2018-01-01")] == [0, 1, 3, 4]
    assert one(spark, "[]", lambda c: history.insert_position(history.fights(c), F.lit("2020-01-01"))) == 0
    assert [one(spark, s, lambda c: history.next_streak(c, F.lit("W"))) for s in ("3W", "2L", "", "x")] == ["4W", "1W", "1W", "1W"]


def test_external_ids(spark):
    packed = "https://t.example/fightcenter/fighters/9-a | https://f.example/fighter-profile/A/7 | https://u.example/combattant/a,5 | https://underground.example/f/a-b;view=full | https://f.example/fighter-profile/A/8"
    assert [one(spark, packed, lambda c, k=k: domain.external_ids(c)[k]) for k in ("ufc_id", "fightmatrix_id", "mma_com_id")] == ["5", "8", "a-b"]
    assert one(spark, "https://t.example/fightcenter/fighters/9-a | https://ufc.example/athlete/x", lambda c: domain.external_ids(c)["ufc_id"]) == "9"
    assert one(spark, None, lambda c: domain.external_ids(c)["ufc_id"]) is None
