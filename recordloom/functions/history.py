"""Fight histories: tolerant decoding and folds over the ordered list (most recent first)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from recordloom.functions.domain import method_category
from recordloom.functions.text import opponent_key

FIGHT = "struct<result:string,opponent:string,opponent_id:bigint,opponent_record:string,event:string,event_date:string,date:string,method:string,method_detail:string,round:int,raw:string>"


def fights(history: Column) -> Column:
    """Array of fights of a JSON text: an object's `fights` or a bare list; corrupt or missing text has none."""
    first = F.substring(F.ltrim(history), 1, 1)
    whole = F.try_parse_json(history).isNotNull()
    listed = F.from_json(history, f"array<{FIGHT}>")
    nested = F.from_json(history, f"struct<source:string,count:int,fights:array<{FIGHT}>>")["fights"]
    empty = F.from_json(F.lit("[]"), f"array<{FIGHT}>")
    return F.coalesce(F.when(whole & (first == "["), listed).when(whole & (first == "{"), nested), empty)


def history_source(history: Column) -> Column:
    """Lower case source of a history object, null for lists and corrupt text."""
    return F.lower(F.trim(F.get_json_object(F.when(F.try_parse_json(history).isNotNull(), history), "$.source")))


def count_results(fights_: Column, result: str) -> Column:
    return F.size(F.filter(fights_, lambda f: F.upper(f["result"]) == result))


def count_methods(fights_: Column, result: str, category: str) -> Column:
    """Fights with a result by a method category."""
    return F.size(F.filter(fights_, lambda f: (F.upper(f["result"]) == result) & (method_category(f["method"]) == category)))


def current_streak(results: Column) -> Column:
    """Streak such as `3W` of results, newest first; anything but W and L starts none."""
    first = F.try_element_at(results, F.lit(1))
    run = F.aggregate(
        results,
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda s, r: F.struct((s["n"] + (s["on"] & (r == first)).cast("int")).alias("n"), (s["on"] & (r == first)).alias("on")),
    )["n"]
    return F.when(first.isin("W", "L"), F.concat(run.cast("string"), first))


def last_results(results: Column, n: int = 5) -> Column:
    """The newest `n` results, oldest of them first, comma separated."""
    return F.array_join(F.reverse(F.slice(results, 1, n)), ",")


def method_of(fight: Column) -> Column:
    """Method of a fight; where it has none, what the older form keeps in its date."""
    return F.coalesce(F.nullif(F.trim(fight["method"]), F.lit("")), F.trim(fight["date"]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, however often `body` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without_duplicates(fights_: Column) -> Column:
    """Fights without repetitions. Of the same opponent (without rank) and event date the first with a method stays, else the
    first, where the first stood; undated fights go where the opponent has a dated one."""
    day = lambda f: F.substring(F.coalesce(f["event_date"], F.lit("")), 1, 10)
    full = lambda f: F.coalesce(f["method"], F.lit("")) != ""
    keyed = F.transform(fights_, lambda f, i: F.struct(F.coalesce(opponent_key(f["opponent"]), F.lit("")).alias("o"), day(f).alias("d"), i.alias("i"), f.alias("f")))

    def choose(keyed: Column) -> Column:
        same = lambda x: F.filter(keyed, lambda y: (y["o"] == x["o"]) & (y["d"] == x["d"]))
        best = lambda x: let(same(x), lambda s: F.struct(x["o"].alias("o"), x["d"].alias("d"), (s[0]["i"] == x["i"]).alias("first"), F.coalesce(F.try_element_at(F.filter(s, lambda y: full(y["f"])), F.lit(1)), x)["f"].alias("f")))
        return F.filter(F.transform(keyed, best), lambda x: x["first"])

    kept = let(let(keyed, choose), lambda chosen: F.filter(chosen, lambda x: (x["d"] != "") | ~F.exists(chosen, lambda y: (x["o"] == y["o"]) & (y["d"] != ""))))
    return F.transform(kept, lambda x: x["f"])


def insert_position(fights_: Column, day: Column) -> Column:
    """How many entries stand before a new fight of a day (ISO text) in a list newest first: all up to the last later one."""
    later = F.transform(fights_, lambda f, i: F.when(F.substring(f["event_date"], 1, 10) > day, i + 1).otherwise(0))
    return F.coalesce(F.array_max(later), F.lit(0))


def next_streak(streak: Column, result: Column) -> Column:
    """Streak such as `4W` after one more result: one longer if it is the same, else 1."""
    pattern = r"^\s*(\d+)([WLD])"
    n, kind = F.regexp_extract(F.upper(streak), pattern, 1), F.regexp_extract(F.upper(streak), pattern, 2)
    return F.concat(F.when(kind == result, n.try_cast("int") + 1).otherwise(1).cast("string"), result)
