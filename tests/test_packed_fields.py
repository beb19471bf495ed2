"""Values packed in one field."""

import pytest

from recordloom.operators.packed_fields import FieldParser, fit_codes, split_packed

U = "https://a.example/f/x;view=full"
V = "https://b.example/c/y,12.html"
CASES = [
    (None, []), ("", []), ("   ", []), (" | ", []), ("Belt: brown", ["Belt: brown"]), ("Belt: brown |", ["Belt: brown"]), (f"{U} | {V}", [U, V]), (f"{U}||{V}", [U, V]), (f'["{U}", "{V}"]', [U, V]),
    (f'{{"{U}","{V}"}}', [U, V]), (f"{U}\n{V} | {U}", [U, V, U]), (f'"{U}" "{V}"', [U, V]), (f"{U} {V}", [U, V]), (f', {V.replace(",", chr(92) + ",")}, {U}', [V, U]), ("Style: judo, fast starter", ["Style: judo, fast starter"]),
    ("Style: judo, fast starter; Belt: brown", ["Style: judo, fast starter", "Belt: brown"]), ('Belt: brown, "Style: judo, fast"', ["Belt: brown", "Style: judo, fast"]), ('"Camp: A | B" | Belt: brown', ["Camp: A | B", "Belt: brown"]),
    ('"Nickname: ""Salt"""', ['Nickname: "Salt"']), ("Belt: brown<br/>Belt: black", ["Belt: brown", "Belt: black"]), ("Belt: brown｜Belt: black • Team: X", ["Belt: brown", "Belt: black", "Team: X"]), ("Camp: A \\| B | Belt: x", ["Camp: A | B", "Belt: x"]),
]


@pytest.mark.parametrize(("raw", "items"), CASES)
def test_dialects(raw, items):
    assert (FieldParser().parse(raw) if raw is not None else []) == items


def test_long_text_and_memo():
    p = FieldParser()
    raw = " | ".join([U] * 3000)
    assert p.parse(raw) == [U] * 3000 and p.parse(raw) == [U] * 3000


def test_split_frame(spark):
    rows = [(i, raw, None, "x") for i, (raw, _) in enumerate(CASES)] + [(0, f"{U} | {V}", "Belt: a", "x")]
    df = spark.createDataFrame(rows, "id bigint, field string, notes string, item string")
    got = split_packed(df, "id", ["field", "notes"])
    assert got.columns == ["id", "field", "pos", "item"]
    found = {(r["id"], r["field"], r["pos"]): r["item"] for r in got.collect() if r["id"] > 0}
    want = {(i, "field", k): x for i, (_, items) in enumerate(CASES) for k, x in enumerate(items, 1) if i > 0}
    assert found == want
    assert split_packed(df.limit(0), "id", ["field"]).count() == 0
    assert fit_codes(df.limit(0), ["field"]) == {"field": {}}
