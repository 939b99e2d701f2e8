import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators.packed import LABELS, LISTS, explode_packed, tokenize


@pytest.mark.parametrize(
    ("text", "values"),
    [
        (None, []),
        ("", []),
        ("  ", []),
        ("[]", []),
        ("NULL", []),
        ("salt", ["salt"]),
        ('["salt", "a, b"]', ["salt", "a, b"]),
        ("['a', \"za'atar\"]", ["a", "za'atar"]),
        ('["se\\u00f1or", "2\\" piece"]', ["señor", '2" piece']),
        ('["\\ud83d\\ude00"]', ["😀"]),
        ('"2"" piece kale", salt', ['2" piece kale', "salt"]),
        ("salt, diced; kale", ["salt, diced", "kale"]),
        ("a;;b ; ;c;", ["a", "b", "c"]),
        ("• a\n• b", ["a", "b"]),
        ("• a, sliced • b", ["a, sliced", "b"]),
        ("a\r\nb\tc || d", ["a", "b", "c", "d"]),
        ('a; "b; c"; d', ["a", "b; c", "d"]),
        ('2" piece; b', ['2" piece', "b"]),
        ("a (b; c); d", ["a (b; c)", "d"]),
        ("a (b; c", ["a (b", "c"]),
        ("1 1/2 tsp salt; x - y", ["1 1/2 tsp salt", "x - y"]),
        ("[optional] salt; b [x]", ["[optional] salt", "b [x]"]),
        ('"unclosed; b', ['"unclosed', "b"]),
    ],
)
def test_lists(text, values):
    assert tokenize(text, LISTS) == values


@pytest.mark.parametrize(("text", "values"), [("a & b", ["a", "b"]), ("a, b and c", ["a", "b", "c"]), ("x/y+z", ["x", "y", "z"]), ("brand", ["brand"]), ("None_Detected ", ["None_Detected"]), ('"a" and "b"', ["a", "b"])])
def test_labels(text, values):
    assert tokenize(text, LABELS) == values


plain = st.text(st.characters(blacklist_categories=("Cs", "Cc")), min_size=1).filter(lambda x: x.strip(" \t\r\n"))


@settings(max_examples=150, deadline=None)
@given(st.lists(plain, min_size=1, max_size=6))
def test_json_round_trip(values):
    for ascii_only in (True, False):
        assert tokenize(json.dumps(values, ensure_ascii=ascii_only)) == [v.strip(" \t\r\n") for v in values]


@settings(max_examples=150, deadline=None)
@given(st.lists(plain, min_size=2, max_size=6))
def test_quoted_round_trip(values):
    text = ";".join('"' + v.replace("\\", "\\\\").replace('"', '""') + '"' for v in values)
    assert tokenize(text) == [v.strip(" \t\r\n") for v in values]


def test_explode(spark, rows):
    df = spark.createDataFrame([(1, "a;b", "x", 9), (1, "a;b", "x", 9), (2, None, "p,q", 1), (None, "c", None, 2)], "id int, f string, g string, item int")
    out = explode_packed(df, ["id"], {"f": LISTS, "g": LABELS}, at_least=2)
    assert rows(out) == [(1, "f", 0, "a"), (1, "f", 0, "a"), (1, "f", 1, "b"), (1, "f", 1, "b"), (2, "g", 0, "p"), (2, "g", 1, "q")]
    assert rows(explode_packed(df, ["id"], {"f": LISTS}))[0] == (None, "f", 0, "c")
    assert explode_packed(df.limit(0), ["id"], {"f": LISTS}).count() == 0
    with pytest.raises(ValueError):
        explode_packed(df, ["item"], {"f": LISTS})


def test_very_long(spark):
    text = ";".join(f"value {i}" for i in range(100_000))
    assert len(tokenize(text)) == 100_000
    assert len(tokenize("(" * 50_000 + ";a")) == 2


@pytest.mark.parametrize(
    ("text", "values"),
    [
        ("stock (cubes (beef; veal); low salt); leek", ["stock (cubes (beef; veal); low salt)", "leek"]),
        ("a [b [c; d]; e]; f", ["a [b [c; d]; e]", "f"]),
        ("a (b [c; d]; e); f", ["a (b [c; d]; e)", "f"]),
        ("a (b;\nc); d", ["a (b;\nc)", "d"]),
        ("a (b; (c; d); e", ["a (b", "(c; d)", "e"]),
        ("a) b; c (d; e)", ["a) b", "c (d; e)"]),
        ("[x (y, (z, w)), v]", ["x (y, (z, w))", "v"]),
    ],
)
def test_nested_and_multi_line_brackets(text, values):
    assert tokenize(text, LISTS) == values


def test_nested_labels():
    assert tokenize("x (a and (b, c)) and y", LABELS) == ["x (a and (b, c))", "y"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("salt (fine (sea, flaky), or kosher), pepper", ["salt (fine (sea, flaky), or kosher)", "pepper"]),
        ("a {b, c}, d", ["a {b, c}", "d"]),
        ('kale (see "A) note", v2), oil', ['kale (see "A) note", v2)', "oil"]),
        ('stock (2" cubes, cut), leek', ['stock (2" cubes, cut)', "leek"]),
        ("a {b, c, d", ["a {b", "c", "d"]),
        ("x (a {b) c}, d", ["x (a {b) c}", "d"]),
    ],
)
def test_depth_is_counted(text, want):
    assert tokenize(text) == want
