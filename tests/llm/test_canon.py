import pytest

from millrace.llm.canon import content_tokens, edit_distance, map_typed, map_values, tokens, variants

ENTRIES = ["salt", "soy sauce", "fish sauce", "chicken thigh", "jalapeño", "za’atar", "crème fraîche", "kaffir lime leaf", "bay leaf", "peanut", "butter", "peanut butter", "thyme sprig", "dried fig", "sun-dried tomato", "mint leaf"]

CASES = [
    ("Salt", "salt"), ("salts", "salt"), ("½ tsp salt", "salt"), ("1 1/2 small soy sauce, to taste", "soy sauce"), ("soysauce", "soy sauce"), ("so sauce", "soy sauce"), ("thigh, chicken", "chicken thigh"), ("chikcen thihg", "chicken thigh"),
    ("jalapeno (good quality)", "jalapeño"), ("jalape�o", "jalapeño"), ("2–3 JALAPEÑO - sliced", "jalapeño"), ("za'atar", "za’atar"), ("creme fraiche", "crème fraîche"), ("kaffirlimeleaf", "kaffir lime leaf"), ("bya leaf", "bay leaf"),
    ("butter, peanut", "peanut butter"), ("butter, melted", "butter"), ("500 sprig thyme sprig", "thyme sprig"), ("2-inch piece dried fig", "dried fig"), ("sun_dried​ tomato", "sun-dried tomato"), ("min leaf", "mint leaf"), ("warmed salt to 40 °C", "salt"),
    ("crème de brindle", None), ("water", None), ("for the topping:", None), ("see note 3", None), ("love and patience", None), ("leaf", None), ("", None), ("...", None), ("12", None), ("x" * 5000, None),
]


def test_mapping(spark):
    ref = spark.createDataFrame([(e, "x") for e in ENTRIES] + [(None, "y"), ("", "z")], "name string, value string")
    values = spark.createDataFrame([(v, v, 7) for v, _ in CASES] + [(None, None, 1)], "value string, text string, n int")
    got = {r["value"]: r["entry"] for r in map_values(values, ref, "name").collect()}
    assert got == {v: e for v, e in CASES if e}
    assert map_values(values, ref.limit(0), "name").count() == 0
    assert map_values(values.limit(0), ref, "name").count() == 0


def test_typed(spark, rows):
    ref = spark.createDataFrame([(e,) for e in ENTRIES], "entry string")
    df = spark.createDataFrame([(1, "salt;soy suace", "en", "x"), (1, "salt;soy suace", "en", "x"), (2, None, None, "x"), (3, '["crÃ¨me fraÃ®che", "moonwater"]', "en", "x")], "id int, list string, lang string, n string")
    got = rows(map_typed(df, "id", "list", "lang", ref, "entry").select("id", "item_pos", "entry"))
    assert [g for g in got if g[0] == 1] == [(1, 0, "salt")] * 2 + [(1, 1, "soy sauce")] * 2
    assert {g for g in got if g[0] == 3} >= {(3, 1, None)} and len(got) == 6
    assert map_typed(df.limit(0), "id", "list", "lang", ref, "entry").count() == 0


@pytest.mark.parametrize(("a", "b", "d"), [("salt", "salt", 0), ("slat", "salt", 1), ("sat", "salt", 1), ("saalt", "salt", 1), ("sxlt", "salt", 1), ("s�lt", "salt", 0), ("pepper", "salt", 3)])
def test_edits(a, b, d):
    assert edit_distance(a, b, 2) == d


def test_variants_meet():
    for a, b in [("slat", "salt"), ("saallt", "salt"), ("sl", "salt"), ("s�lt", "salt")]:
        assert set(variants(a, 2)) & set(variants(b, 2))


def test_tokens():
    assert tokens("Za’atar & Crème") == ["zaatar", "creme"]
    assert content_tokens("about 2 tbsp Salt (see tip) - sliced") == ["salt"]


def test_noise_words_of_a_long_reference(spark, rows, monkeypatch):
    reference = spark.createDataFrame([("hot sauce",), ("fat free milk",), ("salt",)], "name string")
    values = spark.createDataFrame([(v, v) for v in ("hot saucee", "fat free milkk", "extra salt")], "value string, text string")
    small = rows(map_values(values, reference, "name"))
    monkeypatch.setattr("millrace.llm.canon.MAX_LISTED", 1)
    assert rows(map_values(values, reference, "name")) == small and [r[:2] for r in small] == [("extra salt", "salt"), ("fat free milkk", "fat free milk"), ("hot saucee", "hot sauce")]


@pytest.mark.parametrize("n", [46, 47, 48, 49, 50, 51, 60, 130])
def test_long_words_are_repaired_at_every_length(spark, n):
    """The same across the length at which segments take the place of variants, for any two edits and lost characters."""
    import random

    from millrace.llm.canon import token_keys, word_keys

    r = random.Random(n)
    word = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    keys = set(word_keys(word))
    for _ in range(60):
        typed = list(word)
        for _ in range(2):
            i = r.randrange(len(typed))
            typed[i : i + 1] = r.choice([[], [r.choice("xyz")], [typed[i], r.choice("xyz")]])
        assert keys & set(token_keys("".join(typed)))
    i = n // 2
    assert keys & set(token_keys(word[:i] + "�" + word[i + 2 :])) and keys & set(token_keys(word[:3] + "�" + word[4:]))
    df = spark.createDataFrame([(word, word), (word[:9] + word[10:30] + "x" + word[30:], word[:9] + word[10:30] + "x" + word[30:])], "value string, text string")
    got = map_values(df, spark.createDataFrame([(word,), ("salt",)], "entry string"), "entry").collect()
    assert sorted(x["value"] for x in got) == sorted({x[0] for x in df.collect()}) and {x["entry"] for x in got} == {word}


def test_same_by_broadcast_and_by_shuffle(spark, monkeypatch):
    from millrace.llm import canon

    values = spark.createDataFrame([(x, x) for x in ("fresh cream", "craem", "2 cups of salt, diced", "sour  cream", "unknown stuff")], "value string, text string")
    reference = spark.createDataFrame([(x,) for x in ("fresh cream", "cream", "salt", "sour cream")], "entry string")
    want = sorted(map(tuple, map_values(values, reference, "entry").collect()))
    monkeypatch.setattr(canon, "MAX_LISTED", 2)
    assert sorted(map(tuple, map_values(values, reference, "entry").collect())) == want and len(want) == 4
