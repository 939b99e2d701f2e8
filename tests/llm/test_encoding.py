import random

import pytest

from millrace.llm.encoding import Judge, corpus_dictionaries, garbled_fields, restore, train_dictionaries
from millrace.session import table

CLEAN = [f"{a} {b} with {c}" for a in ("crème fraîche", "jalapeño pie", "purée", "gruyère", "señorita pepper", "bébé carrot", "pâté", "käse powder", "Сырники с мёдом", "小米南瓜粥", "za’atar – mild") for b in ("salt", "½ cup", "180 °C", "soup", "2–3 kg") for c in ("butter", "lime", "açaí")]


@pytest.fixture(scope="module")
def judge():
    return Judge(*train_dictionaries({"en": CLEAN}))


def garble(text, *chain):
    for read, written in chain:
        text = text.encode(written).decode(read)
    return text


CHAINS = [[("cp1252", "utf-8")], [("mac_roman", "utf-8")], [("cp437", "utf-8")], [("cp1250", "utf-8")], [("cp1252", "utf-8"), ("cp1252", "utf-8")]]


@pytest.mark.parametrize("chain", CHAINS)
@pytest.mark.parametrize("text", ["crème fraîche with salt", "jalapeño pie", "½ cup bébé carrot", "gruyère – mild", "180 °C"])
def test_restores(judge, text, chain):
    try:
        bad = garble(text, *chain)
    except UnicodeError:
        pytest.skip("bytes that this encoding lacks")
    assert bad != text
    got, how, garbled = restore(bad, judge, "en")
    assert garbled and how and got == text


@pytest.mark.parametrize("text", [*CLEAN[::7], "MAÇÃ ASSADA COM CANELA", "BÂNH XÂO LÂM", "CHÁ DE HORTELÃ GELADO", "Рагу из баклажанов", "KÂĞIT KEBABI", "plain", "", None])
def test_leaves_right_text(judge, text):
    assert restore(text, judge, "en") == (text, None, False)


def test_partly_garbled_and_lost(judge):
    assert restore("crème fraîche, jalapeÃ±o pie", judge, "en")[0] == "crème fraîche, jalapeño pie"
    got, how, garbled = restore("cr�me", judge, "en")
    assert (got, how, garbled) == ("cr�me", None, True)
    assert restore("2\x963 kg", judge, "en")[2]


def test_table(spark, rows):
    r = random.Random(1)
    data = [(i, r.choice(CLEAN), "en") for i in range(300)] + [(900, "crÃ¨me fraÃ®che with salt", "en"), (901, None, None), (902, "", "en"), (900, "crÃ¨me fraÃ®che with salt", "en")]
    df = spark.createDataFrame([(*d, "clash", "clash") for d in data], "id int, name string, lang string, original string, r string")
    got = rows(garbled_fields(df, "id", ["name"], "lang").select("id", "field_name", "restored"))
    assert got == [(900, "name", "crème fraîche with salt")] * 2
    assert garbled_fields(df.limit(0), "id", ["name"], "lang").count() == 0


def test_very_long(judge):
    text = "crÃ¨me fraÃ®che; " * 20_000
    assert restore(text, judge, "en")[0] == "crème fraîche; " * 20_000


@pytest.mark.parametrize(
    ("bad", "good"),
    [
        ("Jalape&Atilde;&plusmn;o pie", "Jalapeño pie"),
        ("Jalape&amp;Atilde;&amp;plusmn;o pie", "Jalapeño pie"),
        ("180 &Acirc;&deg;C", "180 °C"),
        ("180 &#194;&#xB0;C", "180 °C"),
        (r'["jalape\u00c3\u00b1o pie", "2\" salt"]', r'["jalapeño pie", "2\" salt"]'),
        (r"za\u00e2\u0080\u0099atar with salt", "za’atar with salt"),
        (r"cr\xc3\xa8me with salt", "crème with salt"),
        (r"crème, jalape\\u00c3\\u00b1o pie", "crème, jalapeño pie"),
    ],
)
def test_garbled_then_escaped(judge, bad, good):
    got, how, garbled = restore(bad, judge, "en")
    assert (got, garbled) == (good, True) and how.startswith("unescape ")


@pytest.mark.parametrize("text", ["cr&egrave;me with salt", r'["jalape\u00f1o pie", "a\u0026b"]', r"\ud83d\ude00 \ud83d &#0; &#x110000; &bogus; \x41", "salt &amp; pepper", "salt & lime; R&D"])
def test_escaped_right_text_stays(judge, text):
    assert restore(text, judge, "en") == (text, None, False)


def test_escaped_table(spark, rows):
    df = spark.createDataFrame([(1, "Jalape&Atilde;&plusmn;o pie", "en"), (2, r"lost \u0080 sign", "en"), (3, "salt &amp; lime", "en")] + [(i, CLEAN[i % len(CLEAN)], "en") for i in range(9, 300)], "id int, name string, lang string")
    assert rows(garbled_fields(df, "id", ["name"], "lang").select("id", "restored")) == [(1, "Jalapeño pie"), (2, r"lost \u0080 sign")]


def test_characters_are_counted_over_whole_texts_and_all_languages(spark):
    """A letter far into a long text, and one of a language beyond those with a dictionary of their own, have their price."""
    long = "plain words " * 1000
    rows = [(i, long + "ǖ", "en") for i in range(3)] + [(100 + i, f"text {i} ꙭ", f"l{i % 40:02d}") for i in range(200)] + [(999, None, None), (1000, "", "en")]
    _, alphabet = corpus_dictionaries(spark.createDataFrame(rows, "id int, t string, lang string"), ["t"], "lang")
    assert "ǖ" in alphabet and "ꙭ" in alphabet and "a" not in alphabet
    dictionaries, empty = corpus_dictionaries(spark.createDataFrame([], "id int, t string, lang string"), ["t"], "lang")
    assert dictionaries == {} and empty == {}


def test_dictionaries_come_of_all_texts(spark, monkeypatch):
    """Every word of more than one place counts, however many texts there are, and garbled texts do not."""
    from millrace.llm import encoding

    monkeypatch.setattr(encoding, "SAMPLE", 5)
    rows = [(i, f"pâte word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} salt", "fr") for i in range(300)] * 2 + [(9, "cr\u00c3\u00a8me garbled", "fr")] * 2 + [(7, "crème", "fr")] * 2 + [(5, "\u6c34" * 40, "ja")]
    dictionaries, _ = corpus_dictionaries(spark.createDataFrame(rows, "id int, t string, lang string"), ["t"], "lang")
    words = dictionaries["fr"].decode().split()
    assert {w for _, t, _ in rows[:300] for w in t.split()} | {"crème"} == set(words) and set(words[-2:]) == {"salt", "pâte"} and dictionaries["ja"].decode() == "\u6c34\u6c34\u6c34 "
