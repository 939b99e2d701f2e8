import random

import pytest
import tiktoken  # noqa: F401

from millrace.llm.tokens import TOKENIZERS, decode_corpus, encode_corpus, encoding, words

TEXTS = ["", None, "hello  world\n\n  it's 3,000 €!", "नारियल चटनी", "<|endoftext|> stays text", " ", "\t\n", "a" * 3000, "emoji 👍🏽 ​", "no break", "the the the the", "it’s don't I'll"]


def test_words_join_again():
    for t in TEXTS:
        assert "".join(words(t or "")) == (t or "")


def test_against_whole_texts(spark):
    r = random.Random(6)
    texts = TEXTS + [" ".join(r.choice(["salt", "Pepper", "ça", "1½", "—", "\n", "x9", "नमक"]) for _ in range(r.randrange(60))) for _ in range(80)]
    data = [(i, t, "clash", [1]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, word string, ids array<int>").repartition(3)
    got = {x["doc_id"]: x["ids"] for x in encode_corpus(df).collect()}
    enc = encoding()
    assert got == {i: enc.encode_ordinary(t) if t else [] for i, t, *_ in data}
    back = {x["doc_id"]: x["text"] for x in decode_corpus(encode_corpus(df)).collect()}
    assert back == {i: t or "" for i, t, *_ in data}


def test_against_the_tokenizer_file(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    df = spark.createDataFrame([(i, x) for i, x in enumerate(TEXTS)], "doc_id bigint, text string")
    assert all(x["ids"] == t.encode(TEXTS[x["doc_id"]] or "", add_special_tokens=False).ids for x in encode_corpus(df).collect())


def test_repeats_nulls_and_empty(spark, rows):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "d"), (2, None), (2, None)], "doc_id bigint, text string")
    enc = encoding()
    want = sorted([(1, enc.encode_ordinary("a b"))] * 2 + [(1, enc.encode_ordinary("c")), (2, []), (2, [])])
    got = [tuple(r) for r in encode_corpus(df).collect()]
    assert sorted(g for g in got if g[0] is not None) == want and (None, enc.encode_ordinary("d")) in got and len(got) == 6
    assert encode_corpus(df.limit(0)).count() == 0
    assert len(decode_corpus(encode_corpus(df)).collect()) == 6


def test_unknown_id(spark):
    df = spark.createDataFrame([(1, [99_999_999])], "doc_id bigint, ids array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        decode_corpus(df).collect()
