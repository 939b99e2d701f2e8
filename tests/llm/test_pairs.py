import math
import random
from collections import Counter
from itertools import combinations

from millrace.llm.pairs import co_occurrence


def brute(records, least):
    sets = [s for s in ({x for x in r or () if x is not None} for r in records) if s]
    single, pairs = Counter(x for s in sets for x in s), Counter(p for s in sets for p in combinations(sorted(s), 2))
    return {(a, b, n, single[a], single[b], len(sets)) for (a, b), n in pairs.items() if n >= least}


def found(spark, records, **kw):
    df = spark.createDataFrame([(r, "clash", 1) for r in records], "items array<string>, item string, c int")
    return co_occurrence(df, "items", **kw)


def test_brute_force(spark):
    r = random.Random(2)
    records = [[r.choice("abcdefghijü") for _ in range(r.randrange(8))] for _ in range(400)] + [None, [], [None, "a"], ["a", "a"]]
    got = {(x["item_a"], x["item_b"], x["c_ab"], x["c_a"], x["c_b"], x["n"]) for x in found(spark, records, min_count=5).collect()}
    assert got == brute(records, 5)


def test_hot_item_and_long_record(spark):
    records = [["salt", f"x{i % 7}"] for i in range(300)] + [[f"y{i}" for i in range(600)]] * 2
    got = {(x["item_a"], x["item_b"], x["c_ab"], x["c_a"], x["c_b"], x["n"]) for x in found(spark, records, min_count=2).collect()}
    assert got == brute(records, 2)


def test_share_and_llr(spark):
    records = [["a", "b"]] * 10 + [["a"]] * 10 + [["c"]] * 20
    (row,) = found(spark, records, min_count=1, min_share=0.1).collect()
    assert (row["item_a"], row["item_b"], row["c_ab"]) == ("a", "b", 10) and row["lift"] == 2.0
    n, a, b, ab = 40, 20, 10, 10
    cells = [(ab, a, b), (a - ab, a, n - b), (b - ab, n - a, b), (n - a - b + ab, n - a, n - b)]
    assert math.isclose(row["llr"], 2 * sum(k * math.log(k * n / (r * c)) for k, r, c in cells if k))


def test_empty(spark):
    assert found(spark, []).count() == 0 and found(spark, [None, []]).count() == 0


def test_beyond_the_list_and_with_small_stripes(spark, monkeypatch):
    """The same result where rare items aren't left out early and stripes are sent at every chance."""
    from millrace.llm import pairs

    r = random.Random(6)
    records = [[r.choice("abcdefghij") for _ in range(r.randrange(9))] for _ in range(300)]
    monkeypatch.setattr(pairs, "MAX_LISTED", 2)
    monkeypatch.setattr(pairs, "CHUNK", 50)
    monkeypatch.setattr(pairs, "CELLS", 5)
    got = {(x["item_a"], x["item_b"], x["c_ab"], x["c_a"], x["c_b"], x["n"]) for x in found(spark, records, min_count=5).collect()}
    assert got == brute(records, 5)
