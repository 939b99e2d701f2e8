import random

from millrace.operators.snapshots import snapshot_changes, validity_intervals

SCHEMA = "s string, k bigint, d int, v string, w double, extra string"


def brute(rows):
    latest = {}
    for s, k, d, v, w, _ in rows:
        if s is None or k is None:
            continue
        rank = (d is not None, d or 0, v is not None, v or "", w is not None, w or 0.0)
        if (s, k) not in latest or rank > latest[s, k][0]:
            latest[s, k] = (rank, (v, w))
    ids = sorted({s for s, _ in latest})
    out = set()
    for a, b in zip(ids, ids[1:], strict=False):
        before, after = ({k: r[1] for (s, k), r in latest.items() if s == x} for x in (a, b))
        out |= {(b, k, "added") for k in after.keys() - before.keys()} | {(b, k, "removed") for k in before.keys() - after.keys()}
        out |= {(b, k, "changed") for k in after.keys() & before.keys() if before[k] != after[k]}
    return out


def changes(spark, data):
    return {tuple(r) for r in snapshot_changes(spark.createDataFrame(data, SCHEMA), "s", "k", "d", ["v", "w"]).collect()}


def test_cases(spark):
    data = [
        ("a", 1, 1, "x", 1.0, None), ("b", 1, 1, "x", 1.0, None), ("c", 1, 1, "y", 1.0, None),
        ("a", 2, 1, "x", None, None), ("c", 2, 1, "x", None, None),
        ("b", 3, 1, None, None, None), ("c", 3, 1, "", None, None),
        ("a", 4, 1, "x", 1.0, None), ("b", 4, 5, "late", 1.0, None), ("b", 4, 2, "x", 1.0, None),
        (None, 5, 1, "x", 1.0, None), ("a", None, 1, "x", 1.0, None),
    ]
    assert changes(spark, data) == {("c", 1, "changed"), ("b", 2, "removed"), ("c", 2, "added"), ("b", 3, "added"), ("c", 3, "changed"), ("b", 4, "changed"), ("c", 4, "removed")}


def test_brute_force(spark):
    r = random.Random(3)
    data = [(r.choice(["a", "b", "c", "d", "e"]), r.randrange(40), r.choice([None, 1, 2, 3]), r.choice([None, "x", "y"]), r.choice([None, 0.0, 1.5]), "q") for _ in range(500)]
    data += data[:50]
    r.shuffle(data)
    assert changes(spark, data) == brute(data)


def test_hot_key_and_empty(spark):
    data = [("a", 7, i, str(i), None, None) for i in range(300)] + [("b", 7, 0, "299", None, None), ("b", 8, 0, "1", None, None)]
    assert changes(spark, data) == {("b", 8, "added")}
    assert changes(spark, data[:300]) == set()
    assert spark.createDataFrame([], SCHEMA).transform(lambda d: snapshot_changes(d, "s", "k", "d", ["v"])).count() == 0


def test_intervals_and_kept_columns(spark):
    data = [("a", 1, 1, "x", 1.0, None), ("b", 1, 1, "x", 2.0, None), ("d", 1, 1, "z", 3.0, None), ("c", 9, 1, "z", 3.0, None)]
    df = spark.createDataFrame(data, SCHEMA)
    spans = {(r["_k"], r["_from"], r["_to"]) for r in validity_intervals(df, "s", "k", "d", ["v"]).collect()}
    assert spans == {(1, 1, 2), (1, 4, 4), (9, 3, 3)}
    out = {tuple(r) for r in snapshot_changes(df, "s", "k", "d", ["v"], ["w"]).collect()}
    assert out == {("c", 1, "removed", 2.0), ("d", 1, "added", 3.0), ("c", 9, "added", 3.0), ("d", 9, "removed", 3.0)}
