import random
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.llm.mixture import mixture, mixture_shares, positions

DOCS = "doc_id bigint, source string, text string, _t string, k int, at double"
TARGETS = "source string, target_share double, max_repeats int"


def docs(spark, n=600):
    r = random.Random(8)
    rows = [(i, r.choice(["big"] * 6 + ["mid", "mid", "small", None, "other"]), r.choice([None, "", *[" ".join(["word"] * r.randrange(1, 40))] * 8]), "x", 1, 0.5) for i in range(n)]
    return spark.createDataFrame(rows, DOCS)


def test_shares_and_caps(spark):
    df = docs(spark)
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 4), ("nothing", 0.1, 2)], TARGETS)
    chosen, _ = mixture(df, targets)
    rows = chosen.collect()
    caps = {"big": 1, "mid": 2, "small": 4}
    assert rows and all(0 < x["repeats"] <= caps[x["source"]] for x in rows) and len({x["doc_id"] for x in rows}) == len(rows)
    got = {x["source"]: x["actual_share"] for x in mixture_shares(chosen, targets).collect()}
    assert got["nothing"] == 0 and abs(got["big"] - 0.5) < 0.03 and abs(got["mid"] - 0.3) < 0.03 and abs(got["small"] - 0.2) < 0.03
    again = mixture(df.repartition(4).orderBy(F.desc("doc_id")), targets)[0]
    assert sorted(rows) == sorted(again.collect())


def test_epochs_come_before_the_fraction(spark):
    df = docs(spark)
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 10)], TARGETS)
    chosen = mixture(df, targets)[0].where("source = 'small'").collect()
    repeats = {x["repeats"] for x in chosen}
    have = df.where("source = 'small' AND text <> ''").count()
    assert len(repeats) <= 2 and max(repeats) - min(repeats) <= 1 and (min(repeats) == 0 or len(chosen) == have or max(repeats) == 1)


def test_total_and_weights(spark):
    df = docs(spark)
    targets = spark.createDataFrame([("big", 1.0, 1)], TARGETS)
    rows = mixture(df, targets, total=500)[0].collect()
    spent = sum(x["n_tokens"] for x in rows)
    assert 450 < spent <= 500
    heavy = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.05)
    picked = mixture(df, targets, total=500, weight=heavy)[0].collect()
    by = defaultdict(int)
    for x in picked:
        by[x["doc_id"] % 2] += 1
    assert by[0] > by[1]


def test_empty(spark):
    targets = spark.createDataFrame([("big", 1.0, 1)], TARGETS)
    assert mixture(docs(spark).limit(0), targets)[0].count() == 0
    assert mixture(docs(spark), targets.limit(0))[0].count() == 0


def test_keys_are_spread_evenly_whatever_the_weights(spark):
    """No bin of keys holds above twice its part, none tie, and the order is that of the keys."""
    w = F.pow(F.lit(10.0), -2 * F.rand(3))
    for weight in (w, F.lit(0.01), F.lit(0.05), F.lit(1.0), F.when(F.rand(5) < 0.5, 0.01).otherwise(1.0)):
        df = spark.range(60_000).select(F.col("id").alias("k"), F.lit("a").alias("source"), F.lit(1).alias("n_tokens"), weight.alias("w"))
        keyed = df.withColumn("e", -F.log((F.shiftrightunsigned(F.xxhash64("k"), 11).cast("double") + 0.5) / F.lit(float(2**53))) / F.col("w"))
        rows = positions(keyed).select("e", "at").orderBy("e").collect()
        assert len({r["e"] for r in rows}) == len(rows)
        assert all(a["at"] <= b["at"] for a, b in zip(rows, rows[1:], strict=False)) and all(0 <= r["at"] <= 1 for r in rows)
        bins = [0] * 60
        for r in rows:
            bins[min(59, int(r["at"] * 60))] += 1
        assert max(bins) < 2 * len(rows) / 60


def test_weights_that_are_none(spark):
    df = spark.createDataFrame([(i, "a", "word word", w) for i, w in enumerate([None, 0.0, -1.0, float("nan"), 5.0, 5.0])], "doc_id bigint, source string, text string, w double")
    targets = spark.createDataFrame([("a", 1.0, 1), (None, 0.5, 1)], TARGETS)
    chosen = mixture(df, targets, weight=F.col("w"), total=4)[0].collect()
    assert {r["doc_id"] for r in chosen} == {4, 5}


def test_many_sources(spark):
    """More sources than any list on the driver should hold."""
    n = 12_000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("source"), F.lit("one two").alias("text"))
    targets = df.select("source", F.lit(1.0 / n).alias("target_share"), F.lit(1).alias("max_repeats"))
    assert mixture(df, targets, weight=F.lit(1.0))[0].count() == n
