import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import audits as A
from millrace.operators.simulate import draw_groups

#: The operator's patterns are the caller's; these are the test's own.
METHOD = {"intermediate_title": r"\bspread\b", "intermediate_use": r"\breserve for\b", "finish": r"\bserve\b", "liquid": r"\bwater\b", "add_liquid": r"\badd water\b", "negator": r"\bnever\s$", "consistency": r"\bdough\b", "solid": r"\bbake\b"}


def test_flags(spark):
    def flags(text, title="Soup", items=()):
        df = spark.createDataFrame([(text, title, list(items))], "x string, t string, i array<string>")
        return df.select(A.method_flags(F.col("x"), F.col("t"), F.col("i"), METHOD).alias("f")).first()["f"]

    assert flags("Mix the dough. Bake until crisp. Serve the bread.")["is_intermediate"] == "no"
    assert flags("Mix all. Reserve for the filling.")["is_intermediate"] == "yes"
    assert flags("Heat. Cook carrots. Serve the soup.")["end_state"] == "yes"
    assert flags("Heat. Boil it.", items=["1 cup water"])["liquid_fate_unstated"] == "yes"
    assert flags("Never add water. Heat it.")["liquid_fate_unstated"] == "no"
    assert flags(None, None)["end_state"] == "no" and flags("x" * 7000)["over_cut"] == "yes"


def test_observations(spark):
    rows = [("A text.", "en", False, "input_unavailable"), ("", "en", True, "input_missing_in_source"), ("नमस्ते", "hi", True, "language_not_supported"), ("A text.", "en-GB", True, "observed"), (None, None, None, "input_unavailable")]
    df = spark.createDataFrame(rows, "t string, l string, a boolean, want string")
    for r in df.select(A.observe_text(F.col("t"), F.col("l"), F.col("a")).alias("o"), "want").collect():
        assert r["o"]["reason"] == r["want"]
    assert df.where("l = 'hi'").select(A.observe_text(F.col("t"), F.col("l"), F.col("a")).alias("o")).first()["o"]["garbled"] == "not_detected"


def test_group_draws_equal_item_softmax():
    sizes, u = [2, 3, 1], np.array([0.3, -0.2, 1.0])
    rng = np.random.default_rng(1)
    for g, _, p in [draw_groups(sizes, u, rng, 1)[0] for _ in range(50)]:
        items = np.repeat(u, sizes)
        assert abs(p - np.exp(u[g]) / np.exp(items).sum()) < 1e-14
    assert len({x[:2] for x in draw_groups([1, 1, 1], u, rng, 3)}) == 3
    with pytest.raises(ValueError):
        draw_groups(sizes, u, rng, 7)


def test_calibration():
    mu = A.calibrated_mu(20.0, 0.8, 3, 200)
    draws = np.clip(np.round(np.exp(np.random.default_rng(0).normal(mu, 0.8, 400_000))), 3, 200)
    assert abs(draws.mean() - 20.0) < 0.1
    with pytest.raises(ValueError):
        A.calibrated_mu(2.0, 0.8, 3, 200)


def test_ids_parents_targets(spark, rows):
    lines = spark.createDataFrame([("recipe::17, 93",), ("x 17",), (None,)], "value string")
    assert rows(A.ids_in_text(lines, "value", spark.createDataFrame([(17,), (5,)], "id int"))) == [("17", 2)]
    df = spark.createDataFrame([(["ghee"],), ([],), (None,)], "t array<string>")
    assert [r[0] for r in df.select(A.with_parents(F.col("t"), {"ghee": "milk"})).collect()] == [["ghee", "milk"], [], None]
    m = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "k string, t int")
    assert A.unique_target(m, "k", "t", ["a"]) == {"a": 1}
    for bad in ("b", "c"):
        with pytest.raises(ValueError):
            A.unique_target(m, "k", "t", [bad])
