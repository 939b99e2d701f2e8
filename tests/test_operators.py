import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalar as X
from millrace.functions import text as T
from millrace.operators import contracts as C
from millrace.operators import digests as D
from millrace.operators import evidence as E
from millrace.operators import graph as G
from millrace.operators import ranking as K
from millrace.operators import recommend as M
from millrace.operators import relational as L
from millrace.operators.components import connected_components
from millrace.operators.prefix import hot_join, running_total
from millrace.plans.quality import CLASSES, METHOD


def one(spark, column, schema="x string", row=(None,)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()[0]


def test_running_total(spark):
    r = random.Random(1)
    data = [(r.choice(["a", "b", None]), i, r.random(), r.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, k int, at double, v int")
    got = {x["k"]: x["run"] for x in running_total(df, ["g"], "at", ["k"], "v", "run", bins=16).collect()}
    sums = defaultdict(int)
    for g, k, _, v in sorted(data, key=lambda x: (x[0] or "", x[2], x[1])):
        sums[g] += v
        assert got[k] == sums[g]
    assert running_total(df.limit(0), ["g"], "at", ["k"], "v", "run").count() == 0


def test_hot_join(spark, rows):
    left = spark.createDataFrame([("h",)] * 50 + [(f"c{i}",) for i in range(20)] + [(None,)], "k string")
    right = left.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.upper("k"))
    assert rows(hot_join(left, right, "k", "n")) == rows(left.join(right, "k"))
    assert rows(hot_join(left, right, "k", "n", "left").select("k", "n", "v")) == rows(left.join(right, "k", "left"))


def test_components(spark):
    r = random.Random(5)
    edges = [(f"n{r.randrange(300)}", f"n{r.randrange(300)}") for _ in range(180)] + [("hub", f"leaf{i}") for i in range(100)] + [("x", None), ("y", "y")]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a and b and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    groups = defaultdict(set)
    for a in parent:
        groups[find(a)].add(a)
    assert got == {a: min(g) for g in groups.values() for a in g}


def test_scalars(spark):
    for value, want in [(None, "unknown"), (float("nan"), "unknown"), (-1.0, "unknown"), (float("inf"), "unknown"), (0.0, "zero"), (9.0, "1_9"), (9.5, "1_9"), (10.0, "10_99"), (100.0, "100_plus")]:
        assert one(spark, X.count_bin(F.col("x")), "x double", (value,)) == want
    for a, b, want in [("a", "a", False), ("a", "b", True), (None, None, False), (None, "a", True), ("a", None, True)]:
        assert one(spark, X.changed(F.col("a"), F.col("b")), "a string, b string", (a, b)) is want
    assert one(spark, X.full_match(F.col("x"), "[a-z]+"), row=("abc\n",)) is False
    assert one(spark, X.strict_integer(F.col("x")), row=("12.0",)) == 12
    for bad in ("1.5", "x"):
        with pytest.raises(Exception, match="whole number"):
            one(spark, X.strict_integer(F.col("x")), row=(bad,))
    with pytest.raises(Exception, match="boolean"):
        one(spark, X.strict_boolean(F.col("x")), "x int", (1,))
    assert one(spark, X.joined_digest(F.col("x"), F.lit("b")), row=(None,)) != one(spark, X.joined_digest(F.lit("b"), F.col("x")), row=(None,))
    assert one(spark, X.tier_map(F.col("x")), row=("a:b;c:d",)) == {"a": "b", "c": "d"}
    assert one(spark, X.tier_map(F.col("x")), row=("a:b;a:d",)) is None


def test_label_statuses(spark):
    def s(x):
        return one(spark, X.label_statuses(F.col("x"), ["milk", "egg"]), row=(x,))

    assert s(None) == s("") == s("unknown") == {"milk": "unassessed", "egg": "unassessed"}
    assert s("none_detected") == {"milk": "absent", "egg": "absent"}
    assert s("milk") == {"milk": "present", "egg": "absent"}
    assert s("milk;unknown") == {"milk": "present", "egg": "unassessed"}
    for bad in ("milk;none_detected", "soy"):
        with pytest.raises(Exception, match="bad label"):
            s(bad)


def test_texts(spark):
    assert one(spark, T.casefolded(F.col("x")), row=("  Straße ﬁ ",)) == "strasse fi"
    assert one(spark, T.json_strings(F.col("x")), row=('[" A ", "b", ""]',)) == ["a", "b"]
    for bad in ("NULL", "invalid", "{}", "[]", "[3]", '[""]', '["a", 1]', None):
        assert one(spark, T.json_strings(F.col("x")), row=(bad,)) is None
    assert one(spark, T.literal_items(F.col("x")), row=("['a', \"b'c\"]",)) == ["a", "b'c"]
    assert one(spark, T.last_sentences(F.col("x"), 2), row=("A. B! C?",)) == "B! C?"
    assert one(spark, T.last_sentences(F.col("x"), 3), row=(None,)) == ""
    assert one(spark, T.redact(F.col("x"), {"n": r"\d+"}), row=("a 12",)) == "a [redacted-n]"
    assert one(spark, T.affirmed(F.col("x"), r"add water", r"never\b[^.]{0,25}$"), row=("Never ever add water. Then add water",)) == "add water"
    assert one(spark, T.affirmed(F.col("x"), r"add water", r"never\b[^.]{0,25}$"), row=("never add water",)) is None
    assert one(spark, T.urls(F.col("x")), row=("see https://a.example/b). ok",)) == ["https://a.example/b"]


@pytest.mark.parametrize(
    ("name", "items", "kind"),
    [
        ("peanut", ["2 tbsp oil"], "ambiguous_carrier"),
        ("peanut", ["olive oil"], "text_silent"),
        ("peanut", ["olive oil or vegetable oil"], "ambiguous_carrier"),
        ("milk", ["paneer"], "implicit_name"),
        ("peanut", ["peanuts", "oil"], "explicit"),
        ("milk", ["coconut milk"], "text_silent"),
        ("peanut", ["peanut-free crackers"], "ambiguous_carrier"),
        ("peanut", ["without peanut"], "ambiguous_carrier"),
        ("peanut", [], "unassessed"),
    ],
)
def test_evidence(spark, name, items, kind):
    df = spark.createDataFrame([(items, True)], "i array<string>, a boolean")
    assert df.select(E.evidence_kinds(F.col("i"), F.col("a"), CLASSES).alias("k")).first()[0][name] == kind


@pytest.mark.parametrize(
    ("items", "want"),
    [
        (["no  milk"], ("ambiguous_carrier", "negated_name_requires_review")),
        (["no milk, some whole milk"], ("explicit", "explicit_name_match")),
        (["milk-free", "milk free, milky"], ("ambiguous_carrier", "negated_name_requires_review")),
        (["nothing", "no", "milk"], ("explicit", "explicit_name_match")),
        (["without", None, "cream"], ("implicit_name", "implicit_name_match")),
        (["chocolate; no milk"], ("ambiguous_carrier", "ambiguous_carrier_match")),
        (["almond milk"], ("text_silent", "no_supported_name_or_carrier_match")),
        ([], ("unassessed", "ingredient_evidence_unassessed")),
        (None, ("unassessed", "ingredient_evidence_unassessed")),
    ],
)
def test_evidence_reasons(spark, items, want):
    df = spark.createDataFrame([(items, True)], "i array<string>, a boolean")
    assert tuple(df.select(E.evidence_of(F.col("i"), F.col("a"), CLASSES).alias("k")).first()[0]["milk"]) == want
    assert df.select(E.evidence_kinds(F.col("i"), F.lit(None).cast("boolean"), CLASSES).alias("k")).first()[0]["milk"] == "unassessed"


@pytest.mark.parametrize(
    ("legacy", "kind", "incomplete", "ok", "status"),
    [("absent", "ambiguous_carrier", False, True, "unknown"), ("absent", "text_silent", False, True, "absent"), ("absent", "implicit_name", False, True, "unknown"), ("present", "unassessed", True, False, "present"), ("absent", "text_silent", True, True, "unknown"), ("absent", "text_silent", None, True, "unknown"), ("unassessed", "explicit", False, True, "unknown")],
)
def test_policy(spark, legacy, kind, incomplete, ok, status):
    df = spark.createDataFrame([(legacy, kind, incomplete, ok)], "l string, k string, s boolean, a boolean")
    assert df.select(E.status_policy(F.col("l"), F.col("k"), F.col("s"), F.col("a")).alias("p")).first()[0]["status"] == status


def test_policy_refuses(spark):
    df = spark.createDataFrame([("maybe", "explicit", False, True)], "l string, k string, s boolean, a boolean")
    with pytest.raises(Exception, match="outside the vocabulary"):
        df.select(E.status_policy(F.col("l"), F.col("k"), F.col("s"), F.col("a")).alias("p")).collect()


def test_method_status(spark):
    for text, want in [(None, "MISSING"), ("short", "PLACEHOLDER"), ("Please watch the video for all the steps.", "PLACEHOLDER"), ("A long text about nothing in particular here.", "NOT_A_METHOD"), ("Heat the oil and add the onions, then", "TRUNCATED"), ("Heat water and cook carrots. Serve the soup.", "COMPLETE")]:
        assert one(spark, E.method_status(F.col("x"), METHOD), row=(text,)) == want


def test_graph(spark, rows):
    nodes = spark.createDataFrame([("a", "i"), ("b", "i")], "node_id string, type string")
    edges = spark.createDataFrame([("a", "pairs", "b"), ("a", "shares", "b")], "src string, rel string, dst string")
    evidence = spark.createDataFrame([("a", "pairs", "b", '{"pmi": 1.5, "also": true}')], "head string, rel string, tail string, attributes_json string")
    assert all(r[1] == 0 for r in G.integrity(nodes, edges, evidence).collect())
    bad = spark.createDataFrame([("a", "x", "b", '{"pmi": NaN}')], evidence.schema)
    found = {r[0]: r[1] for r in G.integrity(nodes.limit(1).where("node_id = 'a'"), edges, bad).collect()}
    assert found["dangling tail"] == 2 and found["orphan evidence"] == 1 and found["evidence is no object"] == 1
    assert rows(G.layer_view(edges, evidence, ["shares"], "shares", "also")) == [("a", "shares", "b")]
    assert G.adjacency(edges).first()["neighbours"] == {"pairs": ["b"], "shares": ["b"]}
    with pytest.raises(ValueError):
        G.as_triples(nodes)


def test_clusters(spark):
    df = spark.createDataFrame([(1, "rice", None), (2, "rice", "5"), (3, "dal", "5"), (4, "", None), (5, None, None)], "id int, t string, f string")
    for d in (df, df.orderBy(F.desc("id")).repartition(3)):
        got = {r["id"]: (r["cluster_key"], r["cluster_size"]) for r in G.signature_clusters(d, "id", {"t": F.col("t"), "f": F.col("f")}).collect()}
        assert got == {1: (1, 3), 2: (1, 3), 3: (1, 3), 4: (4, 1), 5: (5, 1)}


def test_contract(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "b", 2.0), (None, None, float("nan"))], "k int, d string, v double")
    c = C.Contract("t").key("k").domain("d", ["a"]).between("v", 0, 1).implies("a means small", F.col("d") == "a", F.col("v") < 0.1)
    assert {r[0]: r[1] for r in c.run(df).collect()} == {"k is null": 1, "d outside its domain": 2, "v out of range": 2, "a means small": 1, "k repeats": 1}
    assert c.problems(df.limit(0)) == []
    assert C.run_all({"ok": lambda: [], "bad": lambda: 1 / 0})["bad"][0].startswith("the check failed")
    assert C.schema_problems(df, {"k": "int", "d": "string"}) == ["undeclared column v"]


def test_digest(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (1, "a")], "k int, v string")
    d = D.logical_digest(df).first()
    assert d == D.logical_digest(df.orderBy(F.desc("k")).repartition(3).select("v", "k")).first()
    assert d != D.logical_digest(df.distinct()).first() and d != D.logical_digest(df.na.fill("")).first()


def test_ranking(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 3.0), (4, None)], "k int, v double")
    got = {r["k"]: r["p"] for r in K.percentile_rank(df, "v", "p").collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 1.0, 4: 0.5}
    single = spark.createDataFrame([("u", 1)], "u string, t int")
    assert K.temporal_split(single, "u", ["t"]).first()["split"] == "train"
    ten = spark.createDataFrame([("u", i) for i in range(10)], "u string, t int")
    assert {r["t"] for r in K.temporal_split(ten, "u", ["t"]).where("split = 'test'").collect()} == {8, 9}
    w = spark.createDataFrame([("g", i, float(i)) for i in range(50)], "g string, k int, w double")
    a, b = (sorted(r["k"] for r in K.gumbel_top_k(x, ["g"], "k", "w", 10, 3).collect()) for x in (w, w.repartition(3)))
    assert a == b and len(a) == 10 and 0 not in a


def test_recommend(spark):
    pairs = [(u, i) for u in range(6) for i in range(6)] + [(9, 0), (0, 9)]
    df = spark.createDataFrame(pairs, "u int, i int")
    assert M.k_core(df, "u", "i", 3).count() == 36
    assert M.k_core(df, "u", "i", 7).count() == 0
    ids = {r["i"]: r["idx"] for r in M.dense_ids(df, "i").collect()}
    assert ids == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 9: 6}
    ranked = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "u int, i int, rank int")
    truth = spark.createDataFrame([(1, 6), (2, 7)], "u int, i int")
    m = M.ranking_metrics(ranked, truth, "u", "i").first()
    assert m["recall_10"] == 0.5 and math.isclose(m["ndcg_10"], 0.5 / math.log2(3)) and m["hit_10"] == 0.5


def test_similar_items_without_shuffled_pairs(spark, rows, monkeypatch):
    """Items are scored within tasks, as by joins of pairs and as by hand, unknown users and items included."""
    import random

    r = random.Random(5)
    pairs = [(u if u else None, r.choice([None, *range(25)])) for u in range(30) for _ in range(r.randrange(1, 12))]
    df = spark.createDataFrame(pairs, "u int, i long")
    out = M.top_similar(df, "u", "i", 5)
    plan = out._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan
    got = rows(out)
    monkeypatch.setattr(M, "MAX_SENT", 0)
    assert rows(M.top_similar(df, "u", "i", 5)) == got
    seen = {(u, i) for u, i in pairs if i is not None}
    n = {i: sum(j == i for _, j in seen) for _, i in seen}
    sim = {(i, j): sum((v, j) in seen for v, x in seen if x == i and v is not None) / math.sqrt(n[i] * n[j]) for i in n for j in n if i != j}
    want = []
    for u in {u for u, _ in seen}:
        own = {i for v, i in seen if v == u}
        scores = {j: round(sum(sim[i, j] for i in own if i != j), 9) for j in n if u is None or j not in own}
        want += [(u, j, k) for k, j in enumerate(sorted((j for j in scores if scores[j]), key=lambda j: (-scores[j], j))[:5], 1)]
    assert sorted(got, key=str) == sorted(want, key=str) and M.top_similar(df.limit(0), "u", "i", 5).count() == 0


def test_best_items_by_factors(spark, rows, monkeypatch):
    """The unseen items of the greatest product within tasks, as by the model's own top lists and as by hand over all products."""
    import random

    import numpy as np

    r = random.Random(7)
    pairs = sorted({(u, r.randrange(40)) for u in range(30) for _ in range(12)})
    df = spark.createDataFrame(pairs, "u int, i int")
    model = M.als_factors(df, "u", "i", rank=4, rounds=2, distinct=True)
    out = M.top_by_factors(model, df, "u", "i", 5)
    assert out.columns == ["u", "i", "score", "rank"] and out.count() == 150
    got = rows(out.select("u", "rank", "i"))
    monkeypatch.setattr(M, "MAX_SENT", 0)
    assert rows(M.top_by_factors(model, df, "u", "i", 5).select("u", "rank", "i")) == got
    g = np.random.default_rng(1)
    users, items = g.normal(size=(9, 4)).astype(np.float32), g.integers(-2, 3, (300, 4)).astype(np.float32)
    users[0] = 0  # ties everywhere: the smaller ids
    order = np.argsort(-np.linalg.norm(items, axis=1), kind="stable")
    seen = [g.choice(300, 20, replace=False) for _ in users]
    for step in (7, 64, 8192):
        for u, (ids, scores) in enumerate(M._best(users, items[order], order, seen, 6, step)):
            all_ = (users[u : u + 1] @ items[order].T)[0]
            want = sorted((x for x in range(300) if x not in set(seen[u])), key=lambda x: (-all_[x], order[x]))[:6]
            assert list(ids) == [order[x] for x in want] or np.allclose(scores, all_[want], atol=1e-5) and u


def test_relational(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k int, v string")
    assert rows(L.exclude(df, spark.createDataFrame([(1,), (None,)], "x int"), "k")) == [(None, "c"), (2, None)]
    with pytest.raises(ValueError):
        L.join_one_to_one(df.union(df), df, ["k"])
    assert L.same_rows(df, df.repartition(2)) and not L.same_rows(df, df.union(df))
    out = rows(L.unpivot_history(spark.createDataFrame([(1, "7", "x")], "k int, a string, b string"), "k", ["a", "b"], "g"))
    assert out == [(1, "a", "g", 7.0, None), (1, "b", "g", None, "x")]


def test_standing_rules_never_lapse(spark):
    """A standing rule holds besides a narrowing one whatever its own flags, unless that one already excludes from it; the last one counts."""
    from millrace.operators import rules as U

    schema = "rule_uid string, rule_class string, source_executable boolean, destination_executable boolean, excludes_tags array<string>, also_excludes_from_uids array<string>, standing_for_groups array<string>, at int"
    rules = spark.createDataFrame([("n", "narrowing", True, True, ["meat"], None, None, 1), ("z", "narrowing", True, True, ["egg"], None, ["g"], 2), ("s", "narrowing", False, False, ["milk"], None, ["g"], 3), ("m", "narrowing", True, True, ["meat"], ["s"], None, 4)], schema)
    occasions = spark.createDataFrame([("a", "g", "n", "rule"), ("b", "g", "m", "rule"), ("c", "g", None, "confirmed_no_constraint")], "occasion_uid string, group string, rule_uid string, status string")
    asked = spark.createDataFrame([(o, {"meat": False, "milk": False, "egg": True}) for o in "abc"], "occasion_uid string, item map<string,boolean>")
    got = {r["occasion_uid"]: r["item_value"] for r in U.decide(asked, occasions, rules, "at").collect()}
    assert got == {"a": "UNKNOWN", "b": "PASS", "c": "NO_CONSTRAINT"}
    assert U.decide(asked, occasions, rules).where("occasion_uid = 'a'").first()["item_value"] == "FAIL"


def test_wide_surface(spark, rows):
    grid = spark.createDataFrame([(1, "ghee", "present"), (1, "milk", "absent"), (2, "milk", "unassessed"), (2, "other", "present")], "id int, class string, status string")
    tokens = {"milk": None, "ghee": "milk"}
    wide = E.wide_surface(grid, "id", "status", tokens)
    assert rows(wide) == [(1, True, False, True, False), (2, False, True, False, False)]
    assert all(r["n"] == 0 for r in E.wide_problems(wide, grid, "id", "status", tokens).collect())
    bad = wide.withColumn("milk", F.lit(False))
    assert {r["check"]: r["n"] for r in E.wide_problems(bad, grid, "id", "status", tokens).collect()} == {"fewer than in the grid": 0, "token without its parent": 1}
    with pytest.raises(ValueError, match="undeclared"):
        E.wide_surface(grid, "id", "status", {"ghee": "milk"})


def test_small_scalars(spark):
    assert one(spark, X.surnames(F.col("x")), row=("Ana Maria Lopez & Bo Li; Cher",)) == ["lopez", "maria"]
    assert one(spark, X.without_suffixes(F.col("x"), ["recipe", "easy"]), row=("Pea  Soup Easy Recipe",)) == "pea soup"
    assert one(spark, X.row_sum("x", "y"), "x int, y int", (None, None)) is None and one(spark, X.row_sum("x", "y"), "x int, y int", (2, None)) == 2
