"""Queries over baskets, interaction logs, rules, simulation and file forms."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import association as A
from millrace.operators import ranking as K
from millrace.operators import recommend as M
from millrace.operators import rules as U
from millrace.operators import simulate as S
from millrace.plans.registry import Registry
from millrace.session import cut, shared_dir, table
from millrace.sources import readers, sinks

R = Registry()


def _baskets(spark: SparkSession, root: str) -> DataFrame:
    l, p, o, c, n = (table(spark, root, t) for t in ("lineitem", "part", "orders", "customer", "nation"))
    rows = l.join(p, l.l_partkey == p.p_partkey).join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return rows.select(F.col("l_orderkey").alias("basket"), F.col("p_name").alias("item"), F.col("n_regionkey").alias("region"))


_BASKET = "SELECT DISTINCT l_orderkey AS basket, p_name AS item, n_regionkey AS region FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
_PAIRS = f"WITH x AS ({_BASKET}), n AS (SELECT count(DISTINCT basket) AS n FROM x), s AS (SELECT item, count(*) AS c FROM x GROUP BY item), p AS (SELECT a.item AS a, b.item AS b, count(*) AS cooccur FROM x a JOIN x b ON a.basket = b.basket AND a.item < b.item GROUP BY ALL), q AS (SELECT p.a, p.b, cooccur, sa.c AS n_a, sb.c AS n_b, n.n, log2(cooccur * n.n / (CAST(sa.c AS DOUBLE) * sb.c)) AS pmi FROM p JOIN s sa ON p.a = sa.item JOIN s sb ON p.b = sb.item, n)"


@R.query("pmi_pairs", f"{_PAIRS}, g AS (SELECT * FROM q WHERE cooccur >= 50 AND pmi >= -0.5), d AS (SELECT a AS item, b AS partner, cooccur, pmi, pmi / -log2(CAST(cooccur AS DOUBLE) / n) AS npmi FROM g UNION ALL SELECT b, a, cooccur, pmi, pmi / -log2(CAST(cooccur AS DOUBLE) / n) FROM g) SELECT item, partner, cooccur, round(pmi, 6) AS pmi, round(npmi, 6) AS npmi, rank FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY round(pmi, 9) DESC, cooccur DESC, partner) AS rank FROM d) WHERE rank <= 15")
def pmi_pairs(spark: SparkSession, root: str) -> DataFrame:
    out = A.pairings(A.basket_pairs(_baskets(spark, root), "basket", "item", min_count=50), 50, -0.5, 15)
    return out.select("item", "partner", "cooccur", F.round("pmi", 6).alias("pmi"), F.round("npmi", 6).alias("npmi"), "rank")


@R.query("pmi_avoid", f"{_PAIRS} SELECT sa.item AS a, sb.item AS b, coalesce(q.cooccur, 0) AS cooccur, round(sa.c * sb.c / CAST(n.n AS DOUBLE), 6) AS expected, round(q.pmi, 6) AS pmi FROM s sa JOIN s sb ON sa.item < sb.item CROSS JOIN n LEFT JOIN q ON q.a = sa.item AND q.b = sb.item WHERE sa.c * sb.c >= 30 * n.n AND (q.pmi IS NULL OR q.pmi <= -0.2)")
def pmi_avoid(spark: SparkSession, root: str) -> DataFrame:
    out = A.avoided(_baskets(spark, root), "basket", "item", 30, -0.2)
    return out.select("a", "b", "cooccur", F.round("expected", 6).alias("expected"), F.round("pmi", 6).alias("pmi"))


@R.query("pmi_regional", f"WITH x AS ({_BASKET}), n AS (SELECT region, count(DISTINCT basket) AS n FROM x GROUP BY region), s AS (SELECT region, item, count(*) AS c FROM x GROUP BY ALL), p AS (SELECT a.region, a.item AS a, b.item AS b, count(*) AS cooccur FROM x a JOIN x b ON a.basket = b.basket AND a.item < b.item GROUP BY ALL), q AS (SELECT p.region, p.a, p.b, cooccur, log2(cooccur * n.n / (CAST(sa.c AS DOUBLE) * sb.c)) AS pmi FROM p JOIN s sa ON p.region = sa.region AND p.a = sa.item JOIN s sb ON p.region = sb.region AND p.b = sb.item JOIN n ON p.region = n.region), t AS (SELECT region, a, b, cooccur, pmi, row_number() OVER (PARTITION BY region ORDER BY round(pmi, 9) DESC, cooccur DESC, a, b) AS rank FROM q WHERE cooccur >= 12 AND pmi >= 0.1) SELECT region, a, b, cooccur, round(pmi, 6) AS pmi, rank FROM t WHERE rank <= 200")
def pmi_regional(spark: SparkSession, root: str) -> DataFrame:
    return A.regional(_baskets(spark, root), "basket", "item", "region", 12, 0.1, 200).select("region", "a", "b", "cooccur", F.round("pmi", 6).alias("pmi"), "rank")


@R.query("substitute_items")
def substitute_items(spark: SparkSession, root: str) -> DataFrame:
    """Items that could stand for one another: alike contexts, seldom together."""
    rows = _baskets(spark, root)
    category = rows.select("item").distinct().withColumn("g", F.substring("item", 1, 1))
    return A.substitutes(A.basket_pairs(rows, "basket", "item"), category, "item", "g", 8)


def _positives(spark: SparkSession, root: str) -> DataFrame:
    o, l = table(spark, root, "orders"), table(spark, root, "lineitem")
    return l.join(o, l.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), F.col("o_orderdate").alias("at"), "l_orderkey", "l_linenumber")


_POS = "SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_CORE = ", ".join([f"c0 AS ({_POS})"] + [f"u{r} AS (SELECT * FROM c{r - 1} WHERE u IN (SELECT u FROM c{r - 1} GROUP BY u HAVING count(*) >= 20)), c{r} AS (SELECT * FROM u{r} WHERE i IN (SELECT i FROM u{r} GROUP BY i HAVING count(*) >= 20))" for r in range(1, 9)])


@R.query("kcore", f"WITH {_CORE} SELECT u AS \"user\", i AS item FROM c8")
def kcore(spark: SparkSession, root: str) -> DataFrame:
    return M.k_core(_positives(spark, root), "user", "item", 20)


def _split(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The distinct pairs of train, and those of test that train has not; kept by the user's lists, so the log is sorted once."""
    rows = K.temporal_split(_positives(spark, root), "user", ["at", "l_orderkey", "l_linenumber", "item"])
    each = rows.groupBy("user").agg(*[F.collect_set(F.when(F.col("split") == s, F.col("item"))).alias(s) for s in ("train", "test")])
    lists = cut(each.select("user", "train", F.array_except("test", "train").alias("test")))
    return tuple(lists.select("user", F.explode(s).alias("item")) for s in ("train", "test"))


_LOG = "WITH r AS (SELECT o_custkey AS u, l_partkey AS i, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, l_orderkey, l_linenumber, l_partkey) AS rn, count(*) OVER (PARTITION BY o_custkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey), sp AS (SELECT u, i, rn > n - least(greatest(1, CAST(round_even(n * 0.2, 0) AS BIGINT)), n - 1) AS test FROM r), tr AS (SELECT DISTINCT u, i FROM sp WHERE NOT test), te AS (SELECT DISTINCT u, i FROM sp WHERE test EXCEPT SELECT u, i FROM tr)"
_METRICS = ", h AS (SELECT te.u, count(*) AS n, sum(CASE WHEN rank <= 10 THEN 1 ELSE 0 END) AS h10, sum(CASE WHEN rank <= 20 THEN 1 ELSE 0 END) AS h20, sum(CASE WHEN rank <= 10 THEN 1 / log2(rank + 1) ELSE 0 END) AS dcg FROM te LEFT JOIN top ON te.u = top.u AND te.i = top.i GROUP BY te.u) SELECT count(*) AS n_users, round(avg(h10 / least(n, 10)), 6) AS recall_10, round(avg(h20 / least(n, 20)), 6) AS recall_20, round(avg(dcg / list_sum(list_transform(range(1, least(n, 10) + 1), lambda k: 1 / log2(k + 1)))), 6) AS ndcg_10, round(avg(CASE WHEN h10 > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit_10 FROM h"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("n_users", *[F.round(c, 6).alias(c) for c in ("recall_10", "recall_20", "ndcg_10", "hit_10")])


@R.query("popularity_eval", f"{_LOG}, pop AS (SELECT i, count(*) AS c FROM tr GROUP BY i), cand AS (SELECT us.u, pop.i, c FROM (SELECT DISTINCT u FROM te) us CROSS JOIN pop WHERE NOT EXISTS (SELECT 1 FROM tr WHERE tr.u = us.u AND tr.i = pop.i)), top AS (SELECT * FROM (SELECT u, i, row_number() OVER (PARTITION BY u ORDER BY c DESC, i) AS rank FROM cand) WHERE rank <= 20){_METRICS}")
def popularity_eval(spark: SparkSession, root: str) -> DataFrame:
    train, test = _split(spark, root)
    return _rounded(M.ranking_metrics(M.top_popular(train, test, "user", "item", 20), test, "user", "item"))


@R.query("itemknn_eval", f"{_LOG}, n AS (SELECT i, count(*) AS c FROM tr GROUP BY i), sim AS (SELECT a.i, b.i AS j, count(*) / sqrt(CAST(max(na.c) AS DOUBLE) * max(nb.c)) AS s FROM tr a JOIN tr b ON a.u = b.u AND a.i <> b.i JOIN n na ON a.i = na.i JOIN n nb ON b.i = nb.i GROUP BY a.i, b.i), sc AS (SELECT tr.u, sim.j AS i, round(sum(s), 9) AS score FROM tr JOIN sim ON tr.i = sim.i GROUP BY ALL), top AS (SELECT * FROM (SELECT u, i, row_number() OVER (PARTITION BY u ORDER BY score DESC, i) AS rank FROM sc WHERE NOT EXISTS (SELECT 1 FROM tr WHERE tr.u = sc.u AND tr.i = sc.i)) WHERE rank <= 20){_METRICS}")
def itemknn_eval(spark: SparkSession, root: str) -> DataFrame:
    train, test = _split(spark, root)
    return _rounded(M.ranking_metrics(M.top_similar(train, "user", "item", 20), test, "user", "item"))


@R.query("als_eval")
def als_eval(spark: SparkSession, root: str) -> DataFrame:
    """Ranking metrics of matrix factorization, seen items masked."""
    train, test = _split(spark, root)
    model = M.als_factors(train.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item")), "user", "item", distinct=True)
    return _rounded(M.ranking_metrics(M.top_by_factors(model, train, "user", "item", 20), test, "user", "item"))


@R.query("train_test_leakage", f"{_LOG} SELECT count(*) AS n FROM (SELECT DISTINCT u, i FROM sp WHERE test INTERSECT SELECT u, i FROM tr)")
def train_test_leakage(spark: SparkSession, root: str) -> DataFrame:
    rows = K.temporal_split(_positives(spark, root), "user", ["at", "l_orderkey", "l_linenumber", "item"])
    return rows.where("split = 'test'").select("user", "item").intersect(rows.where("split = 'train'").select("user", "item")).agg(F.count("*").alias("n"))


@R.query("incompatible_choices", "SELECT u.diet AS user_diet, r.diet AS item_diet, count(*) AS n FROM interactions i LEFT JOIN users u ON i.user_id = u.user_id LEFT JOIN recipes_structured r ON i.recipe_id = r.recipe_id WHERE NOT coalesce((u.diet = 'Vegan' AND r.diet = 'Vegan') OR (u.diet = 'Vegetarian' AND r.diet IN ('Vegan', 'Vegetarian')) OR (u.diet = 'Non-Vegetarian' AND r.diet IN ('Vegan', 'Vegetarian', 'Eggetarian', 'Non-Vegetarian')), false) GROUP BY ALL")
def incompatible_choices(spark: SparkSession, root: str) -> DataFrame:
    i, u, r = table(spark, root, "interactions"), table(spark, root, "users"), table(spark, root, "recipes_structured")
    log = i.join(u.select("user_id", F.col("diet").alias("user_diet")), "user_id", "left").join(r.select("recipe_id", F.col("diet").alias("item_diet")), "recipe_id", "left")
    allowed = {"Vegan": ["Vegan"], "Vegetarian": ["Vegan", "Vegetarian"], "Non-Vegetarian": ["Vegan", "Vegetarian", "Eggetarian", "Non-Vegetarian"]}
    return M.incompatible(log, "user_diet", "item_diet", allowed).groupBy("user_diet", "item_diet").agg(F.count("*").alias("n"))


@R.query("log_statistics", "SELECT count(*) AS n, count(DISTINCT user_id) AS n_users, count(DISTINCT recipe_id) AS n_items, round(avg(rating), 9) AS mean_rating, median(per) AS median_per_user, max(per) AS most_per_user FROM interactions JOIN (SELECT user_id, count(*) AS per FROM interactions GROUP BY 1) USING (user_id)")
def log_statistics(spark: SparkSession, root: str) -> DataFrame:
    i = table(spark, root, "interactions")
    rows = i.join(i.groupBy("user_id").agg(F.count("*").alias("per")), "user_id")
    return rows.agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_users"), F.countDistinct("recipe_id").alias("n_items"), F.round(F.avg("rating"), 9).alias("mean_rating"), F.median("per").alias("median_per_user"), F.max("per").alias("most_per_user"))


@R.query("simulated_choices")
def simulated_choices(spark: SparkSession, root: str) -> DataFrame:
    """Twenty choices of each user among all parts."""
    return S.simulate_choices(spark, table(spark, root, "part").select("p_partkey", "p_brand", "p_type"), "p_partkey", ["p_brand", "p_type"], table(spark, root, "users").count(), 20, 42, {"p_brand": 1.4, "p_type": 0.9})


@R.query("simulated_activity")
def simulated_activity(spark: SparkSession, root: str) -> DataFrame:
    """A lognormal number of actions for every user."""
    return S.activity_counts(table(spark, root, "users").select("user_id"), "user_id", 20.0, 0.8, 3, 200, 9)


_RULES = [
    ("rule::fast", "admits_nothing", True, False, ["*"], None, None),
    ("rule::lent", "narrowing", True, True, ["meat", "dairy"], ["rule::sweet"], None),
    ("rule::open", "no_exclusion", True, True, [], None, None),
    ("rule::home", "narrowing", True, True, ["alcohol"], None, ["g1"]),
    ("rule::vague", "narrowing", False, True, ["grain"], None, None),
    ("rule::sweet", "narrowing", True, True, ["sugar"], None, None),
]
_OCCASIONS = [("occ::0", "g1", "rule::fast", "rule"), ("occ::1", "g1", "rule::lent", "rule"), ("occ::2", "g1", "rule::open", "rule"), ("occ::3", "g2", None, "confirmed_no_constraint"), ("occ::4", "g2", "rule::vague", "rule"), ("occ::5", "g1", None, "unknown"), ("occ::6", "g1", None, "confirmed_no_constraint")]


@R.query("rule_layer_decide", "WITH q AS (SELECT p_partkey, CASE p_partkey % 9 WHEN 7 THEN NULL ELSE 'occ::' || (p_partkey % 9) END AS occ, p_size % 3 AS a, p_size % 2 AS s FROM part) SELECT p_partkey, CASE WHEN occ IS NULL THEN 'NOT_APPLICABLE' WHEN occ = 'occ::0' THEN 'EXPLICIT_PROHIBITION' WHEN occ IN ('occ::1', 'occ::2', 'occ::6') THEN 'EVALUABLE_CONSTRAINT' WHEN occ = 'occ::3' THEN 'NO_ADDITIONAL_RESTRICTION' ELSE 'INSUFFICIENT_EVIDENCE' END AS state, CASE WHEN occ IS NULL THEN NULL WHEN occ = 'occ::0' THEN 'FAIL' WHEN occ = 'occ::1' THEN CASE WHEN a = 1 OR s = 1 THEN 'FAIL' WHEN a = 2 THEN 'UNKNOWN' ELSE 'PASS' END WHEN occ IN ('occ::2', 'occ::6') THEN CASE a WHEN 1 THEN 'FAIL' WHEN 2 THEN 'UNKNOWN' ELSE 'PASS' END WHEN occ = 'occ::3' THEN 'NO_CONSTRAINT' ELSE 'UNKNOWN' END AS item_value, coalesce(occ = 'occ::0', false) AS abstain FROM q")
def rule_layer_decide(spark: SparkSession, root: str) -> DataFrame:
    rules = spark.createDataFrame(_RULES, "rule_uid string, rule_class string, source_executable boolean, destination_executable boolean, excludes_tags array<string>, also_excludes_from_uids array<string>, standing_for_groups array<string>")
    occasions = spark.createDataFrame(_OCCASIONS, "occasion_uid string, group string, rule_uid string, status string")
    item = F.create_map(F.lit("meat"), F.lit(False), F.lit("dairy"), F.lit(False), F.lit("sugar"), F.col("p_size") % 2 == 1, F.lit("alcohol"), F.when(F.col("p_size") % 3 != 2, F.col("p_size") % 3 == 1))
    occasion = F.when(F.col("p_partkey") % 9 != 7, F.concat(F.lit("occ::"), (F.col("p_partkey") % 9).cast("string")))
    requests = table(spark, root, "part").select("p_partkey", occasion.alias("occasion_uid"), item.alias("item"))
    return U.decide(requests, occasions, rules).select("p_partkey", "state", "item_value", "abstain")


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


@R.query("parquet_round_trip", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size BETWEEN 10 AND 20")
def parquet_round_trip(spark: SparkSession, root: str) -> DataFrame:
    path = _scratch(spark, "parquet")
    sinks.write_parquet(table(spark, root, "part"), path, keys=["p_partkey"])
    return spark.read.parquet(path).where("p_size BETWEEN 10 AND 20").select("p_partkey", "p_name", "p_retailprice")


@R.query("csv_round_trip", "SELECT recipe_id, coalesce(recipename, '') AS recipename, coalesce(ingredientslist, '') AS ingredientslist FROM recipes_structured")
def csv_round_trip(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured").select("recipe_id", F.coalesce("recipename", F.lit("")).alias("recipename"), F.coalesce("ingredientslist", F.lit("")).alias("ingredientslist"))
    path = _scratch(spark, "csv")
    sinks.write_csv(r, path)
    back = readers.read_csv_as_text(spark, path, ["recipe_id", "recipename", "ingredientslist"])
    return back.withColumn("recipe_id", F.col("recipe_id").cast("bigint"))


@R.query("adjacency_text_round_trip", "SELECT DISTINCT user_id AS \"user\", recipe_id AS item FROM interactions WHERE user_id IS NOT NULL AND recipe_id IS NOT NULL")
def adjacency_text_round_trip(spark: SparkSession, root: str) -> DataFrame:
    path = _scratch(spark, "adjacency")
    sinks.write_adjacency(table(spark, root, "interactions").where("user_id IS NOT NULL AND recipe_id IS NOT NULL"), "user_id", "recipe_id", path)
    return readers.read_adjacency(spark, path)


@R.query("triple_text_round_trip", "SELECT c_custkey AS head, 0 AS rel, c_nationkey AS tail FROM customer")
def triple_text_round_trip(spark: SparkSession, root: str) -> DataFrame:
    path = _scratch(spark, "triples")
    sinks.write_triples(table(spark, root, "customer").select(F.col("c_custkey").alias("head"), F.lit(0).alias("rel"), F.col("c_nationkey").alias("tail")), path)
    return readers.read_triples(spark, path)


@R.query("json_round_trip", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_round_trip(spark: SparkSession, root: str) -> DataFrame:
    path = _scratch(spark, "json")
    table(spark, root, "events").select("event_id", "event_type", F.from_json("props", "k bigint").alias("props")).write.json(path)
    return readers.read_jsonl(spark, path, "event_id bigint, event_type string, props struct<k: bigint>").select("event_id", "event_type", "props.k")
