"""Queries over ranks, splits, quotas, top-k and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import ranking as K
from millrace.plans.registry import Registry
from millrace.session import table

R = Registry()


@R.query("percentile_rank_midpoint", "SELECT recipe_id, round(CASE WHEN ratingaverage IS NULL THEN 0.5 ELSE (rank() OVER (ORDER BY ratingaverage NULLS LAST) + (count(*) OVER (PARTITION BY ratingaverage) - 1) / 2.0) / (SELECT count(ratingaverage) FROM recipes_structured) END, 9) AS pct FROM recipes_structured")
def percentile_rank_midpoint(spark: SparkSession, root: str) -> DataFrame:
    return K.percentile_rank(table(spark, root, "recipes_structured").select("recipe_id", "ratingaverage"), "ratingaverage", "pct").select("recipe_id", F.round("pct", 9).alias("pct"))


_SPLIT = "SELECT {k}, CASE WHEN row_number() OVER (PARTITION BY {u} ORDER BY {o}) > n - least(greatest(1, CAST(round_even(n * 0.2, 0) AS BIGINT)), n - 1) THEN 'test' ELSE 'train' END AS split FROM (SELECT *, count(*) OVER (PARTITION BY {u}) AS n FROM {t})"


@R.query("temporal_split_events", _SPLIT.format(k="event_id", u="user_id", o="ts, event_id", t="events"))
def temporal_split_events(spark: SparkSession, root: str) -> DataFrame:
    return K.temporal_split(table(spark, root, "events"), "user_id", ["ts", "event_id"]).select("event_id", "split")


@R.query("temporal_split_orders", _SPLIT.format(k="o_orderkey", u="o_custkey", o="o_orderdate, o_orderkey", t="orders"))
def temporal_split_orders(spark: SparkSession, root: str) -> DataFrame:
    return K.temporal_split(table(spark, root, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "split")


@R.query("rating_quota_bands", "SELECT event_id, CASE WHEN r <= a THEN 5 WHEN r <= a + b THEN 4 WHEN r <= a + b + c THEN 3 ELSE 1 END AS rating FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r, round_even(count(*) OVER (PARTITION BY user_id) * 0.72, 0) AS a, round_even(count(*) OVER (PARTITION BY user_id) * 0.16, 0) AS b, round_even(count(*) OVER (PARTITION BY user_id) * 0.04, 0) AS c FROM events)")
def rating_quota_bands(spark: SparkSession, root: str) -> DataFrame:
    return K.quota_bands(table(spark, root, "events"), "user_id", [F.desc("value"), F.col("event_id")], [(5, 0.72), (4, 0.16), (3, 0.04)], 1).select("event_id", "rating")


@R.query("round_robin_sample", "SELECT doc_id, source, lang, turn FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS turn FROM documents) ORDER BY turn, sha256(CAST(doc_id AS VARCHAR)), doc_id LIMIT 120")
def round_robin_sample(spark: SparkSession, root: str) -> DataFrame:
    return K.stratified_round_robin(table(spark, root, "documents").select("doc_id", "source", "lang"), ["source", "lang"], "doc_id", 120).withColumn("turn", F.col("turn").cast("bigint"))


@R.query("first_snapshot_per_key", "SELECT snapshot_recipe_id, recipename, home_region FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_recipe_id ORDER BY snapshot_id, delivered_at, recipename NULLS FIRST, home_region NULLS FIRST) AS rn FROM snapshot_recipe_meta) WHERE rn = 1")
def first_snapshot_per_key(spark: SparkSession, root: str) -> DataFrame:
    return K.first_per_key(table(spark, root, "snapshot_recipe_meta"), ["snapshot_recipe_id"], [F.col(c) for c in ("snapshot_id", "delivered_at", "recipename", "home_region")], ["recipename", "home_region"])


@R.query("softmax_share", "SELECT l_orderkey, l_linenumber, round(exp((l_discount - m) / 0.1) / sum(exp((l_discount - m) / 0.1)) OVER (PARTITION BY l_orderkey), 6) AS share FROM (SELECT *, max(l_discount) OVER (PARTITION BY l_orderkey) AS m FROM lineitem)")
def softmax_share(spark: SparkSession, root: str) -> DataFrame:
    return K.softmax(table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_discount"), ["l_orderkey"], "l_discount", "share", 0.1).select("l_orderkey", "l_linenumber", F.round("share", 6).alias("share"))


@R.query("topk_items_per_group", "SELECT c_nationkey, l_partkey, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, l_partkey) AS rank FROM (SELECT c_nationkey, l_partkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL)) WHERE rank <= 10")
def topk_items_per_group(spark: SparkSession, root: str) -> DataFrame:
    l, o, c = (table(spark, root, t) for t in ("lineitem", "orders", "customer"))
    counts = l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey", "l_partkey").agg(F.count("*").alias("n"))
    return K.top_k(counts, ["c_nationkey"], [F.desc("n"), F.col("l_partkey")], 10)


@R.query("top_frequencies", "SELECT sourcesite, count(*) AS n FROM recipes_structured GROUP BY 1 ORDER BY n DESC, sourcesite NULLS FIRST LIMIT 20")
def top_frequencies(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "recipes_structured").groupBy("sourcesite").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("sourcesite")).limit(20)


@R.query("weighted_sample_without_replacement")
def weighted_sample_without_replacement(spark: SparkSession, root: str) -> DataFrame:
    """Five parts per brand, drawn by size as weight."""
    return K.gumbel_top_k(table(spark, root, "part").select("p_brand", "p_partkey", "p_size"), ["p_brand"], "p_partkey", "p_size", 5, 11)


@R.query("weighted_category_draw")
def weighted_category_draw(spark: SparkSession, root: str) -> DataFrame:
    """A category for every user, drawn with replacement."""
    return K.weighted_choice(table(spark, root, "users").select("user_id"), "user_id", [("low", 0.2), ("medium", 0.5), ("high", 0.3)], 3, "drawn")


@R.query("step_phase_split", "SELECT user_id, event_index, CASE WHEN event_index < 16 THEN 'train' ELSE 'test' END AS phase, count(*) AS n FROM interactions GROUP BY ALL")
def step_phase_split(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "interactions").groupBy("user_id", "event_index").agg(F.count("*").alias("n")).select("user_id", "event_index", F.when(F.col("event_index") < 16, "train").otherwise("test").alias("phase"), "n")
