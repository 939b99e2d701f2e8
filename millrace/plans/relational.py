"""Queries over joins, exclusions, sets, aggregates and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import scalar as X
from millrace.operators import relational as L
from millrace.plans.registry import Registry
from millrace.session import table

R = Registry()


@R.query("exclusion_anti_join", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 10 AND p_partkey IS NOT NULL) OR l_partkey IS NULL")
def exclusion_anti_join(spark: SparkSession, root: str) -> DataFrame:
    small = table(spark, root, "part").where("p_size < 10").select("p_partkey")
    return L.exclude(table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), small, "l_partkey")


@R.query("edge_exclusion", "WITH x AS (SELECT c_nationkey AS h, c_custkey AS t FROM customer), d AS (SELECT n_nationkey AS k FROM nation WHERE n_regionkey = 0 UNION ALL SELECT 7) SELECT h AS head, t AS tail FROM x WHERE h NOT IN (SELECT k FROM d) AND t NOT IN (SELECT k FROM d)")
def edge_exclusion(spark: SparkSession, root: str) -> DataFrame:
    edges = table(spark, root, "customer").select(F.col("c_nationkey").cast("bigint").alias("head"), F.col("c_custkey").alias("tail"))
    gone = table(spark, root, "nation").where("n_regionkey = 0").select(F.col("n_nationkey").cast("bigint").alias("k")).unionByName(spark.range(7, 8).select(F.col("id").alias("k")))
    return L.exclude(edges, gone, "head", "tail")


@R.query("repeated_keys", "SELECT user_id, event_index, count(*) AS n FROM interactions WHERE user_id IS NOT NULL AND event_index IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, root: str) -> DataFrame:
    return L.duplicates(table(spark, root, "interactions"), ["user_id", "event_index"])


@R.query("one_to_one_join", "SELECT p_partkey, p_name, s.q AS sold, s.q IS NOT NULL AS matched FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) s ON l_partkey = p_partkey")
def one_to_one_join(spark: SparkSession, root: str) -> DataFrame:
    sold = table(spark, root, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("sold"))
    joined = L.join_one_to_one(table(spark, root, "part").select("p_partkey", "p_name"), sold, ["p_partkey"])
    return joined.select("p_partkey", "p_name", "sold", F.col("_matched").alias("matched"))


@R.query("key_presence", "WITH a AS (SELECT DISTINCT recipe_id FROM documents), b AS (SELECT DISTINCT recipe_id FROM recipes_structured) SELECT coalesce(a.recipe_id, b.recipe_id) AS recipe_id, CASE WHEN b.y IS NULL THEN 'left_only' WHEN a.x IS NULL THEN 'right_only' ELSE 'both' END AS side FROM (SELECT *, 1 AS x FROM a) a FULL JOIN (SELECT *, 1 AS y FROM b) b ON a.recipe_id IS NOT DISTINCT FROM b.recipe_id")
def key_presence(spark: SparkSession, root: str) -> DataFrame:
    return L.presence(table(spark, root, "documents"), table(spark, root, "recipes_structured"), ["recipe_id"]).withColumnRenamed("_side", "side")


@R.query("authority_overwrite", "WITH m AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END AS p_brand, p_size + CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS p_size FROM part WHERE p_partkey % 11 <> 0) SELECT p.p_partkey, m.p_brand, m.p_size, CASE WHEN p.p_brand IS DISTINCT FROM m.p_brand THEN 1 ELSE 0 END + CASE WHEN p.p_size IS DISTINCT FROM m.p_size THEN 1 ELSE 0 END AS n_changed FROM part p LEFT JOIN m USING (p_partkey)")
def authority_overwrite(spark: SparkSession, root: str) -> DataFrame:
    part = table(spark, root, "part").select("p_partkey", "p_brand", "p_size")
    master = part.where("p_partkey % 11 <> 0").select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).alias("p_brand"), (F.col("p_size") + (F.col("p_partkey") % 7 == 0).cast("int")).alias("p_size"))
    return L.overwrite(part, master, "p_partkey", ["p_brand", "p_size"]).withColumnRenamed("_changed", "n_changed")


@R.query("name_link_outcomes", "WITH k AS (SELECT lower(trim(p_name)) AS k, p_partkey AS t FROM part UNION ALL SELECT lower(trim(CAST(p_partkey AS VARCHAR))), p_partkey FROM part), c AS (SELECT k, count(DISTINCT t) AS n, min(t) AS t FROM k WHERE k IS NOT NULL GROUP BY k), q AS (SELECT DISTINCT p_name AS name FROM part UNION ALL SELECT '17' UNION ALL SELECT 'no such part') SELECT name, CASE WHEN n IS NULL THEN 'unmatched' WHEN n > 1 THEN 'ambiguous' ELSE 'exact' END AS outcome, CASE WHEN n = 1 THEN t END AS target FROM q LEFT JOIN c ON lower(trim(name)) = k")
def name_link_outcomes(spark: SparkSession, root: str) -> DataFrame:
    part = table(spark, root, "part")
    names = part.select(F.col("p_name").alias("name")).distinct().unionByName(spark.createDataFrame([("17",), ("no such part",)], "name string"))
    return L.link_by_name(names, "name", part, "p_partkey", "p_name")


@R.query("set_difference_both_ways", "SELECT c_nationkey AS k, 'left_only' AS side FROM (SELECT c_nationkey FROM customer WHERE c_acctbal > 9800 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 2000) UNION ALL SELECT s_nationkey, 'right_only' FROM (SELECT s_nationkey FROM supplier WHERE s_acctbal > 2000 EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal > 9800)")
def set_difference_both_ways(spark: SparkSession, root: str) -> DataFrame:
    a = table(spark, root, "customer").where("c_acctbal > 9800").select(F.col("c_nationkey").alias("k"))
    b = table(spark, root, "supplier").where("s_acctbal > 2000").select(F.col("s_nationkey").alias("k"))
    return L.symmetric_difference(a, b).withColumnRenamed("_side", "side")


@R.query("registry_union", "WITH r AS (SELECT c_custkey AS id, 'negative' AS reason, 0 AS p FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey, 'building', 1 FROM customer WHERE c_mktsegment = 'BUILDING') SELECT id, arg_max(reason, p) AS reason FROM r GROUP BY id")
def registry_union(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "customer")
    return L.merge_registries(c.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"), F.lit("negative").alias("reason")), c.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"), F.lit("building").alias("reason")))


@R.query("null_safe_diff", "SELECT a.recipe_id, a.dup_family_id IS DISTINCT FROM b.dup_family_id AS family_changed, a.ratingcount IS DISTINCT FROM b.ratingcount AS count_changed FROM recipes_structured a JOIN (SELECT recipe_id, CASE WHEN recipe_id % 3 = 0 THEN NULL ELSE dup_family_id END AS dup_family_id, CASE WHEN recipe_id % 4 = 0 THEN ratingcount + 1 ELSE ratingcount END AS ratingcount FROM recipes_structured) b USING (recipe_id)")
def null_safe_diff(spark: SparkSession, root: str) -> DataFrame:
    a = table(spark, root, "recipes_structured").select("recipe_id", "dup_family_id", "ratingcount")
    b = a.select("recipe_id", F.when(F.col("recipe_id") % 3 != 0, F.col("dup_family_id")).alias("_f"), F.when(F.col("recipe_id") % 4 == 0, F.col("ratingcount") + 1).otherwise(F.col("ratingcount")).alias("_r"))
    return a.join(b, "recipe_id").select("recipe_id", X.changed(F.col("dup_family_id"), F.col("_f")).alias("family_changed"), X.changed(F.col("ratingcount"), F.col("_r")).alias("count_changed"))


@R.query("tolerance_diff", "SELECT o_orderkey, (abs(o_totalprice - s) <= 10000) IS TRUE OR (o_totalprice IS NULL AND s IS NULL) AS is_close FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def tolerance_diff(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("s"))
    return table(spark, root, "orders").join(s, "o_orderkey", "left").select("o_orderkey", X.close(F.col("o_totalprice"), F.col("s"), 10000.0).alias("is_close"))


@R.query("value_shares", "SELECT diet AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM recipes_structured GROUP BY diet")
def value_shares(spark: SparkSession, root: str) -> DataFrame:
    return L.value_shares(table(spark, root, "recipes_structured"), "diet").select("value", "n", F.round("share", 9).alias("share"))


@R.query("fraction_summary", "SELECT l_orderkey, count(*) AS n_lines, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) / nullif(sum(CASE WHEN l_quantity > 0 THEN l_quantity END), 0), 9) AS returned_fraction, sum(CASE WHEN l_discount > 0.09 THEN l_quantity END) AS deep_quantity FROM lineitem GROUP BY 1")
def fraction_summary(spark: SparkSession, root: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    return table(spark, root, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"),
        F.sum(returned.cast("long")).alias("n_returned"),
        F.round(F.sum(F.when(returned, F.col("l_quantity")).otherwise(0.0)) / F.nullif(F.sum(F.when(F.col("l_quantity") > 0, F.col("l_quantity"))), F.lit(0.0)), 9).alias("returned_fraction"),
        F.sum(F.when(F.col("l_discount") > 0.09, F.col("l_quantity"))).alias("deep_quantity"),
    )


@R.query("nunique_with_null", "SELECT sourcesite, count(DISTINCT split_v3) + max(CASE WHEN split_v3 IS NULL THEN 1 ELSE 0 END) AS n_splits FROM recipes_structured GROUP BY sourcesite")
def nunique_with_null(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "recipes_structured").groupBy("sourcesite").agg(L.distinct_with_null("split_v3").alias("n_splits"))


_SLICES = " UNION ALL ".join(f"SELECT '{s}' AS slice, coalesce({s}, 'UNKNOWN') AS slice_value, '{f}' AS field, CAST({f} AS VARCHAR) AS field_value FROM recipes_structured" for s in ("home_region", "lang_base") for f in ("diet", "split_v3"))


@R.query("slices_with_denominator", f"SELECT *, CAST(sum(n) OVER (PARTITION BY slice, slice_value, field) AS BIGINT) AS denominator FROM (SELECT slice, slice_value, field, field_value, count(*) AS n FROM ({_SLICES}) GROUP BY ALL)")
def slices_with_denominator(spark: SparkSession, root: str) -> DataFrame:
    return L.slices(table(spark, root, "recipes_structured"), ["home_region", "lang_base"], ["diet", "split_v3"])


@R.query("two_grain_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus))")
def two_grain_counts(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders")
    return o.groupingSets([["o_orderstatus", "o_orderpriority"], ["o_orderstatus"]], "o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@R.query("label_confusion", "SELECT lang, tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 9) AS precision, round(tp / nullif(tp + fn, 0), 9) AS recall FROM (SELECT lang, CAST(sum(CASE WHEN a AND b THEN 1 ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN a AND NOT b THEN 1 ELSE 0 END) AS BIGINT) AS fp, CAST(sum(CASE WHEN NOT a AND b THEN 1 ELSE 0 END) AS BIGINT) AS fn, CAST(sum(CASE WHEN NOT a AND NOT b THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM (SELECT lang, coalesce(source = 'blog_recipes', false) AS a, coalesce(contains(text, 'minutes'), false) AS b FROM documents) GROUP BY lang)")
def label_confusion(spark: SparkSession, root: str) -> DataFrame:
    out = L.confusion(table(spark, root, "documents"), ["lang"], F.col("source") == "blog_recipes", F.contains("text", F.lit("minutes")))
    return out.select("lang", "tp", "fp", "fn", "tn", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


_PROFILE = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct, min(CAST({c} AS VARCHAR)) AS example FROM users" for c, t in (("user_id", "bigint"), ("home_region", "string"), ("diet", "string"), ("spice_pref", "string")))


@R.query("profile_table", _PROFILE)
def profile_table(spark: SparkSession, root: str) -> DataFrame:
    return L.profile(table(spark, root, "users").drop("joined_at"))


@R.query("melt_to_history", "SELECT recipe_id, field, 'g1' AS generation, try_cast(v AS DOUBLE) AS value_num, CASE WHEN try_cast(v AS DOUBLE) IS NULL THEN v END AS value_str FROM (SELECT recipe_id, 'split_v3' AS field, split_v3 AS v FROM snapshot_recipe_meta UNION ALL SELECT recipe_id, 'home_region', home_region FROM snapshot_recipe_meta UNION ALL SELECT recipe_id, 'ratingcount', CAST(ratingcount AS VARCHAR) FROM snapshot_recipe_meta) WHERE v IS NOT NULL")
def melt_to_history(spark: SparkSession, root: str) -> DataFrame:
    return L.unpivot_history(table(spark, root, "snapshot_recipe_meta"), "recipe_id", ["split_v3", "home_region", "ratingcount"], "g1")


@R.query("pivot_wide", "SELECT user_id, max(CASE WHEN event_type = 'click' THEN n END) AS click, max(CASE WHEN event_type = 'view' THEN n END) AS view, max(CASE WHEN event_type = 'purchase' THEN n END) AS purchase FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id")
def pivot_wide(spark: SparkSession, root: str) -> DataFrame:
    counts = table(spark, root, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return L.pivot_complete(counts, "user_id", "event_type", "n", ["click", "view", "purchase"])


@R.query("class_grid", "SELECT c_custkey, unnest(['milk', 'egg', 'soy']) AS class FROM customer")
def class_grid(spark: SparkSession, root: str) -> DataFrame:
    return L.grid(table(spark, root, "customer"), "c_custkey", ["milk", "egg", "soy"])


@R.query("union_distinct_edges", "SELECT 'nation::' || c_nationkey AS head, 'has_customer' AS rel, 'customer::' || c_custkey AS tail FROM customer UNION SELECT 'nation::' || s_nationkey, 'has_supplier', 'supplier::' || s_suppkey FROM supplier UNION SELECT 'region::' || n_regionkey, 'has_nation', 'nation::' || n_nationkey FROM nation")
def union_distinct_edges(spark: SparkSession, root: str) -> DataFrame:
    def edge(t: str, head: str, h: str, rel: str, tail: str, k: str) -> DataFrame:
        return table(spark, root, t).select(F.concat(F.lit(f"{head}::"), h).alias("head"), F.lit(rel).alias("rel"), F.concat(F.lit(f"{tail}::"), k).alias("tail"))

    return edge("customer", "nation", "c_nationkey", "has_customer", "customer", "c_custkey").unionByName(edge("supplier", "nation", "s_nationkey", "has_supplier", "supplier", "s_suppkey")).unionByName(edge("nation", "region", "n_regionkey", "has_nation", "nation", "n_nationkey")).distinct()


@R.query("group_crosses_partition", "SELECT title_normalized, count(DISTINCT split_v3) AS n_splits, count(*) AS n FROM recipes_structured WHERE trim(coalesce(title_normalized, '')) <> '' GROUP BY 1 HAVING count(DISTINCT split_v3) > 1")
def group_crosses_partition(spark: SparkSession, root: str) -> DataFrame:
    titled = table(spark, root, "recipes_structured").where(~X.is_blank(F.col("title_normalized")))
    return titled.groupBy("title_normalized").agg(F.countDistinct("split_v3").alias("n_splits"), F.count("*").alias("n")).where("n_splits > 1")


@R.query("median_by_group", "SELECT difficulty, median(preptimemins) AS med, round(quantile_cont(cooktimemins, 0.9), 6) AS p90, count(*) AS n FROM recipes_structured WHERE diet = 'Vegan' AND servings_num > 2 GROUP BY difficulty")
def median_by_group(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured").where((F.col("diet") == "Vegan") & (F.col("servings_num") > 2))
    return r.groupBy("difficulty").agg(F.median("preptimemins").alias("med"), F.round(F.percentile("cooktimemins", 0.9), 6).alias("p90"), F.count("*").alias("n"))


@R.query("group_members", "SELECT home_region, diet, array_to_string(list(CAST(user_id AS VARCHAR) ORDER BY user_id), ',') AS members FROM users GROUP BY home_region, diet")
def group_members(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "users").groupBy("home_region", "diet").agg(F.array_join(F.transform(F.sort_array(F.collect_list("user_id")), lambda x: x.cast("string")), ",").alias("members"))


@R.query("mode_per_group", "SELECT sourcesite, arg_min(home_region, struct_pack(a := -n, b := home_region)) AS modal_region FROM (SELECT sourcesite, home_region, count(*) AS n FROM recipes_structured WHERE home_region IS NOT NULL GROUP BY ALL) GROUP BY sourcesite")
def mode_per_group(spark: SparkSession, root: str) -> DataFrame:
    counts = table(spark, root, "recipes_structured").where("home_region IS NOT NULL").groupBy("sourcesite", "home_region").agg(F.count("*").alias("n"))
    return counts.groupBy("sourcesite").agg(F.min_by("home_region", F.struct(-F.col("n"), "home_region")).alias("modal_region"))


@R.query("group_nunique_on_rows", "SELECT recipe_id, coalesce(n, 0) AS n_splits_in_family FROM recipes_structured r LEFT JOIN (SELECT dup_family_id, count(DISTINCT split_v3) AS n FROM recipes_structured WHERE dup_family_id IS NOT NULL GROUP BY 1) USING (dup_family_id)")
def group_nunique_on_rows(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured").select("recipe_id", "dup_family_id", "split_v3")
    n = r.where("dup_family_id IS NOT NULL").groupBy("dup_family_id").agg(F.countDistinct("split_v3").alias("n"))
    return r.join(n, "dup_family_id", "left").select("recipe_id", F.coalesce("n", F.lit(0)).alias("n_splits_in_family"))


@R.query("fk_orphans", "SELECT i.user_id, count(*) AS n FROM interactions i WHERE i.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = i.user_id) GROUP BY 1")
def fk_orphans(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "interactions").where("user_id IS NOT NULL").join(table(spark, root, "users"), "user_id", "left_anti").groupBy("user_id").agg(F.count("*").alias("n"))


@R.query("intersect_ids", "SELECT recipe_id FROM interactions INTERSECT SELECT recipe_id FROM documents")
def intersect_ids(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "interactions").select("recipe_id").intersect(table(spark, root, "documents").select("recipe_id"))


@R.query("snapshot_crosswalk", "WITH a AS (SELECT snapshot_recipe_id AS k, max(recipename) AS v FROM snapshot_recipe_meta WHERE snapshot_id = (SELECT min(snapshot_id) FROM snapshot_recipe_meta) GROUP BY 1), b AS (SELECT snapshot_recipe_id AS k, max(recipename) AS v FROM snapshot_recipe_meta WHERE snapshot_id = (SELECT max(snapshot_id) FROM snapshot_recipe_meta) GROUP BY 1) SELECT coalesce(a.k, b.k) AS snapshot_recipe_id, CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' ELSE 'both' END AS side, a.v IS DISTINCT FROM b.v AS name_changed FROM a FULL JOIN b ON a.k = b.k")
def snapshot_crosswalk(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "snapshot_recipe_meta")
    ends = F.broadcast(s.agg(F.min("snapshot_id").alias("_a"), F.max("snapshot_id").alias("_b")))
    tagged = s.join(ends, (F.col("snapshot_id") == F.col("_a")) | (F.col("snapshot_id") == F.col("_b"))).where("snapshot_recipe_id IS NOT NULL")
    last = F.col("snapshot_id") == F.col("_b")
    both = tagged.groupBy("snapshot_recipe_id").agg(F.max(F.when(~last, F.col("recipename"))).alias("a"), F.max(F.when(last, F.col("recipename"))).alias("b"), F.max((~last).cast("int")).alias("in_a"), F.max(last.cast("int")).alias("in_b"))
    side = F.when(F.col("in_b") == 0, "left_only").when(F.col("in_a") == 0, "right_only").otherwise("both")
    return both.select("snapshot_recipe_id", side.alias("side"), X.changed(F.col("a"), F.col("b")).alias("name_changed"))


@R.query("semi_join_live", "SELECT doc_id, recipe_id FROM documents WHERE recipe_id IN (SELECT recipe_id FROM recipes_structured WHERE split_v3 = 'train')")
def semi_join_live(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", "recipe_id").join(table(spark, root, "recipes_structured").where("split_v3 = 'train'"), "recipe_id", "left_semi")


@R.query("composite_join_checks", "SELECT a.user_id, a.event_index, a.n AS n_rows, b.r AS max_rating, a.n > 1 AS repeated FROM (SELECT user_id, event_index, count(*) AS n FROM interactions GROUP BY ALL) a JOIN (SELECT user_id, event_index, max(rating) AS r FROM interactions GROUP BY ALL) b ON a.user_id = b.user_id AND a.event_index = b.event_index")
def composite_join_checks(spark: SparkSession, root: str) -> DataFrame:
    i = table(spark, root, "interactions").where("user_id IS NOT NULL AND event_index IS NOT NULL")
    return i.groupBy("user_id", "event_index").agg(F.count("*").alias("n_rows"), F.max("rating").alias("max_rating")).withColumn("repeated", F.col("n_rows") > 1)
