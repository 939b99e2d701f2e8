"""Further queries: sources, casts, text functions, ledgers, metadata and validators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import scalar as X
from millrace.functions import text as T
from millrace.operators import contracts as C
from millrace.operators import digests as D
from millrace.operators import ledgers as G
from millrace.operators import relational as L
from millrace.plans.registry import Registry
from millrace.session import shared_dir, table
from millrace.sources import readers, sinks
from millrace.streaming.changes import event_counts

R = Registry()


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


@R.query("tsv_round_trip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def tsv_round_trip(spark: SparkSession, root: str) -> DataFrame:
    path = _scratch(spark, "tsv")
    sinks.write_csv(table(spark, root, "nation"), path, sep="\t")
    return readers.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int", sep="\t")


@R.query("id_map_round_trip", "SELECT 'item:' || p_name || ' ' || p_partkey AS org_id, p_partkey AS remap_id FROM part")
def id_map_round_trip(spark: SparkSession, root: str) -> DataFrame:
    path = _scratch(spark, "ids")
    part = table(spark, root, "part")
    sinks.write_id_map(part.select(F.concat(F.lit("item:"), "p_name", F.lit(" "), "p_partkey").alias("n"), "p_partkey"), "n", "p_partkey", path)
    return readers.read_id_map(spark, path)


@R.query("projected_filtered_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag IN ('R', 'N') AND l_linestatus <> 'F' AND l_quantity BETWEEN 10 AND 20")
def projected_filtered_scan(spark: SparkSession, root: str) -> DataFrame:
    l = table(spark, root, "lineitem")
    return l.where(F.col("l_returnflag").isin("R", "N") & (F.col("l_linestatus") != "F") & F.col("l_quantity").between(10, 20)).select("l_orderkey", "l_quantity")


@R.query("lenient_and_strict_casts", "SELECT recipe_id, try_cast(split_part(url, '/r/', 2) AS DOUBLE) AS url_number, try_cast(recipename AS DOUBLE) AS name_number, CAST(dup_family_id AS BIGINT) AS family, CASE WHEN allergen_scan_incomplete IS NULL THEN 'unknown' WHEN allergen_scan_incomplete THEN 'yes' ELSE 'no' END AS incomplete FROM recipes_structured")
def lenient_and_strict_casts(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured")
    return r.select("recipe_id", X.lenient_number(F.split_part("url", F.lit("/r/"), F.lit(2))).alias("url_number"), X.lenient_number(F.col("recipename")).alias("name_number"), X.strict_integer(F.col("dup_family_id")).alias("family"), X.tri_state(F.col("allergen_scan_incomplete")).alias("incomplete"))


@R.query("column_routing", "SELECT recipe_id, servings_num, preptimemins, cooktimemins FROM recipes_structured")
def column_routing(spark: SparkSession, root: str) -> DataFrame:
    """The columns that routing by pattern sends to the table of numbers."""
    r = table(spark, root, "recipes_structured")
    routes = L.route_columns(r.columns, {"numbers": r"(?:_num|mins)$", "labels": r"^(?:diet|difficulty|split)"}, "rest")
    return r.select("recipe_id", *routes["numbers"])


@R.query("dropped_and_renamed", "SELECT user_id AS id, home_region AS region, diet FROM users")
def dropped_and_renamed(spark: SparkSession, root: str) -> DataFrame:
    return L.rename_all(table(spark, root, "users").drop("spice_pref", "joined_at"), {"user_id": "id", "home_region": "region"})


@R.query("agreeing_aliases", "SELECT recipe_id, ratingaverage / 5 AS fraction, ratingaverage IS NOT NULL AS available FROM recipes_structured")
def agreeing_aliases(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured").select("recipe_id", (F.col("ratingaverage") / 5).alias("old_fraction"), (F.col("ratingaverage") / 5).alias("fraction"))
    return G.one_name(r, "old_fraction", "fraction", 0.0, 1.0).withColumn("available", F.col("fraction").isNotNull())


@R.query("blank_and_suffix_filters", "SELECT recipe_id FROM recipes_structured WHERE trim(coalesce(recipename, '')) <> '' AND (ends_with(url, '7') OR starts_with(recipename, 'Slow')) AND regexp_matches(recipename, '(?i)halwa|pie')")
def blank_and_suffix_filters(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured")
    return r.where(~X.is_blank(F.col("recipename")) & (F.col("url").endswith("7") | F.col("recipename").startswith("Slow")) & F.col("recipename").rlike("(?i)halwa|pie")).select("recipe_id")


@R.query("ordinal_and_scaled", "SELECT recipe_id, CAST(CASE difficulty WHEN 'easy' THEN 1.0 WHEN 'medium' THEN 0.5 WHEN 'hard' THEN 0.0 ELSE 0.5 END AS DOUBLE) AS ease, round(ln(1 + greatest(coalesce(ratingcount, 0), 0)) / (SELECT max(ln(1 + greatest(coalesce(ratingcount, 0), 0))) FROM recipes_structured), 9) AS popularity, round(1 / power(row_number() OVER (ORDER BY recipe_id), 0.35), 9) AS base FROM recipes_structured")
def ordinal_and_scaled(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured").select("recipe_id", "difficulty", F.log1p(F.greatest(F.coalesce("ratingcount", F.lit(0.0)), F.lit(0.0))).alias("lp"))
    most = r.agg(F.max("lp")).first()[0]
    from millrace.operators.recommend import dense_ids

    ranked = r.join(dense_ids(r, "recipe_id"), "recipe_id")
    ease = F.when(F.col("difficulty") == "easy", 1.0).when(F.col("difficulty") == "hard", 0.0).otherwise(0.5)
    return ranked.select("recipe_id", ease.alias("ease"), F.round(F.col("lp") / F.lit(most), 9).alias("popularity"), F.round(1 / F.pow(F.col("idx") + 1, F.lit(0.35)), 9).alias("base"))


@R.query("quoted_and_urls")
def quoted_and_urls(spark: SparkSession, root: str) -> DataFrame:
    """Quoted passages, URLs and control characters of every document, with a case-folded first line."""
    d = table(spark, root, "documents")
    return d.select("doc_id", T.quoted_spans(F.col("text")).alias("quotes"), T.urls(F.col("text")).alias("urls"), T.has_control(F.col("text")).alias("control"), T.casefolded(F.substring_index("text", "\n", 1)).alias("first_line"))


@R.query("tier_ledger", "WITH a AS (SELECT p_partkey, p_brand || ':' || CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS now, CASE WHEN p_partkey % 5 = 0 THEN 'gone:old;' ELSE '' END || p_brand || ':' || CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS prior FROM part) SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'gone' ELSE '' END AS removed, '' AS added, '' AS moved FROM a")
def tier_ledger(spark: SparkSession, root: str) -> DataFrame:
    tier = F.concat("p_brand", F.lit(":"), F.when(F.col("p_size") > 25, "large").otherwise("small"))
    rows = table(spark, root, "part").select("p_partkey", F.concat(F.when(F.col("p_partkey") % 5 == 0, "gone:old;").otherwise(""), tier).alias("prior"), tier.alias("now"))
    diff = G.tier_changes(rows, "p_partkey", "prior", "now")
    return diff.select("p_partkey", *[F.array_join(c, ",").alias(c) for c in ("removed", "added", "moved")])


@R.query("state_digest")
def state_digest(spark: SparkSession, root: str) -> DataFrame:
    """One digest of a keyed state, whatever the row order."""
    p = table(spark, root, "part").select(F.concat_ws("\t", "p_partkey", F.concat_ws(":", "p_brand", "p_type")).alias("line"))
    return D.logical_digest(p)


@R.query("file_manifest", "SELECT * FROM (VALUES ('differs', 1), ('missing', 1), ('undeclared', 1)) t(problem, n)")
def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Three files against a manifest that leaves out one, names one that isn't there and has a wrong digest of one."""
    path = _scratch(spark, "manifest")
    for name in ("nation", "region", "supplier"):
        table(spark, root, name).coalesce(1).write.parquet(f"{path}/{name}")
    files = D.file_digests(spark, path, "*.parquet").select("path", "sha256")
    declared = files.where(~F.contains("path", F.lit("/nation/"))).withColumn("sha256", F.when(F.contains("path", F.lit("/region/")), F.lit("0")).otherwise(F.col("sha256")))
    lost = spark.createDataFrame([(f"{path}/lost.parquet", "1")], "path string, sha256 string")
    return D.manifest_problems(files, declared.unionByName(lost)).groupBy("problem").agg(F.count("*").cast("int").alias("n"))


@R.query("units_declared")
def units_declared(spark: SparkSession, root: str) -> DataFrame:
    """Numeric columns of lineitem that declare no unit after stamping."""
    stamped = C.with_units(table(spark, root, "lineitem"), {"l_quantity": "piece", "l_discount": "1"}, {"price": "money", "key": "id", "number": "id"})
    return spark.createDataFrame([(c,) for c in C.without_units(stamped)], "column string")


@R.query("schema_rules", "SELECT 'name' AS \"column\", 'too long' AS problem, CAST(sum(CASE WHEN length(recipename) > 60 THEN 1 ELSE 0 END) AS BIGINT) AS n FROM recipes_structured UNION ALL SELECT 'lang', 'null', CAST(sum(CASE WHEN lang IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM recipes_structured UNION ALL SELECT 'lang', 'out of shape', CAST(sum(CASE WHEN lang IS NOT NULL AND NOT regexp_full_match(lang, '[a-z]{2}(?:-[A-Z]{2})?') THEN 1 ELSE 0 END) AS BIGINT) FROM recipes_structured UNION ALL SELECT 'split', 'not allowed', CAST(sum(CASE WHEN split_v3 IS NOT NULL AND split_v3 NOT IN ('train', 'val') THEN 1 ELSE 0 END) AS BIGINT) FROM recipes_structured")
def schema_rules(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured").select(F.col("recipename").alias("name"), "lang", F.col("split_v3").alias("split"))
    return G.schema_violations(r, {"name": {"max_length": 60}, "lang": {"nullable": False, "pattern": "[a-z]{2}(?:-[A-Z]{2})?"}, "split": {"allowed": ["train", "val"]}})


@R.query("exclusion_hits", "SELECT 'orders' AS \"table\", count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_acctbal < 0")
def exclusion_hits(spark: SparkSession, root: str) -> DataFrame:
    gone = table(spark, root, "customer").where("c_acctbal < 0").select("c_custkey")
    return G.exclusion_hits({"orders": (table(spark, root, "orders"), "o_custkey"), "customer": (table(spark, root, "customer"), "c_custkey")}, gone)


@R.query("occurrence_rollup", "SELECT o_orderkey, count(l_orderkey) AS n_lines, CAST(coalesce(sum(CASE WHEN l_quantity > 20 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_large, round(sum(CASE WHEN l_returnflag = 'A' AND l_quantity > 0 THEN l_quantity ELSE 0 END) / nullif(sum(CASE WHEN l_quantity > 0 THEN l_quantity END), 0), 9) AS fraction FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def occurrence_rollup(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    out = G.weighted_fraction(table(spark, root, "orders").select("o_orderkey"), lines, "o_orderkey", F.col("l_quantity"), F.col("l_returnflag") == "A", F.col("l_quantity") > 20)
    return out.select("o_orderkey", "n_lines", "n_large", F.round("fraction", 9).alias("fraction"))


@R.query("error_metrics", "SELECT c_nationkey, count(*) AS n, round(avg(ape), 6) AS mean_ape, round(median(ape), 6) AS median_ape, round(avg(CASE WHEN ape <= 0.25 THEN 1.0 ELSE 0.0 END), 6) AS within_25 FROM (SELECT c_nationkey, abs(o_totalprice - s) / s AS ape FROM orders JOIN customer ON o_custkey = c_custkey JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE s <> 0) GROUP BY 1")
def error_metrics(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("s"))
    o, c = table(spark, root, "orders"), table(spark, root, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return G.percentage_errors(o.join(s, "o_orderkey").join(c, "o_custkey"), ["c_nationkey"], F.col("o_totalprice"), F.col("s"), 0.25)


@R.query("fold_split", "SELECT p_partkey, CASE WHEN f < 18 THEN 'train' WHEN f < 19 THEN 'val' ELSE 'test' END AS split FROM (SELECT p_partkey, (('0x' || substr(sha256(p_name), 1, 8))::UBIGINT) % 20 AS f FROM part)")
def fold_split(spark: SparkSession, root: str) -> DataFrame:
    return G.fold_split(table(spark, root, "part").select("p_partkey", "p_name"), "p_name", {"train": 18, "val": 1, "test": 1}).select("p_partkey", "split")


@R.query("claims_kept", "SELECT recipe_id, diet IS NOT NULL AND NOT coalesce(regexp_matches(lower(ingredientslist), 'salmon|tuna|codfish'), false) AS kept FROM recipes_structured WHERE diet IN ('Vegan', 'Vegetarian')")
def claims_kept(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured").where(F.col("diet").isin("Vegan", "Vegetarian"))
    return r.select("recipe_id", (F.col("diet").isNotNull() & ~F.coalesce(F.lower("ingredientslist").rlike("salmon|tuna|codfish"), F.lit(False))).alias("kept"))


@R.query("family_leaders", "SELECT recipe_id, dup_family_id, CASE WHEN dup_family_id IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY dup_family_id) END AS family_size, dup_family_id IS NULL OR recipe_id = min(recipe_id) OVER (PARTITION BY dup_family_id) AS is_leader FROM recipes_structured")
def family_leaders(spark: SparkSession, root: str) -> DataFrame:
    return G.family_leaders(table(spark, root, "recipes_structured").select("recipe_id", "dup_family_id"), "recipe_id", "dup_family_id")


@R.query("event_windows", "SELECT date_trunc('hour', ts) AS start, event_type AS kind, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, root: str) -> DataFrame:
    """The windowed counts of the streaming form, over the batch."""
    return event_counts(table(spark, root, "events"), "ts", "event_type")


@R.query("user_region_crosswalk", "SELECT u.home_region, count(*) AS n_users, CASE WHEN r.home_region IS NULL THEN 'unreachable' ELSE 'reachable' END AS status FROM (SELECT coalesce(nullif(trim(home_region), ''), 'unknown') AS home_region FROM users) u LEFT JOIN (SELECT DISTINCT home_region FROM recipes_structured WHERE home_region IS NOT NULL) r ON u.home_region = r.home_region GROUP BY ALL")
def user_region_crosswalk(spark: SparkSession, root: str) -> DataFrame:
    users = table(spark, root, "users").select(X.or_unknown(F.trim("home_region")).alias("home_region")).groupBy("home_region").agg(F.count("*").alias("n_users"))
    known = table(spark, root, "recipes_structured").where("home_region IS NOT NULL").select("home_region").distinct().withColumn("_k", F.lit(True))
    return users.join(known, "home_region", "left").select("home_region", "n_users", F.when(F.col("_k").isNull(), "unreachable").otherwise("reachable").alias("status"))


@R.query("embedding_norms")
def embedding_norms(spark: SparkSession, root: str) -> DataFrame:
    """vec_id, norm and mean of every embedding, for range checks."""
    e = table(spark, root, "embeddings")
    sq = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return e.select("vec_id", "label", F.round(F.sqrt(sq), 6).alias("norm"), F.size("embedding").alias("dims"))
