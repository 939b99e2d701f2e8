"""Queries over audits of texts, names, ids and simulated logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import audits as A
from millrace.operators.packed import LISTS, unpack
from millrace.plans.logs import simulated_choices
from millrace.plans.registry import Registry
from millrace.session import table

R = Registry()

#: Patterns of the queries here, written for the tables' own sentences.
METHOD = {
    "intermediate_title": r"\b(?:relish|paste|dressing|syrup|crust)\b", "intermediate_use": r"\bsave (?:it|this) for the\b|\bspread it over\b", "finish": r"\b(?:serve|golden|thickens|feast|store)\b",
    "liquid": r"\b(?:wine|juice|broth|milk)\b", "add_liquid": r"\b(?:loosen it with|pour over|fold in)\b", "negator": r"\b(?:nobody|without|instead of|leave out)\s(?:\w+\s){0,2}$", "consistency": r"\b(?:coat|loosen|smooth|sets?)\w*", "solid": r"\b(?:rest|chill|froze|toast)\w*",
}


@R.query("method_flags")
def method_flags(spark: SparkSession, root: str) -> DataFrame:
    """Flags of every document's text, read as a method, with the list of its recipe."""
    d, r = table(spark, root, "documents"), table(spark, root, "recipes_structured").select("recipe_id", "recipename", unpack("ingredientslist", LISTS).alias("items"))
    joined = d.select("doc_id", "recipe_id", "text").join(r, "recipe_id", "left")
    return joined.select("doc_id", A.method_flags(F.col("text"), F.col("recipename"), F.col("items"), METHOD).alias("f")).select("doc_id", "f.*")


@R.query("text_observations", "SELECT doc_id, CASE WHEN source IS NULL THEN 'unknown' WHEN trim(coalesce(text, '')) = '' THEN 'partial' ELSE 'complete' END AS completeness, CASE WHEN source IS NULL OR lang IS NULL THEN 'unknown' WHEN lang IN ('en', 'de') THEN 'supported' ELSE 'not_supported' END AS language, CASE WHEN source IS NULL THEN 'input_unavailable' WHEN trim(coalesce(text, '')) = '' THEN 'input_missing_in_source' WHEN coalesce(lang, '') NOT IN ('en', 'de') THEN 'language_not_supported' ELSE 'observed' END AS reason FROM documents")
def text_observations(spark: SparkSession, root: str) -> DataFrame:
    d = table(spark, root, "documents")
    seen = A.observe_text(F.col("text"), F.col("lang"), F.col("source").isNotNull(), ("en", "de"))
    return d.select("doc_id", seen.alias("o")).select("doc_id", "o.completeness", "o.language", "o.reason")


@R.query("candidate_names", "SELECT name, count(*) AS n FROM (SELECT unnest(regexp_extract_all(coalesce(text, ''), '(?:^|[^\\p{L}])(?:Thanks to|by)[ ]+(\\p{Lu}[\\p{L}’''-]+)', 1)) AS name FROM documents) GROUP BY name ORDER BY n DESC, name LIMIT 20")
def candidate_names(spark: SparkSession, root: str) -> DataFrame:
    return A.candidate_names(table(spark, root, "documents"), "text", ["by", "Thanks to"], 20)


@R.query("ids_in_text", "SELECT id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(list_distinct(regexp_split_to_array(coalesce(text, ''), '[\\s,;|\"]+'))) AS id FROM documents) WHERE id IN (SELECT CAST(p_partkey AS VARCHAR) FROM part) GROUP BY id")
def ids_in_text(spark: SparkSession, root: str) -> DataFrame:
    return A.ids_in_text(table(spark, root, "documents"), "text", table(spark, root, "part").select("p_partkey"))


@R.query("simulated_choices_verified", "SELECT * FROM (VALUES ('incomplete user', 2), ('repeated item', 1), ('unknown item', 1), ('impossible chance', 1)) t(\"check\", n)")
def simulated_choices_verified(spark: SparkSession, root: str) -> DataFrame:
    """A simulated log with planted faults: a lost choice, one told twice, an item that there isn't, a chance above one."""
    log = simulated_choices(spark, root)
    of = lambda u, k: (F.col("user_id") == u) & (F.col("event_index") == k)
    kept = log.where(~of(7, 3)).unionByName(log.where(of(9, 0)))
    log = kept.withColumn("p_partkey", F.when(of(10, 0), F.lit(-5)).otherwise(F.col("p_partkey"))).withColumn("probability", F.when(of(11, 0), F.lit(1.5)).otherwise(F.col("probability")))
    return A.choice_problems(log, "user_id", "p_partkey", "event_index", 20, table(spark, root, "part").select("p_partkey"), "probability")


@R.query("labels_with_parents", "SELECT recipe_id, array_to_string(list_sort(list_distinct(list_concat(t, CASE WHEN list_contains(t, 'ghee') THEN ['milk'] ELSE [] END))), ';') AS labels FROM (SELECT recipe_id, list_distinct(string_split(lower(allergens_v2), ';')) AS t FROM recipes_structured WHERE allergens_v2 IS NOT NULL)")
def labels_with_parents(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured").where("allergens_v2 IS NOT NULL")
    tokens = F.array_distinct(F.split(F.lower("allergens_v2"), ";"))
    return r.select("recipe_id", F.array_join(A.with_parents(tokens, {"ghee": "milk"}), ";").alias("labels"))
