"""Queries over row sums, percentiles, names, dates and wide surfaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import scalar as X
from millrace.operators import evidence as E
from millrace.plans.quality import CLASSES, _evidence_sql, evidence_grid
from millrace.plans.registry import Registry
from millrace.session import table

R = Registry()


@R.query("row_sums", "SELECT recipe_id, CASE WHEN preptimemins IS NOT NULL OR cooktimemins IS NOT NULL THEN coalesce(preptimemins, 0) + coalesce(cooktimemins, 0) END AS minutes FROM recipes_structured")
def row_sums(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "recipes_structured").select("recipe_id", X.row_sum("preptimemins", "cooktimemins").alias("minutes"))


@R.query("linear_percentiles", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem GROUP BY 1")
def linear_percentiles(spark: SparkSession, root: str) -> DataFrame:
    p = lambda q: F.round(F.percentile("l_extendedprice", q), 6)
    return table(spark, root, "lineitem").groupBy("l_returnflag").agg(p(0.25).alias("p25"), p(0.9).alias("p90"))


@R.query("names_without_suffixes", "SELECT recipe_id, trim(regexp_replace(trim(regexp_replace(lower(recipename), '\\s+', ' ', 'g')), '((^| )(recipe|easy|quick|style))+$', '')) AS name FROM recipes_structured")
def names_without_suffixes(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "recipes_structured").select("recipe_id", X.without_suffixes(F.col("recipename"), ["recipe", "easy", "quick", "style"]).alias("name"))


@R.query("days_after_base", "SELECT l_orderkey, l_linenumber, CAST(DATE '2020-01-31' + l_linenumber AS DATE) AS day FROM lineitem")
def days_after_base(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", X.date_after("2020-01-31", F.col("l_linenumber")).alias("day"))


@R.query("wide_surface", f"WITH g AS ({_evidence_sql()}) SELECT recipe_id, " + ", ".join(f"bool_or(class = '{c}' AND legacy_status = 'present') AS {c}, bool_or(class = '{c}' AND legacy_status = 'unassessed') AS {c}_unassessed" for c in CLASSES if c != "fish") + ", bool_or(class IN ('fish', 'egg') AND legacy_status = 'present') AS fish, bool_or(class = 'fish' AND legacy_status = 'unassessed') AS fish_unassessed FROM g GROUP BY recipe_id")
def wide_surface(spark: SparkSession, root: str) -> DataFrame:
    """Flags of every recipe; egg is told as derived from fish, to show the closure."""
    return E.wide_surface(evidence_grid(spark, root), "recipe_id", "legacy_status", {c: "fish" if c == "egg" else None for c in CLASSES})


@R.query("wide_self_test", "SELECT * FROM (VALUES ('fewer than in the grid', 0), ('token without its parent', 0)) t(\"check\", n)")
def wide_self_test(spark: SparkSession, root: str) -> DataFrame:
    grid = evidence_grid(spark, root)
    tokens = {c: "fish" if c == "egg" else None for c in CLASSES}
    return E.wide_problems(E.wide_surface(grid, "recipe_id", "legacy_status", tokens), grid, "recipe_id", "legacy_status", tokens)
