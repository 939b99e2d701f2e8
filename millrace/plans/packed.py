"""Queries over packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.packed import LABELS, LISTS, explode_packed
from millrace.plans.registry import Registry
from millrace.session import table

R = Registry()


@R.query("p3_found")
def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """recipe_id, field_name, item_pos, item: the values of every field that holds two or more."""
    return explode_packed(table(spark, root, "recipes_structured"), ["recipe_id"], {"ingredientslist": LISTS, "allergens_v2": LABELS}, at_least=2)
