"""Queries over full snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.snapshots import snapshot_changes
from millrace.plans.registry import Registry
from millrace.session import table

R = Registry()

COMPARED = ("recipe_id", "recipename", "home_region", "split_v3", "dup_family_id", "ratingcount")

_CHANGES = """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY snapshot_id, snapshot_recipe_id ORDER BY delivered_at DESC NULLS LAST,
    recipe_id DESC NULLS LAST, recipename DESC NULLS LAST, home_region DESC NULLS LAST, split_v3 DESC NULLS LAST,
    dup_family_id DESC NULLS LAST, ratingcount DESC NULLS LAST) AS rn
  FROM snapshot_recipe_meta WHERE snapshot_id IS NOT NULL AND snapshot_recipe_id IS NOT NULL),
rows_ AS (SELECT * FROM ranked WHERE rn = 1),
ids AS (SELECT snapshot_id, lead(snapshot_id) OVER (ORDER BY snapshot_id) AS next_id
        FROM (SELECT DISTINCT snapshot_id FROM rows_)),
before AS (SELECT i.next_id AS sid, r.* FROM rows_ r JOIN ids i USING (snapshot_id) WHERE i.next_id IS NOT NULL),
after AS (SELECT r.snapshot_id AS sid, r.* FROM rows_ r JOIN ids i ON i.next_id = r.snapshot_id)
SELECT coalesce(a.sid, b.sid) AS snapshot_id, coalesce(a.snapshot_recipe_id, b.snapshot_recipe_id) AS snapshot_recipe_id,
  CASE WHEN b.sid IS NULL THEN 'added' WHEN a.sid IS NULL THEN 'removed' ELSE 'changed' END AS change_kind{extra}
FROM after a FULL JOIN before b ON a.sid = b.sid AND a.snapshot_recipe_id = b.snapshot_recipe_id
WHERE a.sid IS NULL OR b.sid IS NULL OR a.recipe_id IS DISTINCT FROM b.recipe_id OR a.recipename IS DISTINCT FROM b.recipename
  OR a.home_region IS DISTINCT FROM b.home_region OR a.split_v3 IS DISTINCT FROM b.split_v3
  OR a.dup_family_id IS DISTINCT FROM b.dup_family_id OR a.ratingcount IS DISTINCT FROM b.ratingcount
"""


def _changes(spark: SparkSession, root: str, keep: tuple[str, ...]) -> DataFrame:
    return snapshot_changes(table(spark, root, "snapshot_recipe_meta"), "snapshot_id", "snapshot_recipe_id", "delivered_at", COMPARED, keep)


@R.query("p5_found", _CHANGES.format(extra=""))
def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """snapshot_id, snapshot_recipe_id, change_kind."""
    return _changes(spark, root, ())


@R.query("p5_changes", _CHANGES.format(extra=",\n  CASE WHEN a.sid IS NULL THEN b.recipe_id ELSE a.recipe_id END AS recipe_id"))
def p5_changes(spark: SparkSession, root: str) -> DataFrame:
    """The changes with the recipe_id of each record."""
    return _changes(spark, root, ("recipe_id",))
