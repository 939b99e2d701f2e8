"""Running totals and hot keys without any group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: At most this many keys can each hold one part in HOT_PARTS of all rows, so a table of such keys is small by proof.
HOT_PARTS = 2_000


def unit_hash(*columns: Column) -> Column:
    """A uniform number in (0, 1) that depends on the values alone, never on the partition."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + 0.5) / F.lit(float(2**53))


def running_total(df: DataFrame, groups: Sequence[str], at: str, ties: Sequence[str], value: str, out: str, *, bins: int = 4096) -> DataFrame:
    """Adds out: the sum of value over the rows of the group that come no later by (at, ties).

    at lies in [0, 1]. Each group is cut into bins of at; a small table holds the sum of each bin (at most groups x bins rows), and
    rows are ordered only within their bin, so no group is ever sorted in one task. Null values count as 0.
    """
    cut = df.withColumn("_bin", F.least(F.lit(bins - 1), F.floor(F.col(at) * bins).cast("int")))
    sums = cut.groupBy(*groups, "_bin").agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("_sum"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.partitionBy(*groups).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    renamed = before.select(*[F.col(g).alias(f"_g_{i}") for i, g in enumerate(groups)], F.col("_bin").alias("_b"), "_before")
    on = [F.col(g).eqNullSafe(F.col(f"_g_{i}")) for i, g in enumerate(groups)] + [F.col("_bin") == F.col("_b")]
    joined = cut.join(renamed, on)
    within = Window.partitionBy(*groups, "_bin").orderBy(at, *ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.withColumn(out, F.col("_before") + F.sum(F.coalesce(F.col(value), F.lit(0))).over(within)).drop("_bin", "_b", "_before", *[f"_g_{i}" for i in range(len(groups))])


def hot_join(left: DataFrame, right: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """Join on a key of which one value may hold a large part of left; right has each key once, with its rows in left in count.

    Keys with at least one part in HOT_PARTS of all rows are at most HOT_PARTS by proof: they are joined by broadcast, in place. The
    others are joined by shuffle. how: inner or left. Null keys match nothing. right should be cheap to read twice.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    least = max(1, -(-total // HOT_PARTS))
    hot = right.where(F.col(count) >= least)
    cold = right.where(F.col(count) < least)
    met = left.join(F.broadcast(hot), key, "inner")
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return met.unionByName(rest)
