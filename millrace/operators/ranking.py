"""Ranks, splits, quotas and sampling, all with a total order and seeds that depend on keys alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.prefix import unit_hash


def percentile_rank(df: DataFrame, c: str, out: str, missing: float = 0.5) -> DataFrame:
    """Mean rank of equal values divided by the number of values; null rows get missing.

    Ranks come from counts per distinct value, so only distinct values are ever ordered, in ranges over the cluster.
    """
    counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_v")).agg(F.count("*").alias("_n"))
    ranged = counts.repartitionByRange("_v").withColumn("_p", F.spark_partition_id())
    blocks = ranged.groupBy("_p").agg(F.sum("_n").alias("_s"), F.min("_v").alias("_least"))
    start = blocks.select("_p", (F.sum("_s").over(Window.orderBy("_least")) - F.col("_s")).alias("_start"), F.sum("_s").over(Window.partitionBy()).alias("_all"))
    below = F.coalesce(F.sum("_n").over(Window.partitionBy("_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = ranged.join(F.broadcast(start), "_p").select("_v", ((F.col("_start") + below + (F.col("_n") + 1) / 2) / F.col("_all")).alias("_rank"))
    return df.join(ranks, F.col(c) == F.col("_v"), "left").withColumn(out, F.coalesce("_rank", F.lit(missing))).drop("_v", "_rank")


def temporal_split(df: DataFrame, user: str, order: Sequence[str], share: float = 0.2, out: str = "split") -> DataFrame:
    """train or test by user: the last share of the user's rows (rounded half to even, at least 1, never all) is test."""
    w, all_rows = Window.partitionBy(user).orderBy(*order), Window.partitionBy(user)
    n = F.count("*").over(all_rows)
    held = F.least(F.greatest(F.lit(1), F.bround(n * share).cast("long")), n - 1)
    return df.withColumn(out, F.when(F.row_number().over(w) > n - held, "test").otherwise("train"))


def quota_bands(df: DataFrame, user: str, order: Sequence[Column], shares: Sequence[tuple[int, float]], rest: int, out: str = "rating") -> DataFrame:
    """Ratings by rank within a user: each (rating, share) takes bround(share * n) rows in turn, the remainder gets rest."""
    w, n = Window.partitionBy(user).orderBy(*order), F.count("*").over(Window.partitionBy(user))
    rank, upto, band = F.row_number().over(w), F.lit(0), None
    for rating, share in shares:
        upto = upto + F.bround(n * share)
        hit = rank <= upto
        band = F.when(hit, rating) if band is None else band.when(hit, rating)
    return df.withColumn(out, band.otherwise(rest) if band is not None else F.lit(rest))


def stratified_round_robin(df: DataFrame, cell: Sequence[str], key: str, n: int) -> DataFrame:
    """n rows, taken in turns from the cells in the order of the SHA-256 of the key; a null cell value is a cell of its own."""
    w = Window.partitionBy(*cell).orderBy(F.sha2(F.col(key).cast("string"), 256), F.col(key))
    turn = df.withColumn("_turn", F.row_number().over(w) - 1).where(F.col("_turn") < n)
    return turn.orderBy("_turn", F.sha2(F.col(key).cast("string"), 256), key).limit(n).withColumnRenamed("_turn", "turn")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """Per key the columns of its first row by order; an aggregate with partial results, no sort."""
    return df.groupBy(*key).agg(F.min_by(F.struct(*keep), F.struct(*order)).alias("_f")).select(*key, *[F.col(f"_f.{c}").alias(c) for c in keep])


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """The first k rows of every group (planned with a limit per group before the shuffle)."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(out) <= k)


def softmax(df: DataFrame, by: Sequence[str], score: str, out: str, temperature: float = 1.0) -> DataFrame:
    """exp(score / temperature) over its sum in the group, steady for large scores; null scores give null and count nothing."""
    peak = df.groupBy(*by).agg(F.max(score).alias("_m"))
    e = F.exp((F.col(score) - F.col("_m")) / temperature)
    lifted = df.join(peak, list(by)).withColumn("_e", e)
    sums = lifted.groupBy(*by).agg(F.sum("_e").alias("_s"))
    return lifted.join(sums, list(by)).withColumn(out, F.col("_e") / F.col("_s")).drop("_m", "_e", "_s")


def seeded_order(key: Column, seed: int) -> Column:
    """A pseudo-random sort key that is the same for a key whatever the partitions."""
    return F.xxhash64(key, F.lit(seed))


def gumbel_top_k(df: DataFrame, by: Sequence[str], key: str, weight: str, k: int, seed: int) -> DataFrame:
    """k rows per group without replacement, with chances in proportion to weight (Gumbel top-k); weights not above 0 are never drawn."""
    g = F.log(F.col(weight)) - F.log(-F.log(unit_hash(F.col(key), *[F.col(b) for b in by], F.lit(seed))))
    return top_k(df.where(F.col(weight) > 0).withColumn("_g", g), by, [F.col("_g").desc(), F.col(key)], k, "draw").drop("_g")


def weighted_choice(df: DataFrame, key: str, weights: Sequence[tuple[str, float]], seed: int, out: str) -> DataFrame:
    """One category per row, with replacement, by cumulated weights; depends on key and seed alone."""
    whole, u = sum(w for _, w in weights), unit_hash(F.col(key), F.lit(seed))
    at, choice = 0.0, None
    for name, w in weights[:-1]:
        at += w / whole
        choice = F.when(u < at, name) if choice is None else choice.when(u < at, name)
    return df.withColumn(out, F.lit(weights[-1][0]) if choice is None else choice.otherwise(weights[-1][0]))
