"""Changes between full snapshots of a table, by gaps and islands over (key, row hash)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalar import row_digest

#: Deliveries up to this number are numbered on the driver and broadcast; beyond it they are numbered by a join.
MAX_LISTED = 10_000


def latest_rows(df: DataFrame, snapshot: str, key: str, delivered: str, compared: Sequence[str]) -> DataFrame:
    """One row per (snapshot, key): the one delivered last.

    Ties of the delivery time are settled by the largest row of the compared columns, so the result doesn't depend on row
    order. A null delivery time counts as the earliest. Rows without snapshot or key belong to no record and are left out.
    Partial aggregation runs before the shuffle, so a key that holds a third of all rows costs one row per map task.
    """
    return (
        df.where(F.col(snapshot).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(snapshot).alias("_s"), F.col(key).alias("_k"))
        .agg(F.max(F.struct(F.col(delivered).alias("_d"), *[F.col(c).alias(c) for c in compared])).alias("_r"))
        .select("_s", "_k", *[F.col(f"_r.`{c}`").alias(c) for c in compared])
    )


def _numbered(df: DataFrame, source: DataFrame, snapshot: str) -> tuple[DataFrame, Column]:
    """Adds _n, the number of the snapshot in delivery order from 1; and gives the number of the last one."""
    ids = source.select(F.col(snapshot).alias("_s")).where(F.col("_s").isNotNull()).distinct()
    listed = [r[0] for r in ids.limit(MAX_LISTED + 1).collect()]
    spark = df.sparkSession
    if len(listed) <= MAX_LISTED:
        listed.sort()
        numbers = spark.createDataFrame([(s, i + 1) for i, s in enumerate(listed)], f"_s {ids.dtypes[0][1]}, _n int")
        return df.join(F.broadcast(numbers), "_s"), F.lit(len(listed))
    numbers = ids.withColumn("_n", F.row_number().over(Window.orderBy("_s"))).withColumn("_last", F.count("*").over(Window.partitionBy()))
    return df.join(numbers, "_s"), F.col("_last")


def validity_intervals(df: DataFrame, snapshot: str, key: str, delivered: str, compared: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Per key the maximal runs of consecutive snapshots in which its row stayed the same.

    Columns: _k (key), _from and _to (snapshot numbers), _prev_to and _next_from (of the key's neighbouring intervals), _last
    (number of the last snapshot), and the keep columns as of the interval's first and last row (first_<c>, last_<c>).
    The shuffle by key carries only the hash of the compared columns; the one before it carries them as they stand, since they settle
    ties of the delivery time. Null equals null.
    """
    rows, last = _numbered(latest_rows(df, snapshot, key, delivered, list(dict.fromkeys([*compared, *keep]))), df, snapshot)
    slim = rows.select("_k", "_n", last.alias("_last"), row_digest(*compared).alias("_h"), *[F.col(c).alias(f"_v_{c}") for c in keep])
    w = Window.partitionBy("_k").orderBy("_n")
    fresh = F.coalesce(F.lag("_n").over(w) != F.col("_n") - 1, F.lit(True)) | (F.lag("_h").over(w) != F.col("_h"))
    runs = slim.withColumn("_fresh", fresh.cast("int")).withColumn("_run", F.sum("_fresh").over(w))
    spans = runs.groupBy("_k", "_run").agg(
        F.min("_n").alias("_from"),
        F.max("_n").alias("_to"),
        F.max("_last").alias("_last"),
        *[F.min_by(f"_v_{c}", "_n").alias(f"first_{c}") for c in keep],
        *[F.max_by(f"_v_{c}", "_n").alias(f"last_{c}") for c in keep],
    )
    by = Window.partitionBy("_k").orderBy("_from")
    return spans.select("*", F.lag("_to").over(by).alias("_prev_to"), F.lead("_from").over(by).alias("_next_from"))


def snapshot_changes(df: DataFrame, snapshot: str, key: str, delivered: str, compared: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Records added, removed or changed from each snapshot to the next: snapshot, key, change_kind and the keep columns.

    The snapshot named is the later one; the first gives no rows. A record that returns after an absence is added. The keep
    columns come from the later row, for removed records from the last row before. One snapshot or an empty table gives no rows.
    """
    spans = validity_intervals(df, snapshot, key, delivered, compared, keep)
    starts = F.when(F.col("_from") > 1, F.struct(F.col("_from").alias("n"), F.when(F.col("_prev_to") == F.col("_from") - 1, "changed").otherwise("added").alias("kind")))
    gone = (F.col("_to") < F.col("_last")) & (F.col("_next_from").isNull() | (F.col("_next_from") > F.col("_to") + 1))
    ends = F.when(gone, F.struct((F.col("_to") + 1).alias("n"), F.lit("removed").alias("kind")))
    events = spans.select("*", F.explode(F.array_compact(F.array(starts, ends))).alias("_e"))
    out = events.select(
        F.col("_e.n").alias("_n"),
        F.col("_k").alias(key),
        F.col("_e.kind").alias("change_kind"),
        *[F.when(F.col("_e.kind") == "removed", F.col(f"last_{c}")).otherwise(F.col(f"first_{c}")).alias(c) for c in keep],
    )
    names = df.select(F.col(snapshot).alias("_s")).where(F.col("_s").isNotNull()).distinct()
    numbers, _ = _numbered(names, df, snapshot)
    small = names.limit(MAX_LISTED + 1).count() <= MAX_LISTED
    numbers = numbers.select("_n", F.col("_s").alias(snapshot))
    return out.join(F.broadcast(numbers) if small else numbers, "_n").drop("_n").select(snapshot, key, "change_kind", *keep)
