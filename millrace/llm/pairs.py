"""Items that appear together: stripes of co-occurring neighbours with log-likelihood ratios.

Every task keeps, per item, an associative array of the neighbours it has met, and sends these stripes when they grow large; after
the shuffle the arrays of an item are merged in one pass over its sorted stripes. The stripe of an item that is in many records is
sent in parts by the hash of the neighbour, so that no task gets all of it.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.registry import R
from millrace.operators.packed import LISTS, unpack
from millrace.session import cut, table

#: Frequent items up to this number are sent to all tasks to leave rare ones out early; beyond it every item is kept until the end.
MAX_LISTED = 200_000
#: Pairs that a task gathers before it merges them into its stripes, and cells of its stripes before it sends them.
CHUNK, CELLS = 2_000_000, 4_000_000
#: An item in at least one part in HOT of all records has its stripe sent in so many PARTS; there are at most HOT times the mean number
#: of items of a record of them.
HOT, PARTS = 100, 32


def _stripes(batches: Iterator[pa.RecordBatch], keep: dict[str, int] | None, hot: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """item, part, neighbours, counts: each task's stripes, an item's neighbours being those after it by code point."""
    names: list[str] = sorted(keep, key=keep.get) if keep is not None else []
    codes: dict[str, int] = dict(keep or {})
    waiting: list[np.ndarray] = []
    size = 0
    cells, totals = np.empty(0, np.int64), np.empty(0, np.int64)

    def merge() -> None:
        nonlocal cells, totals, waiting, size
        if not waiting:
            return
        new, n = np.unique(np.concatenate(waiting), return_counts=True)
        both, at = np.unique(np.concatenate([cells, new]), return_inverse=True)
        totals = np.bincount(at, np.concatenate([totals, n]), len(both)).astype(np.int64)
        cells, waiting, size = both, [], 0

    def send() -> Iterator[pa.RecordBatch]:
        nonlocal cells, totals
        merge()
        left, right = cells >> 32, cells & 0xFFFFFFFF
        starts = np.flatnonzero(np.r_[True, left[1:] != left[:-1]]) if len(left) else np.empty(0, np.int64)
        ends = np.r_[starts[1:], len(left)] if len(starts) else starts
        rows: tuple[list, ...] = ([], [], [], [])
        for s, e in zip(starts, ends, strict=True):
            item, others, n = names[left[s]], right[s:e], totals[s:e]
            part = np.array([zlib.crc32(names[x].encode("utf-8", "surrogatepass")) % PARTS for x in others]) if item in hot else np.zeros(len(others), np.int64)
            for k in np.unique(part):
                for column, value in zip(rows, (item, int(k), [names[x] for x in others[part == k]], n[part == k]), strict=True):
                    column.append(value)
            if len(rows[0]) >= 2000:
                yield _batch(rows)
                rows = ([], [], [], [])
        yield _batch(rows)
        cells, totals = np.empty(0, np.int64), np.empty(0, np.int64)
        if keep is None:
            names.clear()
            codes.clear()

    for batch in batches:
        for record in batch.column(0).to_pylist():
            items = sorted({x for x in record or () if x is not None and (keep is None or x in keep)})
            if len(items) < 2:
                continue
            for x in items:
                if x not in codes:
                    codes[x] = len(names)
                    names.append(x)
            own = np.array([codes[x] for x in items], np.int64)
            if len(own) <= 256:
                i, j = np.triu_indices(len(own), 1)
                waiting.append((own[i] << 32) | own[j])
                size += len(i)
            else:  # one neighbour array at a time, so a very long record needs little memory
                for i in range(len(own) - 1):
                    waiting.append((own[i] << 32) | own[i + 1 :])
                    size += len(own) - 1 - i
                    if size > CHUNK:
                        merge()
                        if len(cells) > CELLS:
                            yield from send()
            if size > CHUNK:
                merge()
            if len(cells) > CELLS:
                yield from send()
    yield from send()


def _batch(rows: tuple[list, ...]) -> pa.RecordBatch:
    types = (pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=["item", "part", "neighbours", "counts"])


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The arrays of every run of one item and part merged by key, without neighbours met fewer than least times."""
    now: tuple[str, int] | None = None
    sums: Counter[str] = Counter()
    rows: tuple[list, ...] = ([], [], [], [])

    def close() -> None:
        kept = {x: n for x, n in sums.items() if n >= least}
        if now is not None and kept:
            for column, value in zip(rows, (*now, list(kept), list(kept.values())), strict=True):
                column.append(value)
        sums.clear()

    for batch in batches:
        for item, part, neighbours, counts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (item, part) != now:
                close()
                now = (item, part)
                if len(rows[0]) >= 2000:
                    yield _batch(rows)
                    rows = ([], [], [], [])
            for x, n in zip(neighbours, counts, strict=True):
                sums[x] += n
    close()
    yield _batch(rows)


def log_likelihood_ratio(both: Column, a: Column, b: Column, n: Column) -> Column:
    """G2 of the 2x2 table of two items in n records, from counts alone."""

    def part(k: Column, row: Column, col: Column) -> Column:
        return F.when(k > 0, k * (F.log(k.cast("double")) + F.log(n.cast("double")) - F.log(row.cast("double")) - F.log(col.cast("double")))).otherwise(0.0)

    return 2 * (part(both, a, b) + part(a - both, a, n - b) + part(b - both, n - a, b) + part(n - a - b + both, n - a, n - b))


def co_occurrence(records: DataFrame, items: str, *, min_count: int = 4, min_share: float = 0.0) -> DataFrame:
    """item_a, item_b, c_ab, c_a, c_b, n, lift, llr of every pair together in at least max(min_count, min_share * n) records.

    records has an array<string> column of items; an item counts once per record, null items never. n counts the records with at
    least one item. item_a comes before item_b by code point. Null and empty arrays add nothing; without records there are no rows.
    Only items frequent enough themselves can be in such a pair, so rarer ones are left out first; no pair is lost by it. With
    min_share > 0 their number is at most (mean items per record) / min_share, whatever the corpus.
    """
    rows = cut(records.select(F.array_distinct(F.filter(F.col(items), lambda x: x.isNotNull())).alias("items")).where(F.size("items") > 0))
    n = rows.count()
    least = max(min_count, 1, math.ceil(min_share * n - 1e-6))
    single = rows.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("c")).where(F.col("c") >= least)
    listed = single.limit(MAX_LISTED + 1).collect()
    spark = records.sparkSession
    if len(listed) <= MAX_LISTED:
        shared = spark.sparkContext.broadcast({r[0]: i for i, r in enumerate(listed)})
        counts = F.broadcast(spark.createDataFrame(listed, "item string, c long"))
    else:
        shared, counts = None, single
    often = math.ceil(n / HOT)
    hot = spark.sparkContext.broadcast(frozenset(r[0] for r in (listed if shared else single.where(F.col("c") >= often).collect()) if r[1] >= often))
    schema = "item string, part int, neighbours array<string>, counts array<long>"
    stripes = rows.mapInArrow(lambda it: _stripes(it, shared.value if shared else None, hot.value), schema)
    merged = stripes.repartition("item", "part").sortWithinPartitions("item", "part").mapInArrow(lambda it: _merged(it, least), schema)
    pairs = merged.select(F.col("item").alias("item_a"), F.explode(F.arrays_zip("neighbours", "counts")).alias("z")).select("item_a", F.col("z.neighbours").alias("item_b"), F.col("z.counts").alias("c_ab"))
    a, b = (counts.select(F.col("item").alias(f"item_{x}"), F.col("c").alias(f"c_{x}")) for x in "ab")
    full = pairs.join(a, "item_a").join(b, "item_b").withColumn("n", F.lit(n).cast("long"))
    lift = F.col("c_ab") * F.col("n") / (F.col("c_a").cast("double") * F.col("c_b"))
    return full.select("item_a", "item_b", "c_ab", "c_a", "c_b", "n", lift.alias("lift"), log_likelihood_ratio(F.col("c_ab"), F.col("c_a"), F.col("c_b"), F.col("n")).alias("llr"))


def _ingredients(spark: SparkSession, root: str) -> DataFrame:
    lists = table(spark, root, "recipes_structured").select(unpack("ingredientslist", LISTS).alias("v"))
    return lists.select(F.transform("v", F.lower).alias("items"))


#: Critical value of the chi-squared distribution with one degree of freedom at 0.001.
SIGNIFICANT = 10.828


@R.query("p1_pairs")
def p1_pairs(spark: SparkSession, root: str) -> DataFrame:
    """All pairs in at least four recipes whose log-likelihood ratio is significant, with their counts and lift."""
    return co_occurrence(_ingredients(spark, root), "items", min_count=4).where(F.col("llr") >= SIGNIFICANT)


@R.query("p1_found")
def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """item_a, item_b: in at least 4 recipes and N/250 of them, at least twice as often as by chance.

    The likelihood ratio takes no part: of fewer than some thousand recipes the definition takes pairs that aren't significant, of more
    all that it takes are.
    """
    pairs = co_occurrence(_ingredients(spark, root), "items", min_count=4, min_share=1 / 250)
    twice = F.col("c_ab") * F.col("n") >= 2 * F.col("c_a") * F.col("c_b")
    return pairs.where((F.col("c_ab") * 250 >= F.col("n")) & twice).select("item_a", "item_b")
