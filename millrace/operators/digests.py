"""Digests of tables that don't depend on row order, and of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def logical_digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (rows, digest): the same for the same rows in any order and partitioning, repeats counted.

    The digest adds two 64-bit hashes of every row in wide decimals, so it is built by partial aggregation without a sort.
    """
    cs = [F.col(c) for c in columns or sorted(df.columns)]
    marked = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in cs]
    a, b = F.xxhash64(*marked, F.lit(1)), F.xxhash64(*marked, F.lit(2))
    sums = df.agg(F.count("*").alias("rows"), F.sum(a.cast("decimal(38,0)")).alias("a"), F.sum(b.cast("decimal(38,0)")).alias("b"))
    return sums.select("rows", F.sha2(F.concat_ws("|", F.col("rows").cast("string"), F.coalesce(F.col("a"), F.lit(0)).cast("string"), F.coalesce(F.col("b"), F.lit(0)).cast("string")), 256).alias("digest"))


def group_digest(df: DataFrame, by: Sequence[str], line: str, prefix: str = "") -> DataFrame:
    """Per group the SHA-256 of its sorted lines joined by commas; meant for groups whose lines fit one row."""
    return df.groupBy(*by).agg(F.concat(F.lit(prefix), F.sha2(F.array_join(F.sort_array(F.collect_list(line)), ","), 256)).alias("digest"))


def file_digests(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, length, sha256 and whether the file begins as Parquet does."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), (F.substring("content", 1, 4) == F.lit(b"PAR1")).alias("is_parquet"))


def manifest_problems(actual: DataFrame, declared: DataFrame) -> DataFrame:
    """path, problem (missing, undeclared, differs) of two tables of path and sha256."""
    a, d = actual.select("path", F.col("sha256").alias("a")), declared.select("path", F.col("sha256").alias("d"))
    problem = F.when(F.col("a").isNull(), "missing").when(F.col("d").isNull(), "undeclared").when(F.col("a") != F.col("d"), "differs")
    return a.join(d, "path", "full_outer").select("path", problem.alias("problem")).where(F.col("problem").isNotNull())
