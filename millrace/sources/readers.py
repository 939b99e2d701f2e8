"""Readers for the file forms that the library works on. All give a DataFrame; none collects."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str, *, sep: str = ",", header: bool = True) -> DataFrame:
    """CSV with quoted line ends and doubled quotes, typed by the given schema; the empty text is null."""
    return spark.read.csv(path, schema=schema, header=header, sep=sep, multiLine=True, quote='"', escape='"', enforceSchema=False)


def read_csv_as_text(spark: SparkSession, path: str, columns: list[str], *, sep: str = ",") -> DataFrame:
    """CSV with every value a text and the empty text kept."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = spark.read.csv(path, schema=schema, header=True, sep=sep, multiLine=True, quote='"', escape='"', nullValue="\x00", emptyValue="")
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])


def csv_columns(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The header alone."""
    return spark.read.csv(path, header=True, sep=sep).columns


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a line; a line that is none raises."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """head, rel, tail of lines with three numbers between blanks; other lines raise."""
    parts = F.split(F.trim("value"), r"\s+")
    ok = F.when(F.size(parts) == 3, parts).otherwise(F.raise_error(F.concat(F.lit("no triple: "), F.col("value"))).cast("array<string>"))
    return spark.read.text(path).where(F.trim("value") != "").select(ok.alias("p")).select(*[F.col("p")[i].cast("bigint").alias(n) for i, n in enumerate(("head", "rel", "tail"))])


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    """user, item, one row per item of a line 'user item item ...'; a repeated item gives repeated rows."""
    parts = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).where(F.trim("value") != "").select(parts.alias("p"))
    return lines.select(F.col("p")[0].cast("bigint").alias("user"), F.explode(F.slice("p", F.lit(2), F.greatest(F.size("p") - 1, F.lit(0)))).alias("i")).select("user", F.col("i").cast("bigint").alias("item"))


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """org_id, remap_id: the last field of a line is the id, what goes before may hold blanks; the header and empty lines are left out.

    A repeated name or id raises.
    """
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").rlike(r"^\s*org_id\s+remap_id\s*$"))
    rows = lines.select(F.regexp_extract("value", r"^(.*\S)\s+(\S+)\s*$", 1).alias("org_id"), F.regexp_extract("value", r"^(.*\S)\s+(\S+)\s*$", 2).cast("bigint").alias("remap_id"))
    for c in ("org_id", "remap_id"):
        if rows.groupBy(c).count().where("count > 1").limit(1).count():
            raise ValueError(f"repeated {c} in {path}")
    return rows


def read_pinned(spark: SparkSession, path: str, sha256: str, reader: str = "parquet", **options) -> DataFrame:
    """A single local file, read only if its SHA-256 is the given one."""
    digest = hashlib.sha256()
    with open(path.removeprefix("file://"), "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            digest.update(block)
    if digest.hexdigest() != sha256:
        raise ValueError(f"{path} is not the pinned file")
    return spark.read.format(reader).options(**options).load(path)


def materialised(spark: SparkSession, path: str) -> DataFrame:
    """path, length, is_parquet of every file: whether it is Parquet itself or a stub in its place."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", (F.substring("content", 1, 4) == F.lit(b"PAR1")).alias("is_parquet"))


def footer(path: str) -> tuple[dict[str, str], int]:
    """Column types and row count from a Parquet file's footer."""
    import pyarrow.parquet as pq

    meta = pq.ParquetFile(path)
    return {f.name: str(f.type) for f in meta.schema_arrow}, meta.metadata.num_rows


def read_manifest(path: str) -> dict:
    return json.loads(Path(path).read_text())


def read_yaml(path: str) -> object:
    """A small YAML file on the driver, where a YAML parser is installed."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("no YAML parser is installed") from e
    return yaml.safe_load(Path(path).read_text())


def read_any_parquet(spark: SparkSession, path: str, *, skip_corrupt: bool = False) -> DataFrame:
    """Parquet; with skip_corrupt unreadable files are left out, which is said by file_digests beside it."""
    return spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower()).parquet(path)
