"""Writers: deterministic, guarded, and each with a receipt where asked."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.digests import logical_digest


def guard_output(path: str, protected: Sequence[str]) -> str:
    """The path, if it lies in no protected folder and holds none."""
    p = os.path.realpath(path)
    for q in map(os.path.realpath, protected):
        if os.path.commonpath([p, q]) in (p, q):
            raise ValueError(f"{path} overlaps the protected {q}")
    return path


def write_parquet(df: DataFrame, path: str, *, keys: Sequence[str] = (), level: int = 9, block_bytes: int = 64 << 20) -> None:
    """zstd Parquet, ranged and sorted by the keys where given; Spark's commit makes it appear whole or not at all."""
    if keys:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    df.write.mode("errorifexists").option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).option("parquet.block.size", str(block_bytes)).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("errorifexists").csv(path, header=True, sep=sep, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_adjacency(df: DataFrame, user: str, item: str, path: str) -> None:
    """Lines 'user item item ...' with sorted items."""
    lines = df.groupBy(user).agg(F.array_join(F.transform(F.sort_array(F.collect_set(item)), lambda x: x.cast("string")), " ").alias("i"))
    lines.select(F.concat_ws(" ", F.col(user).cast("string"), "i").alias("value")).write.mode("errorifexists").text(path)


def write_id_map(df: DataFrame, name: str, idx: str, path: str) -> None:
    """Lines 'name id' after a header in the first file."""
    df.select(F.concat_ws(" ", F.col(name).cast("string"), F.col(idx).cast("string")).alias("value")).write.mode("errorifexists").text(path)


def write_triples(df: DataFrame, path: str) -> None:
    df.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in ("head", "rel", "tail")]).alias("value")).write.mode("errorifexists").text(path)


def write_json(report: dict, path: str) -> None:
    """A small report, moved into place when whole."""
    folder = Path(path).parent
    with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, suffix=".part") as f:
        json.dump(report, f, indent=2, sort_keys=True, ensure_ascii=False)
    os.replace(f.name, path)


def receipt(df: DataFrame) -> dict:
    """Rows, columns and logical digest of a table."""
    row = logical_digest(df).first()
    return {"rows": row["rows"], "columns": dict(df.dtypes), "digest": row["digest"]}


def render_markdown(df: DataFrame, title: str, limit: int = 1000) -> str:
    """A small result as a Markdown table; more rows than the limit raise."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows]) + "\n"
