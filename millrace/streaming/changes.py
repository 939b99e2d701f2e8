"""Streaming forms of row-local and windowed operators (an extension; batches give the same rows)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.evidence import lexicon_match


def lexicon_stream(events: DataFrame, text: str, at: str, lexicon: Mapping[str, tuple[str, str | None]], window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """start, class, n: texts with a term of each class per window of event time; rows later than late are dropped by the watermark."""
    hits = F.array_compact(F.array(*[F.when(lexicon_match(F.col(text), p, n), F.lit(c)) for c, (p, n) in lexicon.items()]))
    rows = events.select(F.col(at).alias("_at"), F.explode(hits).alias("class")).withWatermark("_at", late)
    return rows.groupBy(F.window("_at", window), "class").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "class", "n")


def event_counts(events: DataFrame, at: str, kind: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """start, kind, n per window of event time."""
    rows = events.select(F.col(at).alias("_at"), F.col(kind).alias("kind")).withWatermark("_at", late)
    return rows.groupBy(F.window("_at", window), "kind").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "kind", "n")


def first_deliveries(events: DataFrame, key: str, at: str, late: str = "1 day") -> DataFrame:
    """The first arrival of every key within the watermark, repeats dropped."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])
