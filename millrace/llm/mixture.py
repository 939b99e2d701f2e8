"""Mixing sources to target shares of all tokens: Efraimidis-Spirakis keys, complete epochs, then a prefix of the order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.registry import R
from millrace.llm.tokens import TOKENIZERS, token_count
from millrace.operators.prefix import running_total, unit_hash
from millrace.session import cut, table

SEED = 20260
#: Weights are told apart by this ratio where the positions of keys are worked out; it only evens out the tasks.
RATIO = 1.25
#: What a weight that is null, not a number or not above zero counts as: such documents come last.
LAST = 1e-9


def quality(text: str) -> Column:
    """Weight of a document in (0, 1] from its text alone: the share of letters, digits and blanks, times how far its words and lines
    are different ones, times how near the length of its words is to that of language, less for very short texts; 0.01 at least."""
    t = F.coalesce(F.col(text), F.lit(""))
    plain = F.regexp_replace(t, r"[^\p{L}\p{M}\p{N}\s]", "")
    words = F.filter(F.split(F.lower(plain), r"\s+"), lambda w: w != "")
    lines = F.filter(F.split(t, r"\n"), lambda x: F.trim(x) != "")
    n = F.greatest(F.size(words), F.lit(1))
    shape = F.when((F.length(plain) / n).between(3, 12), 1.0).otherwise(0.5)
    score = F.length(plain) / F.greatest(F.length(t), F.lit(1)) * F.sqrt(F.size(F.array_distinct(words)) / n) * (F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1))) * shape * (n / (n + F.lit(10)))
    return F.greatest(F.lit(0.01), F.coalesce(score, F.lit(0.0)))


def _sized(docs: DataFrame, names: DataFrame, key: str, source: str, text: str, weight: Column | None, path: str, tokenizer: str) -> DataFrame:
    """Documents with tokens, weight w and the exponential key e = -ln(u) / w."""
    w = quality(text) if weight is None else weight.cast("double")
    w = F.when(w.isNull() | F.isnan(w) | (w <= 0), F.lit(LAST)).otherwise(w)
    kept = docs.select(F.col(key).alias("k"), F.col(source).alias("source"), F.col(text).alias("text"), w.alias("w")).join(names, "source", "left_semi")
    e = -F.log(unit_hash(F.col("k"), F.xxhash64("text"), F.lit(SEED))) / F.col("w")
    return kept.select("k", "source", token_count("text", path, tokenizer).alias("n_tokens"), "w", e.alias("e")).where("n_tokens > 0")


def positions(sized: DataFrame) -> DataFrame:
    """Adds at, in [0, 1]: the part of its source's documents whose key is expected to be no greater, from the weights of them all.

    It rises with the key, so it keeps the order, and is spread evenly whatever the weights, so equal bins of it hold about as many
    documents each.
    """
    step = math.log(RATIO)
    counts = sized.groupBy("source", F.floor(F.log("w") / step).alias("_b")).agg(F.count("*").alias("_n"))
    shares = counts.groupBy("source").agg(F.collect_list(F.struct(F.exp((F.col("_b") + 0.5) * step).alias("w"), F.col("_n").cast("double").alias("n"))).alias("_w"), F.sum("_n").cast("double").alias("_all"))
    left = F.aggregate("_w", F.lit(0.0), lambda a, x: a + x["n"] * F.exp(-x["w"] * F.col("e")))
    return sized.join(shares, "source").withColumn("at", F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - left / F.col("_all")))).drop("_w", "_all")


def mixture(docs: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", *, weight: Column | None = None, total: int | None = None, path: str = TOKENIZERS, tokenizer: str = "byte_bpe_50k") -> tuple[DataFrame, DataFrame]:
    """The chosen documents (key, source, repeats, n_tokens) and the plan per source (budget, epochs, rest).

    targets: source, target_share, max_repeats. Without total, the mixture is the largest that keeps every share with no document
    used more than max_repeats times. A source's budget is its share of the total; as many complete epochs as fit come first, then
    documents in the order of exponential keys scaled by weight (by default quality) while their running sum stays within what is left,
    so each source falls short of its budget by less than one document. Documents of no target source, with null source or without
    tokens are not chosen. A target source without tokens is reported with 0 and leaves its share to the others in proportion. An empty
    corpus gives no rows. Any number of sources: the plan is worked out by joins.
    """
    names = targets.select("source").where("source IS NOT NULL").distinct()
    sized = cut(_sized(docs, names, key, source, text, weight, path, tokenizer))
    supply = sized.groupBy("source").agg(F.sum("n_tokens").alias("supply"))
    there = cut(targets.select("source", "target_share", F.col("max_repeats").cast("long").alias("most")).where("target_share > 0 AND most > 0").join(supply, "source"))
    whole = there.agg(F.sum("target_share")).first()[0] or 1.0
    share = F.col("target_share") / F.lit(whole)
    largest = there.agg(F.min(F.col("most") * F.col("supply") / share)).first()[0] or 0
    size = largest if total is None else min(total, largest)
    budget = F.least(F.floor(F.lit(float(size)) * share + 1e-9).cast("long"), F.col("most") * F.col("supply"))
    epochs = F.expr("budget div supply")
    plan = there.withColumn("budget", budget).withColumn("epochs", epochs).withColumn("rest", F.when(F.col("epochs") < F.col("most"), F.col("budget") - F.col("epochs") * F.col("supply")).otherwise(F.lit(0))).select("source", "budget", "epochs", "rest")
    ordered = running_total(positions(sized), ["source"], "at", ["e", "k", "n_tokens"], "n_tokens", "_run").join(plan, "source")
    repeats = F.col("epochs") + (F.col("_run") <= F.col("rest")).cast("long")
    chosen = ordered.select(F.col("k").alias(key), "source", repeats.cast("int").alias("repeats"), "n_tokens").where("repeats > 0")
    return chosen, plan


def mixture_shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, docs, tokens, actual_share: what the mixture reached; sources without documents have 0."""
    got = chosen.groupBy("source").agg(F.count("*").alias("docs"), F.sum(F.col("repeats") * F.col("n_tokens")).alias("tokens"), F.max("repeats").alias("most_repeats"))
    full = targets.select("source", "target_share").join(got, "source", "left").withColumn("_all", F.sum("tokens").over(Window.partitionBy()))  # one row a source
    return full.select("source", "target_share", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.coalesce(F.col("tokens") / F.col("_all"), F.lit(0.0)).alias("actual_share"))


@R.query("p9_mixture")
def p9_mixture(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, source, repeats, n_tokens of the chosen documents."""
    return mixture(table(spark, root, "documents"), table(spark, root, "mix_targets"))[0]


@R.query("p9_shares")
def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    """The share of all tokens that each source reached, beside its target."""
    targets = table(spark, root, "mix_targets")
    return mixture_shares(mixture(table(spark, root, "documents"), targets)[0], targets)
