"""Association of items in baskets: pointwise mutual information, contrast, regional lift, substitution."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def basket_pairs(rows: DataFrame, basket: str, item: str, *, by: Sequence[str] = (), min_count: int = 1) -> DataFrame:
    """by, a, b (a before b), cooccur, n_a, n_b, n: baskets with both, with either, and all baskets (per by).

    An item counts once per basket; null items and baskets not at all. Items in fewer than min_count baskets are left out before
    pairs are made, which loses no pair of at least that support; pairs are made within a basket's row and added up before the
    shuffle.
    """
    clean = rows.where(F.col(basket).isNotNull() & F.col(item).isNotNull()).select(*by, basket, item).distinct()
    baskets = clean.select(*by, basket).distinct()
    single = clean.groupBy(*by, item).agg(F.count("*").alias("c")).where(F.col("c") >= min_count)
    kept = clean.join(single, [*by, item], "left_semi").groupBy(*by, basket).agg(F.sort_array(F.collect_list(item)).alias("v")).where(F.size("v") > 1)
    inner = F.flatten(F.transform("v", lambda x, i: F.transform(F.slice(F.col("v"), i + 2, F.greatest(F.size("v") - i - 1, F.lit(0))), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    pairs = kept.select(*by, F.explode(inner).alias("p")).groupBy(*by, F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("cooccur")).where(F.col("cooccur") >= min_count)
    a = single.withColumnsRenamed({item: "a", "c": "n_a"})
    b = single.withColumnsRenamed({item: "b", "c": "n_b"})
    out = pairs.join(a, [*by, "a"]).join(b, [*by, "b"])
    if by:
        return out.join(baskets.groupBy(*by).agg(F.count("*").alias("n")), list(by))
    return out.withColumn("n", F.lit(baskets.count()).cast("long"))


def pmi(pairs: DataFrame) -> DataFrame:
    """Adds pmi (log2 of observed over expected), npmi, expected."""
    value = F.log2(F.col("cooccur") * F.col("n") / (F.col("n_a").cast("double") * F.col("n_b")))
    share = -F.log2(F.col("cooccur") / F.col("n"))
    return pairs.withColumn("pmi", value).withColumn("npmi", F.when(share > 0, value / share).otherwise(1.0)).withColumn("expected", F.col("n_a").cast("double") * F.col("n_b") / F.col("n"))


def pairings(pairs: DataFrame, min_support: int, min_pmi: float, top: int) -> DataFrame:
    """item, partner, cooccur, pmi, npmi, rank: the best partners of every item, both ways round (ties: more baskets, then name)."""
    good = pmi(pairs).where((F.col("cooccur") >= min_support) & (F.col("pmi") >= min_pmi))
    both = good.select(F.col("a").alias("item"), F.col("b").alias("partner"), "cooccur", "pmi", "npmi").unionByName(good.select(F.col("b").alias("item"), F.col("a").alias("partner"), "cooccur", "pmi", "npmi"))
    w = Window.partitionBy("item").orderBy(F.round("pmi", 9).desc(), F.desc("cooccur"), "partner")
    return both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def avoided(rows: DataFrame, basket: str, item: str, min_expected: float, max_pmi: float) -> DataFrame:
    """a, b, cooccur, expected, pmi of pairs far rarer than by chance, never seen together included (pmi null).

    Only items with count squared over all baskets at or above the expected floor can be in such a pair with each other's greatest
    partner; the list of such items is bounded by the floor, and pairs are made among them alone.
    """
    clean = rows.where(F.col(basket).isNotNull() & F.col(item).isNotNull()).select(basket, item).distinct()
    n = clean.select(basket).distinct().count()
    single = clean.groupBy(item).agg(F.count("*").alias("c"))
    most = single.agg(F.max("c")).first()[0] or 0
    able = single.where(F.col("c") * F.lit(most) >= min_expected * n)
    # items meet by size class: an item goes to every class that holds partners large enough for it
    sized = able.toDF("b", "n_b").withColumn("size", F.floor(F.log2("n_b")).cast("int"))
    least = F.floor(F.log2(F.lit(float(max(min_expected * n, 1e-9))) / F.col("n_a"))).cast("int")
    top = int(math.log2(most)) if most else 0
    reach = able.toDF("a", "n_a").withColumn("size", F.explode(F.sequence(F.least(F.greatest(least, F.lit(0)), F.lit(top)), F.lit(top))))
    grid = reach.join(sized, "size").where((F.col("a") < F.col("b")) & (F.col("n_a") * F.col("n_b") >= min_expected * n))
    seen = basket_pairs(rows, basket, item).select("a", "b", "cooccur")
    joined = grid.join(seen, ["a", "b"], "left").withColumn("cooccur", F.coalesce("cooccur", F.lit(0))).withColumn("expected", F.col("n_a") * F.col("n_b") / F.lit(float(n)))
    value = F.when(F.col("cooccur") > 0, F.log2(F.col("cooccur") / F.col("expected")))
    return joined.withColumn("pmi", value).where(F.col("pmi").isNull() | (F.col("pmi") <= max_pmi)).select("a", "b", "cooccur", "expected", "pmi")


def regional(rows: DataFrame, basket: str, item: str, region: str, min_support: int, min_pmi: float, top: int) -> DataFrame:
    """region, a, b, cooccur, pmi, lift_over_all, tier, rank: pairs of a region against the pairs of all."""
    local = pmi(basket_pairs(rows.where(F.col(region).isNotNull()), basket, item, by=[region], min_count=min_support))
    whole = pmi(basket_pairs(rows, basket, item)).select("a", "b", F.col("pmi").alias("_all"))
    good = local.where((F.col("cooccur") >= min_support) & (F.col("pmi") >= min_pmi)).join(whole, ["a", "b"], "left")
    w = Window.partitionBy(region).orderBy(F.round("pmi", 9).desc(), F.desc("cooccur"), "a", "b")
    ranked = good.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    counts = ranked.groupBy(region).agg(F.count("*").alias("_n"))
    tier = F.when(F.col("_n") >= 100, "strong").when(F.col("_n") >= 20, "medium").otherwise("weak")
    return ranked.join(counts, region).select(region, "a", "b", "cooccur", "pmi", (F.col("pmi") - F.col("_all")).alias("lift_over_all"), tier.alias("tier"), "rank")


def substitutes(pairs: DataFrame, category: DataFrame, item: str, group: str, top: int) -> DataFrame:
    """item, other, score, rank: cosine of positive PMI vectors times 1 less the pair's own PMI rank, within a category.

    category gives each item's group. Vectors meet over their common contexts only.
    """
    value = pmi(pairs).where("pmi > 0")
    long = value.select(F.col("a").alias("x"), F.col("b").alias("ctx"), "pmi").unionByName(value.select(F.col("b").alias("x"), F.col("a").alias("ctx"), "pmi"))
    norm = long.groupBy("x").agg(F.sqrt(F.sum(F.col("pmi") * F.col("pmi"))).alias("norm"))
    cat = category.select(F.col(item).alias("x"), F.col(group).alias("g"))
    v = long.join(norm, "x").join(cat, "x")
    dot = v.alias("l").join(v.alias("r"), (F.col("l.ctx") == F.col("r.ctx")) & (F.col("l.g") == F.col("r.g")) & (F.col("l.x") != F.col("r.x"))).groupBy(F.col("l.x").alias("item"), F.col("r.x").alias("other")).agg((F.sum(F.col("l.pmi") * F.col("r.pmi")) / F.max(F.col("l.norm") * F.col("r.norm"))).alias("cosine"))
    own = long.select(F.col("x").alias("item"), F.col("ctx").alias("other"), "pmi")
    most = own.groupBy("item").agg(F.max("pmi").alias("most"))
    scored = dot.join(own, ["item", "other"], "left").join(most, "item", "left").withColumn("score", F.col("cosine") * (1 - F.coalesce(F.col("pmi") / F.col("most"), F.lit(0.0))))
    w = Window.partitionBy("item").orderBy(F.round("score", 9).desc(), "other")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("item", "other", "score", "rank")
