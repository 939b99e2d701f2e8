"""Reproducible simulation of choices: every user draws from streams of their own, so any partitioning gives the same log."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.audits import calibrated_mu
from millrace.operators.prefix import unit_hash


def draw_groups(sizes: Sequence[int], utilities: np.ndarray, rng: np.random.Generator, n: int, switch: int | None = None, later: np.ndarray | None = None) -> list[tuple[int, int, float]]:
    """n draws without replacement of items in groups of equal utility: (group, place of the item among those left, probability).

    The chance of an item is exp(utility) over the sum for all items left, which needs the groups alone. From draw switch on the later
    utilities hold. More draws than items raise.
    """
    left = np.array(sizes, float)
    if n > left.sum():
        raise ValueError(f"{n} draws of {int(left.sum())} items")
    out = []
    for k in range(n):
        u = utilities if switch is None or k < switch else later
        mass = np.exp(u - u[left > 0].max()) * left
        p = mass / mass.sum()
        g = int(np.searchsorted(np.cumsum(p), rng.random(), side="right"))
        g = min(g, len(p) - 1)
        while left[g] <= 0:
            g -= 1
        out.append((g, int(rng.integers(int(left[g]))), float(p[g] / left[g])))
        left[g] -= 1
    return out


def simulate_choices(spark: SparkSession, items: DataFrame, item: str, features: Sequence[str], users: int, draws: int, seed: int, weights: Mapping[str, float]) -> DataFrame:
    """user_id, event_index, item, probability: each user's draws by the match of item features with the user's tastes.

    Items are grouped by their features (sorted, so input order doesn't matter); the groups, not the items, are what is scored. The
    item table must fit a broadcast (checked: at most 5 million items); a user's random stream depends on (seed, user) alone.
    """
    n_items = items.count()
    if n_items > 5_000_000:
        raise ValueError("more than 5 million items")
    grouped = items.select(*features, item).toPandas().sort_values([*features, item], key=lambda c: c.map(lambda v: "" if v is None else str(v)) if c.name != item else c)
    groups = [(k if isinstance(k, tuple) else (k,), g[item].to_numpy()) for k, g in grouped.groupby(list(features), dropna=False, sort=True)]
    kinds = [sorted({str(k[i]) for k, _ in groups}) for i in range(len(features))]
    codes = np.array([[kinds[i].index(str(k[i])) for i in range(len(features))] for k, _ in groups])
    shared = spark.sparkContext.broadcast(([len(v) for _, v in groups], codes, [v for _, v in groups]))
    w = [weights[f] for f in features]
    sizes_of = [len(k) for k in kinds]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes, code, members = shared.value
        for batch in batches:
            rows = []
            for user in batch["id"]:
                taste = np.random.default_rng([seed, int(user), 0])
                likes = [int(taste.integers(n)) for n in sizes_of]
                u = sum(w[i] * (code[:, i] == likes[i]) for i in range(len(w)))
                rng, gone = np.random.default_rng([seed, int(user), 1]), {}
                for k, (g, place, p) in enumerate(draw_groups(sizes, u.astype(float), rng, draws)):
                    taken = gone.setdefault(g, [])
                    at = place
                    for t in sorted(taken):
                        at += at >= t
                    taken.append(at)
                    rows.append((int(user), k, members[g][at], p))
            yield pd.DataFrame(rows, columns=["user_id", "event_index", item, "probability"])

    return spark.range(users).mapInPandas(run, f"user_id long, event_index int, {item} {dict(items.dtypes)[item]}, probability double")


def activity_counts(df: DataFrame, key: str, mean: float, sigma: float, low: int, high: int, seed: int, out: str = "n") -> DataFrame:
    """A lognormal count per key, rounded and within bounds, of which mean is the expected value."""
    u1, u2 = unit_hash(F.col(key), F.lit(seed)), unit_hash(F.col(key), F.lit(seed + 1))
    normal = F.sqrt(-2 * F.log(u1)) * F.cos(2 * 3.141592653589793 * u2)
    mu = calibrated_mu(mean, sigma, low, high)
    return df.withColumn(out, F.greatest(F.lit(low), F.least(F.lit(high), F.round(F.exp(F.lit(mu) + sigma * normal)).cast("int"))))


def cover_all(df: DataFrame, key: str, category: str, wanted: Sequence[str]) -> DataFrame:
    """Gives every wanted category that no row has to one row, the smallest keys first; other rows stay."""
    have = {r[0] for r in df.select(category).where(F.col(category).isin(*wanted)).distinct().collect()}
    lacking = [w for w in wanted if w not in have]
    if not lacking:
        return df
    keys = [r[0] for r in df.select(key).distinct().orderBy(key).limit(len(lacking)).collect()]
    out = F.col(category)
    for k, w in zip(keys, lacking, strict=False):
        out = F.when(F.col(key) == k, F.lit(w)).otherwise(out)
    return df.withColumn(category, out)
