"""Ledgers and validators over several tables: tiers, schemas, exclusions, roll-ups, folds and families."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import tier_map


def one_name(df: DataFrame, old: str, new: str, low: float, high: float) -> DataFrame:
    """df with the new name only; the two must agree where both are there and lie within the bounds, else it raises."""
    x, y = F.col(old), F.col(new)
    value = F.coalesce(y, x)
    differ = x.isNotNull() & y.isNotNull() & (x != y)
    outside = value.isNotNull() & (F.isnan(value) | ~value.between(low, high))
    checked = F.when(differ, F.raise_error(F.lit(f"{old} and {new} disagree")).cast("double")).when(outside, F.raise_error(F.lit(f"{new} out of bounds")).cast("double")).otherwise(value)
    return df.select(*[checked.alias(new) if c == new else F.col(c) for c in df.columns if c != old])


def tier_changes(df: DataFrame, key: str, prior: str, now: str) -> DataFrame:
    """key, removed, added, moved: classes of two 'class:tier;...' texts; a text that is none raises nothing and gives nulls."""
    a, b = tier_map(F.col(prior)), tier_map(F.col(now))
    both = F.array_intersect(F.map_keys(a), F.map_keys(b))
    moved = F.filter(both, lambda k: F.try_element_at(a, k) != F.try_element_at(b, k))
    sort = F.array_sort
    return df.select(key, sort(F.array_except(F.map_keys(a), F.map_keys(b))).alias("removed"), sort(F.array_except(F.map_keys(b), F.map_keys(a))).alias("added"), sort(moved).alias("moved"))


def undeclared_additions(changes: DataFrame, key: str, declared: DataFrame) -> DataFrame:
    """key, class of additions that the declared table (key, class) lacks."""
    return changes.select(key, F.explode("added").alias("class")).join(declared.select(key, "class"), [key, "class"], "left_anti")


def schema_violations(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """column, problem, n by declared rules: nullable, allowed, pattern (of the whole text), max_length; one pass.

    Nulls violate nullable: False alone. Missing columns raise.
    """
    missing = [c for c in rules if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    cells = []
    for c, rule in rules.items():
        x, text = F.col(c), F.col(c).cast("string")
        checks = []
        if not rule.get("nullable", True):
            checks.append(("null", x.isNull()))
        if "allowed" in rule:
            checks.append(("not allowed", ~x.isin(*rule["allowed"])))
        if "pattern" in rule:
            checks.append(("out of shape", ~text.rlike(rf"\A(?:{rule['pattern']})\z")))
        if "max_length" in rule:
            checks.append(("too long", F.length(text) > rule["max_length"]))
        cells += [F.struct(F.lit(c).alias("column"), F.lit(p).alias("problem"), F.coalesce(F.sum(F.coalesce(v, F.lit(False)).cast("long")), F.lit(0)).alias("n")) for p, v in checks]
    return df.agg(F.array(*cells).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def exclusion_hits(tables: Mapping[str, tuple[DataFrame, str]], gone: DataFrame) -> DataFrame:
    """table, n: rows of each table whose key is excluded (gone has one column); namespaced keys like 'type::7' count by their id."""
    g = gone.select(F.col(gone.columns[0]).cast("string").alias("_g")).where("_g IS NOT NULL").distinct()
    out = None
    for name, (df, key) in tables.items():
        ident = F.regexp_replace(F.col(key).cast("string"), r"^.*::", "")
        one = df.select(ident.alias("_g")).join(g, "_g", "left_semi").agg(F.lit(name).alias("table"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def weighted_fraction(parents: DataFrame, lines: DataFrame, key: str, weight: Column, part: Column, flagged: Column) -> DataFrame:
    """key, n_lines, n_large (flagged lines), fraction (weight of the part over all positive weight) for every parent.

    A parent without lines has counts of 0 and a null fraction; so has one without positive weight.
    """
    w = F.when(weight > 0, weight)
    sums = lines.groupBy(key).agg(F.count("*").alias("n_lines"), F.sum(F.coalesce(flagged, F.lit(False)).cast("long")).alias("n_large"), F.sum(F.when(F.coalesce(part, F.lit(False)), F.coalesce(w, F.lit(0.0))).otherwise(0.0)).alias("_p"), F.sum(w).alias("_w"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return parents.join(sums, key, "left").select(key, zero("n_lines"), zero("n_large"), (F.col("_p") / F.nullif(F.col("_w"), F.lit(0.0))).alias("fraction"))


def percentage_errors(df: DataFrame, by: Sequence[str], estimate: Column, truth: Column, within: float) -> DataFrame:
    """by, n, mean_ape, median_ape, within_<percent>: absolute errors over the truth; rows with a truth of 0 or null don't count."""
    ape = F.abs(estimate - truth) / F.nullif(truth, F.lit(0.0))
    rows = df.select(*by, ape.alias("_a")).where("_a IS NOT NULL")
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg("_a"), 6).alias("mean_ape"), F.round(F.median("_a"), 6).alias("median_ape"), F.round(F.avg((F.col("_a") <= within).cast("double")), 6).alias(f"within_{round(within * 100)}"))


def fold_split(df: DataFrame, group: str, folds: Mapping[str, int], out: str = "split") -> DataFrame:
    """The split of a row by the fold of its group's SHA-256, so a group is never parted; a null group has the fold of the empty text."""
    total = sum(folds.values())
    fold = F.conv(F.substring(F.sha2(F.coalesce(F.col(group).cast("string"), F.lit("")), 256), 1, 8), 16, 10).cast("bigint") % total
    upto, choice = 0, None
    for name, n in folds.items():
        upto += n
        choice = F.when(fold < upto, name) if choice is None else choice.when(fold < upto, name)
    return df.withColumn(out, choice)


def family_leaders(df: DataFrame, key: str, family: str) -> DataFrame:
    """df with family_size and is_leader (the smallest key of its family); a row without family leads itself."""
    sizes = df.where(F.col(family).isNotNull()).groupBy(family).agg(F.count("*").alias("_n"), F.min(key).alias("_first"))
    joined = df.join(sizes, family, "left")
    return joined.select(*df.columns, F.coalesce("_n", F.lit(1)).alias("family_size"), F.coalesce(F.col("_first") == F.col(key), F.lit(True)).alias("is_leader"))
