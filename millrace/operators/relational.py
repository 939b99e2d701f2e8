"""Joins, exclusions, set operations, aggregates and reshaping with strict null and cardinality rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exclude(df: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """Rows of which none of the columns holds an excluded key (keys has one column). Null values are kept."""
    (name,) = keys.columns
    banned = keys.select(F.col(name).alias("_x")).where(F.col("_x").isNotNull()).distinct()
    for c in columns:
        df = df.join(banned, F.col(c) == F.col("_x"), "left_anti")
    return df


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, none null, that come more than once, with n."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return df.where(whole).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def join_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that fails where a key comes twice on either side; _matched tells whether the right side was there."""
    for side, name in ((left, "left"), (right, "right")):
        if duplicates(side, keys).limit(1).count():
            raise ValueError(f"the {name} side repeats a key of {list(keys)}")
    return left.join(right.withColumn("_matched", F.lit(True)), list(keys), "left").withColumn("_matched", F.coalesce("_matched", F.lit(False)))


def presence(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join of the distinct keys with _side: both, left_only or right_only. Null equals null."""
    l = left.select(*keys).distinct().withColumn("_l", F.lit(1))
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).distinct().withColumn("_r", F.lit(1))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    side = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    return l.join(r, on, "full_outer").select(*[F.when(F.col("_l").isNull(), F.col(f"_r_{k}")).otherwise(F.col(k)).alias(k) for k in keys], side.alias("_side"))


def overwrite(df: DataFrame, master: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """df with the columns as the master has them (null where the master lacks the key) and _changed, how many differ by it."""
    m = master.select(key, *[F.col(c).alias(f"_m_{c}") for c in columns])
    joined = df.join(m, key, "left")
    changed = sum(((~F.col(c).eqNullSafe(F.col(f"_m_{c}"))).cast("int") for c in columns), F.lit(0))
    return joined.withColumn("_changed", changed).select(*[F.col(f"_m_{c}").alias(c) if c in columns else F.col(c) for c in df.columns], "_changed")


def link_by_name(names: DataFrame, name: str, targets: DataFrame, target_id: str, target_name: str) -> DataFrame:
    """name, outcome (exact, ambiguous, unmatched) and target, which only an exact link has. Case and outer blanks don't matter."""
    keyed = targets.select(F.lower(F.trim(F.col(target_name))).alias("_k"), F.col(target_id).alias("_t")).unionByName(targets.select(F.lower(F.trim(F.col(target_id).cast("string"))).alias("_k"), F.col(target_id).alias("_t")))
    counted = keyed.where(F.col("_k").isNotNull()).groupBy("_k").agg(F.countDistinct("_t").alias("_n"), F.min("_t").alias("_t"))
    joined = names.select(F.col(name).alias("name")).join(counted, F.lower(F.trim(F.col("name"))) == F.col("_k"), "left")
    outcome = F.when(F.col("_n").isNull(), "unmatched").when(F.col("_n") > 1, "ambiguous").otherwise("exact")
    return joined.select("name", outcome.alias("outcome"), F.when(outcome == "exact", F.col("_t")).alias("target"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often, whatever their order."""
    b = b.select(*a.columns)
    return not a.exceptAll(b).limit(1).count() and not b.exceptAll(a).limit(1).count()


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of one table only, with _side left_only or right_only."""
    b = b.select(*a.columns)
    return a.subtract(b).withColumn("_side", F.lit("left_only")).unionByName(b.subtract(a).withColumn("_side", F.lit("right_only")))


def merge_registries(*registries: DataFrame) -> DataFrame:
    """id, reason of several tables of ids and reasons; the last table that holds an id gives its reason (ties: the greater)."""
    parts = [r.select("id", F.struct(F.lit(i).alias("p"), F.col("reason").alias("reason")).alias("x")) for i, r in enumerate(registries)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("id").agg(F.max("x").alias("x")).select("id", F.col("x.reason").alias("reason"))


def distinct_with_null(c: str) -> Column:
    """Distinct values, null counting as one."""
    return F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))


def value_shares(df: DataFrame, c: str) -> DataFrame:
    """value, n, share of every value, null being one; the shares sum to 1."""
    counts = df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n"))
    return counts.select("value", "n", (F.col("n") / counts.agg(F.sum("n")).scalar()).alias("share"))


def slices(df: DataFrame, by: Sequence[str], fields: Sequence[str], unknown: str = "UNKNOWN") -> DataFrame:
    """slice, slice_value, field, field_value, n, denominator for every slice column and field; null slice values are unknown.

    One pass: rows are unpivoted to (slice, field) pairs and added up before the shuffle.
    """
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(s).alias("slice"), F.coalesce(F.col(s).cast("string"), F.lit(unknown)).alias("slice_value"), F.lit(f).alias("field"), F.col(f).cast("string").alias("field_value"))
                for s in by
                for f in fields
            ]
        )
    )
    counts = df.select(pairs.alias("p")).groupBy("p.slice", "p.slice_value", "p.field", "p.field_value").agg(F.count("*").alias("n"))
    whole = counts.groupBy("slice", "slice_value", "field").agg(F.sum("n").alias("denominator"))
    return counts.join(whole, ["slice", "slice_value", "field"]).select("slice", "slice_value", "field", "field_value", "n", "denominator")


def confusion(df: DataFrame, by: Sequence[str], label: Column, evidence: Column) -> DataFrame:
    """Per group the counts tp, fp, fn, tn and precision and recall of a label against evidence; null counts as false."""
    l, e = F.coalesce(label, F.lit(False)), F.coalesce(evidence, F.lit(False))
    cells = df.groupBy(*by).agg(*[F.sum(x.cast("long")).alias(n) for n, x in (("tp", l & e), ("fp", l & ~e), ("fn", ~l & e), ("tn", ~l & ~e))])
    return cells.select(*by, "tp", "fp", "fn", "tn", (F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))).alias("precision"), (F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))).alias("recall"))


def profile(df: DataFrame) -> DataFrame:
    """column, dtype, non_null, n_distinct, example (the least value as text) of every column, in one aggregate."""
    aggs = []
    for c in df.columns:
        q = F.col(f"`{c}`")
        aggs.append(F.struct(F.lit(c).alias("column"), F.lit(dict(df.dtypes)[c]).alias("dtype"), F.count(q).alias("non_null"), F.countDistinct(q).alias("n_distinct"), F.min(q.cast("string")).alias("example")))
    return df.agg(F.array(*aggs).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def unpivot_history(df: DataFrame, key: str, fields: Sequence[str], generation: str) -> DataFrame:
    """key, field, generation, value_num, value_str: one row per non-null field; what is no number goes to value_str."""
    rows = df.select(F.col(key), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("v")) for f in fields])).alias("x")).where(F.col("x.v").isNotNull())
    number = F.col("x.v").try_cast("double")
    return rows.select(key, F.col("x.field").alias("field"), F.lit(generation).alias("generation"), number.alias("value_num"), F.when(number.isNull(), F.col("x.v")).alias("value_str"))


def pivot_complete(df: DataFrame, key: str, column: str, value: str, classes: Sequence[str]) -> DataFrame:
    """One row per key with a column per class; a key that lacks a class has null there. Of repeated cells the least value counts."""
    return df.groupBy(key).pivot(column, list(classes)).agg(F.min(value))


def grid(df: DataFrame, key: str, classes: Sequence[str], name: str = "class") -> DataFrame:
    """Every key beside every class, without a join."""
    return df.select(key, F.explode(F.array(*[F.lit(c) for c in classes])).alias(name))


def rename_all(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Renamed columns; a new name that is taken already raises."""
    taken = [n for o, n in names.items() if n in df.columns and n not in names]
    if taken:
        raise ValueError(f"names in use: {taken}")
    return df.withColumnsRenamed(dict(names))


def route_columns(columns: Sequence[str], routes: Mapping[str, str], rest: str) -> dict[str, list[str]]:
    """Columns by the table whose pattern they match first; the others go to rest."""
    import re

    out: dict[str, list[str]] = {t: [] for t in [*routes, rest]}
    for c in columns:
        out[next((t for t, p in routes.items() if re.search(p, c)), rest)].append(c)
    return out
