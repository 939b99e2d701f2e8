"""Data contracts: declared violations of a table, counted in one aggregate.

A check gives a name and a Column that is true for a violating row; all checks of a table are summed in a single pass. Nothing is
fatal by itself: the result is one row per check with its number of violations, and problems() turns it into sentences.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Contract:
    """Checks of one table."""

    name: str
    checks: list[tuple[str, Column]] = field(default_factory=list)
    keys: list[tuple[str, ...]] = field(default_factory=list)

    def rows(self, name: str, violation: Column) -> Contract:
        self.checks.append((name, F.coalesce(violation, F.lit(False))))
        return self

    def not_null(self, *columns: str) -> Contract:
        for c in columns:
            self.rows(f"{c} is null", F.col(c).isNull())
        return self

    def key(self, *columns: str) -> Contract:
        """The columns are never null and never repeat together."""
        self.keys.append(columns)
        return self.not_null(*columns)

    def domain(self, c: str, values: Sequence[str]) -> Contract:
        """Only these values; null violates."""
        return self.rows(f"{c} outside its domain", F.col(c).isNull() | ~F.col(c).isin(*values))

    def shape(self, c: str, pattern: str) -> Contract:
        """The whole text matches; null violates."""
        return self.rows(f"{c} out of shape", F.col(c).isNull() | ~F.coalesce(F.col(c).cast("string").rlike(rf"\A(?:{pattern})\z"), F.lit(False)))

    def between(self, c: str, low: float, high: float) -> Contract:
        """Within the bounds where it is not null; NaN violates."""
        return self.rows(f"{c} out of range", F.col(c).isNotNull() & (F.isnan(F.col(c).cast("double")) | ~F.col(c).between(low, high)))

    def implies(self, name: str, when: Column, then: Column) -> Contract:
        """Where when is true, then is true; a null consequence violates."""
        return self.rows(name, F.coalesce(when, F.lit(False)) & ~F.coalesce(then, F.lit(False)))

    def max_length(self, c: str, most: int) -> Contract:
        return self.rows(f"{c} too long", F.length(F.col(c).cast("string")) > most)

    def run(self, df: DataFrame) -> DataFrame:
        """check, violations. Key repeats count the rows beyond the first of each key."""
        total = F.struct(F.lit(f"{self.name} rows").alias("check"), F.count("*").alias("violations"))
        sums = [F.struct(F.lit(n).alias("check"), F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias("violations")) for n, c in self.checks]
        out = df.agg(F.array(total, *sums).alias("x")).select(F.explode("x").alias("x")).select("x.*").where(~F.col("check").eqNullSafe(F.lit(f"{self.name} rows")))
        for k in self.keys:
            per = df.dropna(subset=list(k)).groupBy(*k).agg(F.count("*").alias("n"))
            out = out.unionByName(per.agg(F.lit(f"{', '.join(k)} repeats").alias("check"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")))
        return out

    def problems(self, df: DataFrame) -> list[str]:
        """Sentences for what is violated, in alphabetical order; empty means valid."""
        missing = [c for c in {x for k in self.keys for x in k} if c not in df.columns]
        if missing:
            return [f"{self.name}: missing columns {sorted(missing)}"]
        return sorted(f"{self.name}: {r['check']} ({r['violations']} rows)" for r in self.run(df).where("violations > 0").collect())


def schema_problems(df: DataFrame, columns: Mapping[str, str], *, exact: bool = True) -> list[str]:
    """Missing columns, other types and, if exact, undeclared columns."""
    have = dict(df.dtypes)
    out = [f"missing column {c}" for c in columns if c not in have]
    out += [f"{c} is {have[c]}, not {t}" for c, t in columns.items() if c in have and have[c] != t]
    return out + ([f"undeclared column {c}" for c in have if c not in columns] if exact else [])


def orphans(df: DataFrame, c: str, parent: DataFrame, p: str) -> DataFrame:
    """Distinct non-null values of c that the parent lacks, with n."""
    known = parent.select(F.col(p).alias("_p")).distinct()
    return df.where(F.col(c).isNotNull()).join(known, F.col(c) == F.col("_p"), "left_anti").groupBy(c).agg(F.count("*").alias("n"))


def incomplete_grid(df: DataFrame, key: str, column: str, classes: Sequence[str]) -> DataFrame:
    """Keys that lack a class or have one twice: key, n_rows, n_classes."""
    inside = F.when(F.col(column).isin(*classes), F.col(column))
    counts = df.groupBy(key).agg(F.count("*").alias("n_rows"), F.countDistinct(inside).alias("n_classes"))
    return counts.where((F.col("n_rows") != len(classes)) | (F.col("n_classes") != len(classes)))


def split_problems(df: DataFrame, groups: Sequence[str], split: str) -> DataFrame:
    """group, value, n_splits of every non-blank group value whose rows lie in several splits (null is one)."""
    each = F.explode(F.array(*[F.struct(F.lit(g).alias("group"), F.lower(F.trim(F.col(g).cast("string"))).alias("value")) for g in groups]))
    rows = df.select(each.alias("g"), F.coalesce(F.col(split), F.lit("∅")).alias("s")).where(F.coalesce(F.col("g.value"), F.lit("")) != "")
    return rows.groupBy("g.group", "g.value").agg(F.countDistinct("s").alias("n_splits")).where("n_splits > 1")


def run_all(checks: Mapping[str, Callable[[], list[str]]]) -> dict[str, list[str]]:
    """The problems of every check; one that fails is itself a problem and stops none of the others."""
    out: dict[str, list[str]] = {}
    for name, check in checks.items():
        try:
            out[name] = check()
        except Exception as e:  # noqa: BLE001
            out[name] = [f"the check failed: {type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"]
    return out


def with_units(df: DataFrame, units: Mapping[str, str], inherit: Mapping[str, str] | None = None) -> DataFrame:
    """Units as column metadata, by name or else by the suffix of the name; values and nulls are untouched."""
    fields = []
    for c in df.columns:
        unit = units.get(c) or next((u for s, u in (inherit or {}).items() if c.endswith(s)), None)
        fields.append(F.col(c).alias(c, metadata={"unit": unit}) if unit else F.col(c))
    return df.select(*fields)


def without_units(df: DataFrame) -> list[str]:
    """Numeric columns that declare no unit."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and "unit" not in (f.metadata or {})]


def pii_counts(df: DataFrame, columns: Sequence[str], patterns: Mapping[str, str], exempt: Mapping[tuple[str, str], str] | None = None) -> DataFrame:
    """column, pattern, n: rows in which a text column matches, in one pass.

    exempt maps (column, pattern) to a shape whose whole values don't count there.
    """
    cells = []
    for c in columns:
        for name, p in patterns.items():
            hit = F.coalesce(F.col(c).cast("string").rlike(p), F.lit(False))
            shape = (exempt or {}).get((c, name))
            if shape:
                hit = hit & ~F.coalesce(F.col(c).cast("string").rlike(rf"\A(?:{shape})\z"), F.lit(False))
            cells.append(F.struct(F.lit(c).alias("column"), F.lit(name).alias("pattern"), F.coalesce(F.sum(hit.cast("long")), F.lit(0)).alias("n")))
    return df.agg(F.array(*cells).alias("x")).select(F.explode("x").alias("x")).select("x.*")
