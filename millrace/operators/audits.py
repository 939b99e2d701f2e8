"""Audits of texts, names, ids and simulated logs."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import affirmed, has_control, last_sentences, later_half


def method_flags(text: Column, title: Column, items: Column, patterns: Mapping[str, str]) -> Column:
    """struct of is_intermediate, end_state, liquid_fate_unstated, over_cut (yes or no) of a method text.

    patterns: intermediate_title, intermediate_use (looked for in the last three sentences), finish (in the later half), liquid (in the
    items), add_liquid and negator (an addition that isn't negated right before), consistency, solid. A text is over the cut beyond
    6,000 characters. Null texts and titles are empty.
    """
    t, name = F.coalesce(text, F.lit("")), F.coalesce(title, F.lit(""))
    has = lambda c, p: c.rlike(f"(?i){patterns[p]}")
    liquid = F.exists(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.coalesce(x.rlike(f"(?i){patterns['liquid']}"), F.lit(False))) | affirmed(text, patterns["add_liquid"], patterns["negator"]).isNotNull()
    yes = lambda c: F.when(c, "yes").otherwise("no")
    return F.struct(
        yes(has(name, "intermediate_title") | has(last_sentences(t, 3), "intermediate_use")).alias("is_intermediate"),
        yes(has(later_half(t), "finish")).alias("end_state"),
        yes(liquid & ~has(t, "consistency") & ~has(t, "solid")).alias("liquid_fate_unstated"),
        yes(F.length(t) > 6000).alias("over_cut"),
    )


def observe_text(text: Column, lang: Column, available: Column, supported: Sequence[str] = ("en",)) -> Column:
    """struct of completeness, language, garbled, repeated, reason: closed values, unknown wherever nothing can be told.

    An unavailable source leaves all unknown; a missing text in an available source is partial; garbled looks at characters alone and
    so holds for every language; repeated (more than half of the sentences double) only for supported languages.
    """
    blank = F.trim(F.coalesce(text, F.lit(""))) == ""
    there = F.coalesce(available, F.lit(False))
    base = F.lower(F.substring_index(F.coalesce(lang, F.lit("")), "-", 1))
    known = base.isin(*supported)
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+|\n+"), lambda x: F.trim(x) != "")
    double = F.size(F.array_distinct(parts)) * 2 < F.size(parts)
    return F.struct(
        F.when(~there, "unknown").when(blank, "partial").otherwise("complete").alias("completeness"),
        F.when(~there | (base == ""), "unknown").when(known, "supported").otherwise("not_supported").alias("language"),
        F.when(~there | blank, "unknown").when(has_control(text), "detected").otherwise("not_detected").alias("garbled"),
        F.when(~there | blank | ~known, "unknown").when(double, "yes").otherwise("no").alias("repeated"),
        F.when(~there, "input_unavailable").when(blank, "input_missing_in_source").when(~known, "language_not_supported").otherwise("observed").alias("reason"),
    )


def candidate_names(df: DataFrame, text: str, cues: Sequence[str], top: int, skip: Sequence[str] = ()) -> DataFrame:
    """name, n: capitalised words after a cue word (aunt, by, thanks to), the most frequent ones for review (ties by name)."""
    cue = "|".join(sorted(cues, key=len, reverse=True))
    found = F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(rf"(?:^|[^\p{{L}}])(?:{cue})[ ]+(\p{{Lu}}[\p{{L}}’'-]+)"), F.lit(1)))
    counts = df.select(found.alias("name")).where(~F.col("name").isin(*skip) if skip else F.lit(True)).groupBy("name").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "name").limit(top)


def ids_in_text(lines: DataFrame, text: str, ids: DataFrame) -> DataFrame:
    """id, n: lines that name an id of the one-column table ids, as a field between blanks or commas, namespaced or not."""
    fields = F.array_distinct(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), r"[\s,;|\"]+"), lambda x: F.regexp_replace(x, r"^.*::", "")))
    known = ids.select(F.col(ids.columns[0]).cast("string").alias("id")).where("id IS NOT NULL").distinct()
    return lines.select(F.explode(fields).alias("id")).where("id <> ''").groupBy("id").agg(F.count("*").alias("n")).join(known, "id", "left_semi")


def choice_problems(log: DataFrame, user: str, item: str, index: str, draws: int, items: DataFrame, probability: str | None = None) -> DataFrame:
    """check, n of a simulated log: users without draws 0 to draws - 1, repeated items of a user, unknown items, impossible chances."""
    per = log.groupBy(user).agg(F.count("*").alias("n"), F.countDistinct(index).alias("d"), F.min(index).alias("a"), F.max(index).alias("b"))
    one = lambda name, df: df.agg(F.lit(name).alias("check"), F.count("*").alias("n"))
    known = items.select(F.col(items.columns[0]).alias(item)).distinct()
    out = one("incomplete user", per.where((F.col("n") != draws) | (F.col("d") != draws) | (F.col("a") != 0) | (F.col("b") != draws - 1)))
    out = out.unionByName(one("repeated item", log.groupBy(user, item).count().where("count > 1"))).unionByName(one("unknown item", log.join(known, item, "left_anti")))
    if probability:
        out = out.unionByName(one("impossible chance", log.where(~F.coalesce(F.col(probability).between(0.0, 1.0), F.lit(False)) | (F.col(probability) == 0))))
    return out


def calibrated_mu(mean: float, sigma: float, low: int, high: int) -> float:
    """mu of the lognormal of which the mean, rounded and kept within the bounds, is the given one; found by bisection.

    A mean outside the bounds raises.
    """
    if not low < mean < high:
        raise ValueError("the mean lies outside the bounds")

    def cdf(x: float, mu: float) -> float:
        return 0.5 * (1 + math.erf((math.log(x) - mu) / (sigma * math.sqrt(2)))) if x > 0 else 0.0

    def value(mu: float) -> float:
        # the sum of the chances to lie above each whole number
        return low + sum(1 - cdf(k - 0.5, mu) for k in range(low + 1, high + 1))

    a, b = math.log(max(low, 1)) - 5 * sigma - 5, math.log(high) + 5 * sigma + 5
    for _ in range(80):
        mid = (a + b) / 2
        a, b = (mid, b) if value(mid) < mean else (a, mid)
    return (a + b) / 2


def with_parents(tokens: Column, parents: Mapping[str, str]) -> Column:
    """The tokens and the classes they are derived from, sorted; null stays null."""
    more = F.flatten(F.transform(tokens, lambda t: F.coalesce(*[F.when(t == k, F.array(F.lit(v))) for k, v in parents.items()], F.array().cast("array<string>"))))
    return F.array_sort(F.array_union(tokens, more))


def unique_target(df: DataFrame, key: str, target: str, wanted: Sequence) -> dict:
    """The one target of each wanted key; none or several raise."""
    got = {r[0]: r[1] for r in df.where(F.col(key).isin(*wanted)).groupBy(key).agg(F.collect_set(target)).collect()}
    bad = {k: sorted(got.get(k, [])) for k in wanted if len(got.get(k, [])) != 1}
    if bad:
        raise ValueError(f"not one target: {bad}")
    return {k: got[k][0] for k in wanted}
