"""Scalar column builders. Every builder takes columns and gives a column; none knows a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_digest(*columns: str) -> Column:
    """md5 of the columns as they stand: nulls, empty texts and shifted boundaries all differ."""
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.when(text.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.length(text).cast("string"), F.lit(":"), text)))
    return F.md5(F.concat(*parts, F.lit("")))


def joined_digest(*columns: Column) -> Column:
    """SHA-256 of the fields joined by NUL, null as empty."""
    return F.sha2(F.concat_ws("\0", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256)


def short_id(prefix: str, *columns: Column, length: int = 16) -> Column:
    """prefix and the first characters of the SHA-256 of the fields joined by line ends, null as empty."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\n", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256), 1, length))


def text_or_empty(c: Column) -> Column:
    """Trimmed text, null as empty."""
    return F.trim(F.coalesce(c, F.lit("")))


def is_blank(c: Column) -> Column:
    """Null or nothing but blanks; never null itself."""
    return text_or_empty(c) == ""


def or_unknown(c: Column, unknown: str = "unknown") -> Column:
    """The text, or unknown where it is null or blank."""
    return F.when(is_blank(c), F.lit(unknown)).otherwise(c)


def count_bin(c: Column) -> Column:
    """unknown (null, NaN, infinite, negative), zero, 1_9, 10_99 or 100_plus."""
    x = c.cast("double")
    bad = x.isNull() | F.isnan(x) | (x < 0) | (x == float("inf"))
    return F.when(bad, "unknown").when(x == 0, "zero").when(x < 10, "1_9").when(x < 100, "10_99").otherwise("100_plus")


def closed_vocabulary(c: Column, known: Mapping[str, str], otherwise: str) -> Column:
    """The value of a closed vocabulary by its lower-case trimmed text; anything else, null too, is otherwise."""
    out = F.lit(otherwise)
    text = F.lower(text_or_empty(c))
    for k, v in known.items():
        out = F.when(text == k, F.lit(v)).otherwise(out)
    return out


def tri_state(c: Column) -> Column:
    """yes, no or unknown of a nullable boolean."""
    return F.when(c.isNull(), "unknown").when(c, "yes").otherwise("no")


def changed(a: Column, b: Column) -> Column:
    """Whether two values differ, null being a value of its own."""
    return ~a.eqNullSafe(b)


def close(a: Column, b: Column, tolerance: float = 1e-12) -> Column:
    """Both null, or both there and no further apart than the tolerance; never null."""
    return (a.isNull() & b.isNull()) | F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))


def lenient_number(c: Column) -> Column:
    """The number that a text tells, else null."""
    return c.try_cast("double")


def strict_integer(c: Column) -> Column:
    """A whole number as bigint; null stays null, anything else raises."""
    x = c.cast("string").try_cast("double")
    ok = c.isNull() | (x.isNotNull() & (x == F.floor(x)) & (F.abs(x) < 2.0**53))
    return F.when(ok, x.cast("bigint")).otherwise(F.raise_error(F.concat(F.lit("not a whole number: "), c.cast("string"))).cast("bigint"))


def strict_boolean(c: Column) -> Column:
    """True and False and their capitalised texts; null stays null, anything else (0 and 1 too) raises."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit(None).cast("boolean")).when(text.isin("True", "true"), True).when(text.isin("False", "false"), False).otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), text)).cast("boolean"))


def ordinal_score(c: Column, order: str = "EDCBA", default: float = 3.0) -> Column:
    """Letters to (rank - 1) / (letters - 1), the first letter of order being rank 1; others count as the default rank."""
    rank = F.coalesce(*[F.when(F.upper(F.trim(c)) == letter, F.lit(float(i + 1))) for i, letter in enumerate(order)], F.lit(default))
    return (rank - 1) / F.lit(float(len(order) - 1))


def zone(c: Column, zones: Mapping[str, Sequence[str]], other: str = "O") -> Column:
    """The zone whose members hold the value, else other."""
    out = F.lit(other)
    for name, members in zones.items():
        out = F.when(c.isin(*members), F.lit(name)).otherwise(out)
    return F.when(c.isNull(), F.lit(other)).otherwise(out)


def url_host(c: Column) -> Column:
    """Host of a URL, null where there is none."""
    return F.try_parse_url(c, F.lit("HOST"))


def full_match(c: Column, pattern: str) -> Column:
    """Whether the whole text matches, a line end at its end included; null is no match."""
    return F.coalesce(c.rlike(rf"\A(?:{pattern})\z"), F.lit(False))


def traffic_light(value: Column, low: float, high: float) -> Column:
    """green up to low, red above high, amber between; null for null."""
    return F.when(value <= low, "green").when(value > high, "red").when(value.isNotNull(), "amber")


def label_statuses(labels: Column, classes: Sequence[str], unknown: str = "unknown", none: str = "none_detected") -> Column:
    """map of class to present, absent or unassessed from a delimited label text.

    Empty or only unknown: all unassessed; only none: all absent; none among others or a token outside raises; else listed classes are
    present, the others unassessed if unknown is listed too, otherwise absent.
    """
    raw = F.filter(F.transform(F.split(F.coalesce(labels, F.lit("")), "[;,]"), lambda x: F.trim(x)), lambda x: x != "")
    tokens = F.array_distinct(raw)
    stray = F.array_except(tokens, F.array(*[F.lit(c) for c in [*classes, unknown, none]]))
    only_none = (F.size(tokens) == 1) & F.array_contains(tokens, none)
    blank = (F.size(tokens) == 0) | ((F.size(tokens) == 1) & F.array_contains(tokens, unknown))
    pairs = []
    for c in classes:
        status = F.when(blank, "unassessed").when(only_none, "absent").when(F.array_contains(tokens, c), "present").when(F.array_contains(tokens, unknown), "unassessed").otherwise("absent")
        pairs += [F.lit(c), status]
    bad = (F.size(stray) > 0) | (F.array_contains(tokens, none) & (F.size(tokens) > 1))
    return F.when(bad, F.raise_error(F.concat(F.lit("bad label text: "), labels)).cast("map<string,string>")).otherwise(F.create_map(*pairs))


def tier_map(c: Column) -> Column:
    """map of 'class:tier;...'; null where a class comes twice or a part has no tier, empty for an empty text."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    keys = F.transform(parts, lambda x: F.split(x, ":")[0])
    ok = (F.size(F.array_distinct(keys)) == F.size(keys)) & ~F.exists(parts, lambda x: F.size(F.split(x, ":")) != 2)
    entries = F.transform(F.when(ok, parts).otherwise(F.array().cast("array<string>")), lambda x: F.struct(F.split(x, ":")[0], F.split(x, ":")[1]))
    return F.when(ok, F.map_from_entries(entries))


def salt_from_sodium(sodium_mg: Column) -> Column:
    """Grams of salt of milligrams of sodium."""
    return sodium_mg * 0.0025


def row_sum(*columns: str) -> Column:
    """The sum of a row's columns, nulls as nothing; null where all are null."""
    some = F.coalesce(*[F.col(c) for c in columns])
    return F.when(some.isNotNull(), sum((F.coalesce(F.col(c), F.lit(0)) for c in columns[1:]), F.coalesce(F.col(columns[0]), F.lit(0))))


def date_after(base: str, days: Column) -> Column:
    """The date so many days after a base date; null without days."""
    return F.date_add(F.lit(base).cast("date"), days.cast("int"))


def without_suffixes(c: Column, suffixes: Sequence[str]) -> Column:
    """A name in lower case, blanks collapsed, without the suffix words at its end, however many; a name of suffixes only is empty."""
    words = "|".join(suffixes)
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.lower(c), r"\s+", " ")), rf"(?:(?:^| )(?:{words}))+$", ""))


def surnames(c: Column, *, least: int = 3) -> Column:
    """The words of people's names that may be surnames: all but the first of each name between commas, ; or &, in lower case, from so many letters on."""
    names = F.filter(F.transform(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[,;&]"), lambda x: F.trim(x)), lambda x: x != "")
    words = F.flatten(F.transform(names, lambda x: F.slice(F.split(x, r"\s+"), 2, 1000)))
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: F.length(w) >= least)))
