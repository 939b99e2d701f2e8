"""Lexicons over texts and lists: evidence per class with negation, and policies that fail closed."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The vocabularies of evidence, labels, statuses and reasons, and the words, signs and lengths that results depend on.
KINDS = ("explicit", "implicit_name", "ambiguous_carrier", "text_silent", "unassessed")
LEGACY = ("present", "absent", "unassessed")
EVIDENCE_REASONS = {"explicit": "explicit_name_match", "implicit_name": "implicit_name_match", "ambiguous_carrier": "ambiguous_carrier_match", "negated": "negated_name_requires_review", "text_silent": "no_supported_name_or_carrier_match", "unassessed": "ingredient_evidence_unassessed"}
#: What must hold, and the status and reason that follow; the first row that holds counts.
POLICY = (
    ({"legacy": ("present",)}, "present", "legacy_positive_preserved"),
    ({"legacy": ("unassessed",)}, "unknown", "legacy_unassessed"),
    ({"scan": ("incomplete",)}, "unknown", "scan_incomplete"),
    ({"kind": ("unassessed",)}, "unknown", "ingredient_evidence_unassessed"),
    ({"kind": ("explicit", "implicit_name")}, "unknown", "name_conflicts_with_legacy_absence"),
    ({"kind": ("ambiguous_carrier",)}, "unknown", "text_open_legacy_absence"),
    ({}, "absent", "silver_inferred_absence_not_verified_safe"),
)
DECISIONS = {"present": "FAIL", "unknown": "UNKNOWN", "absent": "PASS_SILVER_ONLY"}
EXCLUDING_WORDS = "no|without|omit|avoid|excluding"
FREE_AFTER = r"[ -]?free\b"
ALTERNATIVES = r";|\bor\b|\band\b"
CONTEXT_BEFORE = 22
OPEN_SIGNS = ",;:-–—(&/+"
OPEN_WORDS = "and|or|the|a|an|to|with|of|in|on|for|till|until|then|add|is|into|at|by|as|from|some|your|but"
CLOSING_SIGNS = ".!?)\"'’”"
LIST_ITEM = r"^\(?\d{1,2}[).:]\s"
LEAST_METHOD, MOST_PLACEHOLDER, CLOSED_SHARE = 25, 200, 0.75

#: Signs that mark where a mention starts and ends; texts lose them beforehand.
_START, _END, _PART = "\x02", "\x03", "\n\x01\n"
_DENIED_BEFORE = rf"(?i)\b(?:{'|'.join(rf'{w}\s{{0,{CONTEXT_BEFORE - len(w)}}}' for w in EXCLUDING_WORDS.split('|'))}){_START}"
_DENIED_AFTER = rf"(?i){_END}{FREE_AFTER}"
#: What every text with a denied mention holds.
_DOUBT = rf"(?i)\b(?:{EXCLUDING_WORDS}|free)\b"


def lexicon_match(c: Column, positive: str, negative: str | None = None) -> Column:
    """Whether a text has a term after the phrases that only contain it are taken out; null has none."""
    text = c if negative is None else F.regexp_replace(c, f"(?i){negative}", " ")
    return F.coalesce(text.rlike(f"(?i){positive}"), F.lit(False))


def lexicon_counts(df: DataFrame, by: Sequence[str], text: str, lexicon: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """by, class, n, total: texts with a term of each class, all classes in one pass."""
    sums = [F.sum(lexicon_match(F.col(text), p, n).cast("long")).alias(f"_c{i}") for i, (p, n) in enumerate(lexicon.values())]
    counts = df.groupBy(*by).agg(F.count("*").alias("total"), *sums)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"_c{i}").alias("n")) for i, c in enumerate(lexicon)]))
    return counts.select(*by, "total", cells.alias("x")).select(*by, "x.class", "x.n", "total")


def _lines(items: Column) -> Column:
    """The lines of a list as one text, parted so that no pattern reaches from one into the next."""
    return F.translate(F.array_join(F.filter(items, lambda x: x.isNotNull()), _PART), _START + _END, "")


def _pieces(text: Column) -> Column:
    """The parts of all lines between ;, or, and."""
    return F.split(text, f"(?i){_PART}|{ALTERNATIVES}")


def _denied(marked: Column) -> Column:
    return marked.rlike(_DENIED_BEFORE) | marked.rlike(_DENIED_AFTER)


def _affirmed(marked: Column) -> Column:
    """Whether a mention is left once those denied before or after are taken out."""
    rest = F.regexp_replace(F.regexp_replace(marked, f"{_DENIED_BEFORE}[^{_END}]*{_END}", ""), f"(?i){_START}[^{_END}]*{_END}{FREE_AFTER}", "")
    return F.contains(rest, F.lit(_START))


def _carrier(pattern: str, exclusion: str) -> Callable[[Column], Column]:
    return lambda x: x.rlike(f"(?i){pattern}") & ~x.rlike(f"(?i){exclusion}")


def _evidence(text: Column, pieces: Column, doubt: Column, spec: Mapping) -> Column:
    """struct(kind, reason) of one class over lines that are assessable; mentions are marked only where one may be denied."""
    if spec.get("strip"):
        text, pieces = F.regexp_replace(text, f"(?i){spec['strip']}", " "), F.transform(pieces, lambda x: F.regexp_replace(x, f"(?i){spec['strip']}", " "))

    def out(reason: str, kind: str | None = None) -> Column:
        return F.struct(F.lit(kind or reason).alias("kind"), F.lit(EVIDENCE_REASONS[reason]).alias("reason"))

    named = {kind: (text.rlike(f"(?im){spec[k]}"), F.regexp_replace(text, f"(?im)({spec[k]})", f"{_START}$1{_END}")) for k, kind in (("explicit", "explicit"), ("implicit", "implicit_name")) if spec.get(k)}
    found = F.when(text.isNull(), out("unassessed"))
    for kind, (there, marked) in named.items():
        found = found.when(there & (~doubt | _affirmed(marked)), out(kind))
    for p, no in spec.get("carriers", ()):
        found = found.when(F.exists(pieces, _carrier(p, no)) if no else text.rlike(f"(?im){p}"), out("ambiguous_carrier"))
    for there, marked in named.values():
        found = found.when(doubt & there & _denied(marked), out("negated", "ambiguous_carrier"))
    return found.otherwise(out("text_silent"))


def _evidence_map(text: Column, pieces: Column, doubt: Column, classes: Mapping[str, Mapping]) -> Column:
    return F.create_map(*[x for c, spec in classes.items() for x in (F.lit(c), _evidence(text, pieces, doubt, spec))])


def _assessed(items: Column, assessable: Column) -> Column:
    """The text of a list that can be assessed, else null."""
    return F.when(F.coalesce(assessable, F.lit(False)) & (F.coalesce(F.size(items), F.lit(0)) > 0), _lines(items))


def evidence_of(items: Column, assessable: Column, classes: Mapping[str, Mapping]) -> Column:
    """map of class to struct(kind, reason): the evidence in a list of lines.

    classes: class to explicit and implicit (patterns or None), carriers (pairs of a pattern and an exclusion) and strip (phrases taken
    out beforehand). A mention right after a word of exclusion (both within 22 characters) or before '-free' is denied. Affirmed
    explicit names go before implicit ones, then carriers in the parts between ;, or, and, then denied mentions (carriers too, for
    another reason); else the text is silent. A list that is null, empty or not assessable is unassessed for every class. Patterns are
    regular expressions of the JVM; case is ignored, ^ and $ are the ends of a line.
    """
    text = _assessed(items, assessable)
    return _evidence_map(text, _pieces(text), text.rlike(_DOUBT), classes)


def evidence_kinds(items: Column, assessable: Column, classes: Mapping[str, Mapping]) -> Column:
    """map of class to kind of evidence, as evidence_of without the reasons."""
    return F.transform_values(evidence_of(items, assessable, classes), lambda _, e: e["kind"])


def _decided() -> dict[str, tuple[str, str]]:
    """Status and reason of every combination of label, state of the scan and kind."""
    out = {}
    for legacy, scan, kind in product(LEGACY, ("complete", "incomplete"), KINDS):
        cell = {"legacy": legacy, "scan": scan, "kind": kind}
        out[" ".join(cell.values())] = next((status, reason) for where, status, reason in POLICY if all(cell[k] in v for k, v in where.items()))
    return out


def status_policy(legacy: Column, kind: Column, scan_incomplete: Column, assessable: Column) -> Column:
    """struct(status, reason) by a decision table; a missing scan flag counts as incomplete, what isn't assessable as unassessed.

    A label or kind outside its vocabulary, null included, raises an error.
    """
    decided = F.create_map(*[x for k, (status, reason) in _decided().items() for x in (F.lit(k), F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason")))])
    known = F.coalesce(legacy.isin(*LEGACY) & kind.isin(*KINDS), F.lit(False))
    scan = F.when(F.coalesce(scan_incomplete, F.lit(True)), "incomplete").otherwise("complete")
    seen = F.when(F.coalesce(assessable, F.lit(False)), kind).otherwise("unassessed")
    refused = F.raise_error(F.concat(F.lit("outside the vocabulary: "), F.coalesce(legacy, F.lit("null")), F.lit(", "), F.coalesce(kind, F.lit("null"))))
    return F.try_element_at(decided, F.when(known, F.concat_ws(" ", legacy, scan, seen)).otherwise(refused.cast("string")))


def constraint(status: Column) -> Column:
    """FAIL for present, UNKNOWN for unknown, PASS_SILVER_ONLY for absent; anything else raises."""
    known = F.try_element_at(F.create_map(*[F.lit(x) for pair in DECISIONS.items() for x in pair]), status)
    return F.coalesce(known, F.raise_error(F.concat(F.lit("unknown status "), F.coalesce(status, F.lit("null")))).cast("string"))


def evidence_grid(df: DataFrame, key: str, items: Column, legacy: Column, scan_incomplete: Column, assessable: Column, classes: Mapping[str, Mapping]) -> DataFrame:
    """key, class, legacy_status, kind, evidence_reason, status, reason, decision for every key and class.

    legacy is a map of class to status; a class it lacks is unassessed.
    """
    read = df.select(F.col(key), _assessed(items, assessable).alias("_t"), legacy.alias("_l"), scan_incomplete.alias("_s"), assessable.alias("_a"))
    base = read.select("*", _pieces(F.col("_t")).alias("_p"), F.col("_t").rlike(_DOUBT).alias("_d")).select(key, "_l", "_s", "_a", _evidence_map(F.col("_t"), F.col("_p"), F.col("_d"), classes).alias("_k"))
    each = base.select(key, "_l", "_s", "_a", F.explode_outer("_k").alias("class", "_e")).withColumn("legacy_status", F.coalesce(F.try_element_at("_l", F.col("class")), F.lit("unassessed")))
    judged = each.withColumn("_p", status_policy(F.col("legacy_status"), F.col("_e.kind"), F.col("_s"), F.col("_a")))
    return judged.select(key, "class", "legacy_status", F.col("_e.kind").alias("kind"), F.col("_e.reason").alias("evidence_reason"), F.col("_p.status").alias("status"), F.col("_p.reason").alias("reason"), constraint(F.col("_p.status")).alias("decision"))


def review_queue(grid: DataFrame, reasons: Sequence[str], key: str) -> DataFrame:
    """The cells of a grid whose status or evidence has one of the reasons, by key and class; why lists the reasons that hold."""
    why = F.filter(F.array("reason", "evidence_reason"), lambda x: F.coalesce(x.isin(*reasons), F.lit(False)))
    return grid.withColumn("why", F.array_join(why, ",")).where("why <> ''").select(key, "class", "legacy_status", "kind", "status", "why")


def wide_surface(grid: DataFrame, key: str, status: str, tokens: Mapping[str, str | None]) -> DataFrame:
    """key and per token two flags: token (present) and token_unassessed, from a long grid of key, class and status.

    tokens is the vocabulary: each token with the token it is derived from, which is present wherever it is; a token derived from an
    undeclared one raises. A class outside the vocabulary is left out; a key without a row for a token has false for both.
    """
    bad = sorted(t for t, parent in tokens.items() if parent is not None and parent not in tokens)
    if bad:
        raise ValueError(f"derived from undeclared tokens: {bad}")

    def under(token: str) -> list[str]:
        return [token, *(x for t, parent in tokens.items() if parent == token for x in under(t))]

    has = lambda names, value: F.coalesce(F.bool_or(F.col("class").isin(*names) & (F.col(status) == value)), F.lit(False))
    return grid.groupBy(key).agg(*[x for t in tokens for x in (has(under(t), "present").alias(t), has([t], "unassessed").alias(f"{t}_unassessed"))])


def wide_problems(wide: DataFrame, grid: DataFrame, key: str, status: str, tokens: Mapping[str, str | None]) -> DataFrame:
    """check, n of a wide surface against its grid: tokens whose count is less than the grid's, and rows with a token but not its parent."""
    long = grid.where(F.col(status) == "present").groupBy("class").agg(F.countDistinct(key).alias("want"))
    counts = wide.agg(F.array(*[F.struct(F.lit(t).alias("class"), F.sum(F.col(t).cast("long")).alias("got")) for t in tokens]).alias("x")).select(F.explode("x").alias("x")).select("x.class", "x.got")
    short = counts.join(long, "class", "left").where(F.coalesce("got", F.lit(0)) < F.coalesce("want", F.lit(0))).agg(F.lit("fewer than in the grid").alias("check"), F.count("*").alias("n"))
    orphan = sum((F.col(t) & ~F.col(p)).cast("long") for t, p in tokens.items() if p) if any(tokens.values()) else F.lit(0)
    return short.unionByName(wide.agg(F.lit("token without its parent").alias("check"), F.coalesce(F.sum(orphan), F.lit(0)).cast("long").alias("n")))


def method_status(text: Column, patterns: Mapping[str, str], *, least: int = LEAST_METHOD, most: int = MOST_PLACEHOLDER) -> Column:
    """MISSING, PLACEHOLDER, NOT_A_METHOD, TRUNCATED or COMPLETE of a method text.

    patterns: placeholder, verb (of doing), finish. A text is truncated if it ends in a joining sign or word, or if its last of three or
    more sentences lacks the stop that at least three quarters of the others have, states no finish and is no list item.
    """
    s = F.trim(F.coalesce(text, F.lit("")))
    parts = F.filter(F.transform(F.split(s, r"(?<=[.!?])\s+|\s*[\n|]+\s*"), lambda x: F.trim(x)), lambda x: x != "")
    last = F.element_at(parts, -1)
    others = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1)))
    stopped = F.size(F.filter(others, lambda x: x.rlike(f"[{re.escape(CLOSING_SIGNS)}]$")))
    joint = s.rlike(f"[{re.escape(OPEN_SIGNS)}]$") | s.rlike(rf"(?i)\b(?:{OPEN_WORDS})$")
    open_end = s.rlike(r"[\p{L}\p{N}]$") & (F.size(parts) >= 3) & (stopped >= CLOSED_SHARE * (F.size(parts) - 1)) & ~last.rlike(f"(?i){patterns['finish']}") & ~last.rlike(LIST_ITEM)
    return (
        F.when(s == "", "MISSING")
        .when((F.length(s) < least) | ((F.length(s) <= most) & s.rlike(f"(?i){patterns['placeholder']}")), "PLACEHOLDER")
        .when(~s.rlike(f"(?i){patterns['verb']}"), "NOT_A_METHOD")
        .when(joint | open_end, "TRUNCATED")
        .otherwise("COMPLETE")
    )


def label_conflicts(df: DataFrame, label: str, rules: Mapping[str, Sequence[str]], text: str, lexicon: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """label, class, n_rows, n_conflicts: rows of a label whose text names a class that the label forbids."""
    cells = [F.struct(F.lit(l).alias("label"), F.lit(c).alias("class"), F.sum((F.col(label) == l).cast("long")).alias("n_rows"), F.sum(((F.col(label) == l) & lexicon_match(F.col(text), *lexicon[c])).cast("long")).alias("n_conflicts")) for l, cs in rules.items() for c in cs]
    return df.agg(F.array(*cells).alias("x")).select(F.explode("x").alias("x")).select("x.label", "x.class", F.coalesce("x.n_rows", F.lit(0)).alias("n_rows"), F.coalesce("x.n_conflicts", F.lit(0)).alias("n_conflicts"))


def two_leg_audit(gold: DataFrame, query: str, item: str, flags: DataFrame, flag: str, texts: DataFrame, text: str, key: str, positive: str, negative: str | None) -> DataFrame:
    """Per query n, missing, flagged, named, either, both_null: a flag and a text looked up for every item of a gold list.

    An item whose flag and text are both null can't be audited (both_null); one that isn't in texts at all is missing.
    """
    f = flags.select(F.col(key).alias("_k"), F.col(flag).alias("_flag"))
    t = texts.select(F.col(key).alias("_j"), F.col(text).alias("_text"), F.lit(True).alias("_there"))
    joined = gold.join(f, F.col(item) == F.col("_k"), "left").join(t, F.col(item) == F.col("_j"), "left")
    named = lexicon_match(F.col("_text"), positive, negative)
    flagged = F.coalesce(F.col("_flag"), F.lit(False))
    n = lambda c: F.sum(c.cast("long"))
    return joined.groupBy(query).agg(F.count("*").alias("n"), n(F.col("_there").isNull()).alias("missing"), n(flagged).alias("flagged"), n(named).alias("named"), n(flagged | named).alias("either"), n(F.col("_flag").isNull() & F.col("_text").isNull()).alias("both_null"))
