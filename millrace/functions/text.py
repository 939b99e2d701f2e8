"""Text column builders: normalising, sentences, quotes, redaction, and patterns that need match positions."""

from __future__ import annotations

import ast
import re
import unicodedata
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse(c: Column) -> Column:
    """Lower case with blanks collapsed and trimmed, in the JVM; see casefolded for full case folding."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def casefolded(c: Column) -> Column:
    """NFKC, full case folding, blanks collapsed; null stays null."""

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([None if x is None else " ".join(unicodedata.normalize("NFKC", x).casefold().split()) for x in batch.to_pylist()], pa.string())

    return run(c)


def literal_items(c: Column) -> Column:
    """array<string> of a list literal in a text, or of the text itself; blank members are left out, null gives an empty array."""

    def parse(text: str | None) -> list[str]:
        if text is None or not text.strip():
            return []
        try:
            got = ast.literal_eval(text) if text.lstrip().startswith("[") else text
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            got = text
        members = got if isinstance(got, list) else [got]
        return [str(m).strip() for m in members if m is not None and str(m).strip()]

    @F.arrow_udf("array<string>")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([parse(x) for x in batch.to_pylist()], pa.list_(pa.string()))

    return run(c)


def json_strings(c: Column) -> Column:
    """array of the trimmed lower-case members of a JSON list of texts; null where it is none, or has other members, or none left."""
    parsed = F.try_parse_json(c)
    texts = F.schema_of_variant(parsed) == "ARRAY<STRING>"
    items = F.filter(F.transform(F.from_json(F.when(texts, c), "array<string>"), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    return F.when(F.size(items) > 0, items)


def sentences(c: Column) -> Column:
    """array of trimmed sentences: parted after . ! ? and blanks, or at line ends and bars."""
    parts = F.split(F.coalesce(c, F.lit("")), r"(?<=[.!?])\s+|\s*[\n|]+\s*")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def last_sentences(c: Column, n: int = 3) -> Column:
    """The last n sentences, joined by blanks; fewer where there are fewer."""
    s = sentences(c)
    return F.array_join(F.slice(s, -F.least(F.lit(n), F.greatest(F.size(s), F.lit(1))), F.lit(n)), " ")


def later_half(c: Column, least: int = 3) -> Column:
    """The last half of the sentences, at least so many."""
    s = sentences(c)
    k = F.least(F.greatest(F.lit(least), F.ceil(F.size(s) / 2).cast("int")), F.greatest(F.size(s), F.lit(1)))
    return F.array_join(F.slice(s, -k, k), " ")


def quoted_spans(c: Column, least: int = 20) -> Column:
    """Quoted passages of at least so many characters, in four styles of quotes."""
    styles = [rf'"([^"]{{{least},}})"', rf"“([^”]{{{least},}})”", rf"«([^»]{{{least},}})»", rf"‘([^’]{{{least},}})’"]
    return F.flatten(F.array(*[F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(s), F.lit(1)) for s in styles]))


def urls(c: Column) -> Column:
    """URLs in a text, without closing punctuation."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"https?://[^\s<>\"']+"), F.lit(0))
    return F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?)\]]+$", ""))


def integers(c: Column) -> Column:
    """The runs of digits in a text as bigint, those too long left out."""
    return F.array_compact(F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("bigint")))


def has_control(c: Column) -> Column:
    """Whether a text holds a control character (but tab and line ends) or the replacement character."""
    return F.coalesce(c.rlike("[\\p{Cc}&&[^\\n\\r\\t]]|\\uFFFD"), F.lit(False))


def redact(c: Column, patterns: Mapping[str, str]) -> Column:
    """Each pattern's matches replaced by [redacted-<name>], one pattern after the other; null stays null."""
    for name, pattern in patterns.items():
        c = F.regexp_replace(c, pattern, f"[redacted-{name}]")
    return c


def extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, null without a match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def affirmed(c: Column, pattern: str, negator: str, before: int = 30) -> Column:
    """The first match of a pattern before which, within so many characters, there is no negator; null without one."""
    bare = F.translate(c, "\x02\x03", "")
    parts = F.split(F.regexp_replace(bare, f"(?i)({pattern})", "\x02$1\x03"), "\x02")

    def judged(part: Column, i: Column) -> Column:
        """A match, unless what goes before it, of which the last parts are enough, has a negator."""
        near = F.greatest(F.lit(1), i - before + 1)
        left = F.right(F.translate(F.array_join(F.slice(parts, near, i - near + 1), ""), "\x03", ""), F.lit(before))
        return F.when((i > 0) & ~left.rlike(f"(?i){negator}"), F.substring_index(part, "\x03", 1))

    return F.get(F.array_compact(F.transform(parts, judged)), F.lit(0))



def card(fields: Mapping[str, Column], unknown: str = "unknown") -> Column:
    """A text card: one line 'name: value' per allowed field, null or blank as unknown."""
    lines = [F.concat(F.lit(f"{name}: "), F.when(F.trim(F.coalesce(c.cast("string"), F.lit(""))) == "", unknown).otherwise(c.cast("string"))) for name, c in fields.items()]
    return F.concat_ws("\n", *lines)


def kept_keys(c: Column, allowed: Mapping[str, object]) -> Column:
    """A JSON text with the allowed keys only, at every depth; allowed maps a key to True or to the mapping of its own keys.

    Lists keep their members, each reduced alike. A text that is no JSON object gives null. Arrow-batched.
    """
    import json

    def cut(value: object, keys: Mapping[str, object]) -> object:
        if isinstance(value, list):
            return [cut(v, keys) for v in value]
        if not isinstance(value, dict):
            return value
        return {k: v if keys[k] is True else cut(v, keys[k]) for k, v in value.items() if k in keys}

    def one(text: str | None) -> str | None:
        try:
            value = json.loads(text or "")
        except ValueError:
            return None
        return json.dumps(cut(value, allowed), ensure_ascii=False, sort_keys=True) if isinstance(value, dict) else None

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([one(x) for x in batch.to_pylist()], pa.string())

    return run(c)


def verbatim(quote: Column, source: Column) -> Column:
    """Whether a quote stands in the source as it is but for blanks; null is nowhere."""
    squeeze = lambda x: F.regexp_replace(x, r"\s+", " ")
    return F.coalesce(F.contains(squeeze(source), F.trim(squeeze(quote))), F.lit(False))


def pattern_digest(patterns: Mapping[str, object]) -> str:
    """SHA-256 of a set of patterns, whatever their order, to tell which set made a table."""
    import hashlib
    import json

    return hashlib.sha256(json.dumps(patterns, ensure_ascii=False, sort_keys=True, separators=(",", ":"), default=list).encode()).hexdigest()


def html_text(c: Column) -> Column:
    """The text of an HTML page: scripts, styles and tags taken out, the common entities read, blanks collapsed."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))
