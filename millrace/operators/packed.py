"""Fields that hold several values: a quote-aware finite-state tokenizer and its row-expanding operator.

The tokenizer walks a field once. Its states are *value start*, *inside quotes* and *raw value*; escapes and doubled
quotes are consumed inside quotes, bracket groups are consumed whole inside raw values (nesting), and only a separator met
outside both ends a value. It is local to a row, so the operator needs no shuffle and no group can become hot.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\r\n"


@dataclass(frozen=True)
class Dialect:
    """How one field is packed.

    strong: separators that always part values. weak: separators that part values only in an array or where the field has no
    strong separator. words: separating words, with blanks on both sides. empty: whole fields that hold no value.
    """

    strong: str = ";|\n\r\t•"
    weak: str = ","
    words: tuple[str, ...] = ()
    empty: frozenset[str] = frozenset({"", "[]", "NULL"})


LISTS = Dialect()
LABELS = Dialect(strong=";|\n\r\t•,/&+", weak="", words=("and",))

_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|(.))", re.S)
_SURROGATES = re.compile("[\ud800-\udbff][\udc00-\udfff]")


def _unescape(text: str) -> str:
    if "\\" not in text:
        return text
    out = _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _ESCAPES.get(m[3], m[3]), text)
    out = _SURROGATES.sub(lambda m: m[0].encode("utf-16", "surrogatepass").decode("utf-16"), out)
    return re.sub("[\ud800-\udfff]", "�", out)


@lru_cache(maxsize=64)
def _patterns(seps: str, words: tuple[str, ...]) -> tuple[re.Pattern, re.Pattern]:
    """The raw-value state (up to the next separator or opening bracket) and the separator itself."""
    chars = re.escape(seps)
    word = "".join(rf"|[ \t]+{re.escape(w)}(?=[ \t])" for w in words)
    stop = rf"(?:[{chars}]{word})"
    raw = rf"(?>(?:(?!{stop})[^(\[{{])*)" if words else rf"[^{chars}(\[{{]*+"
    return re.compile(raw, re.S), re.compile(stop)


_QUOTED = {
    '"': re.compile(r'"((?:[^"\\]|\\.|"")*+)"', re.S),
    "'": re.compile(r"'((?:[^'\\]|\\.)*+)'", re.S),
}


_CLOSING = {"(": ")", "[": "]", "{": "}"}
#: A bracket, or a quoted passage: a quote that opens a word and one that ends one.
_NESTING = re.compile(r'[()\[\]{}]|(?<![^\s(\[{,;|])"(?:[^"\\]|\\.)*"(?![^\s)\]},;|])', re.S)


def _partners(text: str, start: int, end: int) -> dict[int, int]:
    """Place of each opening bracket that closes: that of its partner, by the depth among brackets of its kind.

    Brackets inside quotes within brackets don't count.
    """
    depth: dict[str, list[int]] = {c: [] for c in _CLOSING.values()}
    out, pos = {}, start
    while m := _NESTING.search(text, pos, end):
        c, pos = m[0], m.end()
        if c in _CLOSING:
            depth[_CLOSING[c]].append(m.start())
        elif c in depth:
            if depth[c]:
                out[depth[c].pop()] = m.start()
        elif not any(depth.values()):  # outside brackets quotes are the business of the walk
            pos = m.start() + 1
    return out


def _walk(text: str, start: int, end: int, seps: str, words: tuple[str, ...], quotes: str) -> tuple[list[str], set[str]]:
    raw, stop = _patterns(seps, words)
    values: list[str] = []
    met: set[str] = set()
    partners = _partners(text, start, end)
    pos = start
    while pos <= end:
        while pos < end and text[pos] in BLANKS and text[pos] not in seps:
            pos += 1
        quoted = text[pos] in quotes and _QUOTED[text[pos]].match(text, pos, end) if pos < end else None
        if quoted:
            after = quoted.end()
            while after < end and text[after] in BLANKS and text[after] not in seps:
                after += 1
            if after < end and not stop.match(text, after, end) and not (words and stop.match(text, quoted.end(), end)):
                quoted = None  # the quote belongs to the value, as in 2" piece
        if quoted:
            body = quoted[1].replace('""', '"') if text[pos] == '"' else quoted[1]
            value = _unescape(body).strip(BLANKS)
            pos = after if after >= end or text[after] in seps else quoted.end()
        else:
            at = raw.match(text, pos, end).end()
            while at < end and text[at] in _CLOSING:  # a bracket that never closes is a plain sign
                at = raw.match(text, partners.get(at, at) + 1, end).end()
            value, pos = text[pos:at].strip(BLANKS), at
        if value:
            values.append(value)
        sep = stop.match(text, pos, end)
        if not sep:
            break
        met.add(sep[0])
        pos = sep.end()
    return values, met


def _is_array(text: str) -> bool:
    """Starts with a bracket whose partner is the last character; brackets inside quotes don't count."""
    if not (text.startswith("[") and text.endswith("]")):
        return False
    depth, i, fresh = 0, 0, False
    while i < len(text):
        c = text[i]
        if c in "\"'" and fresh and (m := _QUOTED[c].match(text, i)):
            i, fresh = m.end(), False
            continue
        if c == "[":
            depth += 1
        elif c == "]":
            depth -= 1
            if not depth:
                return i == len(text) - 1
        fresh = c in "[," or fresh and c in BLANKS
        i += 1
    return False


def tokenize(text: str | None, dialect: Dialect = LISTS) -> list[str]:
    """The values of one field, in their order.

    >>> tokenize('["salt", "a, b"]')
    ['salt', 'a, b']
    >>> tokenize('"2"" piece kale", salt')
    ['2" piece kale', 'salt']
    >>> tokenize("salt, diced; kale")
    ['salt, diced', 'kale']
    """
    if text is None:
        return []
    text = text.strip(BLANKS)
    if text in dialect.empty:
        return []
    everything = dialect.strong + dialect.weak
    if _is_array(text):
        return _walk(text, 1, len(text) - 1, "," if "," in everything else everything, (), "\"'")[0]
    values, met = _walk(text, 0, len(text), everything, dialect.words, '"')
    if dialect.weak and any(m not in dialect.weak for m in met):
        values, _ = _walk(text, 0, len(text), dialect.strong, dialect.words, '"')
    return values


def unpack(column: Column | str, dialect: Dialect = LISTS) -> Column:
    """array<string> of the values of a packed field; null and empty fields give an empty array. Arrow-batched, no shuffle."""

    @F.arrow_udf("array<string>")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([tokenize(x, dialect) for x in batch.to_pylist()], type=pa.list_(pa.string()))

    return run(column)


def explode_packed(df: DataFrame, keys: Sequence[str], fields: dict[str, Dialect], *, at_least: int = 1) -> DataFrame:
    """One row per value of every packed field: the keys, field_name, item_pos (from 0) and item.

    Fields with fewer than at_least values give no row; null, blank, '[]' and 'NULL' hold no value. Repeated input rows give
    repeated output rows. Columns of df other than keys and fields are not read. A key must not be called field_name, item_pos
    or item.
    """
    clash = {"field_name", "item_pos", "item"} & set(keys)
    if clash:
        raise ValueError(f"key columns clash with output columns: {sorted(clash)}")
    packed = F.array(*[F.struct(F.lit(f).alias("field_name"), unpack(F.col(f"`{f}`"), d).alias("vals")) for f, d in fields.items()])
    return (
        df.select(*[F.col(f"`{k}`") for k in keys], F.explode(packed).alias("_p"))
        .where(F.size("_p.vals") >= at_least)
        .select(*[F.col(f"`{k}`") for k in keys], F.col("_p.field_name").alias("field_name"), F.posexplode("_p.vals").alias("item_pos", "item"))
    )
