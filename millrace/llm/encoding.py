"""Garbled text from a wrong character encoding: candidate decodings judged by description length.

A candidate is the text after a chain of steps; a step writes garbled places back into bytes by the encoding they were read in and
reads these bytes by the right one. Every candidate is compressed with zstandard under dictionaries trained per language; the chain
with the least description length, its own cost included, wins, otherwise the text stays as it is.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.registry import R
from millrace.session import table

#: Texts that a language weighs at most in what characters cost, languages with a dictionary of their own (all others share one), and
#: bytes of a dictionary: those of the words that save most over all texts. Words beyond WORD characters, as in scripts without blanks,
#: count by each three characters in a row.
SAMPLE, LANGUAGES, DICTIONARY, WORD = 2_000, 32, 48_000, 16
OTHERS = "others"
#: Longest chain, and its cost in bytes: of any step, and besides of one that swaps single-byte encodings.
STEPS, STEP_COST, SWAP_COST = 3, 0.5, 2
#: Costs in bytes of a character that the samples never show (twice outside Latin), of any character beyond ASCII (zstandard counts whole bytes, so
#: without it short texts often tie), and of a capital beyond ASCII right after a small letter; and the levels of compression, of
#: which the best counts.
ESCAPE, BEYOND, SWITCH, LEVELS = 8, 2, 3, (3, 9, 19)

# Encodings that UTF-8 is commonly read in by mistake, and pairs (read in, written in) of mistaken single-byte encodings.
READ_AS = ("cp1252", "latin_1", "mac_roman", "cp1250", "cp1251", "cp437", "cp850", "cp866", "koi8_r", "cp1253", "cp1254", "cp852", "cp1257", "iso8859_15", "iso8859_2")
WIDE = ("gb18030", "shift_jis", "big5")
SWAPS = (
    ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1251", "cp1252"), ("cp1252", "cp1251"), ("cp1250", "cp1252"),
    ("cp1252", "cp1250"), ("cp1252", "cp1254"), ("cp1254", "cp1252"), ("cp1252", "koi8_r"), ("latin_1", "cp1252"), ("cp1253", "cp1252"), ("cp1257", "cp1252"),
)

_SEQUENCE = re.compile("[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}")
_RUN = re.compile(r"[^\x00-\x7f]+")
#: A word with characters beyond ASCII, over which single-byte encodings are swapped.
_WORD = re.compile(r"""(?=[!-~]*[^\x00-\x7f])[^\s,;|"()\[\]/]+""")
#: Marks that no text has that was read right: C1 controls, the replacement character.
_LOST = re.compile("[\x80-\x9f�]")
_PAIR = re.compile(r"[^\x00-\x7f]{2}")
_PART = re.compile(r"""[^\s,;|"()\[\]]{2,}""")
_ASCII = frozenset(map(chr, range(128)))
#: What may be an escaped character: by backslash as in JSON or Python, or as an HTML entity; escaped again or not. Java reads it alike.
_ESCAPED = r"\\+u[0-9a-fA-F]{4}(?:\\+u[dD][c-fC-F][0-9a-fA-F]{2})?|\\+x[0-9a-fA-F]{2}|&(?:amp;)*(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?"
_ESCAPES = re.compile(_ESCAPED)
#: Letters outside Latin, where the named language may well not be that of the text.
_WIDER = re.compile("[\u0370-\u1fff\u2c00-\U0010ffff]")
_WIDE = re.compile("[\u0800-\U0010ffff]")


class _Bytes(dict):
    """char -> the Latin-1 character of its byte in an encoding; other characters -> one that is in no sequence."""

    def __init__(self, name: str) -> None:
        super().__init__()
        for b in range(128, 256):
            try:
                c = bytes([b]).decode(name)
            except UnicodeDecodeError:
                c = chr(b) if b < 160 else ""  # undefined bytes are commonly kept as controls
            if len(c) == 1:
                self[ord(c)] = chr(b)

    def __missing__(self, c: int) -> str:
        return chr(c) if c < 128 else "￿"


@lru_cache(maxsize=64)
def _bytes(name: str) -> _Bytes:
    return _Bytes(name)


def _from_utf8(name: str) -> Callable[[str], str]:
    def step(text: str) -> str:
        raw = text.translate(_bytes(name))
        out, at = [], 0
        for m in _SEQUENCE.finditer(raw):
            out += [text[at : m.start()], m[0].encode("latin-1").decode("utf-8")]
            at = m.end()
        return "".join(out) + text[at:] if at else text

    return step


def _from_utf8_wide(name: str) -> Callable[[str], str]:
    def one(m: re.Match) -> str:
        try:
            return m[0].encode(name).decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            return m[0]

    return lambda text: _RUN.sub(one, text)


@lru_cache(maxsize=64)
def _swap_table(read: str, written: str) -> dict[int, str]:
    out = {}
    for c, b in _bytes(read).items():
        try:
            new = b.encode("latin-1").decode(written)
        except UnicodeDecodeError:
            continue
        if new != chr(c) and len(new) == 1:
            out[c] = new
    return out


@lru_cache(maxsize=1)
def steps() -> tuple[tuple[str, Callable[[str], str], bool], ...]:
    """Name, function, whether it is for wide characters."""
    return tuple([(f"{n}>utf-8", _from_utf8(n), False) for n in READ_AS] + [(f"{n}>utf-8", _from_utf8_wide(n), True) for n in WIDE])


class Judge:
    """Description length of a text in bytes under the dictionary of its language, or the best of all where that is unknown.

    A character that the samples never show costs an escape on top of its compressed bytes.
    """

    def __init__(self, dictionaries: dict[str, bytes], alphabet: dict[str, float]) -> None:
        self.by_language = {}
        self.alphabet = alphabet
        for lang, content in dictionaries.items():
            # without the entropy tables of a dictionary, which make a short text with more literals cost less at times
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.by_language[lang] = [zstandard.ZstdCompressor(dict_data=d, compression_params=self._params(level, len(content))) for level in LEVELS]
        self.every = [c for own in self.by_language.values() for c in own] or [zstandard.ZstdCompressor(compression_params=self._params(level, 0)) for level in LEVELS]
        self.words: dict[tuple[str, str | None], tuple[str, str]] = {}

    @staticmethod
    def _params(level: int, size: int) -> zstandard.ZstdCompressionParameters:
        return zstandard.ZstdCompressionParameters.from_level(level, dict_size=size, write_checksum=0, write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)

    def length(self, text: str, lang: str | None = None) -> float:
        data = text.encode("utf-8", "surrogatepass")
        own = self.by_language[lang] if lang in self.by_language and not _WIDER.search(text) else self.every
        return min(len(c.compress(data)) for c in own) + self.signs(text)

    def signs(self, text: str) -> float:
        """What the characters beyond ASCII cost on top of their compressed bytes."""
        cost, before = 0.0, ""
        for c in text:
            if c > "\x7f":
                cost += BEYOND + self.alphabet.get(c, ESCAPE if c < "\u0250" else 2 * ESCAPE) + SWITCH * (before.islower() and c.isupper())
            before = c
        return cost


def foreign(text: str) -> set[str]:
    """The different characters of a text beyond ASCII."""
    return {c for c in text if c > "\x7f"}


def suspect(text: str, known: set[str] | frozenset[str]) -> bool:
    """Whether a text lost characters, or a step turns it into characters that are known: it may be garbled."""
    if text.isascii():
        return False
    if _LOST.search(text):
        return True
    near, wide = _PAIR.search(text), _WIDE.search(text)
    trials = (step(text) for _, step, is_wide in steps() if (wide if is_wide else near))
    return any(got != text and set(got) - set(text) - _ASCII <= known for got in trials)


def known_characters(counts: dict[str, float]) -> frozenset[str]:
    """Characters of more than one text."""
    return frozenset(c for c, n in counts.items() if n > 1)


def character_costs(counts: dict[str, float], texts: float) -> dict[str, float]:
    """What each character beyond ASCII costs, by the part of all texts that it is in; characters of one text only have no price."""
    return {c: round(math.log2((texts + 1) / n) / 4, 2) for c, n in sorted(counts.items()) if n > 1}


def train_dictionaries(samples: dict[str, list[str]], alphabet: dict[str, float] | None = None, known: frozenset[str] | None = None) -> tuple[dict[str, bytes], dict[str, float]]:
    """Per language a dictionary, trained where there is enough text, else of the texts themselves; and what each character costs.

    Left out are texts that may be garbled. Without alphabet and known characters these come from the samples.
    """
    if known is None:
        known = known_characters(Counter(c for texts in samples.values() for t in texts for c in foreign(t)))
    out, seen = {}, Counter()
    for lang, texts in samples.items():
        clean = [t for t in texts if t and not suspect(t, known)]
        data = [t.encode("utf-8", "surrogatepass") for t in clean]
        if not data:
            continue
        try:
            content = zstandard.train_dictionary(DICTIONARY, data).as_bytes()
        except zstandard.ZstdError:
            content = b""
        out[lang] = content if len(content) >= 1000 else b"\n".join(data)[-DICTIONARY:]
        seen.update(c for t in clean for c in foreign(t))
    return out, character_costs(seen, sum(len(t) for t in samples.values())) if alphabet is None else alphabet


def _character_counts(texts: DataFrame, known: frozenset[str] | None) -> dict[tuple[str, str], dict[str, int]]:
    """Per language and field the texts that each character beyond ASCII is in, over all texts and whole ones; with known, over those
    that can't be garbled.

    There are no more characters than Unicode has, however large the corpus, and at most LANGUAGES + 1 languages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, str, str]] = Counter()
        for batch in batches:
            for lang, f, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if known is None or not suspect(t, known):
                    counts.update((lang, f, c) for c in foreign(t))
        columns = list(zip(*counts, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(counts.values(), pa.int64())], names=["lang", "f", "c", "n"])

    counted = texts.where(F.col("t").rlike(r"[^\x00-\x7f]")).select("lang", "f", "t").mapInArrow(run, "lang string, f string, c string, n long").groupBy("lang", "f", "c").agg(F.sum("n").alias("n"))
    out: dict[tuple[str, str], dict[str, int]] = {}
    for r in counted.collect():
        out.setdefault((r["lang"], r["f"]), {})[r["c"]] = r["n"]
    return out


def _words(text: str) -> Iterator[str]:
    """The words of a text that a dictionary may hold."""
    for w in _PART.findall(text):
        if len(w) <= WORD:
            yield w
        else:
            yield from (w[i : i + 3] for i in range(len(w) - 2))


def _dictionaries(texts: DataFrame, known: frozenset[str], fields: int) -> dict[str, bytes]:
    """Per language the words that save most bytes, counted over all texts that can't be garbled; each field has an equal part of the bytes.

    The most frequent words stand last, where they are the cheapest to point at. Words of one place only save nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[tuple[str, str, str]] = Counter()
            for lang, f, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if not suspect(t, known):
                    counts.update((lang, f, w) for w in _words(t))
            columns = list(zip(*counts, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(counts.values(), pa.int64())], names=["lang", "f", "w", "n"])

    counted = texts.select("lang", "f", "t").mapInArrow(run, "lang string, f string, w string, n long").groupBy("lang", "f", "w").agg(F.sum("n").alias("n")).where("n > 1")
    size, room = F.octet_length("w"), DICTIONARY // fields
    best = Window.partitionBy("lang", "f").orderBy(F.desc(F.col("n") * size), "w")
    kept = counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= room // 3)  # a word and its blank take three bytes at least
    upto = F.sum(size + 1).over(best.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out: dict[str, list[tuple[int, str]]] = {}
    for r in kept.withColumn("upto", upto).where(F.col("upto") <= room).select("lang", "w", "n").collect():
        out.setdefault(r["lang"], []).append((r["n"], r["w"]))
    return {lang: (" ".join(w for _, w in sorted(found)) + " ").encode("utf-8", "surrogatepass") for lang, found in sorted(out.items())}


def candidates(text: str) -> dict[str, tuple[float, str]]:
    """Every text that a chain of steps gives: (cost, chain). The text itself costs nothing."""
    found: dict[str, tuple[float, str]] = {text: (0, "")}
    front = [text]
    for _ in range(STEPS):
        new = []
        for t in front:
            cost, chain = found[t]
            side_by_side, wide = _PAIR.search(t), _WIDE.search(t)
            for name, step, is_wide in steps():
                if not (wide if is_wide else side_by_side):
                    continue
                got = step(t)
                if got != t and got not in found:
                    found[got] = (cost + STEP_COST, f"{chain} {name}".strip())
                    new.append(got)
        front = new
        if not front:
            break
    return found


def _reads_as_word(word: str, new: str) -> bool:
    """Whether a swap can be meant: letters come of letters, or of signs between letters; case and script go on within the word."""
    if not any(c.isascii() and c.isalpha() for c in word):  # an amount: digits and one sign, which is read as a fraction
        pairs = [(a, b) for a, b in zip(word, new, strict=True) if a > "\x7f"]
        if len(pairs) == 1 and unicodedata.category(pairs[0][1]) == "No":
            return True
    foreign = not any("a" <= c.lower() <= "z" for c in word)
    shouted = sum("A" <= c <= "Z" for c in word) > 1 and not any("a" <= c <= "z" for c in word)
    for i, (a, b) in enumerate(zip(word, new, strict=True)):
        if a == b:
            if foreign and a > "\x7f":
                return False
            continue
        inside = 0 < i < len(word) - 1 and word[i - 1].isalpha() and word[i + 1].isalpha()
        if not b.isalpha() or not (a.isalpha() or inside) or (b > "\u024f") != foreign or b.islower() and shouted:
            return False
        if i and new[i - 1].islower() and b.isupper():
            return False
    return True


def _swapped_word(word: str, judge: Judge, lang: str | None) -> tuple[str, str]:
    """A word read in one single-byte encoding and written in another, where that shortens its description."""
    if (word, lang) not in judge.words:
        best, chain, length = word, "", judge.length(f" {word} ", lang)
        for read, written in SWAPS:
            new = word.translate(_swap_table(read, written))
            if new != word and _reads_as_word(word, new) and (n := judge.length(f" {new} ", lang) + STEP_COST + (SWAP_COST if any(c.isalpha() for c in new) else 0)) < length:
                best, chain, length = new, f"{read}>{written}", n
        if len(judge.words) > 200_000:
            judge.words.clear()
        judge.words[word, lang] = best, chain
    return judge.words[word, lang]


def _unescaped(m: re.Match) -> str:
    if m[0][0] == "&":
        entity = "&" + m[0].rpartition("&")[2].removeprefix("amp;").replace("amp;", "")
        got = html.unescape(entity)
        lost = "\ufffd" in got and not re.fullmatch(r"&#(?:0*65533|[xX]0*[fF]{3}[dD]);?", entity)  # no character's number
        return m[0] if got.isascii() or lost else got
    codes = [int(h, 16) for h in re.findall(r"[ux]([0-9a-fA-F]+)", m[0])]
    if len(codes) == 2 and 0xD800 <= codes[0] < 0xDC00:
        return chr(0x10000 + (codes[0] - 0xD800 << 10) + codes[1] - 0xDC00)
    return m[0] if codes[0] < 128 or 0xD800 <= codes[0] < 0xE000 or len(codes) == 2 else chr(codes[0])


def unescape(text: str) -> str:
    """The text with its escaped characters beyond ASCII; those in ASCII stay escaped, so quotes and separators do."""
    return _ESCAPES.sub(_unescaped, text) if "\\" in text or "&" in text else text


def restore(text: str | None, judge: Judge, lang: str | None = None) -> tuple[str | None, str | None, bool]:
    """(text as first written, chain of steps or null, whether it is garbled). Characters that were lost stay lost.

    A text that was garbled before it was escaped is unescaped first; right text that is merely escaped isn't garbled.
    """
    if text is None:
        return text, None, False
    best, chain, garbled = _restore(text, judge, lang)
    plain = unescape(text)
    if plain != text:
        under, how, bad = _restore(plain, judge, lang, STEP_COST)
        if bad and (not garbled or how and under != unescape(best)):
            return (under, f"unescape {how}", True) if how else (text, None, True)
    return best, chain, garbled


def _restore(text: str, judge: Judge, lang: str | None, start: float = 0) -> tuple[str, str | None, bool]:
    """As restore, of a text whose characters are as they stand; start is what any chain costs besides its steps."""
    if text.isascii():
        return text, None, False
    found = candidates(text)
    best, chain = text, ""
    if len(found) > 1:
        lengths = {t: judge.length(t, lang) + cost + (start if cost else 0) for t, (cost, _) in found.items()}
        best = min(found, key=lambda t: (lengths[t], found[t][0], t))
        chain = found[best][1]
    swaps: list[str] = []

    def swap(m: re.Match) -> str:
        new, how = _swapped_word(m[0], judge, lang)
        if how and how not in swaps:
            swaps.append(how)
        return new

    best = _WORD.sub(swap, best)
    chain = " ".join([chain, *swaps]).strip()
    return best, chain or None, bool(chain) or _LOST.search(text) is not None


@lru_cache(maxsize=4)
def _judge(items: tuple[tuple[str, bytes], ...], alphabet: tuple[tuple[str, float], ...]) -> Judge:
    return Judge(dict(items), dict(alphabet))


def corpus_dictionaries(df: DataFrame, fields: Sequence[str], lang: str) -> tuple[dict[str, bytes], dict[str, float]]:
    """Dictionaries of the words that save most, and what characters cost, both counted over all texts.

    The LANGUAGES most frequent languages have a dictionary of their own, all others share one.
    """
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("t")) for f in fields]))
    texts = df.select(base_language(lang).alias("lang"), each.alias("x")).where("x.t <> ''").select("lang", "x.f", "x.t")
    per = {(r["lang"], r["f"]): r["n"] for r in texts.groupBy("lang", "f").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang", "f").limit(LANGUAGES * len(fields)).collect()}
    own = sorted({x for x, _ in per})
    every = texts.where(~F.col("lang").isin(*own)).groupBy("f").agg(F.count("*").alias("n")).collect() if own else []
    per |= {(OTHERS, r["f"]): r["n"] for r in every}
    named = texts.withColumn("lang", F.when(F.col("lang").isin(*own), F.col("lang")).otherwise(F.lit(OTHERS)))
    # a frequent language weighs no more than SAMPLE texts, so the letters of the others don't count as strange
    weight = {x: min(1.0, SAMPLE / n) for x, n in per.items()}
    known = known_characters(sum((Counter(c) for c in _character_counts(named, None).values()), Counter()))
    counts: Counter[str] = Counter()
    for x, seen in _character_counts(named, known).items():
        counts.update({c: n * weight[x] for c, n in seen.items() if n > 1})
    costs = character_costs({c: max(n, 1.000001) for c, n in counts.items()}, sum(n * weight[x] for x, n in per.items()))
    return _dictionaries(named, known, len(fields)), costs


def base_language(lang: str) -> Column:
    """The primary subtag in lower case; null as und."""
    return F.lower(F.substring_index(F.coalesce(F.col(lang), F.lit("und")), "-", 1))


def may_be_garbled(column: str) -> Column:
    """Whether a text holds a character beyond ASCII, as it stands or escaped; all others are right."""
    return F.col(column).rlike(rf"[^\x00-\x7f]|{_ESCAPED}")


def restored(column: Column | str, lang: Column | str, trained: tuple[dict[str, bytes], dict[str, float]]) -> Column:
    """struct(text, chain, garbled) of a text column and its language; null stays null, texts in ASCII without escapes are left at once."""
    items, alphabet = tuple(sorted(trained[0].items())), tuple(sorted(trained[1].items()))

    @F.arrow_udf("struct<text:string,chain:string,garbled:boolean>")
    def run(batch: pa.Array, langs: pa.Array) -> pa.Array:
        judge = _judge(items, alphabet)
        rows = [restore(t, judge, l) for t, l in zip(batch.to_pylist(), langs.to_pylist(), strict=True)]
        return pa.array([{"text": a, "chain": b, "garbled": c} for a, b, c in rows], pa.struct([("text", pa.string()), ("chain", pa.string()), ("garbled", pa.bool_())]))

    return run(column, lang)


def garbled_fields(df: DataFrame, key: str, fields: Sequence[str], lang: str) -> DataFrame:
    """key, field_name, original, restored, chain: one row per garbled field of a row.

    A field is garbled where a chain of steps shortens its description, or where characters were lost (U+FFFD, C1 controls);
    what can be restored is. Escaped characters (JSON, HTML) are judged as what they stand for. Right text in any language gives no row, nor do null and empty fields. Rows are local: no shuffle.
    """
    dictionaries = corpus_dictionaries(df, fields, lang)
    foreign = F.array(*[F.when(may_be_garbled(f), F.struct(F.lit(f).alias("field_name"), F.col(f).alias("original"))) for f in fields])
    each = df.select(F.col(key), base_language(lang).alias("_lang"), F.explode(F.array_compact(foreign)).alias("x")).select(key, "_lang", "x.*")
    return each.withColumn("r", restored("original", "_lang", dictionaries)).where("r.garbled").select(key, "field_name", "original", F.col("r.text").alias("restored"), F.col("r.chain").alias("chain"))


@R.query("p2_restored")
def p2_restored(spark: SparkSession, root: str) -> DataFrame:
    """The garbled fields with the text as it was first written, as far as it can be had."""
    return garbled_fields(table(spark, root, "recipes_structured"), "recipe_id", ["recipename", "ingredientslist"], "lang")


@R.query("p2_found")
def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """recipe_id, field_name of every garbled field."""
    return p2_restored(spark, root).select("recipe_id", "field_name")
