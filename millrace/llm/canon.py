"""Mapping of freely typed values to a reference list: token repair by edit distance, then soft TF-IDF over whole entries.

Everything is done on distinct values and distinct tokens. A distinct token meets the reference vocabulary in an equi-join on
deletion variants, which finds every pair within the edit bound without comparing all with all; the repaired tokens of a value are
combined per entry, and the best entry of a value wins. The mapping goes back to the rows by a join that spreads hot values.
"""

from __future__ import annotations

import math
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.encoding import corpus_dictionaries, may_be_garbled, restored
from millrace.llm.registry import R
from millrace.operators.packed import LISTS, explode_packed
from millrace.operators.prefix import hot_join
from millrace.session import cut, table

#: Tables of the reference up to so many rows are sent to all tasks; larger ones are joined by shuffle, with the same result.
MAX_LISTED = 50_000
#: Least score of an accepted entry, and what an edit in every letter would take off the similarity of a token.
ACCEPT, EDIT = 0.79, 0.5
#: Words beyond this length meet by their SEGMENTS instead of by variants, of which there would be too many: two edits and as many lost
#: characters as leave one segment whole leave it near its place.
LONG, SEGMENTS = 48, 8

# Fixed values, in English as the reference list: words that tell an amount, a unit, a quality or a way of preparing, and never which
# thing is meant. Which of them are words of the reference list, and so count, is looked up in the whole list at every size.
UNITS = "g gm gram grams kg mg oz ounce ounces lb lbs ml cl dl l litre liter litres liters tsp tbsp teaspoon teaspoons tablespoon tablespoons cup cups pint pints pc pcs piece pieces pkt packet packets pack jar jars tin tins can cans bunch bunches handful handfuls pinch pinches dash sprig sprigs knob slice slices small medium large inch cm mm dozen"
REMARKS = (
    "a an the of about approx circa few some any more extra plus to for with into as at or and if until you ll want serve taste needed required optional good best quality fresh freshly leftover organic homemade ripe nice ready brand low fat free range room temp temperature warm warmed "
    "hot cold chilled roughly finely coarsely thinly thickly lightly torn peeled diced washed drained divided chopped toasted rinsed sliced pureed julienned softened thawed sifted sauteed grated heaped crushed cubed halved quartered melted beaten trimmed cooked boiled roasted fried steamed soaked pitted seeded cut pieces cm c la mode preferably such use your choice each"
)
NOISE = frozenset(REMARKS.split())

_FOLD = {ord(a): b for a, b in zip("ıİłŁøØđĐßæÆœŒ", ["i", "i", "l", "l", "o", "o", "d", "d", "ss", "ae", "ae", "oe", "oe"], strict=True)}
_TOKEN = re.compile(r"[^\W_�]*�[^\W_]*(?:�[^\W_]*)*|[^\W_]+")
_AMOUNT = r"[\s\W\d¼-¾⅐-⅞]*(?:[^\x00-\x7f](?=\s)\s*)?"  # a lone sign before a blank is an amount that was read wrongly
_LEAD = re.compile(rf"^{_AMOUNT}(?:\b(?:about|approx|some|a few|few)\b{_AMOUNT})*(?:(?:{'|'.join(UNITS.split())})\b\.?\s+){{0,2}}", re.I)
_TELLS_AMOUNT = re.compile(r"[\d¼-¾⅐-⅞]|[^\x00-\x7f]\s|about|few|some", re.I)
_CONTROLS = {c: bytes([c]).decode("cp1252", "ignore") for c in range(128, 160)}
_BRACKETS = re.compile(r"\([^()]*\)|\[[^\[\]]*\]")
_DASH = re.compile(r"\s[-–—]\s.*$", re.S)
_APOSTROPHE = re.compile(r"(?<=\w)['’‘`´](?=\w)")


def fold(text: str) -> str:
    """Lower case without accents, format characters and apostrophes within words."""
    text = unicodedata.normalize("NFKD", text.translate(_CONTROLS).translate(_FOLD))
    text = "".join(c for c in text if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    return _APOSTROPHE.sub("", text.casefold())


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(fold(text))


def content_tokens(value: str, vocabulary: frozenset[str] | set[str] = frozenset()) -> list[str]:
    """The tokens of a value that tell what is meant: without amount and unit, bracketed and dashed remarks, and noise words.

    A noise word that the vocabulary holds counts, but not as the unit after an amount. If nothing is left, the remarks count too.
    """
    bare = _DASH.sub("", _BRACKETS.sub(" ", value))
    for text in (bare, value):
        head = _LEAD.match(text)
        cut = text[head.end() :] if head and _TELLS_AMOUNT.search(head[0]) else text
        got = [t for t in tokens(cut) if not any(c.isdigit() for c in t) and not ("�" in t and len(t.replace("�", "")) < 2) and (t in vocabulary or t not in NOISE)]
        if got:
            return got
    return []


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits between two tokens, a swap of neighbours being one; U+FFFD in a stands for any one or two characters at no cost.

    Gives most + 1 where there are more than most.
    """
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most + a.count("�"):
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            if x == "�":
                new[j] = min(row[j - 1], row[j - 2] if j > 1 else most + 1, row[j] + 1, new[j - 1] + 1)
                continue
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                new[j] = min(new[j], before[j - 2] + 1)
        before, row = row, new
    return min(row[-1], most + 1)


def edits_allowed(length: int) -> int:
    """Edits that a reference word of so many letters may be away from what is typed."""
    return 0 if length < 3 else 1 if length < 4 else 2


def variants(token: str, edits: int) -> list[str]:
    """The token with up to so many characters left out; lost characters are left out first."""
    token = token.replace("�", "")
    found, front = {token}, {token}
    for _ in range(edits):
        front = {t[:i] + t[i + 1 :] for t in front for i in range(len(t))} - found
        found |= front
    return sorted(found)


def _segment(length: int, k: int) -> tuple[int, int]:
    return length * k // SEGMENTS, length * (k + 1) // SEGMENTS


def word_keys(word: str) -> list[str]:
    """What a reference word is met by: its variants, or the segments of a long one with their place."""
    if len(word) <= LONG:
        return variants(word, edits_allowed(len(word)))
    return sorted({f"{len(word)} {k} {word[a:b]}" for k in range(SEGMENTS) for a, b in [_segment(len(word), k)]})


def token_keys(token: str) -> list[str]:
    """What a token is met by: its variants up to two edits, and if it may be a long word the segments of any length and shift in reach.

    A lost character stands for one or two, so it moves what comes after it by one at most.
    """
    out = set(variants(token, 2)) if len(token) <= LONG + 2 else set()
    lost = token.count("�")
    reach = 2 + min(lost, SEGMENTS - 3)
    for length in range(max(LONG + 1, len(token) - 2), len(token) + reach + 1):
        for k in range(SEGMENTS):
            a, b = _segment(length, k)
            for shift in range(-reach, 3):
                if 0 <= a + shift and b + shift <= len(token) and "�" not in (part := token[a + shift : b + shift]):
                    out.add(f"{length} {k} {part}")
    return sorted(out)


def stems(token: str) -> list[str]:
    """The token and what it may be the plural of."""
    out = [token]
    if len(token) > 3 and token.endswith("s"):
        out.append(token[:-1])
        if token.endswith("es"):
            out.append(token[:-2])
        if token.endswith("ies"):
            out.append(token[:-3] + "y")
    return out


def _vocabulary(reference: DataFrame, entry: str) -> tuple[DataFrame, DataFrame]:
    """(word, entry, at, span, weight): each entry by its words, single and run together; (entry, size, norm2)."""

    @F.arrow_udf("array<string>")
    def split(batch: pa.Array) -> pa.Array:
        return pa.array([tokens(x) for x in batch.to_pylist()], pa.list_(pa.string()))

    listed = reference.select(F.col(entry).alias("entry")).where(F.col(entry).isNotNull()).distinct().withColumn("words", split("entry")).where(F.size("words") > 0)
    n = listed.count()
    single = listed.select("entry", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"), "words")
    weights = single.groupBy("word").agg((1 + F.log(F.lit(float(n + 1)) / F.countDistinct("entry"))).alias("idf"))
    weighted = single.join(weights, "word")
    norms = weighted.groupBy("entry").agg(F.max("size").alias("size"), F.sum(F.col("idf") * F.col("idf")).alias("norm2"))
    # words run together: from every word of an entry to every later one, weights by running sums

    @F.arrow_udf("array<struct<word:string,at:int,span:int,weight:double>>")
    def runs(batch: pa.Array) -> pa.Array:
        rows = []
        for parts in batch.to_pylist():
            upto = [0.0]
            for x in parts:
                upto.append(upto[-1] + x["idf"] ** 2)
            out = []
            for i in range(len(parts)):
                word = parts[i]["word"]
                for j in range(i + 1, len(parts)):
                    word += parts[j]["word"]
                    out.append({"word": word, "at": i, "span": j - i + 1, "weight": upto[j + 1] - upto[i]})
            rows.append(out)
        return pa.array(rows, pa.list_(pa.struct([("word", pa.string()), ("at", pa.int32()), ("span", pa.int32()), ("weight", pa.float64())])))

    listed_words = weighted.groupBy("entry").agg(F.sort_array(F.collect_list(F.struct("at", "word", "idf"))).alias("parts"))
    run = listed_words.where(F.size("parts") > 1).select("entry", F.explode(runs("parts")).alias("x")).select("x.word", "entry", "x.at", "x.span", "x.weight")
    one = weighted.select("word", "entry", "at", F.lit(1).alias("span"), F.pow("idf", F.lit(2)).alias("weight"))
    return one.unionByName(run), norms


def repair_tokens(tokens_: DataFrame, words: DataFrame) -> DataFrame:
    """token, word, similarity: every vocabulary word within the edit bound of a distinct token, or whose plural it is."""

    @F.arrow_udf("array<struct<v:string,stem:string>>")
    def token_variants(batch: pa.Array) -> pa.Array:
        rows = []
        for t in batch.to_pylist():
            found = {}
            for s in stems(t):
                for v in token_keys(s):
                    found.setdefault((v, s), None)
            rows.append([{"v": v, "stem": s} for v, s in found])
        return pa.array(rows, pa.list_(pa.struct([("v", pa.string()), ("stem", pa.string())])))

    @F.arrow_udf("array<string>")
    def word_variants(batch: pa.Array) -> pa.Array:
        return pa.array([word_keys(w) for w in batch.to_pylist()], pa.list_(pa.string()))

    @F.arrow_udf("double")
    def similarity(token: pa.Array, stem: pa.Array, word: pa.Array) -> pa.Array:
        out = []
        for t, s, w in zip(token.to_pylist(), stem.to_pylist(), word.to_pylist(), strict=True):
            most = edits_allowed(len(w))
            d = edit_distance(s, w, most)
            out.append(None if d > most else 1.0 - EDIT * d / len(w) - 0.01 * (t != s) - 0.01 * ("�" in s))
        return pa.array(out, pa.float64())

    left = tokens_.select("token", F.explode(token_variants("token")).alias("x")).select("token", "x.*")
    right = words.select("word").distinct().select("word", F.explode(word_variants("word")).alias("v"))
    met = left.join(right, "v").select("token", "stem", "word").distinct()
    return met.withColumn("similarity", similarity("token", "stem", "word")).where("similarity IS NOT NULL").groupBy("token", "word").agg(F.max("similarity").alias("similarity"))


def map_values(values: DataFrame, reference: DataFrame, entry: str) -> DataFrame:
    """value, entry, score for every distinct value of which an entry is denoted; values has value and text (what is read of it).

    Score is the soft TF-IDF cosine of the value's repaired content tokens and the entry's tokens: every token of the entry must be
    met, a token that means nothing in the entry counts by its own weight (unknown words by the greatest), and ACCEPT is the least. Ties go to the entry that comes first. Values that
    denote no entry, empty or null values give no row. An empty reference list gives none at all.
    """
    words, norms = _vocabulary(reference, entry)
    words, norms = cut(words), cut(norms)
    size = norms.count()
    known = frozenset(r[0] for r in words.where((F.col("span") == 1) & F.col("word").isin(*sorted(NOISE))).select("word").distinct().collect())  # only noise words are asked for
    small = F.broadcast if max(size, words.count()) <= MAX_LISTED else (lambda df: df)

    @F.arrow_udf("array<string>")
    def content(batch: pa.Array) -> pa.Array:
        return pa.array([content_tokens(x, known) if x else [] for x in batch.to_pylist()], pa.list_(pa.string()))

    read = cut(values.where(F.col("value").isNotNull()).select("value", content("text").alias("tokens")).where(F.size("tokens") > 0))
    each = read.select("value", F.posexplode("tokens").alias("pos", "token"))
    repaired = cut(repair_tokens(each.select("token").distinct(), words))
    strange = (1 + math.log(size + 1)) ** 2
    exact = words.where("span = 1").groupBy("word").agg(F.max("weight").alias("own"))
    known_own = repaired.where("similarity >= 0.98").join(small(exact), "word").groupBy("token").agg(F.max("own").alias("own"))
    owned = each.join(known_own, "token", "left").withColumn("own", F.coalesce("own", F.lit(strange)))
    wholes = owned.groupBy("value").agg(F.sum("own").alias("all_own"))
    met = owned.join(repaired, "token").join(small(words), "word")
    spots = met.groupBy("value", "entry", "at", "span").agg(F.max(F.struct("similarity", "pos", "own")).alias("b"), F.max("weight").alias("weight"))
    sums = spots.groupBy("value", "entry").agg(F.sum("weight").alias("got"), F.sum(F.col("b.similarity") * F.col("weight")).alias("dot"), F.aggregate(F.collect_set(F.struct("b.pos", "b.own")), F.lit(0.0), lambda a, x: a + x.own).alias("used"))
    scored = sums.join(small(norms), "entry").where(F.col("got") >= F.col("norm2") - 1e-6).join(wholes, "value")
    value2 = F.col("got") + F.greatest(F.lit(0.0), F.col("all_own") - F.col("used"))
    score = F.least(F.lit(1.0), F.col("dot") / F.sqrt(F.col("got") * value2))
    ranked = scored.select("value", "entry", F.round(score, 9).alias("score")).where(F.col("score") >= ACCEPT)
    return ranked.groupBy("value").agg(F.max(F.struct("score", "entry")).alias("top"), F.min(F.struct(-F.col("score"), F.col("entry"))).alias("first")).select("value", F.col("first.entry").alias("entry"), F.col("top.score").alias("score"))


def typed_values(df: DataFrame, key: str, field: str, lang: str) -> tuple[DataFrame, DataFrame]:
    """(key, item_pos, value) of a packed field; and the distinct values with n, their rows, and text, the value as first written."""
    items = explode_packed(df, [key], {field: LISTS}).select(key, "item_pos", F.col("item").alias("value"))
    counted = items.groupBy("value").agg(F.count("*").alias("n"))
    trained = corpus_dictionaries(df, [field], lang)
    values = cut(counted.withColumn("text", F.when(may_be_garbled("value"), restored("value", F.lit(None).cast("string"), trained).getField("text")).otherwise(F.col("value"))))
    return items, values


def map_typed(df: DataFrame, key: str, field: str, lang: str, reference: DataFrame, entry: str) -> DataFrame:
    """key, item_pos, value, entry, score for every value of a packed field; entry and score are null where none is denoted."""
    items, values = typed_values(df, key, field, lang)
    mapped = values.select("value", "n").join(map_values(values, reference, entry), "value", "left")
    return hot_join(items, cut(mapped), "value", "n").drop("n")


def _mapped(spark: SparkSession, root: str) -> DataFrame:
    return map_typed(table(spark, root, "recipes_structured"), "recipe_id", "ingredientslist", "lang", table(spark, root, "ingredient_bridge_food"), "ingredient")


@R.query("p7_found")
def p7_found(spark: SparkSession, root: str) -> DataFrame:
    """recipe_id, item_pos, ingredient of the values that denote an entry without being it literally."""
    return _mapped(spark, root).where(F.col("entry").isNotNull() & (F.col("entry") != F.col("value"))).select("recipe_id", "item_pos", F.col("entry").alias("ingredient"))


@R.query("p7_unmatched")
def p7_unmatched(spark: SparkSession, root: str) -> DataFrame:
    """value, n: the values that denote no entry, with their number of places."""
    return _mapped(spark, root).where(F.col("entry").isNull()).groupBy("value").agg(F.count("*").alias("n"))


@R.query("p7_mapping")
def p7_mapping(spark: SparkSession, root: str) -> DataFrame:
    """value, ingredient, score: the entry of every distinct value that denotes one."""
    _, values = typed_values(table(spark, root, "recipes_structured"), "recipe_id", "ingredientslist", "lang")
    return map_values(values, table(spark, root, "ingredient_bridge_food"), "ingredient").withColumnRenamed("entry", "ingredient")
