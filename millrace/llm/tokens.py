"""Encoding of a whole corpus with a public byte-level BPE tokenizer, each distinct word once.

Pre-tokens are independent of each other in byte-level BPE, so a word has the same ids wherever it stands. A first pass counts
the words; each distinct word is encoded once. Words that make up a large part of the corpus (at most HOT_WORDS by proof: each
holds at least one part in HOT_WORDS of all words) go back to the texts by a broadcast table, all others by one shuffled join; the
ids come together again by position.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.registry import R
from millrace.session import cut, table

#: Folder of the public vocabulary files; a parameter of every operator here.
TOKENIZERS = "/opt/tokenizers"
HOT_WORDS = 20_000
#: Longer words are never broadcast, so the broadcast table has at most HOT_WORDS x HOT_BYTES bytes of words.
HOT_BYTES = 48

# Fixed value: the published pre-token pattern of the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def ranks(path: str, name: str) -> dict[bytes, int]:
    with open(f"{path}/{name}.tiktoken", "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoding(path: str = TOKENIZERS, name: str = "byte_bpe_50k") -> tiktoken.Encoding:
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks(path, name), special_tokens={})


_WORDS = regex.compile(PATTERN)


def words(text: str) -> list[str]:
    """The pre-tokens of a text; joined they give the text again."""
    return _WORDS.findall(text)


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """word, n: every distinct pre-token with its number of places, added up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for t in batch.column(0):
                if t.is_valid:
                    counts.update(words(t.as_py()))
                if len(counts) > 200_000:
                    yield flush()
        yield flush()

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def encode_words(counted: DataFrame, path: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """Adds ids: each distinct word encoded once."""

    @F.arrow_udf("array<int>")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array(encoding(path, name).encode_ordinary_batch(batch.to_pylist(), num_threads=1), type=pa.list_(pa.int32()))

    return counted.withColumn("ids", run("word"))


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """key, ids: one row per input row, without special tokens.

    Null and empty texts have the empty list. Repeated rows give as many rows; rows with one key and different texts each give
    their own. Strings of special tokens in a text are ordinary text. Texts are encoded whole, however long.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
    vocabulary = cut(encode_words(count_words(rows, "text"), path, name))
    total = vocabulary.agg(F.sum("n")).first()[0] or 0
    least = max(2, -(-total // HOT_WORDS))
    hot_rows = vocabulary.where((F.col("n") >= least) & (F.octet_length("word") <= HOT_BYTES)).select("word", "ids").collect()
    hot = spark.sparkContext.broadcast({r[0]: np.array(r[1], np.int32) for r in hot_rows})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per text one row with the places and ids of its hot words, and one row for each other word with its places."""
        known = hot.value
        for batch in batches:
            keys, digests, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for k, d, t in zip(keys, digests, texts, strict=True):
                rest: dict[str, list[int]] = {}
                at, sizes, ids = [], [], []
                for i, w in enumerate(words(t or "")):
                    got = known.get(w)
                    if got is None:
                        rest.setdefault(w, []).append(i)
                    else:
                        at.append(i)
                        sizes.append(len(got))
                        ids.append(got)
                for row in [(k, d, None, at, sizes, np.concatenate(ids) if ids else []), *((k, d, w, p, None, None) for w, p in rest.items())]:
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                if len(out[0]) > 50_000:
                    yield _placed(out, kind)
                    out = ([], [], [], [], [], [])
            yield _placed(out, kind)

    kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[rows.dtypes[0][1]]
    digest = F.struct(F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    keyed = rows.select("k", digest.cast("string").alias("d"), "text")
    placed = keyed.mapInArrow(place, f"k {rows.dtypes[0][1]}, d string, word string, at array<int>, sizes array<int>, ids array<int>")
    placed = cut(placed)
    rest = placed.where(F.col("word").isNotNull()).select("k", "d", "word", "at").join(vocabulary.select("word", "ids"), "word").select("k", "d", "at", F.lit(None).cast("array<int>").alias("sizes"), "ids")
    parts = placed.where(F.col("word").isNull()).select("k", "d", "at", "sizes", "ids").unionByName(rest)

    @F.arrow_udf("array<int>")
    def assemble(batch: pa.Array) -> pa.Array:
        return pa.array([_assembled(x) for x in batch.to_pylist()], type=pa.list_(pa.int32()))

    grouped = parts.groupBy("k", "d").agg(F.collect_list(F.struct("at", "sizes", "ids")).alias("parts"))
    copies = F.size(F.filter("parts", lambda p: p.sizes.isNotNull()))
    return grouped.select(F.col("k").alias(key), assemble("parts").alias("ids"), F.explode(F.sequence(F.lit(1), copies)).alias("_c")).drop("_c")


def _placed(out: tuple[list, ...], kind: pa.DataType) -> pa.RecordBatch:
    ints = pa.list_(pa.int32())
    types = (kind, pa.string(), pa.string(), ints, ints, ints)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["k", "d", "word", "at", "sizes", "ids"])


def _assembled(parts: list[dict]) -> np.ndarray:
    """The ids of one text in order; copies of a text bring each place several times, of which one counts."""
    spans: dict[int, list[int]] = {}
    for p in parts:
        if p["sizes"] is None:
            for i in p["at"]:
                spans[i] = p["ids"]
        else:
            start = 0
            for i, n in zip(p["at"], p["sizes"], strict=True):
                spans[i] = p["ids"][start : start + n]
                start += n
    return np.fromiter((x for i in sorted(spans) for x in spans[i]), np.int32)


def decode_corpus(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", path: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """key, text: the texts of id lists, by a join with the table of token bytes (its size is fixed by the vocabulary).

    An empty or null list gives the empty text; ids outside the vocabulary raise an error. Bytes that are no UTF-8 become U+FFFD.
    """
    spark = encoded.sparkSession
    rows = [(i, bytearray(b)) for b, i in ranks(path, name).items()]
    tokens = F.broadcast(spark.createDataFrame(rows, "token int, b binary"))
    one = encoded.select(F.col(key), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids")).withColumn("_row", F.xxhash64(F.col(key), F.col("ids")))
    counted = one.groupBy(key, "_row", "ids").agg(F.count("*").alias("_copies"))
    long = counted.select(key, "_row", "_copies", F.posexplode_outer("ids").alias("at", "token"))
    known = long.join(tokens, "token", "left").withColumn("b", F.when(F.col("token").isNotNull() & F.col("b").isNull(), F.raise_error(F.lit("id outside the vocabulary")).cast("binary")).otherwise(F.coalesce(F.col("b"), F.lit(b""))))

    @F.arrow_udf("string")
    def join_bytes(batch: pa.Array) -> pa.Array:
        return pa.array([b"".join(x["b"] for x in parts).decode("utf-8", "replace") for parts in batch.to_pylist()], pa.string())

    grouped = known.groupBy(key, "_row", "_copies").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("at", F.lit(0)).alias("at"), "b"))).alias("parts"))
    return grouped.select(key, join_bytes("parts").alias("text"), F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_c")).drop("_c")


def token_count(column: str, path: str = TOKENIZERS, name: str = "byte_bpe_50k"):
    """Number of tokens of a text, 0 for null and empty texts; row-local."""

    @F.arrow_udf("long")
    def run(batch: pa.Array) -> pa.Array:
        enc = encoding(path, name)
        return pa.array([len(enc.encode_ordinary(t)) if t else 0 for t in batch.to_pylist()], pa.int64())

    return run(column)


@R.query("p8_ids")
def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, ids of every document by byte_bpe_50k."""
    return encode_corpus(table(spark, root, "documents"))


@R.query("p8_decoded")
def p8_decoded(spark: SparkSession, root: str) -> DataFrame:
    """doc_id and the text read back from the ids; equal to the text of the document (null as empty)."""
    return decode_corpus(encode_corpus(table(spark, root, "documents")))
