"""Interaction logs: dense ids, k-core, recommenders and ranking metrics."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, LongType, StructField, StructType

from millrace.session import cut, shared_dir

#: Lists of items are sent to all tasks up to so many pairs of user and item in all (four bytes each).
MAX_SENT = 32_000_000


def dense_ids(df: DataFrame, c: str) -> DataFrame:
    """c, idx from 0 in sorted order; values are ordered in ranges over the cluster, never in one task."""
    ranged = cut(df.select(c).where(F.col(c).isNotNull()).distinct().repartitionByRange(c).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"), F.min(c).alias("_least"))
    start = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_least")) - F.col("_n")).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(c)) - 1
    return ranged.join(F.broadcast(start), "_p").select(c, (F.col("_start") + inside).alias("idx"))


def k_core(pairs: DataFrame, user: str, item: str, k: int, *, max_rounds: int = 200) -> DataFrame:
    """The distinct pairs of which every user and every item keeps at least k, items judged after users in each round."""
    now = cut(pairs.select(user, item).where(F.col(user).isNotNull() & F.col(item).isNotNull()).distinct())
    n = now.count()
    for _ in range(max_rounds):
        for side in (user, item):
            enough = now.groupBy(side).agg(F.count("*").alias("_n")).where(F.col("_n") >= k).select(side)
            now = now.join(enough, side, "left_semi")
        now = cut(now)
        left = now.count()
        if left == n:
            return now
        n = left
    raise RuntimeError(f"the core did not settle in {max_rounds} rounds")


def popularity(train: DataFrame, item: str) -> DataFrame:
    """item, score: the item's rows."""
    return train.groupBy(item).agg(F.count("*").cast("double").alias("score"))


def top_popular(train: DataFrame, users: DataFrame, user: str, item: str, k: int) -> DataFrame:
    """user, item, rank: the k most popular items that the user has not seen (ties: the smaller item).

    A user who has seen s items finds their k within the first k + s of the list, so each user meets that many items, no more.
    """
    seen = train.select(user, item).distinct()
    per = users.select(user).distinct().join(seen.groupBy(user).agg(F.count("*").alias("_s")), user, "left").withColumn("_s", F.coalesce("_s", F.lit(0)))
    most = (per.agg(F.max("_s")).first()[0] or 0) + k
    ranked = popularity(train, item).orderBy(F.desc("score"), item).limit(most)
    listed = F.broadcast(ranked.withColumn("_r", F.row_number().over(Window.orderBy(F.desc("score"), item))))
    wide = per.select(user, F.explode(F.sequence(F.lit(1), (F.col("_s") + k).cast("int"))).alias("_r")).join(listed, "_r").select(user, item, "_r")
    return wide.join(seen, [user, item], "left_anti").withColumn("rank", F.row_number().over(Window.partitionBy(user).orderBy("_r"))).where(F.col("rank") <= k).select(user, item, "rank")


def item_similarity(train: DataFrame, user: str, item: str, *, most: int = 1000) -> DataFrame:
    """item, other, sim: common users over the root of both items' users, for distinct items.

    A user with more than most items would bring more pairs than all others; such users are refused rather than cut.
    """
    seen = train.select(user, item).distinct()
    if seen.groupBy(user).agg(F.count("*").alias("n")).where(F.col("n") > most).limit(1).count():
        raise ValueError(f"a user has more than {most} items")
    n = seen.groupBy(item).agg(F.count("*").alias("_n"))
    pairs = seen.join(seen.select(user, F.col(item).alias("other")), user).where(F.col(item) != F.col("other")).groupBy(item, "other").agg(F.count("*").alias("c"))
    return pairs.join(n, item).join(n.select(F.col(item).alias("other"), F.col("_n").alias("_m")), "other").select(item, "other", (F.col("c") / F.sqrt(F.col("_n").cast("double") * F.col("_m"))).alias("sim"))


def top_similar(train: DataFrame, user: str, item: str, k: int) -> DataFrame:
    """user, item, rank: unseen items by the sum of their similarity to the user's items (ties: the smaller item).

    Of up to MAX_SENT distinct pairs every task gets all lists of items and scores its users one by one, so neither pairs of items nor
    pairs of user and item are ever shuffled. More pairs are joined by shuffle, with the same result.
    """
    lists = cut(train.groupBy(user).agg(F.array_sort(F.collect_set(item)).alias("_seen")))
    if (lists.agg(F.sum(F.size("_seen"))).first()[0] or 0) > MAX_SENT:
        return _top_similar_joined(lists.select(user, F.explode("_seen").alias(item)), user, item, k)
    sent = lists.sparkSession.sparkContext.broadcast(_packed(lists, user))
    kinds = (lists.schema[user], lists.schema["_seen"].dataType.elementType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _Scorer.of(sent)
        for batch in batches:
            users, rows = batch.column(0), [score.top(x, k, known) for x, known in zip(_places(batch.column(1), score.items), batch.column(0).is_valid().to_pylist(), strict=True)]
            lengths = np.array([len(r) for r in rows], np.int64)
            ranks = np.concatenate([np.arange(1, n + 1) for n in lengths] or [np.zeros(0)]).astype(np.int32)
            found = score.items.take(pa.array(np.concatenate([*rows, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([users.take(pa.array(np.repeat(np.arange(len(rows)), lengths))), found, pa.array(ranks)], names=[user, item, "rank"])

    return lists.select(user, "_seen").mapInArrow(run, StructType([StructField(user, kinds[0].dataType), StructField(item, kinds[1]), StructField("rank", IntegerType())]))


def _top_similar_joined(seen: DataFrame, user: str, item: str, k: int) -> DataFrame:
    """As top_similar, of distinct pairs, by joins on the similarity of items."""
    scored = seen.join(item_similarity(seen, user, item), item).groupBy(user, F.col("other").alias(item)).agg(F.round(F.sum("sim"), 9).alias("score"))
    unseen = scored.join(seen, [user, item], "left_anti")
    return unseen.withColumn("rank", F.row_number().over(Window.partitionBy(user).orderBy(F.desc("score"), item))).where(F.col("rank") <= k).select(user, item, "rank")


def _places(lists: pa.Array, items: pa.Array) -> list[np.ndarray]:
    """Per list the places of its values in the sorted items."""
    at = pc.index_in(lists.flatten(), value_set=items).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(at, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))[:-1]) if len(lists) else []


def _packed(lists: DataFrame, user: str) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The sorted different items; the lists of all users behind one another as places in these, with the start of each; whether each user is known."""
    got = lists.select("_seen", F.col(user).isNotNull().alias("known")).toArrow()
    seen, known = got["_seen"].combine_chunks(), got["known"].to_numpy().astype(bool)
    seen = seen.combine_chunks() if isinstance(seen, pa.ChunkedArray) else seen
    flat = seen.flatten()
    items = flat.unique()
    items = items.take(pc.sort_indices(items))
    at = pc.index_in(flat, value_set=items).to_numpy(zero_copy_only=False).astype(np.int32)
    return items, at, np.concatenate([[0], np.cumsum(pc.list_value_length(seen).to_numpy(zero_copy_only=False))]).astype(np.int64), known


def _spans(values: np.ndarray, start: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given spans behind one another, and the length of each span."""
    n = start[which + 1] - start[which]
    return values[np.repeat(start[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())], n


class _Scorer:
    """Sums of similarity by the lists of all users: over the users who share an item, the root of its users' number, then their items."""

    last: tuple[tuple, _Scorer] | None = None

    def __init__(self, items: pa.Array, lists: np.ndarray, start: np.ndarray, known: np.ndarray) -> None:
        self.items, self.lists, self.start = items, lists, start
        owners = np.repeat(np.arange(len(start) - 1, dtype=np.int32), np.diff(start))
        self.root = 1 / np.sqrt(np.maximum(1, np.bincount(lists, minlength=len(items))).astype(np.float64))
        met = known[owners]  # an unknown user shares items with none
        by_item = np.argsort(lists[met], kind="stable")
        self.users = owners[met][by_item]
        self.users_start = np.concatenate([[0], np.cumsum(np.bincount(lists[met], minlength=len(items)))]).astype(np.int64)
        self.sums, self.mark = np.zeros(len(items)), np.zeros(len(items), np.int64)

    @classmethod
    def of(cls, sent: Broadcast) -> _Scorer:
        """That of a broadcast value, kept between the tasks of a worker."""
        if cls.last is None or cls.last[0] is not sent.value:
            cls.last = (sent.value, cls(*sent.value))
        return cls.last[1]

    def top(self, seen: np.ndarray, k: int, known: bool) -> np.ndarray:
        """The places of the k best items for a user with these, the best first."""
        users, n = _spans(self.users, self.users_start, seen)
        others, m = _spans(self.lists, self.start, users)
        np.add.at(self.sums, others, np.repeat(np.repeat(self.root[seen], n), m))
        self.mark[others] = np.arange(len(others))
        found = others[self.mark[others] == np.arange(len(others))].astype(np.int64)  # each item once
        if known:
            self.mark[seen] = -1
            found = found[self.mark[found] >= 0]
        else:  # nobody's own list: an item of theirs counts by the others alone
            own = np.zeros(len(self.items))
            own[seen] = self.root[seen] * np.diff(self.users_start)[seen]
            self.sums -= own
            found = found[self.sums[found] > 1e-12]
        scores = np.round(self.sums[found] * self.root[found], 9)
        self.sums[others] = 0
        if not known:
            self.sums[seen] = 0
        if len(found) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[scores >= least], scores[scores >= least]
        return found[np.lexsort((found, -scores))][:k]


def ranking_metrics(ranked: DataFrame, truth: DataFrame, user: str, item: str, ks: Sequence[int] = (10, 20)) -> DataFrame:
    """One row: recall_<k> (hits over the lesser of truth and k), ndcg and hit rate at the first k, over all users with truth."""
    t = truth.select(user, item).distinct()
    n = t.groupBy(user).agg(F.count("*").alias("_n"))
    hits = ranked.join(t, [user, item], "left_semi")
    first = ks[0]
    cells = [F.sum((F.col("rank") <= k).cast("int")).alias(f"_h{k}") for k in ks]
    per = n.join(hits.groupBy(user).agg(*cells, F.sum(F.when(F.col("rank") <= first, 1 / F.log2(F.col("rank") + 1.0))).alias("_dcg")), user, "left")
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("_n"), F.lit(first)).cast("int")), F.lit(0.0), lambda a, r: a + 1 / F.log2(r + F.lit(1.0)))
    out = [F.avg(F.coalesce(F.col(f"_h{k}"), F.lit(0)) / F.least("_n", F.lit(k))).alias(f"recall_{k}") for k in ks]
    return per.agg(F.count("*").alias("n_users"), *out, F.avg(F.coalesce("_dcg", F.lit(0.0)) / ideal).alias(f"ndcg_{first}"), F.avg((F.coalesce(F.col(f"_h{first}"), F.lit(0)) > 0).cast("double")).alias(f"hit_{first}"))


def als_factors(train: DataFrame, user: str, item: str, *, rank: int = 16, rounds: int = 5, seed: int = 42, distinct: bool = False):
    """Matrix factorization of implicit feedback by alternating least squares, on dense integer ids.

    distinct: each pair is there once.
    """
    from pyspark.ml.recommendation import ALS

    shared_dir(train.sparkSession)  # with checkpoints the shuffle files of a round are removed when it ends
    counts = train.select(user, item, F.lit(1.0).cast("float").alias("_c")) if distinct else train.groupBy(user, item).agg(F.count("*").cast("float").alias("_c"))
    return ALS(rank=rank, maxIter=rounds, implicitPrefs=True, userCol=user, itemCol=item, ratingCol="_c", seed=seed, checkpointInterval=1).fit(counts)


def top_by_factors(model, train: DataFrame, user: str, item: str, k: int) -> DataFrame:
    """user, item, score, rank: the k items of the greatest product of factors that the user has not seen (ties: the smaller item).

    Item factors of up to MAX_SENT numbers go to all tasks, which score blocks of users; none of the products is shuffled. Items come
    by falling norm, so a user is done when no later one can reach their last score. Larger factors are left to the model's own
    top lists, with as many more items as the user with the most has seen.
    """
    lists = train.groupBy(user).agg(F.array_sort(F.collect_set(item)).alias("_seen"))
    if model.itemFactors.count() * model.rank > MAX_SENT:
        most = lists.agg(F.max(F.size("_seen"))).first()[0] or 0
        found = model.recommendForAllUsers(k + most).select(user, F.explode("recommendations").alias("r")).select(F.col(user).cast(train.schema[user].dataType), F.col(f"r.{item}").cast(train.schema[item].dataType).alias(item), F.col("r.rating").alias("score"))
        ranked = found.join(train, [user, item], "left_anti").withColumn("rank", F.row_number().over(Window.partitionBy(user).orderBy(F.desc("score"), item)))
        return ranked.where(F.col("rank") <= k).select(user, item, "score", "rank")
    got = model.itemFactors.select("id", "features").toArrow()
    ids = got["id"].to_numpy().astype(np.int64)
    factors = got["features"].combine_chunks().flatten().to_numpy().astype(np.float32).reshape(len(ids), -1)
    order = np.lexsort((ids, -np.linalg.norm(factors, axis=1)))
    sent = train.sparkSession.sparkContext.broadcast((ids[order], factors[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, factors = sent.value
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                own = batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
                places = _places(batch.column(2), pa.array(ids))
                rows = _best(own, factors, ids, places, k)
                n = [len(r[0]) for r in rows]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(np.concatenate([r[0] for r in rows]), pa.int64()), pa.array(np.concatenate([r[1] for r in rows]), pa.float32()), pa.array(np.concatenate([np.arange(1, x + 1) for x in n]), pa.int32())], names=[user, item, "score", "rank"])

    own = model.userFactors.select(F.col("id").cast(train.schema[user].dataType).alias(user), "features").join(lists, user)
    schema = StructType([StructField(user, train.schema[user].dataType), StructField(item, LongType()), StructField("score", FloatType()), StructField("rank", IntegerType())])
    return own.mapInArrow(run, schema).withColumn(item, F.col(item).cast(train.schema[item].dataType))


def _best(users: np.ndarray, factors: np.ndarray, ids: np.ndarray, seen: list[np.ndarray], k: int, step: int = 8192) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per user the ids and scores of the k best unseen items; factors by falling norm. A norm bounds a score but for rounding, which 1e-4 of it covers."""
    norms, items = np.linalg.norm(users.astype(np.float64), axis=1) * (1 + 1e-4), np.linalg.norm(factors.astype(np.float64), axis=1)
    kept = [(np.zeros(0, np.int64), np.zeros(0, np.float32)) for _ in users]
    least, open_ = np.full(len(users), -np.inf), np.arange(len(users))
    row = np.repeat(np.arange(len(users)), [len(x) for x in seen])
    place = np.concatenate([*seen, np.zeros(0, np.int64)])
    for at in range(0, len(factors), step):
        open_ = open_[norms[open_] * items[at] >= least[open_]]
        if not len(open_):
            break
        scores = users[open_] @ factors[at : at + step].T
        where = np.full(len(users), -1)
        where[open_] = np.arange(len(open_))
        masked = (place >= at) & (place < at + step) & (where[row] >= 0)
        scores[where[row[masked]], place[masked] - at] = -np.inf
        # at first the k-th of the chunk bounds what can be among the best
        bound = least[open_].astype(np.float32)
        fresh = np.isneginf(bound)
        if fresh.any() and scores.shape[1] > k:
            bound[fresh] = np.partition(scores[fresh], scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        r, c = np.nonzero((scores >= bound[:, None]) & (scores > -np.inf))
        edges = np.searchsorted(r, np.arange(len(open_) + 1))
        for i in np.nonzero(np.diff(edges))[0]:
            cols, u = c[edges[i] : edges[i + 1]], open_[i]
            found, got = np.concatenate([kept[u][0], ids[at + cols]]), np.concatenate([kept[u][1], scores[i, cols]])
            top = np.lexsort((found, -got))[:k]
            kept[u] = found[top], got[top]
            if len(top) == k:
                least[u] = got[top[-1]]
    return kept


def incompatible(log: DataFrame, user_class: str, item_class: str, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows whose item class is not allowed to the user's class; a user class that isn't declared allows nothing."""
    ok = F.lit(False)
    for u, items in allowed.items():
        ok = ok | ((F.col(user_class) == u) & F.col(item_class).isin(*items))
    return log.where(~F.coalesce(ok, F.lit(False)))
