"""Splits that keep related records together: components of shared keys, a min-cost flow over bundles, members by hash."""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.registry import R
from millrace.operators.components import connected_components
from millrace.operators.prefix import hot_join, running_total, unit_hash
from millrace.session import cut, table

#: Most bundles of equal size and label profile that the solver gets: sizes are told apart one by one as far as that keeps their number
#: below it, whatever the corpus. So many of the largest components beyond are bundles of their own; the rest are bundled by quarter
#: powers of two of their size and eighths of their labels, and dealt by rows.
MOST_BUNDLES, LARGEST = 60_000, 20_000
SEED = 4711


def host(column: str) -> Column:
    """The host of a site name however it is spelled: without scheme, user, port, path, 'www.' and case; blank is null."""
    text = F.regexp_replace(F.lower(F.col(column)), r"^\s+|\s+$", "")
    bare = F.regexp_replace(text, r"^(?:[a-z][a-z0-9+.\-]*:)?/+", "")
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r"[/?#\\].*$", ""), r"^[^@]*@", ""), r"(:\d*)?\.?$", "")
    out = F.regexp_replace(name, r"^(?:www\d?\.)+", "")
    return F.when(F.trim(out) != "", F.trim(out))


def tied_groups(df: DataFrame, key: str, ties: dict[str, Column]) -> DataFrame:
    """key, _group (smallest key of its group), _size (rows in it) and the other columns of df.

    Rows are tied by an equal non-null value of any tie, directly or through others. The keys are linked rather than the rows, so a
    value shared by a third of all rows is one node, added up before the shuffle. A row without ties is a group of its own; its
    _group is its key. Columns of df that are called _group, _size, _node, n or _t<number> are left out. A null key is the key of no
    group but takes part in one; the smallest key that is there names it.
    """
    names = sorted(ties)
    reserved = {"_node", "_group", "_size", "n", *[f"_t{i}" for i in range(len(names))]}
    tagged = cut(df.select(*[F.col(f"`{c}`") for c in df.columns if c not in reserved or c == key], *[F.when(ties[n].isNotNull(), F.concat(F.lit(f"{i}:"), ties[n].cast("string"))).alias(f"_t{i}") for i, n in enumerate(names)]))
    columns = [f"_t{i}" for i in range(len(names))]
    links = None
    for c in columns[1:]:
        pair = tagged.select(F.col(columns[0]).alias("a"), F.col(c).alias("b")).distinct()
        links = pair if links is None else links.unionByName(pair)
    for i in range(1, len(columns)):
        for j in range(i + 1, len(columns)):
            links = links.unionByName(tagged.where(F.col(columns[0]).isNull()).select(F.col(columns[i]).alias("a"), F.col(columns[j]).alias("b")).distinct())
    first = F.coalesce(*[F.col(c) for c in columns])
    counts = cut(tagged.where(first.isNotNull()).groupBy(first.alias("_node")).agg(F.count("*").alias("n"), F.min(key).alias("least")))
    if links is None:
        keyed = counts.withColumn("root", F.col("_node"))
    else:
        roots = connected_components(links, "a", "b").withColumnRenamed("node", "_node")
        keyed = counts.join(roots, "_node", "left").withColumn("root", F.coalesce("root", "_node"))
    sums = keyed.groupBy("root").agg(F.sum("n").alias("_size"), F.min("least").alias("_group"))
    groups = cut(keyed.select("_node", "root", "n").join(sums, "root").select("_node", "n", "_group", "_size"))
    noded = tagged.withColumn("_node", first).drop(*columns)
    tied = hot_join(noded.where(F.col("_node").isNotNull()), groups, "_node", "n").drop("n", "_node")
    alone = noded.where(F.col("_node").isNull()).drop("_node").withColumn("_group", F.col(key)).withColumn("_size", F.lit(1).cast("long"))
    return tied.unionByName(alone)


def min_cost_flow(arcs: Sequence[tuple[str, str, int, int]], source: str, sink: str) -> tuple[dict[tuple[str, str, int], int], int]:
    """Flow by (from, to, cost) and total cost of a cheapest maximum flow; arcs are (from, to, capacity, cost >= 0)."""
    graph: dict[str, list[list]] = defaultdict(list)
    for a, b, capacity, cost in arcs:
        graph[a].append([b, capacity, cost, len(graph[b]), True])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1, False])
    potential: dict[str, int] = defaultdict(int)
    total = 0
    while True:
        dist, back, heap = {source: 0}, {}, [(0, source)]
        while heap:
            d, v = heapq.heappop(heap)
            if d > dist[v]:
                continue
            for i, (to, capacity, cost, _, _) in enumerate(graph[v]):
                reach = d + cost + potential[v] - potential[to]
                if capacity > 0 and reach < dist.get(to, reach + 1):
                    dist[to], back[to] = reach, (v, i)
                    heapq.heappush(heap, (reach, to))
        if sink not in dist:
            break
        far = max(dist.values())
        for v in list(graph):
            potential[v] += dist.get(v, far)
        path, v = [], sink
        while v != source:
            u, i = back[v]
            path.append(graph[u][i])
            v = u
        push = min(e[1] for e in path)
        for e in path:
            e[1] -= push
            graph[e[0]][e[3]][1] += push
            total += push * (e[2])
    flow: dict[tuple[str, str, int], int] = defaultdict(int)
    for a, edges in list(graph.items()):
        for to, _, cost, rev, forward in edges:
            if forward and (used := graph[to][rev][1]):
                flow[a, to, cost] += used
    return dict(flow), total


def bundle_flow(rows: Sequence[int], costs: Sequence[Sequence[float]], quotas: Sequence[int], deviate: float) -> tuple[list[list[int]], float]:
    """Rows that each bundle sends to each split, at least total cost, and that cost.

    A row of bundle i in split s costs costs[i][s]; a row beyond the quota of a split costs deviate besides. As min_cost_flow over the
    arcs source - bundle - split - sink, with the bundles folded into arcs between the splits: bundles come one after the other, and
    each is sent along shortest paths on which rows of former bundles may move from split to split. So a step costs splits cubed.
    """
    k = len(quotas)
    flow = [[0] * k for _ in rows]
    room = list(quotas)
    moves: list[list[list[tuple[float, int]]]] = [[[] for _ in range(k)] for _ in range(k)]
    total = 0.0
    for i, supply in enumerate(rows):
        left = supply
        while left > 0:
            best = {}
            for a in range(k):
                for b in range(k):
                    heap = moves[a][b]
                    while heap and flow[heap[0][1]][a] == 0:
                        heapq.heappop(heap)
                    if a != b and heap:
                        best[a, b] = heap[0]
            dist, back = list(costs[i]), [None] * k
            for _ in range(k):
                for (a, b), (c, _) in best.items():
                    if dist[a] + c < dist[b] - 1e-12:
                        dist[b], back[b] = dist[a] + c, a
            end = min(range(k), key=lambda s: (dist[s] + (0.0 if room[s] > 0 else deviate), s))
            push, s = (min(left, room[end]) if room[end] > 0 else left), end
            path = []
            while back[s] is not None:
                path.append((back[s], s, best[back[s], s][1]))
                push = min(push, flow[path[-1][2]][back[s]])
                s = back[s]
            for a, b, j in path:
                flow[j][a] -= push
                flow[j][b] += push
                for c in range(k):
                    if c != b:
                        heapq.heappush(moves[b][c], (costs[j][c] - costs[j][b], j))
            flow[i][s] += push
            for c in range(k):
                if c != s:
                    heapq.heappush(moves[s][c], (costs[i][c] - costs[i][s], i))
            total += push * (dist[end] + (0.0 if room[end] > 0 else deviate))
            room[end] -= push
            left -= push
    return flow, total


def allocate(bundles: Sequence[tuple[int, tuple[int, ...], int]], shares: dict[str, float], *, move: float = 1.0, deviate: float = 4.0, loose: Sequence[tuple[int, tuple[float, ...]]] = ()) -> tuple[list[dict[str, int]], list[dict[str, int]], float]:
    """Components of each bundle (size, rows of each split's label, components) that each split gets; rows of each loose bundle; the cost.

    Splits in sorted order. A row that changes its label costs move, a row beyond the quota of its split costs deviate; rows without a
    label of a split cost nothing. Loose bundles (rows, part of them with each split's label) may be parted anywhere. The flow is made
    integral bundle by bundle, large components first: a bundle gives each split the whole components of what the flow sends there and
    what the split still lacks of former bundles; components left over go where most is lacking.
    """
    splits = sorted(shares)
    rows = [s * n for s, _, n in bundles] + [r for r, _ in loose]
    every, whole = sum(rows), sum(shares.values()) or 1.0
    quota = [int(every * shares[s] / whole) for s in splits]
    quota[max(range(len(splits)), key=lambda i: (shares[splits[i]], i))] += every - sum(quota)
    costs = [[move * (sum(labels) - labels[i]) / size for i in range(len(splits))] for size, labels, _ in bundles]
    costs += [[move * (sum(parts) - parts[i]) for i in range(len(splits))] for _, parts in loose]
    flow, cost = bundle_flow(rows, costs, quota, deviate)
    lacking = [0] * len(splits)
    out: list[dict[str, int]] = [{}] * len(bundles)
    for j in sorted(range(len(bundles)), key=lambda j: (-bundles[j][0], bundles[j][1])):
        size, _, n = bundles[j]
        lacking = [x + f for x, f in zip(lacking, flow[j], strict=True)]
        given = [0] * len(splits)
        for i in sorted(range(len(splits)), key=lambda i: (-lacking[i], i)):
            given[i] = min(n - sum(given), max(0, lacking[i]) // size)
        while sum(given) < n:
            given[max(range(len(splits)), key=lambda i: (lacking[i] - given[i] * size, -costs[j][i], shares[splits[i]], -i))] += 1
        lacking = [x - g * size for x, g in zip(lacking, given, strict=True)]
        out[j] = dict(zip(splits, given, strict=True))
    return out, [dict(zip(splits, f, strict=True)) for f in flow[len(bundles) :]], cost


def exact_size(splits: int) -> int:
    """Greatest size up to which all label profiles of so many splits, and rows without one, make no more than MOST_BUNDLES bundles."""
    size = 1
    while math.comb(size + 1 + splits + 1, splits + 1) <= MOST_BUNDLES:
        size += 1
    return size


def grouped_split(df: DataFrame, key: str, ties: dict[str, Column], targets: DataFrame, split: str, share: str, out: str = "new_split") -> DataFrame:
    """df's key with its group, the rows of its group, its present split and a new one near the target shares; no group is parted.

    Groups of one size and label profile (rows of each target split's label) are a bundle; what each split gets of a bundle comes from
    a min-cost flow, made integral, and its members are dealt by the hash of their group, so the result depends on neither order nor
    partitions. The solver's input is bounded (MOST_BUNDLES, LARGEST); beyond it groups are bundled more coarsely, none is left out.
    A group larger than every quota goes where most rows are lacking. Targets are a table made by hand, one row a split.
    """
    spark = df.sparkSession
    shares = {r[0]: r[1] for r in targets.where(F.col(split).isNotNull()).select(split, share).collect()}
    if not shares:
        raise ValueError("no target shares")
    splits = sorted(shares)
    tied = df.select(F.col(key), F.col(split).alias("_old"), *[ties[t].cast("string").alias(f"_tie{i}") for i, t in enumerate(sorted(ties))])
    grouped = cut(tied_groups(tied, key, {t: F.col(f"_tie{i}") for i, t in enumerate(sorted(ties))}).select(key, "_old", "_group", "_size"))
    counts = [F.sum((F.col("_old") == s).cast("long")) for s in splits]
    sums = grouped.groupBy("_group").agg(F.max("_size").alias("_size"), F.array(*[F.coalesce(c, F.lit(0)) for c in counts]).alias("_labels"))
    least = exact_size(len(splits))
    comps = cut(sums.withColumn("_at", unit_hash(F.col("_group"), F.lit(SEED))))
    large = comps.where(F.col("_size") > least).orderBy(F.desc("_size"), "_at", "_group").limit(LARGEST).collect()
    own = spark.createDataFrame([(r["_group"],) for r in large], comps.select("_group").schema)
    rest = comps.join(F.broadcast(own), "_group", "left_anti").withColumn("_loose", F.col("_size") > least)
    rest = rest.withColumn("_class", F.when(F.col("_loose"), F.floor(4 * F.log2("_size"))).otherwise(F.col("_size"))).withColumn("_profile", F.when(F.col("_loose"), F.transform("_labels", lambda n: F.round(8 * n / F.col("_size")).cast("long"))).otherwise(F.col("_labels")))
    rest = rest.withColumn("_bundle", F.concat_ws(" ", "_loose", "_class", F.array_join(F.transform("_profile", lambda n: n.cast("string")), ",")))
    found = rest.groupBy("_bundle", "_loose", "_class", "_profile").agg(F.count("*").alias("n"), F.sum("_size").alias("rows")).collect()
    exact, coarse = sorted((r for r in found if not r["_loose"]), key=lambda r: r["_bundle"]), sorted((r for r in found if r["_loose"]), key=lambda r: r["_bundle"])
    bundles = [(r["_size"], tuple(r["_labels"]), 1) for r in large] + [(r["_class"], tuple(r["_profile"]), r["n"]) for r in exact]
    dealt, poured, _ = allocate(bundles, shares, loose=[(r["rows"], tuple(x / 8 for x in r["_profile"])) for r in coarse])
    placed = [(r["_group"], next(s for s, n in given.items() if n)) for r, given in zip(large, dealt, strict=False)]
    cuts = []
    for r, given, unit in [*((r, g, r["_class"]) for r, g in zip(exact, dealt[len(large) :], strict=True)), *((r, g, 1) for r, g in zip(coarse, poured, strict=True))]:
        top = 0
        for s in splits:
            if given[s]:
                cuts.append((r["_bundle"], top, top + given[s] * unit, s))
                top += given[s] * unit
    ranges = spark.createDataFrame(cuts, "_bundle string, _above long, _upto long, _new string")
    ranked = running_total(rest, ["_bundle"], "_at", ["_group"], "_size", "_run")
    middle = F.col("_run") - F.col("_size") / 2
    chosen = ranked.join(ranges, "_bundle").where((middle > F.col("_above")) & (middle <= F.col("_upto"))).select("_group", "_size", "_new")
    individual = comps.join(F.broadcast(spark.createDataFrame(placed, own.schema.add("_new", "string"))), "_group").select("_group", "_size", "_new")
    every = cut(chosen.unionByName(individual)).select("_group", F.col("_new").alias(out), F.col("_size").alias("_rows"))
    return hot_join(grouped.select(key, "_old", "_group", F.col("_size").alias("group_rows")), every, "_group", "_rows").select(key, F.col("_group").alias(f"group_{key}"), "group_rows", F.col("_old").alias(split), out)


def _ties() -> dict[str, Column]:
    return {"family": F.col("dup_family_id"), "site": host("sourcesite")}


_FOUND = r"""
WITH RECURSIVE sites AS (
  SELECT recipe_id, dup_family_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(sourcesite), '^\s+|\s+$', '', 'g'),
    '^(?:[a-z][a-z0-9+.\-]*:)?/+', ''), '[/?#\\].*$', ''), '^[^@]*@', ''), '^(?:www\d?\.)+', '') AS host FROM recipes_structured),
keys AS (SELECT recipe_id, 'f' || dup_family_id AS k FROM sites WHERE dup_family_id IS NOT NULL
         UNION ALL SELECT recipe_id, 'h' || trim(host) FROM sites WHERE trim(coalesce(host, '')) <> ''),
links AS (SELECT DISTINCT a.k AS x, b.k AS y FROM keys a JOIN keys b USING (recipe_id)),
walk AS (SELECT DISTINCT k AS x, k AS y FROM keys UNION SELECT w.x, l.y FROM walk w JOIN links l ON w.y = l.x),
roots AS (SELECT x AS k, min(y) AS root FROM walk GROUP BY x),
members AS (SELECT DISTINCT recipe_id, root FROM keys JOIN roots USING (k))
SELECT recipe_id, min(recipe_id) OVER (PARTITION BY root) AS group_recipe_id FROM members
QUALIFY count(*) OVER (PARTITION BY root) > 1
"""


def _dealt(spark: SparkSession, root: str) -> DataFrame:
    recipes = table(spark, root, "recipes_structured").select("recipe_id", "dup_family_id", "sourcesite", "split_v3")
    return grouped_split(recipes, "recipe_id", _ties(), table(spark, root, "split_targets"), "split_v3", "target_share")


@R.query("p6_found", _FOUND)
def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """recipe_id, group_recipe_id of every recipe tied to another."""
    return _dealt(spark, root).where("group_rows > 1").select("recipe_id", "group_recipe_id")


@R.query("p6_splits")
def p6_splits(spark: SparkSession, root: str) -> DataFrame:
    """recipe_id, group_recipe_id, split_v3 and new_split of every recipe."""
    return _dealt(spark, root).drop("group_rows")


@R.query("p6_shares")
def p6_shares(spark: SparkSession, root: str) -> DataFrame:
    """Rows and share of each new split beside its target, and the rows that kept their label."""
    dealt = p6_splits(spark, root)
    got = dealt.groupBy("new_split").agg(F.count("*").alias("n_rows"), F.sum((F.col("split_v3") == F.col("new_split")).cast("long")).alias("kept"))
    targets = table(spark, root, "split_targets").select(F.col("split_v3").alias("new_split"), "target_share")
    return F.broadcast(targets).join(got, "new_split", "left").select("new_split", "target_share", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("kept", F.lit(0)).alias("kept"), (F.coalesce("n_rows", F.lit(0)) / F.sum("n_rows").over(Window.partitionBy())).alias("actual_share"))
