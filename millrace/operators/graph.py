"""Typed property graphs as tables of nodes and edges: integrity, statistics, adjacency, merging, clusters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.components import connected_components

TRIPLE = ("head", "rel", "tail")


def as_triples(edges: DataFrame) -> DataFrame:
    """head, rel, tail, whether the table calls them so or src, rel, dst; other columns stay."""
    if set(TRIPLE) <= set(edges.columns):
        return edges
    if {"src", "rel", "dst"} <= set(edges.columns):
        return edges.withColumnsRenamed({"src": "head", "dst": "tail"})
    raise ValueError(f"no head, rel, tail or src, rel, dst among {edges.columns}")


def without_nodes(nodes: DataFrame, edges: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges without the nodes gone (one column) and all that touches them."""
    g = gone.toDF("_g").where(F.col("_g").isNotNull()).distinct()
    edges = as_triples(edges)
    for end in ("head", "tail"):
        edges = edges.join(g, F.col(end) == F.col("_g"), "left_anti")
    return nodes.join(g, F.col("node_id") == F.col("_g"), "left_anti"), edges


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """what (node_type, relation), name, n."""
    return nodes.groupBy(F.col("type").alias("name")).agg(F.count("*").alias("n")).select(F.lit("node_type").alias("what"), "name", "n").unionByName(as_triples(edges).groupBy(F.col("rel").alias("name")).agg(F.count("*").alias("n")).select(F.lit("relation").alias("what"), "name", "n"))


def tail_counts(edges: DataFrame, rel: str) -> DataFrame:
    """name, n: tails of one relation without their namespace."""
    return as_triples(edges).where(F.col("rel") == rel).groupBy(F.regexp_replace("tail", r"^.*?::", "").alias("name")).agg(F.count("*").alias("n"))


def integrity(nodes: DataFrame, edges: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """check, n: null or repeated nodes, null, repeated or dangling edges, and evidence that is repeated, orphaned or no JSON object."""
    edges = as_triples(edges)
    ids = nodes.select("node_id").where("node_id IS NOT NULL").distinct()

    def n(name: str, df: DataFrame, total: Column | None = None) -> DataFrame:
        return df.agg(F.lit(name).alias("check"), F.coalesce(total if total is not None else F.count("*"), F.lit(0)).cast("bigint").alias("n"))

    def repeats(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return n(name, df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("c")), F.sum(F.col("c") - 1))

    parts = [
        n("null node", nodes.where("node_id IS NULL")),
        repeats("repeated node", nodes, ["node_id"]),
        n("null edge", edges.where("head IS NULL OR rel IS NULL OR tail IS NULL")),
        repeats("repeated edge", edges, TRIPLE),
        n("dangling head", edges.where("head IS NOT NULL").join(ids, F.col("head") == F.col("node_id"), "left_anti")),
        n("dangling tail", edges.where("tail IS NOT NULL").join(ids, F.col("tail") == F.col("node_id"), "left_anti")),
    ]
    if evidence is not None:
        e = as_triples(evidence)
        parts += [
            repeats("repeated evidence", e, TRIPLE),
            n("orphan evidence", e.join(edges, list(TRIPLE), "left_anti")),
            n("evidence is no object", e.where(~F.coalesce(F.schema_of_variant(F.try_parse_json("attributes_json")).rlike("^OBJECT"), F.lit(False)))),
        ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def restore(edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """Edges with attributes, a map of text from the evidence's JSON; null where an edge has none."""
    e = as_triples(evidence).select(*TRIPLE, F.from_json("attributes_json", "map<string,string>").alias("attributes"))
    return as_triples(edges).join(e, list(TRIPLE), "left")


def adjacency(edges: DataFrame) -> DataFrame:
    """head, neighbours (map of relation to sorted tails). A head's edges form one row; salt and use edges where that is too long."""
    per = as_triples(edges).groupBy("head", "rel").agg(F.sort_array(F.collect_set("tail")).alias("tails"))
    return per.groupBy("head").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rel", "tails")))).alias("neighbours"))


def attribute_triples(df: DataFrame, key: str, prefix: str, attributes: Mapping[str, str]) -> DataFrame:
    """head, rel, tail: one triple per non-blank attribute, rel has_<name>, tail <name>::<value>."""
    each = F.explode(F.array(*[F.struct(F.lit(f"has_{n}").alias("rel"), F.when(F.trim(F.col(c).cast("string")) != "", F.concat(F.lit(f"{n}::"), F.col(c).cast("string"))).alias("tail")) for n, c in attributes.items()]))
    return df.select(F.concat(F.lit(f"{prefix}::"), F.col(key).cast("string")).alias("head"), each.alias("x")).where("x.tail IS NOT NULL").select("head", "x.rel", "x.tail")


def layer_view(edges: DataFrame, evidence: DataFrame, relations: Sequence[str], promoted: str, flag: str) -> DataFrame:
    """Distinct triples of a layer: its own relations, and any edge whose evidence has the flag, renamed to the promoted relation."""
    edges = as_triples(edges)
    marked = as_triples(evidence).where(F.lower(F.get_json_object("attributes_json", f"$.{flag}")) == "true").select(*TRIPLE)
    return edges.where(F.col("rel").isin(*relations)).select(*TRIPLE).unionByName(edges.join(marked, list(TRIPLE), "left_semi").select("head", F.lit(promoted).alias("rel"), "tail")).distinct()


def reconcile(edges: DataFrame, rel: str, df: DataFrame, key: str, prefix: str, labels: str) -> DataFrame:
    """class, n_graph, n_column, n_both: a relation of the graph against the ;-parted labels of a column."""
    g = as_triples(edges).where(F.col("rel") == rel).select("head", F.regexp_replace("tail", r"^.*?::", "").alias("class")).distinct().withColumn("_g", F.lit(1))
    each = F.explode(F.array_distinct(F.filter(F.transform(F.split(F.lower(F.coalesce(F.col(labels), F.lit(""))), ";"), lambda x: F.trim(x)), lambda x: x != "")))
    c = df.select(F.concat(F.lit(f"{prefix}::"), F.col(key).cast("string")).alias("head"), each.alias("class")).distinct().withColumn("_c", F.lit(1))
    one = g.join(c, ["head", "class"], "full_outer")
    return one.groupBy("class").agg(F.count("_g").alias("n_graph"), F.count("_c").alias("n_column"), F.count(F.col("_g") + F.col("_c")).alias("n_both"))


def signature_clusters(df: DataFrame, key: str, signatures: Mapping[str, Column], prefix: str = "q1_") -> DataFrame:
    """key, cluster_key (smallest of its cluster), cluster_size, cluster_id of rows linked by any equal signature.

    A null or empty signature links nothing. Signatures and rows are the nodes of one graph, so a signature with many rows costs one
    edge per row and no pairs. cluster_id is prefix and the SHA-256 of the smallest key and the size; rows alone are clusters of one.
    """
    sig = F.explode(F.array(*[F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"s:{n}:"), F.sha2(c, 256))) for n, c in signatures.items()]))
    edges = df.select(F.concat(F.lit("k:"), F.lpad(F.col(key).cast("string"), 20, "0")).alias("a"), sig.alias("b"))
    roots = connected_components(edges, "a", "b").where(F.col("node").startswith("k:"))
    named = df.select(F.col(key), F.concat(F.lit("k:"), F.lpad(F.col(key).cast("string"), 20, "0")).alias("node")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = named.groupBy("root").agg(F.count("*").alias("cluster_size"), F.min(key).alias("cluster_key"))
    ident = F.concat(F.lit(prefix), F.sha2(F.concat_ws(",", F.col("cluster_key").cast("string"), F.col("cluster_size").cast("string")), 256))
    return named.join(sizes, "root").select(key, "cluster_key", "cluster_size", ident.alias("cluster_id"))


def link_counts(df: DataFrame, signatures: Mapping[str, Column]) -> DataFrame:
    """kind, links: per signature its non-empty rows less its distinct values."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.when(F.coalesce(c, F.lit("")) != "", c).alias("s")) for n, c in signatures.items()]))
    rows = df.select(each.alias("x")).where("x.s IS NOT NULL").select("x.kind", "x.s")
    return rows.groupBy("kind", "s").agg(F.count("*").alias("n")).groupBy("kind").agg(F.sum(F.col("n") - 1).alias("links"))
