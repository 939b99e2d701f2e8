"""Queries over property graphs and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import graph as G
from millrace.plans.registry import Registry
from millrace.session import table

R = Registry()

_NODES = "SELECT 'part::' || p_partkey AS node_id, 'part' AS type FROM part UNION ALL SELECT DISTINCT 'brand::' || p_brand, 'brand' FROM part UNION ALL SELECT DISTINCT 'kind::' || p_type, 'kind' FROM part"
_EDGES = "SELECT 'part::' || p_partkey AS head, 'has_brand' AS rel, 'brand::' || p_brand AS tail FROM part UNION ALL SELECT 'part::' || p_partkey, 'has_kind', 'kind::' || p_type FROM part"


def _graph(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, root, "part")
    edges = G.attribute_triples(part, "p_partkey", "part", {"brand": "p_brand", "kind": "p_type"})
    heads = part.select(F.concat(F.lit("part::"), "p_partkey").alias("node_id"), F.lit("part").alias("type"))
    tails = edges.select(F.col("tail").alias("node_id"), F.split("tail", "::")[0].alias("type")).distinct()
    return heads.unionByName(tails), edges


@R.query("kg_triples", _EDGES)
def kg_triples(spark: SparkSession, root: str) -> DataFrame:
    return _graph(spark, root)[1]


@R.query("kg_stats", f"SELECT 'node_type' AS what, type AS name, count(*) AS n FROM ({_NODES}) GROUP BY type UNION ALL SELECT 'relation', rel, count(*) FROM ({_EDGES}) GROUP BY rel")
def kg_stats(spark: SparkSession, root: str) -> DataFrame:
    return G.graph_stats(*_graph(spark, root))


@R.query("kg_tail_counts", f"SELECT regexp_replace(tail, '^.*?::', '') AS name, count(*) AS n FROM ({_EDGES}) WHERE rel = 'has_brand' GROUP BY 1")
def kg_tail_counts(spark: SparkSession, root: str) -> DataFrame:
    return G.tail_counts(_graph(spark, root)[1], "has_brand")


@R.query("kg_integrity", f"WITH n AS ({_NODES}), e AS (SELECT * FROM ({_EDGES}) UNION ALL SELECT 'part::1', 'has_brand', 'brand::missing' UNION ALL SELECT 'part::2', 'has_kind', NULL) SELECT 'null node' AS \"check\", (SELECT count(*) FROM n WHERE node_id IS NULL) AS n UNION ALL SELECT 'repeated node', CAST((SELECT count(*) - count(DISTINCT node_id) FROM n) AS BIGINT) UNION ALL SELECT 'null edge', (SELECT count(*) FROM e WHERE head IS NULL OR rel IS NULL OR tail IS NULL) UNION ALL SELECT 'repeated edge', (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM e WHERE tail IS NOT NULL GROUP BY head, rel, tail)) UNION ALL SELECT 'dangling head', (SELECT count(*) FROM e WHERE head NOT IN (SELECT node_id FROM n)) UNION ALL SELECT 'dangling tail', (SELECT count(*) FROM e WHERE tail NOT IN (SELECT node_id FROM n))")
def kg_integrity(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    broken = spark.createDataFrame([("part::1", "has_brand", "brand::missing"), ("part::2", "has_kind", None)], "head string, rel string, tail string")
    return G.integrity(nodes, edges.unionByName(broken))


@R.query("kg_node_exclusion", f"SELECT head, rel, tail FROM ({_EDGES}) WHERE tail <> 'brand::Brand#11' AND head NOT IN (SELECT 'part::' || p_partkey FROM part WHERE p_size < 5)")
def kg_node_exclusion(spark: SparkSession, root: str) -> DataFrame:
    nodes, edges = _graph(spark, root)
    gone = table(spark, root, "part").where("p_size < 5").select(F.concat(F.lit("part::"), "p_partkey").alias("x")).unionByName(spark.createDataFrame([("brand::Brand#11",)], "x string"))
    return G.without_nodes(nodes, edges, gone)[1]


@R.query("adjacency_lists", f"SELECT head, string_agg(rel || '=' || tails, '|' ORDER BY rel) AS neighbours FROM (SELECT head, rel, string_agg(DISTINCT tail, ',' ORDER BY tail) AS tails FROM ({_EDGES}) GROUP BY ALL) GROUP BY head")
def adjacency_lists(spark: SparkSession, root: str) -> DataFrame:
    parts = F.transform(F.map_entries("neighbours"), lambda e: F.concat(e.key, F.lit("="), F.array_join(e.value, ",")))
    return G.adjacency(_graph(spark, root)[1]).select("head", F.array_join(parts, "|").alias("neighbours"))


@R.query("reconcile_graph_vs_column", "WITH c AS (SELECT DISTINCT recipe_id, trim(x) AS class FROM (SELECT recipe_id, unnest(string_split(lower(coalesce(allergens_v2, '')), ';')) AS x FROM recipes_structured) WHERE trim(x) <> ''), g AS (SELECT DISTINCT recipe_id, class FROM c WHERE class NOT IN ('egg', 'milk')) SELECT coalesce(g.class, c.class) AS class, count(g.recipe_id) AS n_graph, count(c.recipe_id) AS n_column, CAST(sum(CASE WHEN g.recipe_id IS NOT NULL AND c.recipe_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_both FROM c FULL JOIN g ON c.recipe_id = g.recipe_id AND c.class = g.class GROUP BY 1")
def reconcile_graph_vs_column(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured")
    each = F.explode(F.filter(F.transform(F.split(F.lower(F.coalesce("allergens_v2", F.lit(""))), ";"), lambda x: F.trim(x)), lambda x: x != ""))
    edges = r.select(F.concat(F.lit("recipe::"), "recipe_id").alias("head"), F.lit("contains").alias("rel"), each.alias("c")).where("c NOT IN ('egg', 'milk')").select("head", "rel", F.concat(F.lit("allergen::"), "c").alias("tail"))
    return G.reconcile(edges, "contains", r, "recipe_id", "recipe", "allergens_v2")


@R.query("layer_view", f"SELECT head, rel, tail FROM ({_EDGES}) WHERE rel = 'has_brand' UNION SELECT head, 'shares_kind', tail FROM ({_EDGES}) WHERE rel = 'has_kind' AND head IN (SELECT 'part::' || p_partkey FROM part WHERE p_size > 25)")
def layer_view(spark: SparkSession, root: str) -> DataFrame:
    _, edges = _graph(spark, root)
    large = table(spark, root, "part").where("p_size > 25").select(F.concat(F.lit("part::"), "p_partkey").alias("head"))
    evidence = edges.where("rel = 'has_kind'").join(large, "head", "left_semi").withColumn("attributes_json", F.lit('{"also": true, "n": 2}'))
    return G.layer_view(edges, evidence, ["has_brand"], "shares_kind", "also")


def _signatures() -> dict[str, object]:
    return {"title": F.lower(F.trim("title_normalized")), "family": F.col("dup_family_id").cast("string"), "list": F.when(F.length("ingredientslist") > 30, F.lower("ingredientslist"))}


_SIG = "SELECT recipe_id, 't' || lower(trim(title_normalized)) AS s FROM recipes_structured WHERE trim(coalesce(title_normalized, '')) <> '' UNION ALL SELECT recipe_id, 'f' || dup_family_id FROM recipes_structured WHERE dup_family_id IS NOT NULL UNION ALL SELECT recipe_id, 'l' || lower(ingredientslist) FROM recipes_structured WHERE length(ingredientslist) > 30"


@R.query("dup_components", f"WITH RECURSIVE sig AS ({_SIG}), links AS (SELECT DISTINCT a.recipe_id AS x, b.recipe_id AS y FROM sig a JOIN sig b ON a.s = b.s), walk AS (SELECT recipe_id AS x, recipe_id AS y FROM recipes_structured UNION SELECT w.x, l.y FROM walk w JOIN links l ON w.y = l.x), roots AS (SELECT x AS recipe_id, min(y) AS cluster_key FROM walk GROUP BY x) SELECT recipe_id, cluster_key, count(*) OVER (PARTITION BY cluster_key) AS cluster_size FROM roots")
def dup_components(spark: SparkSession, root: str) -> DataFrame:
    return G.signature_clusters(table(spark, root, "recipes_structured"), "recipe_id", _signatures()).select("recipe_id", "cluster_key", "cluster_size")


@R.query("dup_links", f"SELECT CASE left(s, 1) WHEN 't' THEN 'title' WHEN 'f' THEN 'family' ELSE 'list' END AS kind, CAST(count(*) - count(DISTINCT s) AS BIGINT) AS links FROM ({_SIG}) GROUP BY 1")
def dup_links(spark: SparkSession, root: str) -> DataFrame:
    return G.link_counts(table(spark, root, "recipes_structured"), _signatures())


@R.query("dense_remap", "SELECT DISTINCT recipe_id AS item, dense_rank() OVER (ORDER BY recipe_id) - 1 AS idx FROM interactions WHERE recipe_id IS NOT NULL")
def dense_remap(spark: SparkSession, root: str) -> DataFrame:
    from millrace.operators.recommend import dense_ids

    return dense_ids(table(spark, root, "interactions").where("recipe_id IS NOT NULL"), "recipe_id").select(F.col("recipe_id").alias("item"), "idx")
