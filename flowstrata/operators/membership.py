"""Cluster membership of nodes and edges (the relational shell around the
partitioner).

Shapes used throughout:

* ``tree``      ``(cl string, flow double, node_name string)``
* ``vertices``  ``(node_id bigint, node_name string)``
* ``edges``     ``(source bigint, target bigint[, weight double])``
* ``members``   ``(node_id, node_name, cl, flow, cl_top)``

All joins are equi-joins.  Small per-cluster tables (sizes, kept clusters)
are left to adaptive execution, which broadcasts them only when their
measured size is under the broadcast threshold and shuffles otherwise; hub
nodes and giant clusters are split by the adaptive skew-join rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import split_join
from ..functions.paths import cl_top


def members(tree: DataFrame, vertices: DataFrame) -> DataFrame:
    """Tree rows with node ids (inner join on name: unmatched names drop,
    a name shared by two vertices yields two rows)."""
    t = tree.withColumn("cl_top", cl_top("cl"))
    return (t.join(vertices.select("node_id", "node_name"), "node_name")
            .select("node_id", "node_name", "cl", "flow", "cl_top"))


def cluster_sizes(members: DataFrame) -> DataFrame:
    """``(cl_top, n)``: node rows per top cluster."""
    return members.groupBy("cl_top").agg(F.count(F.lit(1)).alias("n"))


def cluster_size_filter(sizes: DataFrame, min_size: int = 10,
                        max_size: int | None = None) -> DataFrame:
    """Clusters with ``min_size <= n`` (and ``n <= max_size`` if given);
    both bounds inclusive, ``None`` = no upper bound."""
    if min_size is None or min_size < 1:
        raise ValueError("min_size must be >= 1")
    if max_size is not None and max_size < 1:
        raise ValueError("max_size must be >= 1 or None")
    cond = F.col("n") >= min_size
    if max_size is not None:
        cond = cond & (F.col("n") <= max_size)
    return sizes.where(cond)


def kept_members(members: DataFrame, kept: DataFrame) -> DataFrame:
    """Members of kept clusters (semi join, no fan-out)."""
    return members.join(kept.select("cl_top"), "cl_top", "left_semi").select(
        *members.columns)


def passthrough_nodes(members: DataFrame, kept: DataFrame) -> DataFrame:
    """Members whose node is in no kept cluster: clusters that are too small
    or too large keep their original path."""
    kept_ids = kept_members(members, kept).select("node_id")
    return members.join(kept_ids, "node_id", "left_anti").select(*members.columns)


def within_cluster_edges(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges whose two ends are in the same kept cluster:
    ``(source, target, cl_top[, weight])``.

    ``kept`` is the kept-member table (node_id, cl_top).  The cluster
    equality is part of the second join key, so no post-join filter."""
    m = kept.select("node_id", "cl_top")
    extra = [c for c in edges.columns if c not in ("source", "target")]
    e = edges.join(m.withColumnRenamed("node_id", "source"), "source")
    e = e.join(m.withColumnRenamed("node_id", "target"), ["target", "cl_top"])
    return e.select("source", "target", "cl_top", *extra)


def links_and_nodes(kept: DataFrame, within: DataFrame) -> DataFrame:
    """Every kept node with its within-cluster out-links; a node without
    one appears once with null source/target."""
    w = within.select("source", "target")
    return (kept.select("cl_top", "node_id")
            .join(w, F.col("node_id") == F.col("source"), "left")
            .select("cl_top", "node_id", "source", "target"))


def edge_clusters(edges: DataFrame, members: DataFrame,
                  source: str = "source", target: str = "target") -> DataFrame:
    """Top cluster of both ends (``cl_out`` of the source, ``cl_in`` of the
    target); an end without a cluster gets null."""
    m = members.select("node_id", "cl_top")
    e = edges.join(m.withColumnRenamed("node_id", source)
                   .withColumnRenamed("cl_top", "cl_out"), source, "left")
    e = e.join(m.withColumnRenamed("node_id", target)
               .withColumnRenamed("cl_top", "cl_in"), target, "left")
    return e.select(*edges.columns, "cl_out", "cl_in")


def same_cluster_edges(clustered: DataFrame) -> DataFrame:
    """Edges whose ends share a (non-null) cluster."""
    return clustered.where(F.col("cl_out") == F.col("cl_in"))


def edges_per_cluster(clustered_within: DataFrame) -> DataFrame:
    """Within-cluster edges with the edge count of their cluster attached
    (``num_rows_in_cl``): an aggregate joined back on the cluster."""
    counts = clustered_within.groupBy("cl_out").agg(
        F.count(F.lit(1)).alias("num_rows_in_cl"))
    return split_join(clustered_within, counts.withColumn("_n", F.col("num_rows_in_cl")), ["cl_out"], "_n",
                      ["source", "target"])


def edges_with_cluster_sizes(clustered: DataFrame, sizes: DataFrame) -> DataFrame:
    """Attach the node count of the source's cluster (left join).  Clusters
    with many edges and edges without a cluster are spread."""
    rows = clustered.groupBy("cl_out").agg(F.count(F.lit(1)).alias("_n"))
    s = sizes.select(F.col("cl_top").alias("cl_out"),
                     F.col("n").alias("num_papers_in_cluster")).join(rows, "cl_out")
    return split_join(clustered, s, ["cl_out"], "_n", ["source", "target"], "left")


def edges_of_clusters(clustered: DataFrame, clusters: DataFrame,
                      key: str = "cl_out") -> DataFrame:
    """Edges whose ``key`` cluster is in ``clusters(cl_top)`` (semi join)."""
    c = clusters.select(F.col("cl_top").alias(key)).distinct()
    return clustered.join(c, key, "left_semi")


def endpoint_nodes(edges: DataFrame) -> DataFrame:
    """Distinct nodes at either end of the edges: ``(node_id)``."""
    return (edges.select(F.col("source").alias("node_id"))
            .union(edges.select(F.col("target").alias("node_id")))
            .distinct())


def partition_contingency(a: DataFrame, b: DataFrame, a_col: str = "cl_a",
                          b_col: str = "cl_b") -> DataFrame:
    """Node counts for every pair (cluster in partition a, cluster in b).
    ``a``/``b`` are ``(node_id, <cluster>)``."""
    return (a.join(b, "node_id")
            .groupBy(a_col, b_col).agg(F.count(F.lit(1)).alias("n")))


def duplicate_names(vertices: DataFrame) -> DataFrame:
    """Names carried by more than one vertex: ``(node_name, n)``."""
    return (vertices.groupBy("node_name").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def names_by_id(vertices: DataFrame) -> DataFrame:
    """One name per node id (the smallest, deterministic)."""
    return vertices.groupBy("node_id").agg(F.min("node_name").alias("node_name"))
