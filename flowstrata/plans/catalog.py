"""Registered queries: one per operator of the inventory.  Each takes
``(spark, sf_dir)`` and returns a DataFrame over the whole tables (jobs that
stage tables run when called);
:data:`ORACLE` holds the DuckDB statement for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import membership as M
from ..sources import tables as T
from .oracle import MAX_SIZE, MIN_SIZE, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


# ---------------------------------------------------------------- shell ----

def network(spark: SparkSession, sf_dir: str, max_size: int | None = MAX_SIZE):
    """(members, kept clusters, kept members, edges) with the registered bounds;
    ``max_size=None``: no cluster is too large."""
    members = M.members(T.tree(spark, sf_dir), T.vertices(spark, sf_dir))
    kept = M.cluster_size_filter(M.cluster_sizes(members), MIN_SIZE, max_size)
    return members, kept, M.kept_members(members, kept), T.edges(spark, sf_dir)


@register("members", with_views("SELECT * FROM members"))
def q_members(spark, sf_dir):
    return M.members(T.tree(spark, sf_dir), T.vertices(spark, sf_dir))


@register("cluster_sizes", with_views("SELECT * FROM sizes"))
def q_cluster_sizes(spark, sf_dir):
    return M.cluster_sizes(q_members(spark, sf_dir))


@register("cluster_size_filter", with_views("SELECT * FROM kept"))
def q_cluster_size_filter(spark, sf_dir):
    return M.cluster_size_filter(q_cluster_sizes(spark, sf_dir), MIN_SIZE, MAX_SIZE)


@register("kept_members", with_views("SELECT * FROM kept_members"))
def q_kept_members(spark, sf_dir):
    return network(spark, sf_dir)[2]


@register("within_cluster_edges", with_views("SELECT * FROM within"))
def q_within_cluster_edges(spark, sf_dir):
    _, _, km, edges = network(spark, sf_dir)
    return M.within_cluster_edges(edges, km)


@register("links_and_nodes", with_views("""
SELECT m.cl_top, m.node_id, w.source, w.target
FROM kept_members m LEFT JOIN within w ON w.source = m.node_id"""))
def q_links_and_nodes(spark, sf_dir):
    _, _, km, edges = network(spark, sf_dir)
    return M.links_and_nodes(km, M.within_cluster_edges(edges, km))


@register("passthrough_nodes", with_views("""
SELECT * FROM members WHERE node_id NOT IN (SELECT node_id FROM kept_members)"""))
def q_passthrough_nodes(spark, sf_dir):
    members, kept, _, _ = network(spark, sf_dir)
    return M.passthrough_nodes(members, kept)


# ------------------------------------------------------------ flow, objective

from ..operators.flow import undirdir_flow  # noqa: E402
from ..operators.objective import codelength, hierarchical_codelength, one_module_codelength  # noqa: E402
from .oracle import NETWORK_FLOW, VIEWS, WITHIN_FLOW, codelength_sql, hierarchical_sql  # noqa: E402


def within_flow(spark, sf_dir):
    _, _, km, edges = network(spark, sf_dir)
    within = M.within_cluster_edges(edges, km)
    return km, undirdir_flow(within, ["cl_top"], nodes=km.select("cl_top", "node_id"))


@register("undirdir_flow", f"""WITH {VIEWS}{WITHIN_FLOW}
SELECT g AS cl_top, node_id, round(flow, 9) AS flow FROM node_flow""")
def q_undirdir_flow(spark, sf_dir):
    _, (nf, _) = within_flow(spark, sf_dir)
    return nf.select("cl_top", "node_id", F.round("flow", 9).alias("flow"))


@register("link_flow", f"""WITH {VIEWS}{WITHIN_FLOW}
SELECT g AS cl_top, source, target, round(flow, 9) AS flow FROM link_flow""")
def q_link_flow(spark, sf_dir):
    _, (_, lf) = within_flow(spark, sf_dir)
    return lf.select("cl_top", "source", "target", F.round("flow", 9).alias("flow"))


def _rounded(df):
    return df.select(*[c for c in df.columns
                       if c not in ("codelength", "exit_flow", "num_modules")],
                     F.round("codelength", 9).alias("codelength"), "num_modules",
                     F.round("exit_flow", 9).alias("exit_flow"))


PART_TYPE = ("SELECT cl_top AS g, k.node_id, p.p_type AS module FROM kept_members k "
             "JOIN part p ON k.node_id = p.p_partkey")


@register("codelength_per_cluster", f"WITH {VIEWS}{WITHIN_FLOW}" + codelength_sql(PART_TYPE, "p.g AS cl_top"))
def q_codelength_per_cluster(spark, sf_dir):
    """Codelength of each kept cluster's sub-network, modules = part type."""
    km, (nf, lf) = within_flow(spark, sf_dir)
    part = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node_id"),
                                                 F.col("p_type").alias("module"))
    asg = km.select("cl_top", "node_id").join(part, "node_id")
    return _rounded(codelength(nf, lf, asg, ["cl_top"]))


TOP_AS_MODULE = "SELECT 0 AS g, node_id, cl_top AS module FROM members"


@register("codelength", f"WITH {VIEWS}{NETWORK_FLOW}" + codelength_sql(TOP_AS_MODULE, ""))
def q_codelength(spark, sf_dir):
    """Codelength of the whole network under the two-level tree's top clusters."""
    members = M.members(T.tree(spark, sf_dir), T.vertices(spark, sf_dir))
    nf, lf = undirdir_flow(T.edges(spark, sf_dir), nodes=T.vertices(spark, sf_dir))
    asg = members.select("node_id", F.col("cl_top").alias("module"))
    return _rounded(codelength(nf, lf, asg))


#: Three levels of modules inside a cluster, of uneven depth: brand, type, then
#: size; parts of size 1 and 30 sit under the brand.
ATTRIBUTE_PATHS = """SELECT cl_top AS g, k.node_id, CASE WHEN p_size IN (1, 30) THEN [p_brand]
  ELSE [p_brand, p_brand || ':' || p_type, p_brand || ':' || p_type || ':' || (p_size % 3)] END AS inside
FROM kept_members k JOIN part p ON k.node_id = p.p_partkey"""


@register("hierarchical_codelength", f"WITH {VIEWS}{WITHIN_FLOW}" + hierarchical_sql(ATTRIBUTE_PATHS, "g AS cl_top"))
def q_hierarchical_codelength(spark, sf_dir):
    """Codelength of a hierarchy of part attributes in each kept cluster."""
    km, flows = within_flow(spark, sf_dir)
    nf, lf = (stage(x, "within_flow") for x in flows)
    size, node = (F.col("p_size") % 3).cast("string"), F.col("p_partkey").cast("string")
    part = T.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("node_id"),
        F.when(F.col("p_size").isin(1, 30), F.concat_ws(":", "p_brand", node))
        .otherwise(F.concat_ws(":", "p_brand", "p_type", size, node)).alias("path"))
    out = hierarchical_codelength(nf, lf, km.select("cl_top", "node_id").join(part, "node_id"), ["cl_top"])
    return out.withColumn("codelength", F.round("codelength", 9))


# ------------------------------------------------------- partition, refine

from ..operators.hierarchy import refine_clusters  # noqa: E402
from . import pipeline as P  # noqa: E402


@register("two_level_partition")
def q_two_level_partition(spark, sf_dir):
    """Two-level partition of the whole network -> tree ``(cl, flow, node_name)``."""
    return P.two_level_tree(T.vertices(spark, sf_dir), T.edges(spark, sf_dir))


@register("refine_clusters")
def q_refine_clusters(spark, sf_dir):
    """Hierarchical paths inside every kept cluster: ``(node_id, cl_top, cl, status)``."""
    _, _, km, edges = network(spark, sf_dir)
    return refine_clusters(km, M.within_cluster_edges(edges, km))


@register("final_assignment")
def q_final_assignment(spark, sf_dir):
    """Union of refined and pass-through rows, with a status column."""
    return P.hierarchical_communities(
        T.vertices(spark, sf_dir), T.edges(spark, sf_dir), T.tree(spark, sf_dir),
        MIN_SIZE, MAX_SIZE, with_status=True)


@register("refine_status", with_views(f"""
SELECT cl_top, 'ok' AS status, CAST(count(*) AS BIGINT) AS n FROM members
WHERE cl_top IN (SELECT cl_top FROM sizes WHERE n >= {MIN_SIZE}) GROUP BY cl_top"""))
def q_refine_status(spark, sf_dir):
    """Per cluster of at least ``MIN_SIZE`` nodes, however large: status of its
    refinement and node count."""
    _, _, km, edges = network(spark, sf_dir, max_size=None)
    refined = refine_clusters(km, M.within_cluster_edges(edges, km))
    return refined.groupBy("cl_top", "status").agg(F.count(F.lit(1)).alias("n"))


@register("refined_with_flow")
def q_refined_with_flow(spark, sf_dir):
    """Refined paths with the whole-network flow attached (left join)."""
    _, _, km, edges = network(spark, sf_dir)
    refined = refine_clusters(km, M.within_cluster_edges(edges, km))
    return refined.join(km.select("node_id", "flow"), "node_id", "left")


@register("final_assignment_heads", with_views("""
SELECT m.node_id, m.node_name, m.cl_top, round(m.flow, 9) AS flow,
       CASE WHEN k.node_id IS NULL THEN 'passthrough' ELSE 'ok' END AS status,
       CASE WHEN k.node_id IS NULL THEN m.cl END AS old_path, m.cl_top AS path_head
FROM members m LEFT JOIN kept_members k ON m.node_id = k.node_id"""))
def q_final_assignment_heads(spark, sf_dir):
    """Union of refined and pass-through rows: each node once with its name,
    cluster, flow and status; pass-through paths unchanged, path head = cluster."""
    out = P.hierarchical_communities(
        T.vertices(spark, sf_dir), T.edges(spark, sf_dir), T.tree(spark, sf_dir),
        MIN_SIZE, MAX_SIZE, with_status=True)
    return out.select("node_id", "node_name", "cl_top", F.round("flow", 9).alias("flow"), "status",
                      F.when(F.col("status") == "passthrough", F.col("cl")).alias("old_path"),
                      PT.cl_top("cl").alias("path_head"))


@register("hierarchical_communities")
def q_hierarchical_communities(spark, sf_dir):
    """The flagship job: ``(node_id, node_name, cl, cl_top, flow)`` sorted by node id."""
    return P.hierarchical_communities(
        T.vertices(spark, sf_dir), T.edges(spark, sf_dir), T.tree(spark, sf_dir),
        MIN_SIZE, MAX_SIZE)


def _no_worse(refined, links, nodes):
    """``(cl_top, no_worse)``: whether the hierarchy that refinement found in
    a cluster has a codelength of at most the cluster as one module."""
    nf, lf = (stage(x, "within_flow") for x in undirdir_flow(links, ["cl_top"], nodes=nodes.select("cl_top", "node_id")))
    inside = refined.select("cl_top", "node_id", F.expr("substring(cl, instr(cl, ':') + 1)").alias("path"))
    found = hierarchical_codelength(nf, lf, inside, ["cl_top"]).select("cl_top", "codelength")
    one = one_module_codelength(nf, ["cl_top"]).select("cl_top", F.col("codelength").alias("one"))
    return found.join(one, "cl_top").select("cl_top", (F.col("codelength") <= F.col("one") + 1e-9).alias("no_worse"))


@register("refined_codelength", with_views("SELECT DISTINCT cl_top, true AS no_worse FROM kept_members"))
def q_refined_codelength(spark, sf_dir):
    """Quality of the refinement of every kept cluster, by the hierarchical codelength."""
    _, _, km, edges = network(spark, sf_dir)
    with conf_override(spark, SMALL_BROADCASTS):
        km = stage(km, "kept_members")
        within = stage(M.within_cluster_edges(edges, km), "within")
        return stage(_no_worse(refine_clusters(km, within), within, km), "no_worse")


@register("cluster_network")
def q_cluster_network(spark, sf_dir):
    """Network only: two-level partition, then refinement of its clusters."""
    return P.cluster_network(T.vertices(spark, sf_dir), T.edges(spark, sf_dir),
                             MIN_SIZE, MAX_SIZE)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_hierarchical_communities(spark, sf_dir)


# ----------------------------------------------------- edge/cluster statistics

from ..operators import ordering as O  # noqa: E402
from ..functions import paths as PT  # noqa: E402

EDGE_CLUSTERS = """edge_cl AS (
  SELECT e.source, e.target, a.cl_top AS cl_out, b.cl_top AS cl_in
  FROM edges e LEFT JOIN members a ON e.source = a.node_id LEFT JOIN members b ON e.target = b.node_id
),
same_cl AS (SELECT * FROM edge_cl WHERE cl_out = cl_in),
per_cl AS (
  SELECT s.*, c.num_rows_in_cl FROM same_cl s
  JOIN (SELECT cl_out, CAST(count(*) AS BIGINT) AS num_rows_in_cl FROM same_cl GROUP BY cl_out) c
  ON s.cl_out = c.cl_out
)"""
LARGE_EDGE_CLUSTER = 3   # clusters with at least this many within-cluster edges


def _edge_clusters(spark, sf_dir):
    members = M.members(T.tree(spark, sf_dir), T.vertices(spark, sf_dir))
    return members, M.edge_clusters(T.edges(spark, sf_dir), members)


@register("edge_clusters", with_views(f", {EDGE_CLUSTERS}\nSELECT * FROM edge_cl".replace("WITH ,", "WITH")))
def q_edge_clusters(spark, sf_dir):
    return _edge_clusters(spark, sf_dir)[1]


@register("same_cluster_edges", with_views(f", {EDGE_CLUSTERS}\nSELECT * FROM same_cl"))
def q_same_cluster_edges(spark, sf_dir):
    return M.same_cluster_edges(_edge_clusters(spark, sf_dir)[1])


@register("edges_per_cluster", with_views(f", {EDGE_CLUSTERS}\nSELECT * FROM per_cl"))
def q_edges_per_cluster(spark, sf_dir):
    return M.edges_per_cluster(M.same_cluster_edges(_edge_clusters(spark, sf_dir)[1]))


@register("edges_in_large_clusters", with_views(
    f", {EDGE_CLUSTERS}\nSELECT * FROM per_cl WHERE num_rows_in_cl >= {LARGE_EDGE_CLUSTER}"))
def q_edges_in_large_clusters(spark, sf_dir):
    per = M.edges_per_cluster(M.same_cluster_edges(_edge_clusters(spark, sf_dir)[1]))
    return per.where(F.col("num_rows_in_cl") >= LARGE_EDGE_CLUSTER)


@register("edges_with_cluster_sizes", with_views(f""", {EDGE_CLUSTERS}
SELECT e.*, s.n AS num_papers_in_cluster FROM edge_cl e LEFT JOIN sizes s ON e.cl_out = s.cl_top"""))
def q_edges_with_cluster_sizes(spark, sf_dir):
    members, ec = _edge_clusters(spark, sf_dir)
    return M.edges_with_cluster_sizes(ec, M.cluster_sizes(members))


@register("endpoint_count", with_views("""
SELECT CAST(count(*) AS BIGINT) AS n_nodes FROM (SELECT source AS node_id FROM edges UNION SELECT target FROM edges) t"""))
def q_endpoint_count(spark, sf_dir):
    return M.endpoint_nodes(T.edges(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n_nodes"))


@register("partition_contingency", with_views("""
SELECT m.cl_top AS cl_a, p.p_type AS cl_b, CAST(count(*) AS BIGINT) AS n
FROM members m JOIN part p ON m.node_id = p.p_partkey GROUP BY 1, 2"""))
def q_partition_contingency(spark, sf_dir):
    members = M.members(T.tree(spark, sf_dir), T.vertices(spark, sf_dir))
    a = members.select("node_id", F.col("cl_top").alias("cl_a"))
    b = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node_id"),
                                               F.col("p_type").alias("cl_b"))
    return M.partition_contingency(a, b)


@register("pipeline_counts", with_views("""
SELECT 'vertices' AS stage, CAST(count(*) AS BIGINT) AS n FROM vertices
UNION ALL SELECT 'edges', count(*) FROM edges
UNION ALL SELECT 'members', count(*) FROM members
UNION ALL SELECT 'kept_clusters', count(*) FROM kept
UNION ALL SELECT 'kept_members', count(*) FROM kept_members
UNION ALL SELECT 'within_cluster_edges', count(*) FROM within
UNION ALL SELECT 'passthrough_nodes', count(*) FROM members WHERE node_id NOT IN (SELECT node_id FROM kept_members)"""))
def q_pipeline_counts(spark, sf_dir):
    """Rows of every stage before refinement, counted while they are written."""
    _, counts = P.counted_network(T.vertices(spark, sf_dir), T.edges(spark, sf_dir), T.tree(spark, sf_dir), MIN_SIZE, MAX_SIZE)
    return spark.createDataFrame(list(counts.items()), "stage string, n long")


@register("duplicate_names", with_views("""
SELECT p_name AS node_name, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY p_name HAVING count(*) > 1"""))
def q_duplicate_names(spark, sf_dir):
    """Names carried by more than one vertex, with the part name as vertex name."""
    v = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node_id"),
                                               F.col("p_name").alias("node_name"))
    return M.duplicate_names(v)


# ------------------------------------------------------------- ordering

@register("cluster_rank", with_views("""
SELECT cl_top, n, row_number() OVER (ORDER BY n DESC, cl_top) AS rank FROM sizes"""))
def q_cluster_rank(spark, sf_dir):
    return O.cluster_rank(q_cluster_sizes(spark, sf_dir))


@register("leaf_ordinals", with_views("""
SELECT cl_top, node_id, flow, row_number() OVER (PARTITION BY cl_top ORDER BY flow DESC, node_id) AS leaf
FROM members"""))
def q_leaf_ordinals(spark, sf_dir):
    return O.leaf_ordinals(q_members(spark, sf_dir))


TOP_K = 10


@register("top_clusters", with_views(f"SELECT * FROM sizes ORDER BY n DESC, cl_top LIMIT {TOP_K}"))
def q_top_clusters(spark, sf_dir):
    return O.top_clusters(q_cluster_sizes(spark, sf_dir), TOP_K)


EDGE_SAMPLE = 10_000


@register("edge_sample", with_views(f"SELECT * FROM edges ORDER BY source, target LIMIT {EDGE_SAMPLE}"))
def q_edge_sample(spark, sf_dir):
    """The first rows of the edge list in key order (a head() preview)."""
    return T.edges(spark, sf_dir).orderBy("source", "target").limit(EDGE_SAMPLE)


BIN_SIZE = 200
BIN_MIN = 3
BINS_SQL = f"""WITH RECURSIVE {VIEWS.strip()},
s AS (SELECT cl_top, n, row_number() OVER (ORDER BY n DESC, cl_top) AS i FROM sizes WHERE n >= {BIN_MIN}),
walk(i, bin, acc) AS (
  SELECT i, CAST(0 AS BIGINT), n FROM s WHERE i = 1
  UNION ALL
  SELECT s.i, CASE WHEN w.acc >= {BIN_SIZE} THEN w.bin + 1 ELSE w.bin END,
         CASE WHEN w.acc >= {BIN_SIZE} THEN s.n ELSE w.acc + s.n END
  FROM walk w JOIN s ON s.i = w.i + 1
),
bins AS (SELECT s.cl_top, s.n, walk.bin FROM walk JOIN s ON walk.i = s.i)"""


def _bins(spark, sf_dir):
    return O.greedy_bins(q_cluster_sizes(spark, sf_dir), BIN_SIZE, BIN_MIN)


@register("cluster_bins", BINS_SQL + "\nSELECT * FROM bins")
def q_cluster_bins(spark, sf_dir):
    return _bins(spark, sf_dir)


@register("bin_edges", BINS_SQL + f", {EDGE_CLUSTERS}\n" + """
SELECT p.source, p.target, p.cl_out, b.bin FROM same_cl p JOIN bins b ON p.cl_out = b.cl_top""")
def q_bin_edges(spark, sf_dir):
    """Within-cluster edges of every bin's clusters, tagged with the bin."""
    same = M.same_cluster_edges(_edge_clusters(spark, sf_dir)[1])
    bins = _bins(spark, sf_dir)
    return (M.edges_of_clusters(same, bins)
            .join(bins.select(F.col("cl_top").alias("cl_out"), "bin"), "cl_out")
            .select("source", "target", "cl_out", "bin"))


# ---------------------------------------------------------- path functions

@register("cl_top", with_views("SELECT cl, split_part(cl, ':', 1) AS cl_top FROM tree"))
def q_cl_top(spark, sf_dir):
    return T.tree(spark, sf_dir).select("cl", PT.cl_top("cl").alias("cl_top"))


@register("combined_path", with_views("""
SELECT node_id, cl_top || ':' || CAST(row_number() OVER (PARTITION BY cl_top ORDER BY flow DESC, node_id) AS VARCHAR)
       || ':1' AS cl FROM kept_members"""))
def q_combined_path(spark, sf_dir):
    """``cl_top:<sub path>`` with sub path = ``<leaf>:1``."""
    km = network(spark, sf_dir)[2]
    leaves = O.leaf_ordinals(km)
    sub = F.concat(F.col("leaf").cast("string"), F.lit(":1"))
    return leaves.select("node_id", PT.combined_path("cl_top", sub).alias("cl"))


@register("path_join", with_views("""
SELECT node_id, CAST(cl_top AS VARCHAR) || ':' || CAST(node_id % 7 AS VARCHAR) || ':' || CAST(node_id AS VARCHAR) AS path
FROM members"""))
def q_path_join(spark, sf_dir):
    """Integer lists -> path strings."""
    m = q_members(spark, sf_dir)
    arr = F.array(F.col("cl_top").cast("long"), F.col("node_id") % 7, F.col("node_id"))
    return m.select("node_id", PT.path_join(arr).alias("path"))


@register("path_replace_head", with_views("""
SELECT m.node_id, CAST(r.rank AS VARCHAR) || CASE WHEN strpos(m.cl, ':') > 0
       THEN substr(m.cl, strpos(m.cl, ':')) ELSE '' END AS cl
FROM members m JOIN (SELECT cl_top, row_number() OVER (ORDER BY n DESC, cl_top) AS rank FROM sizes) r
ON m.cl_top = r.cl_top"""))
def q_path_replace_head(spark, sf_dir):
    """Re-number top clusters by size rank inside every path."""
    m = q_members(spark, sf_dir)
    ranks = O.cluster_rank(M.cluster_sizes(m)).select("cl_top", "rank")
    return m.join(ranks, "cl_top").select("node_id", PT.path_replace_head("cl", F.col("rank")).alias("cl"))


@register("cluster_file_names", with_views("""
SELECT cl_top, rank, lpad(CAST(rank AS VARCHAR), CAST(length(CAST((SELECT count(*) FROM kept) AS VARCHAR)) AS INTEGER), '0')
       || '_network_cluster-' || cl_top || '.txt' AS file_name
FROM (SELECT cl_top, row_number() OVER (ORDER BY n DESC, cl_top) AS rank FROM kept) t"""))
def q_cluster_file_names(spark, sf_dir):
    kept = network(spark, sf_dir)[1]
    ranked = O.cluster_rank(kept)
    width = len(str(kept.count()))
    return ranked.select("cl_top", "rank",
                         PT.cluster_file_name("rank", F.lit(width), "network", "cl_top").alias("file_name"))


# ------------------------------------------------------- sources and sinks
# Each query writes data derived from the driver tables into the shared
# staging folder with the library's writer and reads it back with its reader.

from ..session import SMALL_BROADCASTS, conf_override, stage, staging_path  # noqa: E402
from ..sources import pajek as PJ  # noqa: E402
from ..sources import text as TX  # noqa: E402

PAJEK_IDS = """ids AS (
  SELECT orig, row_number() OVER (ORDER BY orig) AS node_id
  FROM (SELECT source AS orig FROM edges UNION SELECT target FROM edges) t
)"""


def _pajek_dir(spark, sf_dir):
    vertices, arcs = PJ.edges_to_pajek(T.edges(spark, sf_dir))
    path = staging_path(spark, "network_pajek")
    PJ.write_pajek(vertices, arcs, path)
    return path


@register("edges_to_pajek", with_views(f""", {PAJEK_IDS}
SELECT node_id, CAST(orig AS VARCHAR) AS node_name FROM ids"""))
def q_edges_to_pajek(spark, sf_dir):
    """Vertex table of the Pajek conversion (consecutive ids)."""
    return PJ.edges_to_pajek(T.edges(spark, sf_dir))[0]


@register("pajek_vertices", with_views(f""", {PAJEK_IDS}
SELECT node_id, CAST(orig AS VARCHAR) AS node_name FROM ids"""))
def q_pajek_vertices(spark, sf_dir):
    return PJ.read_pajek(spark, _pajek_dir(spark, sf_dir)).vertices


PAJEK_ARCS = f""", {PAJEK_IDS}
SELECT a.node_id AS source, b.node_id AS target, 1.0 AS weight
FROM edges e JOIN ids a ON e.source = a.orig JOIN ids b ON e.target = b.orig"""


@register("pajek_edges", with_views(PAJEK_ARCS))
def q_pajek_edges(spark, sf_dir):
    return PJ.read_pajek(spark, _pajek_dir(spark, sf_dir)).edges


@register("read_pajek", with_views("""
SELECT 'e' AS section, CAST(count(*) AS BIGINT) AS n FROM edges
UNION ALL SELECT 'v', count(*) FROM (SELECT source FROM edges UNION SELECT target FROM edges) t"""))
def q_read_pajek(spark, sf_dir):
    """Rows per section of a written Pajek network read back (default rules)."""
    t = PJ.read_pajek(spark, _pajek_dir(spark, sf_dir))
    return (t.vertices.select(F.lit("v").alias("section"))
            .unionByName(t.edges.select(F.lit("e").alias("section")))
            .groupBy("section").agg(F.count(F.lit(1)).alias("n")))


@register("pajek_to_edgelist", with_views(f""", {PAJEK_IDS}
SELECT a.node_id AS source, b.node_id AS target
FROM edges e JOIN ids a ON e.source = a.orig JOIN ids b ON e.target = b.orig"""))
def q_pajek_to_edgelist(spark, sf_dir):
    """Pajek (strict header rules) -> headerless TSV edge list -> read back."""
    t = PJ.read_pajek(spark, _pajek_dir(spark, sf_dir), strict_headers=True)
    path = staging_path(spark, "edgelist")
    TX.write_edgelist(t.edges, path)
    return TX.read_edgelist(spark, path)


@register("read_edgelist", with_views("SELECT source AS Paper_ID, target AS Paper_reference_ID FROM edges"))
def q_read_edgelist(spark, sf_dir):
    path = staging_path(spark, "edgelist")
    TX.write_edgelist(T.edges(spark, sf_dir), path)
    return TX.read_edgelist(spark, path, ("Paper_ID", "Paper_reference_ID"))


@register("read_tree", with_views("SELECT cl, round(flow, 9) AS flow, node_name FROM tree"))
def q_read_tree(spark, sf_dir):
    path = staging_path(spark, "tree")
    TX.write_tree(T.tree(spark, sf_dir), path)
    t = TX.read_tree(spark, path)
    return t.select("cl", F.round("flow", 9).alias("flow"), "node_name")


MEMBER_SCHEMA = "node_id BIGINT, node_name STRING, cl STRING, flow DOUBLE, cl_top STRING"


@register("write_result_roundtrip", with_views(
    "SELECT node_id, node_name, cl, round(flow, 9) AS flow, cl_top FROM members"))
def q_write_result_roundtrip(spark, sf_dir):
    """Sorted, range-partitioned TSV result written and read back."""
    path = staging_path(spark, "result")
    TX.write_result(q_members(spark, sf_dir), path)
    r = TX.read_results(spark, path, MEMBER_SCHEMA)
    return r.withColumn("flow", F.round("flow", 9))


@register("sorted_result_file", with_views("""
SELECT row_number() OVER (ORDER BY node_id, cl) + 1 AS line, node_id, node_name, cl, cl_top FROM members"""))
def q_sorted_result_file(spark, sf_dir):
    """One sorted TSV file with one header joined from range-sorted parts;
    each row with its line in the file (the header is line 1)."""
    path = staging_path(spark, "single_result")
    rows = q_members(spark, sf_dir).select("node_id", "node_name", "cl", "cl_top")
    TX.write_result(rows, path, single_file=True, sort_by=["node_id", "cl"])
    lines = TX.numbered_lines(spark, path)
    cells = F.from_csv("value", "node_id BIGINT, node_name STRING, cl STRING, cl_top STRING", {"sep": "\t"})
    return lines.where("line > 1").select("line", cells.alias("r")).select("line", "r.*")


@register("pajek_bad_lines", with_views("""
SELECT 'v' AS section, 'x' || CAST(node_id AS VARCHAR) || ' "' || node_name || '"' AS line FROM members
UNION ALL SELECT 'e', CAST(source AS VARCHAR) || ' to ' || CAST(target AS VARCHAR) FROM edges"""))
def q_pajek_bad_lines(spark, sf_dir):
    """A network written with a broken line beside every good one; the lines
    the reader could not use, written as a side output and read back."""
    members, edges = q_members(spark, sf_dir), T.edges(spark, sf_dir)
    net, bad = staging_path(spark, "broken_net"), staging_path(spark, "bad_lines")
    good = PJ.pajek_lines(members.select("node_id", "node_name"), edges.select("source", "target"))
    broken = (members.select(F.lit(0).alias("sec"), F.col("node_id").alias("k1"), F.lit(1).cast("long").alias("k2"),
                             F.format_string('x%d "%s"', "node_id", "node_name").alias("value"))
              .union(edges.select(F.lit(1), "source", "target", F.format_string("%d to %d", "source", "target"))))
    (good.unionByName(broken).repartitionByRange("sec", "k1", "k2").sortWithinPartitions("sec", "k1", "k2")
     .select("value").write.text(net))
    TX.write_bad_lines(PJ.read_pajek(spark, net).bad, bad)
    return TX.read_bad_lines(spark, bad)


@register("read_results", with_views(
    "SELECT CAST(node_id AS VARCHAR) AS node_id, node_name, cl, cl_top FROM members"))
def q_read_results(spark, sf_dir):
    """Headered TSV parts of one directory read without a schema (strings)."""
    path = staging_path(spark, "results")
    TX.write_result(q_members(spark, sf_dir).drop("flow"), path)
    return TX.read_results(spark, path)


@register("read_single_csv", with_views("SELECT cl_top, n FROM sizes"))
def q_read_single_csv(spark, sf_dir):
    path = staging_path(spark, "sizes_csv")
    q_cluster_sizes(spark, sf_dir).repartition(1).write.csv(path)
    return TX.read_single_csv(spark, path, "cl_top STRING, n BIGINT")


@register("cluster_counts", with_views("SELECT cl_top AS cl, n AS num_papers FROM kept"))
def q_cluster_counts(spark, sf_dir):
    """Cluster counts file with header ``cl<TAB>num_papers``, read back."""
    path = staging_path(spark, "counts")
    TX.write_counts(network(spark, sf_dir)[1], path)
    return TX.read_results(spark, path, "cl STRING, num_papers BIGINT")


LIST_FOLDERS = "cluster_rank BIGINT, cl_top STRING"


@register("cluster_node_lists", with_views("""
SELECT r.rank AS cluster_rank, m.cl_top, m.node_name
FROM members m JOIN (SELECT cl_top, row_number() OVER (ORDER BY n DESC, cl_top) AS rank FROM kept) r
ON m.cl_top = r.cl_top"""))
def q_cluster_node_lists(spark, sf_dir):
    """One node-name list per kept cluster, partitioned by size rank and cluster."""
    members, kept, km, _ = network(spark, sf_dir)
    ranked = O.cluster_rank(kept).select("cl_top", F.col("rank").alias("cluster_rank"))
    rows = km.join(ranked, "cl_top").select("cluster_rank", "cl_top", "node_name")
    path = staging_path(spark, "node_lists")
    TX.write_partitioned_text(rows, path, ["cluster_rank", "cl_top"], "node_name")
    back = TX.read_partitioned_text(spark, path, "node_name", LIST_FOLDERS)
    return back.select("cluster_rank", "cl_top", "node_name")


@register("bin_members", BINS_SQL + "\nSELECT bin, cl_top FROM bins")
def q_bin_members(spark, sf_dir):
    """Cluster names of every bin, one text file set per bin, read back."""
    path = staging_path(spark, "bin_members")
    TX.write_partitioned_text(_bins(spark, sf_dir), path, ["bin"], "cl_top")
    back = TX.read_partitioned_text(spark, path, "cl_top", "bin BIGINT")
    return back.select("bin", "cl_top")


# ------------------------------------------- per-bin trees, finalisation

BIN_TREE_ROWS = """, bin_tree AS (
  SELECT b.bin, m.cl_top, m.cl, m.node_name,
         row_number() OVER (PARTITION BY m.cl_top ORDER BY m.flow DESC, m.node_id) AS leaf
  FROM members m JOIN bins b ON m.cl_top = b.cl_top
)"""


def _bin_tree_files(spark, sf_dir):
    """One tree file per bin (rows in cluster order), written and listed back
    as ``(bin, file, pos, path, name)``."""
    members = q_members(spark, sf_dir)
    bins = _bins(spark, sf_dir)
    leaves = O.leaf_ordinals(members).select("node_id", "leaf")
    rows = (members.join(bins.select("cl_top", "bin"), "cl_top").join(leaves, "node_id")
            .select(PT.zero_padded("bin", F.lit(4)).alias("bin"), "cl_top", "leaf",
                    F.col("cl").alias("path"), F.col("node_name").alias("name")))
    path = staging_path(spark, "bin_trees")
    # the format asks for one file per bin, so a bin is written by one task;
    # a bin holds bin_size nodes plus one cluster, and a cluster is not bounded
    (rows.repartition("bin").sortWithinPartitions("bin", "cl_top", "leaf")
     .select("bin", "path", "name")
     .write.partitionBy("bin").option("sep", " ").csv(path))
    # the partition column is declared so the padded bin names stay text
    back = spark.read.csv(path, sep=" ", schema="path STRING, name STRING, bin STRING")
    return back.select(
        F.col("bin").cast("string").alias("bin"),
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"),
                 F.monotonically_increasing_id()).alias("pos"),
        "path", "name")


@register("trees_per_bin", BINS_SQL + "\nSELECT lpad(CAST(bin AS VARCHAR), 4, '0') AS bin, CAST(1 AS BIGINT) AS n_files FROM bins GROUP BY bin")
def q_trees_per_bin(spark, sf_dir):
    """Bins with exactly one tree file."""
    return O.single_file_bins(_bin_tree_files(spark, sf_dir).select("bin", "file"))


@register("largest_node_lists", with_views("""
SELECT r.rank AS cluster_rank, m.cl_top, m.node_name
FROM members m JOIN (SELECT cl_top, row_number() OVER (ORDER BY n DESC, cl_top) AS rank FROM sizes) r
ON m.cl_top = r.cl_top WHERE r.rank <= 10"""))
def q_largest_node_lists(spark, sf_dir):
    """Node lists of the ten largest clusters only (the bound is the feature)."""
    members = q_members(spark, sf_dir)
    rows = TX.largest_node_lists(members, M.cluster_sizes(members), TOP_K)
    path = staging_path(spark, "largest_lists")
    TX.write_partitioned_text(rows, path, ["cluster_rank", "cl_top"], "node_name")
    back = TX.read_partitioned_text(spark, path, "node_name", LIST_FOLDERS)
    return back.select("cluster_rank", "cl_top", "node_name")


@register("consolidate_trees", BINS_SQL + BIN_TREE_ROWS + """
SELECT node_name AS name,
       CAST(dense_rank() OVER (ORDER BY bin, cl_top) AS VARCHAR) || substr(cl, strpos(cl, ':')) AS path,
       dense_rank() OVER (ORDER BY bin, cl_top) AS top
FROM bin_tree""")
def q_consolidate_trees(spark, sf_dir):
    """Unique top ids over the per-bin tree files (file order, line order)."""
    rows = _bin_tree_files(spark, sf_dir)
    files = rows.select("file", "pos", "path", "name")
    path = staging_path(spark, "consolidated")
    TX.write_consolidated(O.consolidate_trees(files), path)
    return TX.read_consolidated(spark, path)


SUB_RESULTS = """, sub AS (
  SELECT node_id, cl_top, '1:' || CAST(row_number() OVER (PARTITION BY cl_top ORDER BY flow DESC, node_id) AS VARCHAR)
         AS hierInfomap_cl
  FROM kept_members
),
fin AS (
  SELECT v.node_id, t.cl, t.flow, t.node_name, split_part(t.cl, ':', 1) AS cl_top, s.hierInfomap_cl,
         CASE WHEN s.hierInfomap_cl IS NULL THEN t.cl ELSE split_part(t.cl, ':', 1) || ':' || s.hierInfomap_cl END
           AS cl_combined
  FROM tree t LEFT JOIN vertices v ON t.node_name = v.node_name LEFT JOIN sub s ON v.node_id = s.node_id
)"""


def _finalized(spark, sf_dir):
    """Tree + older sub-cluster result files (TSV parts) + vertices."""
    km = network(spark, sf_dir)[2]
    sub = O.leaf_ordinals(km).select(
        "node_id", "cl_top",
        F.concat(F.lit("1:"), F.col("leaf").cast("string")).alias("hierInfomap_cl"))
    path = staging_path(spark, "sub_results")
    TX.write_result(sub, path)
    back = TX.read_results(spark, path, "node_id BIGINT, cl_top STRING, hierInfomap_cl STRING")
    return P.finalize_paths(T.tree(spark, sf_dir), back, T.vertices(spark, sf_dir))


@register("finalize_paths", with_views(SUB_RESULTS + "\nSELECT node_id, cl, round(flow, 9) AS flow, node_name, cl_top, hierInfomap_cl, cl_combined FROM fin"))
def q_finalize_paths(spark, sf_dir):
    return _finalized(spark, sf_dir).withColumn("flow", F.round("flow", 9))


@register("trim_result", with_views(SUB_RESULTS + "\nSELECT node_id AS id, round(flow, 9) AS flow, node_name AS UID, cl_top, cl_combined AS cl FROM fin"))
def q_trim_result(spark, sf_dir):
    return P.trim_result(_finalized(spark, sf_dir)).withColumn("flow", F.round("flow", 9))


def _bin_network(spark, sf_dir):
    """Nodes and links of each bin's combined within-cluster network."""
    members = q_members(spark, sf_dir)
    bins = _bins(spark, sf_dir)
    nodes = members.join(bins.select("cl_top", "bin"), "cl_top").select(
        F.col("bin").cast("string").alias("cl_top"), "node_id")
    same = M.same_cluster_edges(M.edge_clusters(T.edges(spark, sf_dir), members))
    links = same.join(bins.select(F.col("cl_top").alias("cl_out"), "bin"), "cl_out").select(
        "source", "target", F.col("bin").cast("string").alias("cl_top"))
    return nodes, links


@register("refine_by_bin")
def q_refine_by_bin(spark, sf_dir):
    """Hierarchical refinement of each bin's combined within-cluster network:
    ``(node_id, bin, cl, status)`` - the group key is the bin."""
    out = refine_clusters(*_bin_network(spark, sf_dir))
    return out.select("node_id", F.col("cl_top").alias("bin"), "cl", "status")


@register("bin_codelength", BINS_SQL + "\nSELECT DISTINCT CAST(bin AS VARCHAR) AS cl_top, true AS no_worse FROM bins")
def q_bin_codelength(spark, sf_dir):
    """Quality of the refinement of every bin, by the hierarchical codelength."""
    with conf_override(spark, SMALL_BROADCASTS):
        nodes, links = (stage(x, "bin_network") for x in _bin_network(spark, sf_dir))
        return stage(_no_worse(refine_clusters(nodes, links), links, nodes), "no_worse")


# ------------------------------------- partition jobs on a network of known
# optimum: cliques of five parts in rings of three (sources.tables)

CLIQUES = """cp AS (
  SELECT p_partkey AS node_id, p_name AS node_name, (p_partkey // 5) * 5 AS clique, (p_partkey // 15) * 15 AS ring
  FROM part WHERE (p_partkey // 15) IN (SELECT p_partkey // 15 FROM part GROUP BY 1 HAVING count(*) = 15)
)"""
#: Rings whose links are broken on purpose, and rings that share one large cluster.
BROKEN_RING, SHARED_RING = 4, 5


def _ring_number():
    return F.floor(F.col("ring") / (T.CLIQUE * T.RING))


def _rings(spark, sf_dir):
    """Members ``(node_id, cl_top, ring)`` with one cluster per ring, and their links."""
    parts = T.clique_parts(spark, sf_dir).withColumn("cl_top", F.col("ring").cast("string"))
    within = M.within_cluster_edges(T.clique_edges(spark, sf_dir), parts)
    return parts, within


@register("two_level_cliques", f"""WITH {CLIQUES}
SELECT node_id, clique AS module FROM cp""")
def q_two_level_cliques(spark, sf_dir):
    """Two-level partition of the clique network: the modules are the cliques."""
    from ..operators.moves import two_level_partition
    nf, lf = undirdir_flow(T.clique_edges(spark, sf_dir))
    return two_level_partition(nf, lf)[0]


@register("restart_cliques", f"""WITH {CLIQUES}
SELECT ring, node_id, clique AS module FROM cp""")
def q_restart_cliques(spark, sf_dir):
    """Best of three restarts inside every ring: the modules are the cliques."""
    from ..operators.restarts import best_of_restarts
    members, edges = _rings(spark, sf_dir)
    nf, lf = undirdir_flow(edges.withColumnRenamed("cl_top", "ring"), ["ring"])
    best, _ = best_of_restarts(nf, lf, "ring", 3)
    return best.select(F.col("ring").cast("long").alias("ring"), "node_id", "module")


@register("restart_codelength", with_views("""
SELECT DISTINCT cl_top, true AS no_worse, CAST(1 AS BIGINT) AS n_best, CAST(3 AS BIGINT) AS restarts
FROM kept_members"""))
def q_restart_codelength(spark, sf_dir):
    """Best of three restarts in every kept cluster of the network: never
    longer than a single partition of it."""
    from ..operators.moves import two_level_partition
    from ..operators.restarts import best_of_restarts
    _, _, km, edges = network(spark, sf_dir)
    km = stage(km, "kept_members")
    within = stage(M.within_cluster_edges(edges, km), "within")
    nf, lf = undirdir_flow(within, ["cl_top"], nodes=km.select("cl_top", "node_id").distinct())
    nf, lf = stage(nf, "restart_flow"), stage(lf, "restart_link_flow")
    one = codelength(nf, lf, two_level_partition(nf, lf, "cl_top")[0], ["cl_top"]).select("cl_top", F.col("codelength").alias("one"))
    best, runs = best_of_restarts(nf, lf, "cl_top", 3)
    most = codelength(nf, lf, best, ["cl_top"]).select("cl_top", F.col("codelength").alias("best_of"))
    counts = runs.groupBy("cl_top").agg(F.sum(F.col("best").cast("long")).alias("n_best"), F.count("*").alias("restarts"))
    return (one.join(most, "cl_top").join(counts, "cl_top")
            .select("cl_top", (F.col("best_of") <= F.col("one") + 1e-9).alias("no_worse"), "n_best", "restarts"))


@register("refine_cliques", f"""WITH {CLIQUES}
SELECT node_id, CAST(ring AS VARCHAR) AS cl_top,
       CAST(ring AS VARCHAR) || ':' || CAST((clique - ring) // 5 + 1 AS VARCHAR) || ':' || CAST(node_id - clique + 1 AS VARCHAR) AS cl,
       'ok' AS status
FROM cp""")
def q_refine_cliques(spark, sf_dir):
    """Every ring is a cluster and splits into its three cliques."""
    return refine_clusters(*_rings(spark, sf_dir))


@register("refine_status_cliques", f"""WITH {CLIQUES}
SELECT CAST(ring AS VARCHAR) AS cl_top, CASE WHEN (ring // 15) % {BROKEN_RING} = 0 THEN 'failed' ELSE 'ok' END AS status,
       CAST(count(*) AS BIGINT) AS n
FROM cp GROUP BY ring""")
def q_refine_status_cliques(spark, sf_dir):
    """Status per cluster; every fourth ring has a link of negative weight and fails."""
    parts, within = _rings(spark, sf_dir)
    ring = F.floor(F.col("source") / (T.CLIQUE * T.RING))
    broken = (ring % BROKEN_RING == 0) & (F.col("weight") == 1.0)
    bad = within.withColumn("weight", F.when(broken, -1.0).otherwise(F.col("weight")))
    return refine_clusters(parts, bad).groupBy("cl_top", "status").agg(F.count(F.lit(1)).alias("n"))


@register("refined_with_flow_cliques", f"""WITH {CLIQUES}
SELECT node_id, CAST(ring AS VARCHAR) || ':' || CAST((clique - ring) // 5 + 1 AS VARCHAR) || ':' || CAST(node_id - clique + 1 AS VARCHAR) AS cl,
       round(p_retailprice / sum(p_retailprice) OVER (), 9) AS flow
FROM cp JOIN part ON p_partkey = node_id""")
def q_refined_with_flow_cliques(spark, sf_dir):
    """Refined paths with a flow of the whole network attached (left join)."""
    refined = q_refine_cliques(spark, sf_dir)
    ids = T.clique_parts(spark, sf_dir).select("node_id")
    part = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node_id"), "p_retailprice")
    price = part.join(ids, "node_id", "left_semi")
    total = price.agg(F.sum("p_retailprice")).scalar()
    flow = price.select("node_id", F.round(F.col("p_retailprice") / total, 9).alias("flow"))
    return refined.join(flow, "node_id", "left").select("node_id", "cl", "flow")


CLIQUE_TREE = f"""{CLIQUES},
ct AS (
  SELECT node_id, 'part#' || CAST(node_id AS VARCHAR) AS node_name, clique, ring,
         CASE WHEN (ring // 15) % {SHARED_RING} = 1 THEN 'shared' ELSE CAST(ring AS VARCHAR) END AS cl_top FROM cp
),
ck AS (SELECT cl_top FROM ct GROUP BY cl_top HAVING count(*) BETWEEN {MIN_SIZE} AND {MAX_SIZE}),
communities AS (
  SELECT node_id, node_name, cl_top,
         cl_top || ':' || CASE WHEN cl_top = 'shared' OR cl_top NOT IN (SELECT cl_top FROM ck) THEN CAST(node_id AS VARCHAR)
           ELSE CAST((clique - ring) // 5 + 1 AS VARCHAR) || ':' || CAST(node_id - clique + 1 AS VARCHAR) END AS cl
  FROM ct
)"""


def _clique_tree(spark, sf_dir):
    """Vertices and a two-level tree of the clique network: one cluster per
    ring, every fifth ring in one large cluster."""
    parts = T.clique_parts(spark, sf_dir)
    top = F.when(_ring_number() % SHARED_RING == 1, F.lit("shared")).otherwise(F.col("ring").cast("string"))
    vertices = parts.select("node_id", T.node_name("node_id").alias("node_name"))
    tree = parts.select(F.concat(top, F.lit(":"), F.col("node_id").cast("string")).alias("cl"),
                        (F.col("node_id") / 1e6).alias("flow"), T.node_name("node_id").alias("node_name"))
    return vertices, tree


@register("clique_communities", f"WITH {CLIQUE_TREE}\nSELECT * FROM communities WHERE (SELECT count(*) FROM ct WHERE cl_top = 'shared') > {MAX_SIZE}")
def q_clique_communities(spark, sf_dir):
    """The whole job on the clique network (tables to result)."""
    vertices, tree = _clique_tree(spark, sf_dir)
    out = P.hierarchical_communities(vertices, T.clique_edges(spark, sf_dir), tree, MIN_SIZE, MAX_SIZE)
    return out.select("node_id", "node_name", "cl", "cl_top")


@register("communities_from_files", f"WITH {CLIQUE_TREE}\nSELECT * FROM communities WHERE (SELECT count(*) FROM ct WHERE cl_top = 'shared') > {MAX_SIZE}")
def q_communities_from_files(spark, sf_dir):
    """The same job from a Pajek network with weights and a tree file to a TSV result."""
    vertices, tree = _clique_tree(spark, sf_dir)
    net, tree_path, out = (staging_path(spark, n) for n in ("clique_net", "clique_tree", "clique_result"))
    PJ.write_pajek(vertices, T.clique_edges(spark, sf_dir), net)
    TX.write_tree(tree, tree_path)
    P.communities_from_files(spark, net, tree_path, out, MIN_SIZE, MAX_SIZE)
    return TX.read_results(spark, out, "node_id BIGINT, node_name STRING, cl STRING, cl_top STRING, flow DOUBLE").drop("flow")


@register("cluster_cliques", f"""WITH {CLIQUES},
ranked AS (SELECT clique, row_number() OVER (ORDER BY clique) AS rank FROM (SELECT DISTINCT clique FROM cp) t)
SELECT node_id, node_name, CAST(rank AS VARCHAR) AS cl_top,
       CAST(rank AS VARCHAR) || ':' || CAST(node_id - cp.clique + 1 AS VARCHAR) AS cl
FROM cp JOIN ranked ON cp.clique = ranked.clique""")
def q_cluster_cliques(spark, sf_dir):
    """Network only, with part names that many nodes share: each node once,
    cliques as clusters, ranked by flow (all equal) and smallest node."""
    parts = T.clique_parts(spark, sf_dir)
    out = P.cluster_network(parts.select("node_id", "node_name"), T.clique_edges(spark, sf_dir), MIN_SIZE, MAX_SIZE)
    return out.select("node_id", "node_name", "cl_top", "cl")


@register("pajek_weights", f"""WITH {CLIQUES}
SELECT a.node_id AS source, b.node_id AS target, CAST(2.0 AS DOUBLE) AS weight FROM cp a JOIN cp b ON a.clique = b.clique AND a.node_id <> b.node_id
UNION ALL SELECT node_id, ring + (node_id + 1 - ring) % 15, CAST(1.0 AS DOUBLE) FROM cp WHERE node_id = clique + 4""")
def q_pajek_weights(spark, sf_dir):
    """Arcs with weights through a written Pajek network."""
    path = staging_path(spark, "clique_net")
    PJ.write_pajek(_clique_tree(spark, sf_dir)[0], T.clique_edges(spark, sf_dir), path)
    return PJ.read_pajek(spark, path).edges


# ---------------------------------------------------------------- stream

from ..streaming.edges import edge_clusters_stream  # noqa: E402


@register("edge_clusters_stream", ORACLE["edge_clusters"])
def q_edge_clusters_stream(spark, sf_dir):
    """Edge-cluster assignment run as a file stream over the edge table."""
    members = q_members(spark, sf_dir)
    edge_dir = staging_path(spark, "edge_stream_in")
    T.edges(spark, sf_dir).repartition(8).write.parquet(edge_dir)
    out_dir = staging_path(spark, "edge_stream_out")
    q = edge_clusters_stream(spark, edge_dir, members, out_dir)
    q.awaitTermination()
    return spark.read.schema("source BIGINT, target BIGINT, cl_out STRING, cl_in STRING").parquet(out_dir)
