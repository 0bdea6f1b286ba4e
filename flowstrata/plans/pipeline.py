"""End-to-end jobs composed from the operators.

* :func:`hierarchical_communities` - network + two-level tree + size bounds
  -> ``(node_id, node_name, cl, cl_top, flow)`` sorted by node id: kept
  clusters refined, all others passed through with their original path.
* :func:`cluster_network` - network only: two-level partition of the whole
  network first, then the above.
* :func:`communities_from_files`, :func:`cluster_network_file` - the same two
  jobs from files to a sorted TSV result; intermediate tables are removed.
* :func:`finalize_paths` / :func:`trim_result` - merge an older sub-cluster
  result into a tree, then drop and rename columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import split_join
from ..functions.paths import cl_top as top_of, combined_or_original
from ..functions.ranking import consecutive_index, ordinal_within
from ..operators import membership as M
from ..operators.flow import undirdir_flow
from ..operators.hierarchy import RefineConfig, refine_clusters
from ..operators.moves import MoveConfig, two_level_partition
from ..session import counted_stage, stage, staging_area
from ..sources.manifest import build_or_reuse, fingerprint
from ..sources.pajek import read_pajek
from ..sources.text import read_results, read_tree, write_bad_lines, write_result

RESULT_COLUMNS = ["node_id", "node_name", "cl", "cl_top", "flow"]


def chosen_links(edges: DataFrame, weighted: bool = True, self_links: bool = True) -> DataFrame:
    """The links a job works on: without weights all count 1; without
    self-links those from a node to itself are left out."""
    out = edges if weighted else edges.select("source", "target")
    return out if self_links else out.where(F.col("source") != F.col("target"))


def counted_network(vertices: DataFrame, edges: DataFrame, tree: DataFrame, min_size: int = 10,
                    max_size: int | None = None) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The tables that refinement works on, each written once and built from
    the written ones before it, and how many rows each has, counted in
    passing."""
    counts: dict[str, int] = {}
    out: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        out[name] = counted_stage(df, name, counts)
        return out[name]
    vertices, edges = keep("vertices", vertices), keep("edges", edges)
    members = keep("members", M.members(tree, vertices))
    kept = keep("kept_clusters", M.cluster_size_filter(M.cluster_sizes(members), min_size, max_size))
    km = keep("kept_members", M.kept_members(members, kept))
    keep("within_cluster_edges", M.within_cluster_edges(edges, km))
    keep("passthrough_nodes", M.passthrough_nodes(members, kept))
    return out, counts


def communities_of_members(members: DataFrame, edges: DataFrame, min_size: int = 10,
                           max_size: int | None = None, config: RefineConfig | None = None,
                           with_status: bool = False) -> DataFrame:
    """Refine the kept clusters of ``members`` ``(node_id, node_name, cl,
    flow, cl_top)`` and pass all other rows through, sorted by node id."""
    members = stage(members, "members")
    kept = stage(M.cluster_size_filter(M.cluster_sizes(members), min_size, max_size), "kept")
    km = M.kept_members(members, kept)
    refined = refine_clusters(km, M.within_cluster_edges(edges, km), config)
    attrs = km.select("node_id", "cl_top", "node_name", "flow")
    inside = refined.join(attrs, ["node_id", "cl_top"], "left").select(
        *RESULT_COLUMNS, "status")
    outside = M.passthrough_nodes(members, kept).select(
        *RESULT_COLUMNS, F.lit("passthrough").alias("status"))
    out = inside.unionByName(outside)
    if not with_status:
        out = out.drop("status")
    return out.orderBy("node_id")


def hierarchical_communities(vertices: DataFrame, edges: DataFrame, tree: DataFrame,
                             min_size: int = 10, max_size: int | None = None,
                             config: RefineConfig | None = None,
                             with_status: bool = False) -> DataFrame:
    return communities_of_members(M.members(tree, vertices), edges, min_size, max_size, config, with_status)


def partition_members(node_flow: DataFrame, assignment: DataFrame, vertices: DataFrame) -> DataFrame:
    """Member rows of a partition, each node once: module ordinal by module
    flow, leaf ordinal by node flow.  Names come by node id; a node without a
    vertex row (a link end) or without a name has a null name."""
    nf = node_flow.join(assignment, "node_id")
    mods = nf.groupBy("module").agg(F.sum("flow").alias("mflow"), F.count(F.lit(1)).alias("n"))
    mods = consecutive_index(mods, [F.round("mflow", 12).desc(), F.col("module")], "mord")
    leaves = ordinal_within(nf, ["module"], [F.round("flow", 12).desc(), F.col("node_id")], "leaf")
    placed = split_join(leaves, mods.select("module", "n", "mord"), ["module"], "n", ["node_id"])
    top = F.col("mord").cast("string")
    return (placed.join(M.names_by_id(vertices), "node_id", "left")
            .select("node_id", "node_name", F.concat(top, F.lit(":"), F.col("leaf").cast("string")).alias("cl"),
                    "flow", top.alias("cl_top")))


def two_level_members(vertices: DataFrame, edges: DataFrame, config: MoveConfig | None = None) -> DataFrame:
    """Two-level partition of the whole network as member rows."""
    nf, lf = undirdir_flow(edges, nodes=vertices.select("node_id"))
    nf, lf = stage(nf, "network_flow"), stage(lf, "network_links")
    asg, _ = two_level_partition(nf, lf, config=config)
    return partition_members(nf, asg, vertices)


def two_level_tree(vertices: DataFrame, edges: DataFrame,
                   config: MoveConfig | None = None) -> DataFrame:
    """Two-level partition of the whole network as a tree table."""
    return two_level_members(vertices, stage(edges, "edges"), config).select("cl", "flow", "node_name")


def cluster_network(vertices: DataFrame, edges: DataFrame, min_size: int = 10,
                    max_size: int | None = None,
                    config: RefineConfig | None = None) -> DataFrame:
    """Network only.  Members are kept by node id throughout, so nodes that
    share a name, have none or are no vertex appear once each."""
    cfg = config or RefineConfig()
    edges = stage(edges, "edges")  # read by every step
    members = two_level_members(vertices, edges, cfg.moves)
    return communities_of_members(members, edges, min_size, max_size, cfg)


USE_EXISTING = "use_existing"  # mode: a finished output of the same inputs is taken as it is


def _from_files(spark: SparkSession, inputs: list[str], out: str, mode: str, parameters: dict, job) -> bool:
    """Write the result of ``job()`` (result, bad lines) to ``out`` and the
    lines the reader could not use to ``<out>.bad``.  True if it was built."""
    def write(how: str) -> int:
        with staging_area():
            counts: dict[str, int] = {}
            result, bad = job()
            result = counted_stage(result, "result", counts)
            write_result(result, out, how)
            write_bad_lines(bad, bad_path(out), how)
        return counts["result"]
    if mode != USE_EXISTING:
        write(mode)
        return True
    return build_or_reuse(spark, out, fingerprint(spark, inputs, parameters), lambda: write("overwrite"),
                          lambda: read_results(spark, out).count())


def bad_path(out: str) -> str:
    """Where a job from files leaves the lines it could not read."""
    return out.rstrip("/") + ".bad"


def communities_from_files(spark: SparkSession, network: str, tree: str, out: str,
                           min_size: int = 10, max_size: int | None = None, weighted: bool = True,
                           self_links: bool = True, mode: str = "errorifexists",
                           config: RefineConfig | None = None) -> bool:
    """Pajek network and tree file -> sorted TSV result, and the network's bad
    lines next to it.  ``mode`` is a save mode or ``use_existing``: a finished
    output of the same files and parameters is reused, a half-written or stale
    one built again.  True if the result was built."""
    def job():
        net = read_pajek(spark, network)
        return hierarchical_communities(net.vertices, chosen_links(net.edges, weighted, self_links),
                                        read_tree(spark, tree), min_size, max_size, config), net.bad
    return _from_files(spark, [network, tree], out, mode,
                       {"job": "communities", "bounds": [min_size, max_size], "links": [weighted, self_links],
                        "config": config}, job)


def cluster_network_file(spark: SparkSession, network: str, out: str, min_size: int = 10,
                         max_size: int | None = None, weighted: bool = True, self_links: bool = True,
                         mode: str = "errorifexists", config: RefineConfig | None = None) -> bool:
    """Pajek network -> sorted TSV result; bad lines and ``mode`` as above."""
    def job():
        net = read_pajek(spark, network)
        return cluster_network(net.vertices, chosen_links(net.edges, weighted, self_links),
                               min_size, max_size, config), net.bad
    return _from_files(spark, [network], out, mode,
                       {"job": "network", "bounds": [min_size, max_size], "links": [weighted, self_links],
                        "config": config}, job)


def finalize_paths(tree: DataFrame, sub_results: DataFrame, vertices: DataFrame) -> DataFrame:
    """Merge a sub-cluster result (``node_id``, ``hierInfomap_cl``, ...) into
    the two-level tree: ``cl_combined`` = ``cl_top:sub`` where a sub path
    exists, else the original ``cl``.  Node ids come from the vertex names
    (left join: an unknown name gets a null id)."""
    ids = vertices.select("node_name", "node_id")
    t = (tree.join(ids, "node_name", "left")
         .withColumn("cl_top", top_of("cl")))
    sub = sub_results.select("node_id", "hierInfomap_cl")
    return (t.join(sub, "node_id", "left")
            .withColumn("cl_combined", combined_or_original("cl", "cl_top", "hierInfomap_cl"))
            .select("node_id", "cl", "flow", "node_name", "cl_top", "hierInfomap_cl",
                    "cl_combined"))


TRIM_DROP = ("cl", "hierInfomap_cl")
TRIM_RENAME = {"node_id": "id", "node_name": "UID", "cl_combined": "cl"}


def trim_result(df: DataFrame) -> DataFrame:
    """Drop the intermediate path columns and rename the rest; missing
    columns are ignored."""
    out = df.drop(*[c for c in TRIM_DROP if c in df.columns])
    return out.withColumnsRenamed({k: v for k, v in TRIM_RENAME.items() if k in out.columns})
