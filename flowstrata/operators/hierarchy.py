"""Hierarchical refinement of many clusters at once.

Every kept top cluster is an isolated sub-network (its within-cluster
links).  All groups are partitioned together by :func:`two_level_partition`;
a group is split only where the two-level codelength beats the one-module
codelength of that group.

Upwards, the modules of a group are grouped into super-modules as long as that
shortens the hierarchical codelength: with exit flow q of the modules and exit
flow Q of the super-modules, the index over the modules

    plogp(sum q) - sum plogp(q)

is replaced by an index over the super-modules and one inside each,

    plogp(sum Q) - 2 sum plogp(Q) - sum plogp(q) + sum plogp(Q + sum q),

which is the two-level codelength of a network whose nodes are the modules
with flow q, so the same partitioner finds them.  Downwards, each module with
more than ``min_split`` nodes becomes a group of its own, with its own flow on
its own internal links, until no group has a useful split.

Modules are numbered in their parent by flow (desc), then smallest node id;
leaves by node flow in the last sub-network the node was partitioned in
(desc), then node id.  Flows are compared to twelve digits, so the order of
summation cannot change a rank.  Clusters with invalid input (null ids,
non-finite or non-positive weights) are not refined, and a cluster in which the
partitioner fails at any depth loses its paths: their nodes get
``<cl_top>:FAILED`` and status ``failed``, all other clusters are as without them.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import split_join
from ..functions.ranking import ordinal_within
from ..session import SMALL_BROADCASTS, conf_override, release, round_options, stage
from .flow import plogp, undirdir_flow
from .moves import MoveConfig, two_level_partition
from .objective import codelength, one_module_codelength


@dataclass(frozen=True)
class RefineConfig:
    moves: MoveConfig = field(default_factory=MoveConfig)
    # modules with at most this many nodes are not split further
    min_split: int = 3
    min_gain: float = 1e-10
    # look for super-modules
    super_modules: bool = True


def _invalid_groups(nodes: DataFrame, links: DataFrame) -> DataFrame:
    bad_nodes = nodes.where(F.col("node_id").isNull()).select("g")
    w = F.col("weight")
    bad_links = links.where(
        F.col("source").isNull() | F.col("target").isNull() | w.isNull() | F.isnan(w)
        | (w <= 0) | (w == float("inf"))).select("g")
    return bad_nodes.union(bad_links).distinct()


def _keep(rows: DataFrame, groups: DataFrame, spread: list[str], most: int) -> DataFrame:
    """Rows of the given groups ``(g, n)``, giant groups spread."""
    table = groups.select("g", "n", F.lit(1).alias("_in"))
    return split_join(rows, table, ["g"], "n", spread, most=most).drop("_in")


def _drop(rows: DataFrame, groups: DataFrame, spread: list[str], most: int) -> DataFrame:
    """Rows of all other groups."""
    table = groups.select("g", "n", F.lit(1).alias("_in"))
    return split_join(rows, table, ["g"], "n", spread, "left", most=most).where(F.col("_in").isNull()).drop("_in")


def super_levels(node_flow: DataFrame, link_flow: DataFrame, assignment: DataFrame,
                 cfg: RefineConfig, most: int, failures: list | None = None) -> list[DataFrame]:
    """Levels above a two-level partition ``(g, node_id, module)``: tables
    ``(g, node_id, module)`` whose ``node_id`` are the modules one level down.
    A group has as many levels as shorten its hierarchical codelength."""
    levels: list[DataFrame] = []
    asg, links = assignment, link_flow
    while True:
        at = asg.select("g", "node_id", "module")
        between = (links.join(at.select("g", F.col("node_id").alias("source"), F.col("module").alias("ms")), ["g", "source"])
                   .join(at.select("g", F.col("node_id").alias("target"), F.col("module").alias("mt")), ["g", "target"])
                   .where("ms <> mt").groupBy("g", F.col("ms").alias("source"), F.col("mt").alias("target"))
                   .agg(F.sum("flow").alias("flow")))
        mlinks = stage(between, "super_links")
        exits = mlinks.groupBy("g", F.col("source").alias("node_id")).agg(F.sum("flow").alias("flow"))
        modules = at.select("g", F.col("module").alias("node_id")).distinct()
        # groups of three modules and more: two modules have no other grouping than one
        sizes = modules.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
        mnodes = stage(_keep(modules.join(exits, ["g", "node_id"], "left").fillna(0.0, ["flow"]), sizes, ["node_id"], most),
                       "super_nodes")
        if mnodes.isEmpty():
            release(mlinks, mnodes)
            return levels
        sup, _ = two_level_partition(mnodes, _keep(mlinks, sizes, ["source"], most), "g", cfg.moves,
                                     failures=failures)
        two = codelength(mnodes, mlinks, sup, ["g"])
        index = mnodes.groupBy("g").agg((plogp(F.sum("flow")) - F.sum(plogp(F.col("flow")))).alias("L1"),
                                        F.count(F.lit(1)).alias("n"))
        accepted = stage(two.join(index, "g").where((F.col("num_modules") > 1) & (F.col("num_modules") < F.col("n"))
                                                    & (F.col("codelength") < F.col("L1") - cfg.min_gain))
                         .select("g", "n"), "super_accepted")
        level = stage(_keep(sup, accepted, ["node_id"], most), "super_level")
        if level.isEmpty():
            release(mlinks, mnodes, accepted, level)
            return levels
        levels.append(level)
        asg, links = level, _keep(mlinks, accepted, ["source"], most)


def _paths(node_flow: DataFrame, assignment: DataFrame, levels: list[DataFrame], most: int) -> DataFrame:
    """``(g, module, path, size)`` for the modules of the nodes, named from the
    top level down."""
    inside = stage(node_flow.join(assignment, ["g", "node_id"])
                   .groupBy("g", "module").agg(F.sum("flow").alias("flow"), F.count(F.lit(1)).alias("size"),
                                               F.min("node_id").alias("first_id")), "modules")
    stats = [inside]
    for level in levels:  # flow, size and first node of every super-module
        below = stats[-1].select("g", F.col("module").alias("node_id"), "flow", "size", "first_id")
        stats.append(stage(below.join(level, ["g", "node_id"]).groupBy("g", "module").agg(
            F.sum("flow").alias("flow"), F.sum("size").alias("size"), F.min("first_id").alias("first_id")), "modules"))
    parents: DataFrame | None = None  # (g, module, path) of the level above
    for k in range(len(levels), -1, -1):
        items = stats[k]
        if parents is None:
            placed = items.withColumn("parent", F.col("g"))
        else:
            up = levels[k].select("g", F.col("node_id").alias("module"), F.col("module").alias("top"))
            above = parents.select("g", F.col("module").alias("top"), F.col("path").alias("above"))
            placed = (items.join(up.join(above, ["g", "top"]).select("g", "module", "above"), ["g", "module"], "left")
                      .withColumn("parent", F.coalesce("above", "g")).drop("above"))
        ranked = ordinal_within(placed, ["parent"], [F.round("flow", 12).desc(), F.col("first_id")], "ord", most=most)
        parents = ranked.select("g", "module", "size",
                                F.concat("parent", F.lit(":"), F.col("ord").cast("string")).alias("path"))
    return parents


def refine_groups(nodes: DataFrame, links: DataFrame, config: RefineConfig | None = None,
                  failures: list | None = None) -> DataFrame:
    """Hierarchical paths inside each group.

    ``nodes``: ``(g string, node_id bigint)``; ``links``:
    ``(g, source, target[, weight])`` with both ends in ``g``.
    Returns ``(g, node_id, path string, status string)`` where ``path``
    starts with ``g``.  ``failures`` collects tables ``(g, error)`` of the
    sub-groups in which the partitioner failed (``g`` is their path).
    """
    cfg = config or RefineConfig()
    if "weight" not in links.columns:
        links = links.withColumn("weight", F.lit(1.0))
    with conf_override(nodes.sparkSession, SMALL_BROADCASTS):
        nodes = stage(nodes.select(F.col("g").cast("string"), "node_id").distinct(), "refine_nodes")
        links = stage(links.select(F.col("g").cast("string"), "source", "target", F.col("weight").cast("double")), "refine_links")
    most = nodes.count() + links.count()  # no later table has more rows
    with conf_override(nodes.sparkSession, round_options(nodes.sparkSession, most)):
        return _refine(nodes, links, cfg, most, [] if failures is None else failures)


def _refine(nodes: DataFrame, links: DataFrame, cfg: RefineConfig, most: int, failures: list) -> DataFrame:
    sizes = nodes.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    bad = stage(_invalid_groups(nodes, links).join(sizes, "g"), "invalid_groups")
    active_nodes = stage(_drop(nodes, bad, ["node_id"], most), "refine_nodes")
    active_links = stage(_drop(links, bad, ["source"], most), "refine_links")
    finals: list[DataFrame] = []  # (g, node_id, g_final, flow)
    while not active_nodes.isEmpty():
        nf, lf = undirdir_flow(active_links, ["g"], nodes=active_nodes, most=most)
        nf, lf = stage(nf, "refine_flow"), stage(lf, "refine_links_flow")
        asg, _ = two_level_partition(nf, lf, group="g", config=cfg.moves, failures=failures)
        two = codelength(nf, lf, asg, ["g"]).select("g", F.col("codelength").alias("L2"), "num_modules")
        one = one_module_codelength(nf, ["g"], most).select("g", F.col("codelength").alias("L1"))
        n = nf.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        accepted = stage(two.join(one, "g").join(n, "g").where(
            (F.col("num_modules") > 1) & (F.col("L2") < F.col("L1") - cfg.min_gain)).select("g", "n"), "accepted")
        # groups without a useful split: their nodes are leaves of the group
        finals.append(stage(_drop(nf, accepted, ["node_id"], most)
                            .select("g", "node_id", F.col("g").alias("g_final"), "flow"), "leaves"))
        split_nf = stage(_keep(nf, accepted, ["node_id"], most), "refine_flow")
        if split_nf.isEmpty():
            release(nf, lf, accepted, split_nf)
            break
        split_asg = stage(_keep(asg, accepted, ["node_id"], most), "assignment")
        split_lf = _keep(lf, accepted, ["source"], most)
        levels = super_levels(split_nf, split_lf, split_asg, cfg, most, failures) if cfg.super_modules else []
        named = stage(_paths(split_nf, split_asg, levels, most), "module_paths")
        moved = stage(split_join(split_asg.join(split_nf, ["g", "node_id"]), named.withColumnRenamed("size", "n")
                                 .withColumn("size", F.col("n")), ["g", "module"], "n", ["node_id"], most=most)
                      .select("g", "node_id", "flow", "size", F.col("path").alias("g_new")), "moved")
        stop = F.col("size") <= cfg.min_split
        finals.append(stage(moved.where(stop).select("g", "node_id", F.col("g_new").alias("g_final"), "flow"), "leaves"))
        m = moved.where(~stop).select("g", "node_id", "g_new")
        next_links = stage(
            active_links
            .join(m.withColumnRenamed("node_id", "source").withColumnRenamed("g_new", "gs"), ["g", "source"])
            .join(m.withColumnRenamed("node_id", "target").withColumnRenamed("g_new", "gt"), ["g", "target"])
            .where(F.col("gs") == F.col("gt"))
            .select(F.col("gs").alias("g"), "source", "target", "weight"), "refine_links")
        next_nodes = stage(m.select(F.col("g_new").alias("g"), "node_id"), "refine_nodes")
        release(active_nodes, active_links, nf, lf, accepted, split_nf, split_asg, moved, named, *levels)
        active_nodes, active_links = next_nodes, next_links
    if failures:  # the whole cluster fails with any group inside it
        tops = reduce(DataFrame.unionByName, failures).select(F.substring_index("g", ":", 1).alias("g")).distinct()
        bad = stage(bad.unionByName(tops.join(sizes, "g")), "failed_groups")
    done = [_keep(nodes, bad, ["node_id"], most)
            .select("g", "node_id", F.concat(F.col("g"), F.lit(":FAILED")).alias("path"), F.lit("failed").alias("status"))]
    if finals:
        leaves = reduce(DataFrame.unionByName, finals).select("node_id", "g_final", "flow")
        if failures:
            leaves = _drop(leaves.withColumn("g", F.substring_index("g_final", ":", 1)), bad, ["node_id"], most).drop("g")
        leaves = ordinal_within(leaves, ["g_final"], [F.round("flow", 12).desc(), F.col("node_id")], "leaf", most=most)
        done.append(leaves.select(
            F.col("g_final").alias("g"), "node_id",
            F.concat(F.col("g_final"), F.lit(":"), F.col("leaf").cast("string")).alias("path"),
            F.lit("ok").alias("status")))
    # the top cluster is the path head (a top cluster never contains ':')
    return stage(reduce(DataFrame.unionByName, done)
                 .withColumn("g", F.substring_index("g", ":", 1)), "refined")


def refine_clusters(kept_members: DataFrame, within_edges: DataFrame,
                    config: RefineConfig | None = None, failures: list | None = None) -> DataFrame:
    """Refine every kept top cluster: ``(node_id, cl_top, cl, status)``;
    ``failures`` as in :func:`refine_groups`."""
    nodes = kept_members.select(F.col("cl_top").alias("g"), "node_id")
    cols = [F.col("cl_top").alias("g"), "source", "target"]
    if "weight" in within_edges.columns:
        cols.append("weight")
    links = within_edges.select(*cols)
    out = refine_groups(nodes, links, config, failures)
    return out.select("node_id", F.col("g").alias("cl_top"), F.col("path").alias("cl"), "status")
