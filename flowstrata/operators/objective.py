"""Two-level map-equation codelength of a partition (bits per step).

With node flow ``p_v``, module flow ``p_m = sum p_v`` and module exit flow
``q_m`` (flow on links leaving m; self-links never count):

    L = plogp(sum q_m) - 2 sum plogp(q_m) - sum plogp(p_v) + sum plogp(q_m + p_m)

A hierarchy of modules of any depth has one codebook per module: with the exit
flow q of the module (0 for the root) and the usage u of its children (exit
flow of a submodule, flow of a node),

    L = sum over modules of plogp(q + sum u) - plogp(q) - sum plogp(u),

which is the two-level codelength when every path has one module.

Computed per group with aggregations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flow import join_group, plogp, with_group


def codelength(node_flow: DataFrame, link_flow: DataFrame, assignment: DataFrame,
               group: Sequence[str] = ()) -> DataFrame:
    """``(*group, codelength, num_modules, exit_flow)``.

    ``assignment`` is ``(*group, node_id, module)``; nodes missing from it
    are ignored, as are links with an unassigned end.
    """
    grouped = bool(group)
    node_flow, g = with_group(node_flow, group)
    link_flow, _ = with_group(link_flow, group)
    assignment, _ = with_group(assignment, group)
    a = assignment.select(*g, "node_id", "module")
    nf = node_flow.join(a, [*g, "node_id"])
    pm = nf.groupBy(*g, "module").agg(F.sum("flow").alias("p_m"))
    hp = nf.groupBy(*g).agg(F.sum(plogp(F.col("flow"))).alias("h_nodes"))
    src = a.withColumnRenamed("node_id", "source").withColumnRenamed("module", "m_s")
    tgt = a.withColumnRenamed("node_id", "target").withColumnRenamed("module", "m_t")
    q = (link_flow.join(src, [*g, "source"]).join(tgt, [*g, "target"])
         .where(F.col("m_s") != F.col("m_t"))
         .groupBy(*g, F.col("m_s").alias("module")).agg(F.sum("flow").alias("q_m")))
    mod = pm.join(q, [*g, "module"], "left").fillna(0.0, ["q_m"])
    per = mod.groupBy(*g).agg(
        F.sum("q_m").alias("exit_flow"),
        F.sum(plogp(F.col("q_m"))).alias("s_q"),
        F.sum(plogp(F.col("q_m") + F.col("p_m"))).alias("s_qp"),
        F.count(F.lit(1)).alias("num_modules"))
    # one row a group on both sides
    out = per.join(hp, g).select(
        *g,
        (plogp(F.col("exit_flow")) - 2 * F.col("s_q") - F.col("h_nodes")
         + F.col("s_qp")).alias("codelength"),
        "num_modules", "exit_flow")
    return out if grouped else out.drop(*g)


def one_module_codelength(node_flow: DataFrame, group: Sequence[str] = (),
                          most: int | None = None) -> DataFrame:
    """Codelength with every node of a group in one module: the entropy of
    the node flow (normalised per group)."""
    grouped = bool(group)
    node_flow, g = with_group(node_flow, group)
    tot = node_flow.groupBy(*g).agg(F.sum("flow").alias("_t"), F.count(F.lit(1)).alias("n"))
    p = join_group(node_flow, tot, g, grouped, ["node_id"], most).withColumn(
        "_p", F.when(F.col("_t") > 0, F.col("flow") / F.col("_t")).otherwise(F.lit(0.0)))
    out = p.groupBy(*g).agg((-F.sum(plogp(F.col("_p")))).alias("codelength"))
    return out if grouped else out.drop(*g)


def hierarchical_codelength(node_flow: DataFrame, link_flow: DataFrame, paths: DataFrame,
                            group: Sequence[str] = ()) -> DataFrame:
    """``(*group, codelength, num_modules, depth)`` of a hierarchy.

    ``paths`` is ``(*group, node_id, path)``: the parts of ``path`` (separated
    by ``:``) are the modules from the top down and last the node's own place.
    Nodes without a path are ignored, as are links with such an end.  Rows
    grow with the depth of the paths only."""
    grouped = bool(group)
    node_flow, g = with_group(node_flow, group)
    link_flow, _ = with_group(link_flow, group)
    paths, _ = with_group(paths, group)
    parts = F.split("path", ":")
    inner = F.transform(F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)).otherwise(F.array().cast("array<int>")),
                        lambda k: F.concat_ws(":", F.slice(parts, F.lit(1), k)))
    placed = paths.select(*g, "node_id", inner.alias("inside"))
    top = F.lit("")
    nodes = node_flow.join(placed, [*g, "node_id"]).select(
        *g, "inside", F.coalesce(F.get("inside", F.size("inside") - 1), top).alias("parent"), "flow")
    a = placed.select(*g, F.col("node_id").alias("source"), F.col("inside").alias("from"))
    b = placed.select(*g, F.col("node_id").alias("target"), F.col("inside").alias("into"))
    left = (link_flow.join(a, [*g, "source"]).join(b, [*g, "target"])
            .select(*g, "flow", F.explode(F.array_except("from", "into")).alias("module"))
            .groupBy(*g, "module").agg(F.sum("flow").alias("q")))
    modules = (nodes.select(*g, F.explode("inside").alias("module")).distinct()
               .join(left, [*g, "module"], "left").fillna(0.0, ["q"]))
    above = F.regexp_replace("module", ":?[^:]*$", "")
    usage = (modules.select(*g, above.alias("module"), F.col("q").alias("u"))
             .unionByName(nodes.select(*g, F.col("parent").alias("module"), F.col("flow").alias("u")))
             .groupBy(*g, "module").agg(F.sum("u").alias("u"), F.sum(plogp(F.col("u"))).alias("h")))
    q = F.coalesce("q", F.lit(0.0))
    per = usage.join(modules, [*g, "module"], "left")
    out = per.groupBy(*g).agg(
        F.sum(plogp(q + F.col("u")) - plogp(q) - F.col("h")).alias("codelength"),
        (F.count(F.lit(1)) - 1).alias("num_modules"),
        F.max(F.when(F.col("module") == "", 0).otherwise(F.size(F.split("module", ":")))).alias("depth"))
    return out if grouped else out.drop(*g)
