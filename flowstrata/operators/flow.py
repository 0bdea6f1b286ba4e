"""Stationary node and link flow of a directed network, ``undirdir`` model:
node visit rates from the undirected degree, then one directed step.

    p0(v)   = (w_out(v) + w_in(v)) / (2 W)
    f(s,t)  = p0(s) * w(s,t) / w_out(s),  normalised to sum 1
    p(t)    = sum_s f(s,t)

Every quantity is per group ``g`` (no group = the whole network), computed
by aggregations and equi-joins; parallel links are summed first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import split_join

GROUP = "_g"


def with_group(df: DataFrame, group: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add a constant group column when no group is given."""
    if group:
        return df, list(group)
    return df.withColumn(GROUP, F.lit(0)), [GROUP]


def join_group(rows: DataFrame, table: DataFrame, g: list[str], grouped: bool, spread: list[str],
               most: int | None = None) -> DataFrame:
    """Attach per-group scalars (with the rows of the group in ``n``).  With
    no group the table has exactly one row (a proven bound, so broadcast);
    otherwise groups that own many rows are split."""
    if grouped:
        return split_join(rows, table, g, "n", spread, most=most)
    return rows.join(F.broadcast(table.drop("n")), g)


def plogp(x: F.Column) -> F.Column:
    return F.when(x > 0, x * F.log2(x)).otherwise(F.lit(0.0))


def undirdir_flow(links: DataFrame, group: Sequence[str] = (),
                  nodes: DataFrame | None = None, weight: str | None = "weight",
                  most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Return ``(node_flow, link_flow)``:

    * node_flow ``(*group, node_id, flow)`` - every node at an end of a link,
      plus every row of ``nodes`` (``(*group, node_id)``), flow 0 if no in-flow;
    * link_flow ``(*group, source, target, flow)`` - one row per distinct link.

    ``most``: the measured number of rows, if known (see ``split_join``).
    """
    grouped = bool(group)
    links, g = with_group(links, group)
    w = F.col(weight) if weight and weight in links.columns else F.lit(1.0)
    agg = links.groupBy(*g, "source", "target").agg(F.sum(w).cast("double").alias("w"))
    w_out = agg.groupBy(*g, F.col("source").alias("node_id")).agg(F.sum("w").alias("w_out"))
    w_in = agg.groupBy(*g, F.col("target").alias("node_id")).agg(F.sum("w").alias("w_in"))
    deg = (w_out.join(w_in, [*g, "node_id"], "full")
           .fillna(0.0, ["w_out", "w_in"]))
    total = agg.groupBy(*g).agg(F.sum("w").alias("w_tot"), F.count(F.lit(1)).alias("n"))
    deg = join_group(deg, total, g, grouped, ["node_id"], most).withColumn(
        "p0", (F.col("w_out") + F.col("w_in")) / (2 * F.col("w_tot")))
    src = deg.where(F.col("w_out") > 0).select(
        *g, F.col("node_id").alias("source"), "p0", "w_out")
    f = agg.join(src, [*g, "source"]).withColumn(
        "f", F.col("p0") * F.col("w") / F.col("w_out"))
    norm = f.groupBy(*g).agg(F.sum("f").alias("f_tot"), F.count(F.lit(1)).alias("n"))
    link_flow = (join_group(f, norm, g, grouped, ["source", "target"], most)
                 .select(*g, "source", "target", (F.col("f") / F.col("f_tot")).alias("flow")))
    inflow = link_flow.groupBy(*g, F.col("target").alias("node_id")).agg(
        F.sum("flow").alias("flow"))
    all_nodes = deg.select(*g, "node_id")
    if nodes is not None:
        extra, _ = with_group(nodes.select(*group, "node_id"), group)
        all_nodes = all_nodes.union(extra.select(*g, "node_id")).distinct()
    node_flow = (all_nodes.join(inflow, [*g, "node_id"], "left")
                 .fillna(0.0, ["flow"]))
    if not grouped:
        node_flow = node_flow.drop(GROUP)
        link_flow = link_flow.drop(GROUP)
    return node_flow, link_flow
