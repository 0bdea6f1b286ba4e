"""Several restarts of the two-level partition, the best one per group.

Local moving ends in an optimum that depends on the order in which the nodes
are judged.  Every restart sees the same network under other node numbers (a
bijection of 64-bit numbers drawn from the seed; restart 0 keeps the numbers),
and the number of the restart is one more part of the group key, so all
restarts of all groups are partitioned in one job.  The codelength of each is
an aggregate; per group the shortest wins, the first restart among equals (to
twelve digits), so more restarts are never worse than fewer.

Cases: a group without links has one module a node in every restart, and
restart 0 wins; an empty network gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import split_join
from ..session import release, stage
from .moves import MoveConfig, two_level_partition
from .objective import codelength

_SHIFTS = (13, 7, 17)  # a full-period xorshift of 64 bits, hence a bijection


def renumbered(node: Column, restart: Column) -> Column:
    """Another 64-bit number of a node, one to one within a restart; restart 0
    keeps the numbers."""
    x = node.bitwiseXOR(F.xxhash64(restart))
    for i, by in enumerate(_SHIFTS):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, by) if i == 1 else F.shiftleft(x, by))
    return F.when(restart == 0, node).otherwise(x)


def best_of_restarts(node_flow: DataFrame, link_flow: DataFrame, group: str | None = None, restarts: int = 5,
                     config: MoveConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """``([group,] node_id, module)`` of the best of ``restarts`` restarts per
    group (a module is named by its smallest node), and the table of all of
    them, ``([group,] restart, codelength, num_modules, best)``."""
    if restarts < 1:
        raise ValueError("at least one restart")
    gcol = F.col(group) if group else F.lit(0)
    restart = F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("restart")
    key = F.concat_ws("#", F.col("restart").cast("string"), F.col("_group").cast("string")).alias("_run")
    nodes = stage(node_flow.select(gcol.alias("_group"), F.col("node_id").alias("_own"), "flow", restart)
                  .select("_group", "restart", key, "_own", renumbered(F.col("_own"), F.col("restart")).alias("node_id"),
                          "flow"), "restart_nodes")
    ends = [renumbered(F.col(c), F.col("restart")).alias(c) for c in ("source", "target")]
    links = stage(link_flow.select(gcol.alias("_group"), "source", "target", "flow", restart)
                  .select(key, *ends, "flow"), "restart_links")
    runs = nodes.groupBy("_run").agg(F.first("_group").alias("_group"), F.first("restart").alias("restart"),
                                     F.count(F.lit(1)).alias("n"))
    found = stage(two_level_partition(nodes.select("_run", "node_id", "flow"), links, "_run", config)[0], "restart_modules")
    length = codelength(nodes.select("_run", "node_id", "flow"), links, found, ["_run"])
    judged = stage(runs.join(length.select("_run", "codelength", "num_modules"), "_run"), "restart_lengths")
    first = judged.groupBy("_group").agg(
        F.min_by("restart", F.struct(F.round("codelength", 12), "restart")).alias("restart"))
    best = stage(judged.join(first, ["_group", "restart"]).select("_run", "n"), "restart_best")
    # the winner's nodes under their own numbers; its module is named by the smallest of them
    won = stage(split_join(found, best.withColumn("_won", F.lit(1)), ["_run"], "n", ["node_id"])
                .join(nodes.select("_run", "_group", "node_id", "_own"), ["_run", "node_id"])
                .select("_group", "_own", F.col("module").alias("_m")), "restart_won")
    names = won.groupBy("_group", "_m").agg(F.min("_own").alias("module"), F.count(F.lit(1)).alias("n"))
    own = stage(split_join(won, names, ["_group", "_m"], "n", ["_own"]), "restart_result")
    release(nodes, links, found, won)
    name = [F.col("_group").alias(group)] if group else []
    table = judged.join(best.select("_run", F.lit(True).alias("best")), "_run", "left")
    return (own.select(*name, F.col("_own").alias("node_id"), "module"),
            table.select(*name, "restart", "codelength", "num_modules", F.coalesce("best", F.lit(False)).alias("best")))
