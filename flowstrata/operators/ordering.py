"""Order-dependent operators over cluster tables, without single-task folds.

* :func:`greedy_bins` - clusters in size order are added to a bin until the
  bin reaches ``bin_size`` (the crossing cluster stays in it); the rest
  forms the last bin.  A running sum *with reset* has no window form, so:
  prefix sums ``S``; the next bin start after a start ``i`` is one past the
  first ``j`` with ``S_j >= S_{i-1} + bin_size`` (found for all ``i`` at
  once by ranking query and data keys in one merged order); the starts
  reachable from cluster 1 are marked by pointer doubling (log2(#bins)
  self-joins); a cluster's bin is the number of starts before it.
* :func:`consolidate_trees` - unique top ids over many tree files: a new id
  at every file start and at every change of the old top id in file order
  (gaps and islands over one global index).
* :func:`cluster_rank`, :func:`leaf_ordinals`, :func:`top_clusters`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import path_replace_head
from ..functions.ranking import consecutive_index, ordinal_within, prefix_sum
from ..session import stage

#: Rows of one index range in :func:`consolidate_trees`.
INDEX_RANGE = 100_000


def cluster_rank(sizes: DataFrame) -> DataFrame:
    """``(cl_top, n, rank)``: 1 = largest cluster, ties by name."""
    return consecutive_index(sizes, [F.col("n").desc(), F.col("cl_top")], "rank")


def top_clusters(sizes: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest clusters (a top-k report: the limit is the feature)."""
    return sizes.orderBy(F.col("n").desc(), F.col("cl_top")).limit(k)


def leaf_ordinals(members: DataFrame) -> DataFrame:
    """Rank of each node inside its top cluster by (flow desc, node id)."""
    return ordinal_within(members.select("cl_top", "node_id", "flow"), ["cl_top"],
                          [F.col("flow").desc(), F.col("node_id")], "leaf")


def _merged_rank(queries: DataFrame, data: DataFrame) -> DataFrame:
    """For query rows ``(qi, key)`` and data rows ``(key)`` return
    ``(qi, before)`` = number of data rows ordered before each query row in
    the order (key, queries first at equal keys).  ``qi`` is the 1-based
    rank of the query among queries in the same order."""
    both = (queries.select(F.col("key"), F.lit(0).alias("kind"), F.col("qi"))
            .unionByName(data.select(F.col("key"), F.lit(1).alias("kind"),
                                     F.lit(None).cast("long").alias("qi"))))
    idx = consecutive_index(both, ["key", "kind", "qi"], "_k")
    return idx.where(F.col("kind") == 0).select("qi", (F.col("_k") - F.col("qi")).alias("before"))


def greedy_bins(sizes: DataFrame, bin_size: int, min_size: int = 1) -> DataFrame:
    """``(cl_top, n, bin)`` with 0-based bins, clusters ordered by size desc
    then name; clusters below ``min_size`` are left out."""
    if bin_size < 1:
        raise ValueError("bin_size must be >= 1")
    c = sizes.where(F.col("n") >= min_size).select("cl_top", F.col("n").cast("long"))
    order = [F.col("n").desc(), F.col("cl_top")]
    c = consecutive_index(c, order, "i")
    c = stage(prefix_sum(c, ["i"], "n", "S"), "bins_prefix")
    n_total = c.count()
    if n_total == 0:
        return c.select("cl_top", "n", F.lit(0).cast("long").alias("bin"))
    # next start after i: one past the first j with S_j >= S_{i-1} + bin_size
    q = c.select(F.col("i").alias("qi"), (F.col("S") - F.col("n") + bin_size).alias("key"))
    d = c.select(F.col("S").alias("key"))
    nxt = _merged_rank(q, d).select(F.col("qi").alias("i"),
                                    F.least(F.col("before") + 2, F.lit(n_total + 1)).alias("nxt"))
    jump = stage(nxt, "bins_jump")
    reach = stage(jump.where(F.col("i") == 1).select("i"), "bins_reach")
    size = 1
    while True:
        hop = (reach.join(jump, "i").where(F.col("nxt") <= n_total)
               .select(F.col("nxt").alias("i")))
        grown = stage(reach.union(hop).distinct(), "bins_reach")
        new_size = grown.count()
        reach = grown
        if new_size == size:
            break
        size = new_size
        j2 = jump.select(F.col("i").alias("nxt"), F.col("nxt").alias("nxt2"))
        jump = stage(jump.join(j2, "nxt", "left")
                     .select("i", F.coalesce(F.col("nxt2"), F.col("nxt")).alias("nxt")),
                     "bins_jump")
    # bin of cluster i = number of starts <= i, minus one
    q2 = c.select(F.col("i").alias("qi"), F.col("i").alias("key"))
    starts = reach.select(F.col("i").alias("key"))
    # starts sort before a cluster with the same key, so "before" counts them
    merged = (q2.select("key", F.lit(1).alias("kind"), "qi")
              .unionByName(starts.select("key", F.lit(0).alias("kind"),
                                         F.lit(None).cast("long").alias("qi"))))
    idx = consecutive_index(merged, ["key", "kind", "qi"], "_k")
    bins = idx.where(F.col("kind") == 1).select(F.col("qi").alias("i"),
                                               (F.col("_k") - F.col("qi") - 1).alias("bin"))
    return c.join(bins, "i").select("cl_top", "n", "bin")


def consolidate_trees(rows: DataFrame) -> DataFrame:
    """Unique top ids across tree files.

    ``rows``: ``(file, pos, path, name)`` where ``(file, pos)`` orders the
    rows of each file.  Returns ``(name, path, top)``: the path with its
    head replaced by the new top id (1-based).

    Rows are indexed once; an island starts where the row before it (by
    index) has another file or another old top id.  Only the island starts
    (index and number) are numbered, and every row takes the number of the
    last start at or before it by a running maximum over its index range."""
    old = rows.withColumn("old_top", F.substring_index("path", ":", 1))
    r = consecutive_index(old, ["file", "pos"], "idx").withColumn("range", F.floor(F.col("idx") / INDEX_RANGE))
    inside = Window.partitionBy("range").orderBy("idx")
    # the last row of every range is what the first row of the next one follows
    ends = (r.groupBy("range").agg(F.max(F.struct("idx", "file", "old_top")).alias("end"))
            .select((F.col("range") + 1).alias("range"), "end"))
    before = F.coalesce(F.lag(F.struct("idx", "file", "old_top")).over(inside), F.col("end"))
    flagged = (r.join(ends, "range", "left").withColumn("before", before)
               .withColumn("flag", (F.col("before").isNull()
                                    | ~F.col("before.file").eqNullSafe(F.col("file"))
                                    | ~F.col("before.old_top").eqNullSafe(F.col("old_top"))).cast("long")))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = flagged.withColumn("inside", F.sum("flag").over(upto))
    totals = flagged.groupBy("range").agg(F.sum("flag").alias("starts"))
    offsets = (prefix_sum(totals, ["range"], "starts", "upto").select("range", (F.col("upto") - F.col("starts")).alias("off")))
    top = F.col("off") + F.col("inside")
    return (counted.join(offsets, "range").withColumn("top", top)
            .select("name", path_replace_head("path", F.col("top")).alias("path"), "top"))


def single_file_bins(files: DataFrame) -> DataFrame:
    """``files``: ``(bin, file)``; bins holding exactly one tree file."""
    return (files.groupBy("bin").agg(F.countDistinct("file").alias("n_files"))
            .where(F.col("n_files") == 1))
