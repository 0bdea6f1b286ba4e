"""Connected components of a link table by alternating star steps.

Every round joins the links with the smallest neighbour of each node, so a
hub is a partial aggregate plus a join side that skew splitting can divide;
no group is ever gathered in one task.  Rounds are written under the staging
folder (lineage is cut, lost executors recompute one round only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release, stage


def _fingerprint(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"),
                  F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return r["n"], r["x"]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = (down.join(least, "u").where("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(u, v)`` long links to ``(node, root)``: one row per linked node other
    than the root; ``root`` is the smallest node of its component.

    Self-links, repeated links and both directions of a link are the same as
    one link.  An empty link table gives an empty result."""
    now = stage(links.where("u <> v").select("u", "v").distinct(), "links")
    seen = _fingerprint(now)
    while seen[0]:
        large = stage(_large_star(now), "large_star")
        small = stage(_small_star(large), "small_star")
        print_ = _fingerprint(small)
        release(now, large)
        now, last, seen = small, seen, print_
        if seen == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
