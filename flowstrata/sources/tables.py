"""Network views derived from the driver's parquet tables.

``part`` gives the vertices and a two-level tree, consecutive ``lineitem``
rows of an order give the directed edges.  Every view is a lazy DataFrame
over the whole table; column selection and filters reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import dense_rank_of, ordinal_within


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def node_name(key: str) -> F.Column:
    # p_name is not unique, so names are built from the key.
    return F.concat(F.lit("part#"), F.col(key).cast("string"))


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(node_id bigint, node_name string)``."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("node_id"),
                       node_name("p_partkey").alias("node_name"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source bigint, target bigint)``: part of a line item -> part of the
    next line of the same order; duplicates removed."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber")
    a = li.alias("a")
    b = li.alias("b")
    return (a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey"))
                   & (F.col("a.l_linenumber") + 1 == F.col("b.l_linenumber")))
            .select(F.col("a.l_partkey").alias("source"),
                    F.col("b.l_partkey").alias("target"))
            .distinct())


#: Parts of a clique and cliques of a ring in :func:`clique_edges`.
CLIQUE, RING = 5, 3


def clique_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of full cliques and rings: ``(node_id, node_name, clique, ring)``,
    numbered by the smallest part key of the ring.  The name is the part name,
    which many parts share."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node_id"), F.col("p_name").alias("node_name"))
    size = CLIQUE * RING
    ring = F.floor(F.col("node_id") / size) * size
    full = part.groupBy(ring.alias("ring")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == size)
    return (part.withColumn("ring", ring).join(full.select("ring"), "ring", "left_semi")
            .withColumn("clique", F.floor(F.col("node_id") / CLIQUE) * CLIQUE)
            .select("node_id", "node_name", "clique", "ring"))


def clique_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A network of known optimum over the parts: every five parts are a
    clique (all links, weight 2), and in every ring of three cliques the last
    part of a clique links to the first of the next (weight 1)."""
    parts = clique_parts(spark, sf_dir)
    a, b = parts.select("clique", F.col("node_id").alias("source")), parts.select("clique", F.col("node_id").alias("target"))
    inside = a.join(b, "clique").where("source <> target").select("source", "target", F.lit(2.0).alias("weight"))
    last = parts.where(F.col("node_id") == F.col("clique") + CLIQUE - 1)
    step = (F.col("node_id") + 1 - F.col("ring")) % (CLIQUE * RING) + F.col("ring")
    between = last.select(F.col("node_id").alias("source"), step.alias("target"), F.lit(1.0).alias("weight"))
    return inside.unionByName(between)


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-level tree ``(cl string, flow double, node_name string)``.

    Top cluster: brand rank for small parts, 100 + (brand, type) rank for
    large ones; leaf ordinal by price desc within the top cluster; flow is
    the price share.
    """
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    brand = dense_rank_of(part, ["p_brand"], "_r_brand")
    brand_type = dense_rank_of(part, ["p_brand", "p_type"], "_r_bt")
    total = part.agg(F.sum("p_retailprice")).scalar()
    t = (part.join(brand, "p_brand").join(brand_type, ["p_brand", "p_type"])
         .withColumn("cl_top", F.when(F.col("p_size") <= 25, F.col("_r_brand"))
                     .otherwise(F.col("_r_bt") + 100).cast("string")))
    t = ordinal_within(t, ["cl_top"],
                       [F.col("p_retailprice").desc(), F.col("p_partkey")], "_leaf")
    return t.select(
        F.concat(F.col("cl_top"), F.lit(":"), F.col("_leaf").cast("string")).alias("cl"),
        (F.col("p_retailprice") / total).alias("flow"),
        node_name("p_partkey").alias("node_name"))
