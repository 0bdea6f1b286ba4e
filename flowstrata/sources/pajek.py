"""Pajek network text: ``*Vertices`` / ``*Arcs`` sections.

Reading is distributed and shuffles no data line: one pass gathers the header
lines per file split into a table with one row a split (bounded by the number
of splits and header lines, so it is broadcast), a running "last header before
this split" gives each split the section it opens in, and a data line takes
the last header above it inside its split, else the opening section.  Section
rules:

* default: a ``*`` line starting with ``*v`` (any case) opens vertices, any
  other ``*`` line opens edges; lines before the first header are ignored;
* ``strict_headers=True``: a header containing ``vert`` opens vertices, one
  containing ``arc`` or ``edge`` opens edges, any other header leaves the
  section unchanged.

Tokens are split on runs of blanks after trimming; a vertex name may be
quoted.  Rows whose id does not parse go to the ``bad`` table instead of
silently becoming nulls.  Header counts are never trusted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranking import dense_rank_of


@dataclass
class PajekTables:
    vertices: DataFrame  # (node_id bigint, node_name string)
    edges: DataFrame     # (source bigint, target bigint, weight double)
    bad: DataFrame       # (section string, line string)


def _sections(lines: DataFrame, strict: bool) -> DataFrame:
    v = F.lower(F.col("value"))
    is_star = F.col("value").startswith("*")
    if strict:
        mode = (F.when(v.contains("vert"), F.lit("v"))
                .when(v.contains("arc") | v.contains("edge"), F.lit("e")))
    else:
        mode = F.when(v.startswith("*v"), F.lit("v")).otherwise(F.lit("e"))
    header = F.when(is_star & mode.isNotNull(), F.struct("_row", mode.alias("mode")))
    # one row per file split: its header lines, and the section it opens in
    heads = lines.groupBy("_file", "_block").agg(F.sort_array(F.collect_list(header)).alias("_heads"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.last(F.get(F.col("_heads.mode"), F.size("_heads") - 1), ignorenulls=True).over(earlier)
    splits = heads.withColumn("_opened", opened)
    above = F.filter("_heads", lambda h: h["_row"] < F.col("_row"))
    section = F.coalesce(F.get(above, F.size(above) - 1)["mode"], F.col("_opened"))
    return (lines.where(~is_star).join(F.broadcast(splits), ["_file", "_block"])
            .withColumn("section", section).select("section", "value"))


def read_pajek(spark: SparkSession, path: str, strict_headers: bool = False) -> PajekTables:
    """Read one Pajek file or a directory of parts (read in path order as
    one stream)."""
    lines = (spark.read.text(path)
             .select("value",
                     F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_row")))
    lines = lines.where(F.length(F.trim(F.col("value"))) > 0)
    tagged = _sections(lines, strict_headers)
    vert = tagged.where(F.col("section") == "v").select(
        F.col("value").alias("line"),
        F.expr("try_cast(regexp_extract(trim(value), '^(\\\\S+)', 1) AS BIGINT)").alias("node_id"),
        F.coalesce(
            F.nullif(F.regexp_extract(F.col("value"), r'^\s*\S+\s+"([^"]*)"', 1), F.lit("")),
            F.nullif(F.regexp_extract(F.col("value"), r"^\s*\S+\s+([^\s\"]+)", 1), F.lit(""))
        ).alias("node_name"))
    edge = tagged.where(F.col("section") == "e").select(
        F.col("value").alias("line"),
        F.expr("try_cast(split(trim(value), '\\\\s+')[0] AS BIGINT)").alias("source"),
        F.expr("try_cast(get(split(trim(value), '\\\\s+'), 1) AS BIGINT)").alias("target"),
        F.coalesce(F.expr("try_cast(get(split(trim(value), '\\\\s+'), 2) AS DOUBLE)"),
                   F.lit(1.0)).alias("weight"))
    bad = (vert.where(F.col("node_id").isNull()).select(F.lit("v").alias("section"), "line")
           .union(edge.where(F.col("source").isNull() | F.col("target").isNull())
                  .select(F.lit("e").alias("section"), "line")))
    return PajekTables(
        vertices=vert.where(F.col("node_id").isNotNull()).select("node_id", "node_name"),
        edges=edge.where(F.col("source").isNotNull() & F.col("target").isNotNull())
        .select("source", "target", "weight"),
        bad=bad)


def edges_to_pajek(edges: DataFrame, source: str = "source",
                   target: str = "target") -> tuple[DataFrame, DataFrame]:
    """Vertex table with consecutive ids (1-based, ascending original id)
    and the edges recoded to those ids: ``(node_id, node_name)``,
    ``(source, target)``.  ``node_name`` is the original id as text."""
    ends = (edges.select(F.col(source).alias("orig"))
            .union(edges.select(F.col(target).alias("orig"))))
    ids = dense_rank_of(ends, ["orig"], "node_id")
    vertices = ids.select("node_id", F.col("orig").cast("string").alias("node_name"), "orig")
    m = vertices.select("orig", "node_id")
    arcs = (edges.join(m.withColumnRenamed("orig", source).withColumnRenamed("node_id", "_s"), source)
            .join(m.withColumnRenamed("orig", target).withColumnRenamed("node_id", "_t"), target)
            .select(F.col("_s").alias("source"), F.col("_t").alias("target")))
    return vertices.drop("orig"), arcs


def arc_text(arcs: DataFrame) -> Column:
    """Text of an arc: ``source target``, and the weight where there is one."""
    tokens = [F.col(c).cast("string") for c in ("source", "target", "weight") if c in arcs.columns]
    return F.concat_ws(" ", *tokens)


def pajek_lines(vertices: DataFrame, arcs: DataFrame, arcs_label: str = "Arcs") -> DataFrame:
    """Lines of a Pajek file with a sort key ``(sec, k1, k2)``: header, then
    vertices by id, then arcs by (source, target)."""
    nv = vertices.count()
    na = arcs.count()
    spark = vertices.sparkSession
    head_v = spark.createDataFrame([(0, -1, -1, f"*Vertices {nv}")], "sec int, k1 long, k2 long, value string")
    head_a = spark.createDataFrame([(1, -1, -1, f"*{arcs_label} {na}")], "sec int, k1 long, k2 long, value string")
    vl = vertices.select(F.lit(0).alias("sec"), F.col("node_id").alias("k1"), F.lit(0).cast("long").alias("k2"),
                         F.concat(F.col("node_id").cast("string"), F.lit(' "'), F.col("node_name"),
                                  F.lit('"')).alias("value"))
    al = arcs.select(F.lit(1).alias("sec"), F.col("source").alias("k1"), F.col("target").alias("k2"),
                     arc_text(arcs).alias("value"))
    return head_v.unionByName(vl).unionByName(head_a).unionByName(al)


def write_pajek(vertices: DataFrame, arcs: DataFrame, path: str,
                num_parts: int | None = None, mode: str = "errorifexists") -> None:
    """Write a Pajek network as ordered text parts: reading the directory's
    parts in name order gives one valid Pajek stream (range partitioning
    keeps part order = line order)."""
    lines = pajek_lines(vertices, arcs)
    n = num_parts or int(vertices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartitionByRange(n, "sec", "k1", "k2")
     .sortWithinPartitions("sec", "k1", "k2")
     .select("value").write.mode(mode).text(path))
