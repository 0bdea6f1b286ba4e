"""Delimited-text sources and sinks of the pipeline's file formats.

All readers use a fixed schema (no inference pass over the data) and read
every file of a directory in parallel; all writers keep Spark's save modes
(``errorifexists`` refuses an existing output, ``ignore`` keeps it,
``overwrite`` replaces it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.joins import split_join
from ..functions.ranking import consecutive_index
from ..session import delete_path, staging_path
from .manifest import exists

# Fixed values of the tree file format.
TREE_SCHEMA = "cl STRING, flow DOUBLE, node_name STRING"
RESULT_COLUMNS = ["node_id", "node_name", "cl", "cl_top", "flow"]

_CONCAT_SCHEMES = ("hdfs",)  # file systems that join files without copying
_COPY_BYTES = 1 << 20
# a line is kept as it is: quotes doubled, blanks at both ends kept
_RAW_LINES = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# ------------------------------------------------------------------ readers

def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """Tree file: ``cl flow "name"`` blank-separated, ``#`` comments, extra
    columns ignored."""
    return spark.read.csv(path, sep=" ", quote='"', comment="#", schema=TREE_SCHEMA,
                          mode="PERMISSIVE")


def read_edgelist(spark: SparkSession, path: str,
                  names: tuple[str, str] = ("source", "target"),
                  sep: str = "\t") -> DataFrame:
    """Headerless two-column edge list of integer ids."""
    schema = f"{names[0]} BIGINT, {names[1]} BIGINT"
    return spark.read.csv(path, sep=sep, schema=schema, header=False)


def read_results(spark: SparkSession, path: str, schema: str | None = None,
                 sep: str = "\t") -> DataFrame:
    """Headered TSV files of one directory, concatenated.  Without a schema
    all columns are strings (as the files carry no types)."""
    reader = spark.read.option("header", True).option("sep", sep)
    if schema:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_single_csv(spark: SparkSession, path: str, schema: str,
                    sep: str = ",") -> DataFrame:
    """Read a directory that must hold exactly one CSV file."""
    df = spark.read.csv(path, sep=sep, schema=schema, header=False)
    n_files = len(df.inputFiles())  # file listing only, no scan
    if n_files != 1:
        raise ValueError(f"expected exactly one CSV file in {path}, found {n_files}")
    return df


# ------------------------------------------------------------------ writers

def write_tree(tree: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tree rows as ``cl flow "name"`` (names quoted where they need it)."""
    (tree.select("cl", "flow", "node_name").write.mode(mode)
     .option("sep", " ").option("quote", '"').option("quoteAll", False)
     .option("escapeQuotes", True).csv(path))


def _sorted_ranges(df: DataFrame, sort_by: str | Sequence[str]) -> DataFrame:
    keys = [sort_by] if isinstance(sort_by, str) else list(sort_by)
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_result(df: DataFrame, path: str, mode: str = "errorifexists",
                 single_file: bool = False, sort_by: str | Sequence[str] = "node_id",
                 fmt: str = "csv") -> None:
    """Sorted result table: range-partitioned by ``sort_by`` and sorted inside
    each part, so the parts in name order are globally sorted (no single
    task).  ``single_file=True`` leaves one TSV file with one header in the
    folder, made of the same parts by :func:`join_parts`."""
    w = _sorted_ranges(df, sort_by).write.mode(mode)
    if fmt == "parquet":
        if single_file:
            raise ValueError("only text parts can be joined")
        w.parquet(path)
    elif single_file:
        there = delete_or_keep(df.sparkSession, path, mode)
        if not there:
            parts = staging_path(df.sparkSession, "result_parts")
            _sorted_ranges(df, sort_by).write.option("sep", "\t").option("header", False).csv(parts)
            join_parts(df.sparkSession, parts, f"{path.rstrip('/')}/part-00000.csv", "\t".join(df.columns) + "\n")
            delete_path(df.sparkSession, parts)
    else:
        w.option("sep", "\t").option("header", True).csv(path)


def delete_or_keep(spark: SparkSession, path: str, mode: str) -> bool:
    """What a save mode says about an output that may exist: True if it
    exists and stays (``ignore``); ``overwrite`` deletes it."""
    if not exists(spark, path):
        return False
    if mode == "overwrite":
        delete_path(spark, path)
        return False
    if mode == "ignore":
        return True
    raise FileExistsError(f"{path} exists already")


def join_parts(spark: SparkSession, parts: str, target: str, header: str) -> None:
    """``target``: the header and the part files of ``parts`` in name order,
    byte after byte.  A file system that can concatenate files does it in its
    name table (the parts are used up); elsewhere the bytes are streamed
    through a small buffer.  No rows are parsed and no task holds them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, out = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(target)
    fs = out.getFileSystem(conf)
    found = [f.getPath() for f in folder.getFileSystem(conf).listStatus(folder)
             if f.getPath().getName().startswith("part-") and f.getLen() > 0]
    found.sort(key=lambda f: f.getName())
    stream = fs.create(out, False)
    try:
        stream.write(bytearray(header.encode()))
    finally:
        stream.close()
    if not found:
        return
    if fs.getUri().getScheme() in _CONCAT_SCHEMES:
        files = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(found))
        for i, f in enumerate(found):
            files[i] = f
        fs.concat(out, files)
        return
    # no append on some file systems: header and parts go into one new stream
    stream = fs.create(out, True)
    try:
        stream.write(bytearray(header.encode()))
        for f in found:
            part = f.getFileSystem(conf).open(f)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, stream, _COPY_BYTES, False)
            finally:
                part.close()
    finally:
        stream.close()


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, value)``: the lines of one text file with their position from
    1, header included, from its splits in order (no single task)."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    return consecutive_index(lines, ["_block", "_row"], "line").select("line", "value")


def write_bad_lines(bad: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Lines that a reader could not use, as quoted ``section, line`` TSV."""
    (bad.select("section", "line").write.mode(mode).option("sep", "\t").option("quoteAll", True)
     .options(**_RAW_LINES).csv(path))


def read_bad_lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("sep", "\t").options(**_RAW_LINES)
            .csv(path, schema="section STRING, line STRING"))


def write_edgelist(edges: DataFrame, path: str, mode: str = "errorifexists",
                   sep: str = "\t") -> None:
    """Headerless edge list (first two columns)."""
    cols = edges.columns[:2]
    edges.select(*cols).write.mode(mode).option("sep", sep).option("header", False).csv(path)


def write_counts(sizes: DataFrame, path: str, cluster_col: str = "cl",
                 mode: str = "errorifexists") -> None:
    """Cluster counts with header ``<cluster_col>\tnum_papers``."""
    (sizes.select(F.col("cl_top").alias(cluster_col), F.col("n").alias("num_papers"))
     .write.mode(mode).option("sep", "\t").option("header", True).csv(path))


def write_partitioned_text(df: DataFrame, path: str, partition_cols: list[str],
                           value_col: str, mode: str = "errorifexists") -> None:
    """One text file set per partition value (e.g. node names per cluster,
    cluster names per bin); directories ``col=value`` allow pruning.  Values
    with many rows are split over tasks and small ones share a task."""
    (df.select(*partition_cols, F.col(value_col).cast("string").alias("value"))
     .hint("rebalance", *partition_cols)
     .write.mode(mode).partitionBy(*partition_cols).text(path))


def largest_node_lists(members: DataFrame, sizes: DataFrame, max_files: int) -> DataFrame:
    """Rows ``(cluster_rank, cl_top, node_name)`` of the ``max_files`` largest
    clusters (the bound on the number of list files is the feature)."""
    ranked = (sizes.orderBy(F.col("n").desc(), F.col("cl_top")).limit(max_files)
              .select("cl_top", "n", F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("cl_top")))
                      .cast("long").alias("cluster_rank")))
    return split_join(members, ranked, ["cl_top"], "n", ["node_id"]).select("cluster_rank", "cl_top", "node_name")


def write_consolidated(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Headerless TSV ``name, path, top`` of consolidated trees."""
    rows.select("name", "path", "top").write.mode(mode).option("sep", "\t").csv(path)


def read_consolidated(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="name STRING, path STRING, top BIGINT")


def read_partitioned_text(spark: SparkSession, path: str, value_col: str, partitions: str | None = None) -> DataFrame:
    """Read back :func:`write_partitioned_text` with the value column renamed.
    ``partitions`` declares the partition columns (DDL); without it they are as
    typed by discovery.  An output without rows has no folder that names them:
    there only the declaration gives them."""
    found = spark.read.text(path)
    if partitions is not None:
        declared = StructType.fromDDL(partitions)
        if set(declared.names) <= set(found.columns):
            found = spark.read.schema(f"value STRING, {partitions}").text(path)
        else:
            found = found.select("value", *[F.lit(None).cast(f.dataType).alias(f.name) for f in declared])
    return found.withColumnRenamed("value", value_col)


# ------------------------------------------------------------------- JDBC

def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Load a database table, split into ``num_partitions`` range reads on
    ``partition_column`` when given (otherwise one reader)."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def list_jdbc_tables(spark: SparkSession, url: str, properties: dict | None = None) -> DataFrame:
    """Table names visible through a JDBC connection (standard catalog view)."""
    return read_jdbc(spark, url, "(SELECT table_name FROM information_schema.tables) t",
                     properties)
