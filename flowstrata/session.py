"""Session helpers: a local session for tests and benches, and the shared
staging folder that iterative jobs use to cut lineage.

The folder comes from ``spark.checkpoint.dir`` (a shared file system path);
without the setting iterative jobs refuse to run.  ``local_session`` (tests,
benches) takes the folder as an argument.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "flowstrata", checkpoint: str | None = None) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, as the session names it in
    ``spark.checkpoint.dir`` (tests and benches set it themselves)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint folder for written tables."""
    path = os.path.join(checkpoint_dir(spark), "staged", f"{name}-{uuid.uuid4().hex[:12]}")
    if _AREAS:
        _AREAS[-1].append((spark, path))
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but leaves no trace of the producing
    plan (statistics, constraints) in the new one, which keeps planning time
    flat across the rounds of an iterative job.  The returned frame carries
    its path, so that :func:`release` can delete exactly this table."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    # The schema is known: passing it skips the footer-reading job.
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def counted_stage(df: DataFrame, name: str, counts: dict[str, int]) -> DataFrame:
    """:func:`stage` that notes the number of rows in ``counts[name]``, seen
    while they are written (no second pass)."""
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    out = stage(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    counts[name] = seen.get["n"]
    return out


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staged table through the file system of the staging folder."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def release(*frames) -> None:
    """Delete the tables of frames returned by :func:`stage` that nothing
    reads any more (a superseded round); other frames are left alone."""
    for df in frames:
        path = getattr(df, "_staged_path", None)
        if path is not None:
            df._staged_path = None
            delete_path(df.sparkSession, path)


_AREAS: list[list[tuple[SparkSession, str]]] = []


class staging_area:
    """Everything staged inside the ``with`` block is deleted at its end.

    For jobs that end in a sink: build and write the result inside the block,
    then no intermediate table stays behind."""

    def __enter__(self):
        _AREAS.append([])
        return self

    def __exit__(self, *exc):
        for spark, path in _AREAS.pop():
            delete_path(spark, path)
        return False


class conf_override:
    """Temporarily set SQL options on a session, restoring them on exit."""

    def __init__(self, spark: SparkSession, options: dict[str, str]):
        self.spark = spark
        self.options = options
        self.saved: dict[str, str | None] = {}

    def __enter__(self):
        for k, v in self.options.items():
            try:
                self.saved[k] = self.spark.conf.get(k)
            except Exception:  # noqa: BLE001
                self.saved[k] = None
            self.spark.conf.set(k, v)
        return self.spark

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


# Options for the many-join plans of iterative rounds: the runtime
# bloom-filter rule re-estimates statistics across the whole join tree and
# its planning time grows far beyond the work itself.
ROUND_OPTIONS = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "false"}

# A broadcast passes through the driver.  Staged parquet files can hold numbers
# in order many times smaller than the rows read from them, so the size of a
# file bounds no broadcast: only adaptive execution, which has measured the
# rows, sends tables, and only small ones.
SMALL_BROADCASTS = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m"}


#: Below this many rows the stages of a round are so short that re-planning
#: between them costs more than they do.
ADAPTIVE_ROWS = 2_000_000


def round_options(spark: SparkSession, rows: int, rows_per_task: int = 100_000) -> dict[str, str]:
    """Options for rounds over ``rows`` rows: as many shuffle partitions as
    the measured rows need (four at least, never more than configured), and
    adaptive execution only where stages are long enough to gain from it.
    They change how a round runs, never its result."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    options = ROUND_OPTIONS | SMALL_BROADCASTS | {
        "spark.sql.shuffle.partitions": str(min(configured, max(4, rows // rows_per_task)))}
    if rows < ADAPTIVE_ROWS:  # nothing is measured, but no table has more rows than that
        options["spark.sql.adaptive.enabled"] = "false"
        options["spark.sql.autoBroadcastJoinThreshold"] = "256k"
    return options
