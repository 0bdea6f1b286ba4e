"""Order-dependent numbering without a single-task window.

A window with an ORDER BY but no PARTITION BY runs in one task; a window
partitioned by a skewed key runs the hot key in one task.  The helpers here
range-partition on the full (unique) sort key instead, number the sorted rows
of each range in place, and add the totals of the preceding ranges, which form
a table with one row per partition (bounded by the partition count, so it is
safe to broadcast).  The ranges are written once under the staging folder:
these functions run one job when called.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .joins import split_join

_AT = "_fs_at"
_RUN = "_fs_run"
_PARTITION_BITS = 33  # monotonically_increasing_id: partition above, row below


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranges(df: DataFrame, order: list[Column], num_partitions: int | None) -> DataFrame:
    """Rows sorted in ranges of the total order, each with its place
    (partition and row number in one long)."""
    return (df.repartitionByRange(_partitions(df, num_partitions), *order)
            .sortWithinPartitions(*order).withColumn(_AT, F.monotonically_increasing_id()))


def _running(batches, value: str):
    """Append the running sum of ``value`` inside the partition."""
    done = 0
    for b in batches:
        if not b.num_rows:
            continue
        sums = b.column(b.schema.get_field_index(value)).to_numpy(zero_copy_only=False).cumsum() + done
        done = sums[-1]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums)], names=[*b.schema.names, _RUN])


def prefix_sum(df: DataFrame, order: Sequence[str | Column], value: str | Column,
               name: str, num_partitions: int | None = None,
               inclusive: bool = True) -> DataFrame:
    """Running sum of ``value`` (not null) in the total order ``order``.

    ``order`` must be a total order (unique keys), otherwise ties are
    broken arbitrarily.  One shuffle: the rows are range partitioned, each
    range is summed in its sorted order (one vectorised pass) and written
    once, so that the totals and the rows see the same ranges; the totals of
    the preceding ranges (one row a partition) are broadcast."""
    val = F.col(value) if isinstance(value, str) else value
    kind = df.select(val.alias("v")).schema["v"].dataType
    whole = isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType))
    ranged = _ranges(df.withColumn("_fs_val", val.cast("long" if whole else "double")),
                     _cols(order), num_partitions)
    summed = ranged.mapInArrow(lambda it: _running(it, "_fs_val"),
                               T.StructType([*ranged.schema, T.StructField(_RUN, ranged.schema["_fs_val"].dataType)]))
    rows = stage(summed, "ranges")
    pid = F.shiftright(F.col(_AT), _PARTITION_BITS)
    totals = rows.groupBy(pid.alias("_fs_pid")).agg(F.max_by(_RUN, _AT).alias("_fs_tot"))
    offsets = totals.select("_fs_pid", F.coalesce(F.sum("_fs_tot").over(
        Window.orderBy("_fs_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_fs_off"))
    running = F.col("_fs_off") + F.col(_RUN)
    if not inclusive:
        running = running - F.col("_fs_val")
    return (rows.withColumn("_fs_pid", pid).join(F.broadcast(offsets), "_fs_pid")
            .withColumn(name, running).drop("_fs_pid", _AT, _RUN, "_fs_off", "_fs_val"))


def consecutive_index(df: DataFrame, order: Sequence[str | Column], name: str,
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position (bigint) of every row in the total order ``order``:
    one range shuffle, the rows written once, DataFrame functions only."""
    rows = stage(_ranges(df, _cols(order), num_partitions), "ranges")
    rows = rows.withColumn("_fs_pid", F.shiftright(F.col(_AT), _PARTITION_BITS))
    counts = rows.groupBy("_fs_pid").agg(F.count(F.lit(1)).alias("_fs_n"))
    offsets = counts.select("_fs_pid", F.coalesce(F.sum("_fs_n").over(
        Window.orderBy("_fs_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_fs_off"))
    row = F.col(_AT).bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    return (rows.join(F.broadcast(offsets), "_fs_pid")
            .withColumn(name, F.col("_fs_off") + row + 1).drop("_fs_pid", "_fs_off", _AT))


def dense_rank_of(df: DataFrame, keys: Sequence[str], name: str,
                  num_partitions: int | None = None) -> DataFrame:
    """Table ``(keys..., name)``: dense rank of each distinct key tuple in
    ascending order.  Join it back on ``keys`` where needed."""
    distinct = df.select(*keys).distinct()
    return consecutive_index(distinct, list(keys), name, num_partitions)


def ordinal_within(df: DataFrame, parent: Sequence[str],
                   order: Sequence[str | Column], name: str,
                   num_partitions: int | None = None, most: int | None = None) -> DataFrame:
    """``row_number() over (partition by parent order by order)`` computed
    without putting a whole parent group into one task.

    ``parent + order`` must be unique.  The global position comes from
    :func:`consecutive_index`; the start of each parent is a partial
    aggregate, joined back with hot parents split."""
    indexed = consecutive_index(df, [*parent, *order], "_fs_gidx", num_partitions)
    starts = indexed.groupBy(*parent).agg(F.min("_fs_gidx").alias("_fs_start"), F.count(F.lit(1)).alias("_fs_n"))
    return (split_join(indexed, starts, parent, "_fs_n", ["_fs_gidx"], most=most)
            .withColumn(name, F.col("_fs_gidx") - F.col("_fs_start") + 1)
            .drop("_fs_gidx", "_fs_start"))
