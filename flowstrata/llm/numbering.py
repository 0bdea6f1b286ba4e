"""Random order and gapless ranks with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import fresh

FANOUT_BITS = 12


def numbered(df: DataFrame, seed: int) -> tuple[DataFrame, str, str]:
    """``df`` written to the staging folder with a unique row number and a
    random 64-bit key; returns the frame and the names of the two columns.
    Once written, every later pass sees the same numbers, also after an
    executor is lost."""
    rid, key = fresh(df, "_row"), fresh(df, "_key")
    rows = (df.withColumn(rid, F.monotonically_increasing_id())
            .withColumn(key, F.xxhash64(F.lit(seed), F.col(rid))))
    return stage(rows, "numbered"), rid, key


def rank_within(df: DataFrame, group: list[str], key: str, name: str) -> DataFrame:
    """0-based position ``name`` of each row of ``group`` in the order of the
    random ``key``.

    A group of any size is spread over 4096 cells by the leading bits of the
    key; the number of rows in the preceding cells comes from a partial
    aggregate (at most 4096 rows a group), so no group meets in one task.
    ``group`` columns must not be null."""
    cell, before = fresh(df, "_cell"), fresh(df, "_before")
    celled = df.withColumn(cell, F.shiftrightunsigned(F.col(key).bitwiseXOR(F.lit(-1 << 63)),
                                                      64 - FANOUT_BITS).cast("int"))
    counts = celled.groupBy(*group, cell).agg(F.count("*").alias("_n"))
    earlier = (Window.partitionBy(*group).orderBy(cell)
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*group, cell, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(before))
    inside = Window.partitionBy(*group, cell).orderBy(key)
    return (celled.join(offsets, [*group, cell])
            .withColumn(name, F.col(before) + F.row_number().over(inside) - 1)
            .drop(cell, before))


def size_of(text: Column) -> Column:
    """UTF-8 bytes of a text plus one; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
