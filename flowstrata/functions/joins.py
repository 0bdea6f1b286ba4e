"""Equi-joins whose hot keys are split.

A join on a group, cluster or module alone sends all rows of one key to one
task.  :func:`split_join` takes the keys that own more than ``limit`` rows out
of the shuffle: their table rows (at most all rows / ``limit`` of them, a
proven bound) are broadcast, and the rows they match are spread by a salt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def split_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], count: str,
               spread: Sequence[str | Column], how: str = "inner", limit: int = HOT_ROWS,
               most: int | None = None) -> DataFrame:
    """``rows`` joined (inner or left) with ``table``, one row per key, on
    ``keys``.  ``count`` names the column of ``table`` that holds how many
    rows a key has; ``spread`` are the columns of ``rows`` the salt is taken
    from.  The result has the columns of ``rows``, then those of ``table``
    without keys and ``count``.  ``most`` is the measured number of ``rows``
    where the caller knows it: up to ``limit`` no key can be hot and the join
    needs no salt (same result)."""
    keys = list(keys)
    values = [c for c in table.columns if c not in keys and c != count]
    if most is not None and most <= limit:
        return rows.join(table.drop(count), keys, how).select(*rows.columns, *values)
    hot = table.where(F.col(count) > limit).select(*keys, F.struct(*values, F.lit(1).alias("_1")).alias("_hot"))
    cold = table.select(*keys, F.lit(0).alias("_salt"), F.struct(*values, F.lit(1).alias("_1")).alias("_cold"))
    # rows of hot keys are matched already, rows with a null key never match: both are spread
    cold_row = F.col("_hot").isNull()
    for k in keys:
        cold_row = cold_row & F.col(k).isNotNull()
    salted = (rows.join(F.broadcast(hot), keys, "left")
              .withColumn("_salt", F.when(cold_row, 0).otherwise(
                  1 + F.pmod(F.xxhash64(*spread), F.lit(4096)).cast("int"))))
    out = (salted.join(cold, [*keys, "_salt"], "left")
           .withColumn("_got", F.coalesce("_hot", "_cold")))
    if how == "inner":
        out = out.where(F.col("_got").isNotNull())
    return out.select(*[F.col(c) for c in rows.columns], *[F.col("_got")[c].alias(c) for c in values])
