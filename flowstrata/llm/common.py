"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Functions of this package travel to the workers by value, so executors need
# no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__package__])


def worker_cached(key: str, build: Callable):
    """``build()`` once per Python worker process (functions shipped by value
    lose their module globals between tasks; this holder outlives them)."""
    holder = sys.modules.setdefault("_flowstrata_worker", types.ModuleType("_flowstrata_worker"))
    if not hasattr(holder, key):
        setattr(holder, key, build())
    return getattr(holder, key)


def fresh(df: DataFrame, base: str) -> str:
    """A column name like ``base`` that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def id_remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % F.lit(m)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(rows: DataFrame, kind: str) -> DataFrame:
    """One row per (id, kind) of ``(doc_id, kind, v)``, the smallest ``v``: an
    id that fills the table brings no more rows than any other."""
    return rows.groupBy("doc_id", kind).agg(F.min("v").alias("v"))
