"""Distributed numbering agrees with plain window functions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowstrata.functions.ranking import consecutive_index, dense_rank_of, ordinal_within, prefix_sum


def _df(spark):
    return spark.range(0, 997).select(
        F.col("id"), (F.col("id") % 7).alias("grp"), ((F.col("id") * 37) % 101).alias("v"))


def test_consecutive_index(spark):
    df = _df(spark)
    got = {r.id: r.idx for r in consecutive_index(df, ["v", "id"], "idx", 5).collect()}
    ref = {r.id: r.idx for r in df.select(
        "id", F.row_number().over(Window.orderBy("v", "id")).alias("idx")).collect()}
    assert got == ref


def test_ordinal_within(spark):
    df = _df(spark)
    got = {r.id: r.o for r in ordinal_within(df, ["grp"], [F.col("v").desc(), "id"], "o", 4).collect()}
    w = Window.partitionBy("grp").orderBy(F.col("v").desc(), "id")
    ref = {r.id: r.o for r in df.select("id", F.row_number().over(w).alias("o")).collect()}
    assert got == ref


def test_dense_rank(spark):
    df = _df(spark)
    got = {r.grp: r.r for r in dense_rank_of(df, ["grp"], "r", 3).collect()}
    assert got == {g: g + 1 for g in range(7)}


def test_prefix_sum_exclusive(spark):
    df = _df(spark)
    got = {r.id: r.s for r in prefix_sum(df, ["id"], "v", "s", 6, inclusive=False).collect()}
    total, ref = 0, {}
    for i in range(997):
        ref[i] = total
        total += (i * 37) % 101
    assert got == ref
