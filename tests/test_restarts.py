"""Best of several restarts of the partitioner."""

import pytest
from pyspark.sql import functions as F

from flowstrata.operators.flow import undirdir_flow
from flowstrata.operators.moves import two_level_partition
from flowstrata.operators.objective import codelength
from flowstrata.operators.restarts import best_of_restarts, renumbered

from conftest import CYCLES16


def test_renumbered_is_one_to_one(spark):
    ids = spark.range(-3000, 3000).union(spark.createDataFrame([(2**63 - 1,), (-2**63,), (2**40,)], "id long"))
    for k in range(4):
        got = ids.select("id", renumbered(F.col("id"), F.lit(k)).alias("x"))
        assert got.select("x").distinct().count() == got.count()
        assert got.where("x = id").count() == (got.count() if k == 0 else 0)


def _noise(spark):
    """Two groups without clear modules, where the order of moves matters."""
    return (spark.range(600).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"), (F.xxhash64("id") % 40 + 40).alias("source"),
        (F.xxhash64(F.col("id") + 7) % 40 + 40).alias("target")).where("source <> target"))


def test_best_is_never_worse(spark):
    nf, lf = undirdir_flow(_noise(spark), ["g"])
    nf, lf = nf.cache(), lf.cache()
    one = {r.g: r.codelength for r in codelength(nf, lf, two_level_partition(nf, lf, "g")[0], ["g"]).collect()}
    best, runs = best_of_restarts(nf, lf, "g", 5)
    best, runs = best.cache(), runs.collect()
    assert best.count() == nf.count() == best.select("g", "node_id").distinct().count()
    length = {r.g: r.codelength for r in codelength(nf, lf, best, ["g"]).collect()}
    for g in "ab":
        mine = {r.restart: r.codelength for r in runs if r.g == g}
        assert sorted(mine) == list(range(5)) and mine[0] == pytest.approx(one[g], abs=1e-9)
        assert [r.restart for r in runs if r.g == g and r.best] == [min(mine, key=lambda k: (round(mine[k], 12), k))]
        assert length[g] == pytest.approx(min(mine.values()), abs=1e-9) and length[g] <= one[g] + 1e-9
    assert any(len({round(r.codelength, 9) for r in runs if r.g == g}) > 1 for g in "ab")  # restarts differ
    assert best.groupBy("g", "module").agg(F.min("node_id").alias("least")).where("least <> module").count() == 0


def test_whole_network_and_empty(spark, net16):
    nf, lf = undirdir_flow(net16)
    best, runs = best_of_restarts(nf, lf, restarts=3)
    assert {(r.node_id, r.module) for r in best.collect()} == {(i, (i - 1) // 4 * 4 + 1) for i in range(1, 17)}
    assert all(round(r.codelength, 9) == 2.868544526 for r in runs.collect())
    assert best_of_restarts(nf.where("false"), lf.where("false"), restarts=2)[0].count() == 0
    with pytest.raises(ValueError):
        best_of_restarts(nf, lf, restarts=0)
