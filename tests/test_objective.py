"""Golden flow and codelength values of the 16-node sample network."""

import math

import pytest
from pyspark.sql import functions as F

from flowstrata.operators.flow import undirdir_flow
from flowstrata.operators.objective import codelength, hierarchical_codelength, one_module_codelength

GOLD = {"one": 3.926120747, "four": 2.868544526, "single": 5.963003286}


def test_node_flow(net16):
    nf, lf = undirdir_flow(net16)
    flow = {r.node_id: r.flow for r in nf.collect()}
    assert [round(flow[i], 9) for i in (1, 2, 3, 4)] == [0.0875, 0.075, 0.0375, 0.05]
    assert abs(sum(flow.values()) - 1) < 1e-12
    assert lf.count() == 20


MODULES = {"one": "0", "four": "floor((node_id - 1) / 4)", "single": "node_id"}


@pytest.mark.parametrize("name", sorted(MODULES))
def test_codelength_golden(net16, name):
    module = F.expr(MODULES[name])
    nf, lf = undirdir_flow(net16)
    asg = nf.select("node_id", module.cast("long").alias("module"))
    got = codelength(nf, lf, asg).first().codelength
    assert round(got, 9) == GOLD[name]


def test_one_module(net16):
    nf, _ = undirdir_flow(net16)
    assert round(one_module_codelength(nf).first().codelength, 9) == GOLD["one"]


def test_grouped_flow_is_per_group(spark, net16):
    two = net16.withColumn("g", F.lit("a")).unionByName(
        net16.withColumn("g", F.lit("b")).withColumn("source", F.col("source") + 100)
        .withColumn("target", F.col("target") + 100))
    nf, _ = undirdir_flow(two, ["g"])
    sums = {r.g: r.s for r in nf.groupBy("g").agg(F.sum("flow").alias("s")).collect()}
    assert all(abs(v - 1) < 1e-12 for v in sums.values())


def test_hierarchy_of_one_level_is_the_partition(net16):
    nf, lf = undirdir_flow(net16)
    paths = nf.select("node_id", F.expr("concat_ws(':', floor((node_id - 1) / 4), node_id)").alias("path"))
    got = hierarchical_codelength(nf, lf, paths).first()
    assert (round(got.codelength, 9), got.num_modules, got.depth) == (GOLD["four"], 4, 1)
    flat = hierarchical_codelength(nf, lf, nf.select("node_id", F.col("node_id").cast("string").alias("path"))).first()
    assert (round(flat.codelength, 9), flat.num_modules, flat.depth) == (GOLD["one"], 0, 0)


def test_hierarchy_by_definition(net16):
    """Uneven depths: two modules of modules, one plain module, two nodes at
    the top, judged module by module."""
    inside = {**{v: ("a", "a:x") for v in (1, 2, 3, 4)}, **{v: ("a", "a:y") for v in (5, 6, 7)}, 8: ("a",),
              **{v: ("b",) for v in (9, 10, 11, 12, 13, 14)}, 15: (), 16: ()}
    nf, lf = undirdir_flow(net16)
    paths = net16.sparkSession.createDataFrame([(v, ":".join([*(m[-1:] or ()), str(v)])) for v, m in inside.items()], "node_id long, path string")
    got = hierarchical_codelength(nf, lf, paths).first()
    flow = {r.node_id: r.flow for r in nf.collect()}
    q = {"": 0.0, "a": 0.0, "a:x": 0.0, "a:y": 0.0, "b": 0.0}
    for r in lf.collect():
        for m in set(inside[r.source]) - set(inside[r.target]):
            q[m] += r.flow
    below = {m: [] for m in q}
    for v, m in inside.items():
        below[m[-1] if m else ""].append(flow[v])
    for m in q:
        if m:
            below[m.rpartition(":")[0]].append(q[m])
    x = lambda y: y * math.log2(y) if y > 0 else 0.0
    expected = sum(x(q[m] + sum(u)) - x(q[m]) - sum(map(x, u)) for m, u in below.items())
    assert abs(got.codelength - expected) < 1e-9 and got.num_modules == 4 and got.depth == 2
