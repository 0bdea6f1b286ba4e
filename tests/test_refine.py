"""Invariants of the hierarchical refinement and the flagship job."""

import pytest
from pyspark.sql import functions as F

from flowstrata.operators import membership as M
from flowstrata.operators import moves
from flowstrata.operators.flow import undirdir_flow
from flowstrata.operators.hierarchy import refine_clusters
from flowstrata.plans import pipeline as P
from flowstrata.sources import tables as T

from conftest import CYCLES16, SF_SMALL


def _inputs(spark):
    v, e, t = T.vertices(spark, SF_SMALL), T.edges(spark, SF_SMALL), T.tree(spark, SF_SMALL)
    members = M.members(t, v)
    kept = M.cluster_size_filter(M.cluster_sizes(members), 3, 40)
    return v, e, t, members, M.kept_members(members, kept)


def test_flagship_invariants(spark):
    v, e, t, members, km = _inputs(spark)
    out = P.hierarchical_communities(v, e, t, 3, 40, with_status=True)
    rows = out.collect()
    assert len(rows) == members.count() == 200
    assert [r.node_id for r in rows] == sorted({r.node_id for r in rows})  # each once, sorted
    assert all(r.cl.split(":")[0] == r.cl_top for r in rows)
    orig = {r.node_id: r.cl for r in members.collect()}
    kept_ids = {r.node_id for r in km.collect()}
    for r in rows:
        if r.node_id in kept_ids:
            assert r.status == "ok"
        else:
            assert r.status == "passthrough" and r.cl == orig[r.node_id]
    assert len({r.cl for r in rows}) == 200  # a path names one node


def test_failed_cluster_status(spark):
    nodes = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", 4)], "cl_top string, node_id long")
    links = spark.createDataFrame([(1, 2, "a", 1.0), (2, 1, "a", 1.0), (3, 4, "b", float("nan"))],
                                  "source long, target long, cl_top string, weight double")
    out = {r.node_id: (r.cl, r.status) for r in refine_clusters(nodes, links).collect()}
    assert out[3] == ("b:FAILED", "failed") and out[4] == ("b:FAILED", "failed")
    assert out[1][1] == "ok" and out[1][0].startswith("a:")


def test_fault_in_one_group(spark, monkeypatch):
    """A task that fails - in the first split, among its modules, in a later
    split - costs its own cluster only."""
    links = spark.createDataFrame([(s + 100 * k, t + 100 * k, c, 1.0) for k, c in enumerate("abcd") for s, t in CYCLES16],
                                  "source long, target long, cl_top string, weight double")
    nodes = spark.createDataFrame([(c, i + 100 * k) for k, c in enumerate("abcd") for i in range(1, 17)],
                                  "cl_top string, node_id long")
    whole = {r.node_id: (r.cl, r.status) for r in refine_clusters(nodes, links).collect()}
    assert {s for _, s in whole.values()} == {"ok"}
    real = moves.sweep

    def sweep(rows, min_delta):
        g, n = rows["g"].iloc[0], rows["v"].nunique()
        if (g == "b" and n == 16) or (g == "c" and n < 16) or g.startswith("d:"):
            raise ValueError("planted")
        return real(rows, min_delta)
    monkeypatch.setattr(moves, "sweep", sweep)
    failures = []
    got = {r.node_id: (r.cl, r.status) for r in refine_clusters(nodes, links, failures=failures).collect()}
    assert len(got) == 64
    for i, row in got.items():
        top = "abcd"[i // 100]
        assert row == (whole[i] if top == "a" else (f"{top}:FAILED", "failed"))
    assert {(r.g.split(":")[0], r.error) for f in failures for r in f.collect()} == {(c, "ValueError: planted") for c in "bcd"}
    nf, lf = undirdir_flow(links.select(F.col("cl_top").alias("g"), "source", "target", "weight"), ["g"])
    with pytest.raises(Exception, match="planted"):  # without a list of failures the job ends
        moves.two_level_partition(nf, lf, "g")


def test_cluster_without_links(spark):
    nodes = spark.createDataFrame([("z", 5), ("z", 9)], "cl_top string, node_id long")
    links = spark.createDataFrame([], "source long, target long, cl_top string")
    out = sorted((r.node_id, r.cl) for r in refine_clusters(nodes, links).collect())
    assert out == [(5, "z:1"), (9, "z:2")]


@pytest.fixture(scope="module")
def odd_network(spark):
    """Two triangles; two nodes share a name, one has none, one is no vertex."""
    vertices = spark.createDataFrame([(1, "x"), (2, "a"), (3, "b"), (4, "c"), (5, "x"), (9, None)],
                                     "node_id long, node_name string")
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5), (5, 6), (6, 4), (3, 3)], "source long, target long")
    return vertices, edges


def test_cluster_network_keeps_every_node_once(odd_network):
    rows = P.cluster_network(*odd_network, 2, None).collect()
    assert [r.node_id for r in rows] == [1, 2, 3, 4, 5, 6, 9]
    names = {r.node_id: r.node_name for r in rows}
    assert names[1] == names[5] == "x" and names[6] is None and names[9] is None
    top = {r.node_id: r.cl_top for r in rows}
    assert top[1] == top[2] == top[3] != top[4] == top[5] == top[6]


def test_cluster_network_builds_its_links_once(spark, odd_network):
    """The links, here of a counted job, are not built again for every step."""
    vertices, edges = odd_network
    built = spark.sparkContext.accumulator(0)

    def counted(frames):
        for pdf in frames:
            built.add(len(pdf))
            yield pdf
    rows = P.cluster_network(vertices, edges.mapInPandas(counted, edges.schema), 2, None).collect()
    assert len(rows) == 7 and built.value == 7


def test_file_jobs_leave_only_the_result(spark, odd_network, tmp_path):
    from flowstrata.session import checkpoint_dir
    from flowstrata.sources import pajek as PJ
    from flowstrata.sources import text as TX
    import os
    vertices, edges = odd_network
    net, out = str(tmp_path / "net"), str(tmp_path / "out")
    PJ.write_pajek(vertices.where("node_name is not null"), edges, net)
    staged = os.path.join(checkpoint_dir(spark).replace("file:", ""), "staged")
    before = set(os.listdir(staged)) if os.path.isdir(staged) else set()
    P.cluster_network_file(spark, net, out, 2, weighted=False, self_links=False)
    assert set(os.listdir(staged)) <= before
    rows = TX.read_results(spark, out, "node_id BIGINT, node_name STRING, cl STRING, cl_top STRING, flow DOUBLE").collect()
    assert sorted(r.node_id for r in rows) == [1, 2, 3, 4, 5, 6]
    with pytest.raises(Exception):
        P.cluster_network_file(spark, net, out, 2)  # refuses an existing result


def test_chosen_links(spark):
    e = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0)], "source long, target long, weight double")
    assert P.chosen_links(e, weighted=False).columns == ["source", "target"]
    assert P.chosen_links(e, self_links=False).collect()[0].target == 2
    assert P.chosen_links(e).count() == 2


def test_split_join_with_hot_and_null_keys(spark):
    from flowstrata.functions.joins import split_join
    rows = spark.range(1000).select(F.col("id").alias("v"), F.expr("if(id % 10 < 8, 1, if(id % 10 = 8, id, null))").alias("k"))
    table = spark.createDataFrame([(1, "one", 800), (8, "eight", 1), (18, "x", 1), (-5, "no", 0)], "k long, name string, n long")
    for limit in (10**6, 100):
        left = split_join(rows, table, ["k"], "n", ["v"], "left", limit)
        assert left.columns == ["v", "k", "name"] and left.count() == 1000
        assert left.where("name is not null").count() == 802
        assert split_join(rows, table, ["k"], "n", ["v"], limit=limit).count() == 802


def test_status_of_clusters_of_any_size(spark, tmp_path):
    """A cluster larger than the registered upper bound is refined as well; one
    below the lower bound is not."""
    import duckdb

    import __spark_entry__ as entry

    sizes = {"Brand#1": 60, "Brand#2": 3, "Brand#3": 2}
    brands = [b for b, n in sizes.items() for _ in range(n)]
    con = duckdb.connect()
    con.execute("CREATE TABLE part (p_partkey BIGINT, p_brand VARCHAR, p_type VARCHAR, p_size BIGINT, p_retailprice DOUBLE)")
    con.executemany("INSERT INTO part VALUES (?, ?, 'T', 10, ?)", [(k, b, 1.0 + k) for k, b in enumerate(brands, 1)])
    con.execute("CREATE TABLE lineitem (l_orderkey BIGINT, l_partkey BIGINT, l_linenumber BIGINT)")
    con.executemany("INSERT INTO lineitem VALUES (?, ?, ?)", [(k, (k + i) % len(brands) + 1, i) for k in range(80) for i in (1, 2)])
    for t in ("part", "lineitem"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet'")
    got = sorted((r.cl_top, r.status, r.n) for r in entry.queries()["refine_status"](spark, str(tmp_path)).collect())
    assert got == [("1", "ok", 60), ("2", "ok", 3)]
    assert got == sorted(con.execute(f"SELECT cl_top, status, n FROM ({entry.oracle_sql()['refine_status']}) q").fetchall())
