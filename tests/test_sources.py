"""Text formats: Pajek sections and tokens, tree files, writers' save modes."""

import os

import pytest
from pyspark.sql import functions as F

from flowstrata.plans import pipeline as P
from flowstrata.session import staging_path
from flowstrata.sources import manifest as MF
from flowstrata.sources import pajek as PJ
from flowstrata.sources import text as TX

PAJEK = ('*Vertices 4\n1 "Node 1" \n2 "Node 2"\n\n  3 "Node 3"\nx "bad"\n'
         '*comment line\n'
         '*Arcs 99\n1 2 1\n2  3 0.5\n3 1\n4 z\n*Edges\n1 3')


def _write(spark, name, text):
    path = staging_path(spark, name).replace("file:", "")
    os.makedirs(path)
    with open(os.path.join(path, "net.net"), "w") as f:
        f.write(text)
    return path


def test_pajek_default_rules(spark):
    t = PJ.read_pajek(spark, _write(spark, "pj", PAJEK))
    assert sorted(tuple(r) for r in t.vertices.collect()) == [
        (1, "Node 1"), (2, "Node 2"), (3, "Node 3")]
    # '*comment' opens the edge section (any '*' line that is not '*v...')
    assert sorted(tuple(r) for r in t.edges.collect()) == [
        (1, 2, 1.0), (1, 3, 1.0), (2, 3, 0.5), (3, 1, 1.0)]
    bad = sorted(tuple(r) for r in t.bad.collect())
    assert ("v", 'x "bad"') in bad and ("e", "4 z") in bad


def test_pajek_strict_rules(spark):
    text = "*Vertices 2\n1 \"a\"\n*Network x\n2 \"b\"\n*Arcs\n1 2\n"
    t = PJ.read_pajek(spark, _write(spark, "pj2", text), strict_headers=True)
    assert sorted(tuple(r) for r in t.vertices.collect()) == [(1, "a"), (2, "b")]
    assert [tuple(r) for r in t.edges.collect()] == [(1, 2, 1.0)]


def test_pajek_roundtrip_multi_part(spark):
    edges = spark.createDataFrame([(10, 20), (20, 30), (30, 10), (10, 30)], "source long, target long")
    v, a = PJ.edges_to_pajek(edges)
    path = staging_path(spark, "pj3")
    PJ.write_pajek(v, a, path, num_parts=3)
    back = PJ.read_pajek(spark, path)
    assert sorted(tuple(r) for r in back.vertices.collect()) == [(1, "10"), (2, "20"), (3, "30")]
    assert sorted((r.source, r.target) for r in back.edges.collect()) == [(1, 2), (1, 3), (2, 3), (3, 1)]


def test_tree_reader(spark):
    path = staging_path(spark, "tree").replace("file:", "")
    os.makedirs(path)
    with open(os.path.join(path, "t.tree"), "w") as f:
        f.write('# comment\n1:1 0.5 "Node 1" 7\n1:2 0.25 "Node 2"\n12 0.25 "N 3"')
    rows = sorted(tuple(r) for r in TX.read_tree(spark, path).collect())
    assert rows == [("12", 0.25, "N 3"), ("1:1", 0.5, "Node 1"), ("1:2", 0.25, "Node 2")]


def test_save_modes(spark):
    df = spark.range(3).select(F.col("id").alias("node_id"), F.lit("x").alias("cl"))
    path = staging_path(spark, "modes")
    TX.write_result(df, path)
    with pytest.raises(Exception):
        TX.write_result(df, path)                 # refuses an existing output
    TX.write_result(df.limit(1), path, mode="ignore")
    assert TX.read_results(spark, path, "node_id BIGINT, cl STRING").count() == 3
    TX.write_result(df.limit(1), path, mode="overwrite")
    assert TX.read_results(spark, path, "node_id BIGINT, cl STRING").count() == 1


def test_single_csv_guard(spark):
    path = staging_path(spark, "two_csv")
    spark.range(10).repartition(2).write.csv(path)
    with pytest.raises(ValueError):
        TX.read_single_csv(spark, path, "id BIGINT")


def test_pajek_sections_over_many_splits(spark):
    """Headers inside and between splits; no data line is shuffled."""
    lines = ["*Vertices 400"] + [f'{i} "n{i}"' for i in range(400)] + ["*Arcs"] + [f"{i} {i + 1} {i}.5" for i in range(399)]
    lines += ["*Vertices 3", '900 "late"', "*Edges"] + [f"{i} 900" for i in range(50)]
    path = _write(spark, "pj_splits", "\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        t = PJ.read_pajek(spark, path)
        assert t.vertices.count() == 401 and t.edges.count() == 449 and t.bad.count() == 0
        assert t.edges.where("target = 900").count() == 50
        assert {(r.source, r.weight) for r in t.edges.where("target = source + 1 and target < 400").collect()} == {
            (i, i + 0.5) for i in range(399)}
        plan = t.edges._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sorted_result_parts(spark):
    path = staging_path(spark, "sorted")
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("node_id"), F.lit("x").alias("cl"))
    TX.write_result(df, path)
    back = TX.read_results(spark, path, "node_id BIGINT, cl STRING").select(
        "node_id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).collect()
    ids = [r.node_id for r in sorted(back, key=lambda r: (r.f, r.i))]
    assert ids == list(range(5000))


def _single_lines(spark, path):
    return [r.value for r in TX.numbered_lines(spark, path).orderBy("line").collect()]


def test_single_sorted_file_is_joined(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("node_id"), F.lit("x").alias("cl"))
    path = staging_path(spark, "joined")
    TX.write_result(df, path, single_file=True)
    assert len(spark.read.text(path).inputFiles()) == 1
    assert _single_lines(spark, path) == ["node_id\tcl"] + [f"{i}\tx" for i in range(5000)]
    with pytest.raises(FileExistsError):
        TX.write_result(df, path, single_file=True)
    TX.write_result(df.limit(0), path, mode="ignore", single_file=True)
    assert len(_single_lines(spark, path)) == 5001
    TX.write_result(df.limit(0), path, mode="overwrite", single_file=True)
    assert _single_lines(spark, path) == ["node_id\tcl"]


def test_bad_lines_keep_every_character(spark):
    rows = [("v", ' a "b" \\ c\t'), ("e", "1"), ("e", '"'), ("v", "x\ty")]
    path = staging_path(spark, "bad")
    TX.write_bad_lines(spark.createDataFrame(rows, "section string, line string"), path)
    assert sorted(tuple(r) for r in TX.read_bad_lines(spark, path).collect()) == sorted(rows)
    TX.write_bad_lines(spark.createDataFrame([], "section string, line string"), path, "overwrite")
    assert TX.read_bad_lines(spark, path).count() == 0


def test_finished_output_is_reused(spark):
    """A killed write, changed inputs, lost rows and foreign outputs."""
    source, out = _write(spark, "mf_in", "1"), staging_path(spark, "mf_out")
    built = []

    def build(n=5, kill=False):
        spark.range(2 if kill else n).write.mode("overwrite").parquet(out)
        if kill:
            raise RuntimeError("killed")
        built.append(n)
        return n

    def run(parameter=1, **kw):
        return MF.build_or_reuse(spark, out, MF.fingerprint(spark, [source], {"p": parameter}), lambda: build(**kw),
                                 lambda: spark.read.parquet(out).count())
    with pytest.raises(RuntimeError):
        run(kill=True)
    assert MF.read_manifest(spark, out)["state"] == MF.STARTED
    assert run() and not run() and built == [5]              # the half-written output is built again, then reused
    assert run(parameter=2) and not run(parameter=2)         # other parameters: stale
    spark.range(3).write.mode("overwrite").parquet(out)
    assert run(parameter=2) and built == [5, 5, 5]           # rows were lost
    other = staging_path(spark, "foreign")
    spark.range(1).write.parquet(other)
    with pytest.raises(FileExistsError):
        MF.build_or_reuse(spark, other, "f", lambda: 0, lambda: 1)
    assert spark.read.parquet(other).count() == 1


def test_job_from_files_reuses_and_reports_bad_lines(spark):
    net = _write(spark, "job_net", '*Vertices 4\n1 "a"\n2 "b"\nx "c"\n3 "d"\n*Arcs\n1 2\n2 1\n2 oops\n3 1')
    tree = _write(spark, "job_tree", '1:1 0.4 "a"\n1:2 0.4 "b"\n2:1 0.2 "d"')
    out = staging_path(spark, "job_out")

    def run():
        return P.communities_from_files(spark, net, tree, out, min_size=10, mode=P.USE_EXISTING)
    assert run() and not run()
    bad = {tuple(r) for r in TX.read_bad_lines(spark, P.bad_path(out)).collect()}
    assert bad == {("v", 'x "c"'), ("e", "2 oops")}
    assert {r.node_id for r in TX.read_results(spark, out).collect()} == {"1", "2", "3"}


def test_partitioned_text_without_rows_keeps_its_columns(spark):
    kinds = "cluster_rank BIGINT, cl_top STRING"
    rows = spark.createDataFrame([(1, "007", "a"), (2, "x", "b")], f"{kinds}, node_name STRING")
    for n, df in (("full", rows), ("none", rows.where("cluster_rank > 2"))):
        path = staging_path(spark, n)
        TX.write_partitioned_text(df, path, ["cluster_rank", "cl_top"], "node_name")
        back = TX.read_partitioned_text(spark, path, "node_name", kinds).select("cluster_rank", "cl_top", "node_name")
        assert back.dtypes == rows.dtypes
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
