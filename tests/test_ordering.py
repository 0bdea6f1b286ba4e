"""Order-dependent operators against the hand-made fixtures."""

import random

from flowstrata.operators import ordering as O


def _fold_bins(sizes, bin_size):
    """Plain sequential greedy binning (the semantics to reproduce)."""
    order = sorted(sizes, key=lambda kv: (-kv[1], kv[0]))
    out, b, acc = {}, 0, 0
    for name, n in order:
        out[name] = b
        acc += n
        if acc >= bin_size:
            b, acc = b + 1, 0
    return out


def test_renumbering_fixture(spark):
    rows = [("f1", 1, "1:1", "a"), ("f1", 2, "1:2", "b"), ("f1", 3, "2:1", "c"),
            ("f1", 4, "1:3", "d"), ("f2", 1, "1:1", "e"), ("f2", 2, "3:1", "f"),
            ("f2", 3, "3:2", "g")]
    df = spark.createDataFrame(rows, "file string, pos long, path string, name string")
    got = {r.name: (r.top, r.path) for r in O.consolidate_trees(df).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": 1, "b": 1, "c": 2, "d": 3, "e": 4, "f": 5, "g": 5}
    assert got["d"][1] == "3:3" and got["g"][1] == "5:2"


def test_renumbering_repeated_islands_over_ranges(spark, monkeypatch):
    """Islands of one old id that come back, files that start with the id the
    last one ended with, over many small index ranges."""
    rnd, rows, want, top, last = random.Random(3), [], {}, 0, None
    for f in range(6):
        for p in range(80):
            old = rnd.randint(1, 3) if rnd.random() < 0.3 or last is None else last[1]
            top += last != (f, old)
            last = (f, old)
            rows.append((f"f{f}", p, f"{old}:{p}", f"n{f}_{p}"))
            want[f"n{f}_{p}"] = (top, f"{top}:{p}")
    df = spark.createDataFrame(rows, "file string, pos long, path string, name string")
    for size in (7, 100_000):
        monkeypatch.setattr(O, "INDEX_RANGE", size)
        assert {r.name: (r.top, r.path) for r in O.consolidate_trees(df).collect()} == want


def test_greedy_bins_fixture(spark):
    sizes = [("big", 450), ("b2", 200), ("c1", 90), ("c2", 90), ("c3", 90), ("d1", 50),
             ("d2", 40), ("e1", 10)]
    df = spark.createDataFrame(sizes, "cl_top string, n long")
    got = {r.cl_top: r.bin for r in O.greedy_bins(df, 200).collect()}
    assert got == _fold_bins(sizes, 200)
    assert got["big"] == 0 and got["b2"] == 1 and got["c1"] == got["c3"] == 2


def test_greedy_bins_random(spark):
    rnd = random.Random(7)
    sizes = [(f"c{i:04d}", rnd.randint(1, 120)) for i in range(700)]
    df = spark.createDataFrame(sizes, "cl_top string, n long")
    for bin_size in (1, 150, 5000):
        got = {r.cl_top: r.bin for r in O.greedy_bins(df, bin_size).collect()}
        assert got == _fold_bins(sizes, bin_size)


def test_cluster_rank_and_top(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5)], "cl_top string, n long")
    assert [(r.cl_top, r.rank) for r in O.cluster_rank(df).orderBy("rank").collect()] == [
        ("b", 1), ("a", 2), ("c", 3)]
    assert [r.cl_top for r in O.top_clusters(df, 2).collect()] == ["b", "a"]


def test_bins_with_one_file(spark):
    """A bin without a file is unknown, one with two is left out."""
    files = spark.createDataFrame([("0001", "a"), ("0001", "a"), ("0002", "b"), ("0002", "c"), ("0004", "d")], "bin string, file string")
    assert sorted((r["bin"], r["n_files"]) for r in O.single_file_bins(files).collect()) == [("0001", 1), ("0004", 1)]
