import random
from collections import Counter

from flowstrata.llm.hypershuffle import communication_matrix, hypergeometric, shard_digest, shuffle_shards
from flowstrata.llm.numbering import numbered, rank_within


def test_hypergeometric_law():
    rng = random.Random(1)
    n = 40_000
    got = Counter(hypergeometric(rng, 6, 9, 5) for _ in range(n))
    from math import comb
    for k in range(6):
        p = comb(6, k) * comb(9, 5 - k) / comb(15, 5)
        assert abs(got[k] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-9


def test_hypergeometric_edges():
    rng = random.Random(1)
    assert hypergeometric(rng, 0, 5, 3) == 0 and hypergeometric(rng, 5, 0, 3) == 3
    assert hypergeometric(rng, 0, 0, 0) == 0 and hypergeometric(rng, 4, 4, 8) == 4
    big = [hypergeometric(rng, 10**11, 7 * 10**11, 10**9) for _ in range(200)]
    assert abs(sum(big) / 200 - 125_000_000) < 10_000


def test_matrix_sums():
    for blocks in ([], [0], [5], [7, 0, 100, 3], [13] * 50):
        m = communication_matrix(blocks, 8, 3)
        assert [sum(r) for r in m] == blocks
        sizes = [sum(r[s] for r in m) for s in range(8)]
        assert max(sizes) - min(sizes) <= 1


def check_slots(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))


def test_shards_are_exact_and_uniform(spark):
    df = spark.range(0, 20_000, 1, 7).withColumnRenamed("id", "doc_id")
    rows = shuffle_shards(df, 8).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(20_000))
    check_slots(rows, 8)
    # ids of every seventh of the input are spread evenly over shards and halves of slots
    cells = Counter((r["doc_id"] * 7 // 20_000, r["shard"], r["slot"] * 2 // 2500) for r in rows)
    mean = 20_000 / (7 * 8 * 2)
    chi = sum((cells[(a, b, c)] - mean) ** 2 / mean for a in range(7) for b in range(8) for c in range(2))
    assert chi < 112 + 5 * (2 * 112) ** 0.5


def test_odd_rows(spark, odd_docs):
    rows = shard_digest(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    check_slots(rows, 8)
    assert {r["law"] for r in rows} == {"rows"} and all(r["grown_shard"] is None for r in rows)
    null = [r for r in rows if r["doc_id"] == 2][0]
    assert null["size"] == 1 and null["text_crc32"] == 0
    assert shard_digest(odd_docs.where("false")).count() == 0
    full = shuffle_shards(odd_docs)
    assert sorted(full.columns) == sorted({*odd_docs.columns, "shard", "slot"})


def test_rank_of_a_hot_group(spark):
    """One group holds nearly all rows; ranks are gapless in every group."""
    df = spark.range(0, 30_000, 1, 5).selectExpr("if(id % 50 = 0, id % 7, 99) as g")
    rows, rid, key = numbered(df, 1)
    got = rank_within(rows, ["g"], key, "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append((r[key], r["rank"]))
    assert len(got) == 30_000
    for pairs in by.values():
        assert [k for _, k in sorted(pairs)] == list(range(len(pairs)))
