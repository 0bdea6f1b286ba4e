import random

import numpy as np
import pytest
import xxhash
from flowstrata.llm.components import connected_components
from flowstrata.llm.golay import composite_keys, decode_table, fingerprint, keep_one, links, near_copies
from pyspark.sql import functions as F


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


@pytest.mark.parametrize("text", [None, "", " \n", "a", "A b", "A b C", "Ä b\tc\x0bd e a b c", "x " * 500, "\x1c a\x85b c d"])
def test_fingerprint_by_definition(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_golay_decodes_every_word_within_three():
    table = decode_table()
    assert (table >= 0).all()
    assert (np.bincount(table) == 2048).all()  # a perfect code: spheres of equal size


def test_close_words_share_a_key():
    rng = random.Random(5)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 2)):
            b ^= 1 << bit
        signed = np.array([a, b], dtype=np.uint64).view(np.int64)
        keys, owner = composite_keys(signed)
        assert a == b or set(keys[owner == signed[0]]) & set(keys[owner == signed[1]])


def brute_components(fps, bits=2):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    order = sorted(fps)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_connect_like_all_pairs(spark, bits):
    """Chains, a bucket far above the pair limit, and random words."""
    rng = random.Random(2)
    def signed(x):
        return x - (1 << 64) if x >> 63 else x
    words = {rng.getrandbits(64) for _ in range(150)}
    hub = rng.getrandbits(64)
    words |= {hub ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(400)}
    chain = rng.getrandbits(64)
    for _ in range(30):
        chain ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        words.add(chain)
    fps = {signed(x) for x in words}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {f: f for f in fps}
    got |= {r["node"]: r["root"] for r in connected_components(links(df, bits, bucket=8)).collect()}
    assert got == brute_components(fps, bits)


def test_components_of_odd_links(spark):
    rows = [(1, 2), (2, 1), (3, 3), (5, 4), (4, 9), (9, -7), (9, -7)] + [(100, i) for i in range(101, 160)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {2: 1, 5: -7, 4: -7, 9: -7} | {i: 100 for i in range(101, 160)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_copies_against_brute_force(spark, make_docs):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    for _ in range(12):
        words = rng.choices(vocabulary, k=rng.randint(2, 400))
        for _ in range(rng.randint(1, 6)):
            rows.append((i, " ".join(words), "en", "s"))
            words = [w if rng.random() > 0.01 else "new" for w in words]
            i += 1
    got = {r["doc_id"]: r for r in near_copies(make_docs(rows)).collect()}
    fps = {d: plain_fingerprint(t) for d, t, _, _ in rows}
    roots = brute_components(set(fps.values()))
    least = {}
    for d, f in fps.items():
        least[roots[f]] = min(d, least.get(roots[f], d))
    assert len(got) == len(rows)
    for d, f in fps.items():
        assert got[d]["fingerprint"] == f"{f & (2**64 - 1):016x}"
        assert got[d]["component_id"] == least[roots[f]]


def test_odd_rows(spark, odd_docs):
    rows = near_copies(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in zero} == {2} and len(zero) == 4
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({r["component_id"] if r["component_id"] is not None else r["fingerprint"] for r in rows})
    assert near_copies(odd_docs.where("false")).count() == 0
    assert keep_one(odd_docs.where("false")).count() == 0


def test_groups_of_copies_keep_the_smallest_id(make_docs):
    docs = make_docs([(i, f"the same text of group {i % 3} " * 20, "en", "s") for i in range(60)])
    assert sorted(r["doc_id"] for r in keep_one(docs).collect()) == [0, 1, 2]
