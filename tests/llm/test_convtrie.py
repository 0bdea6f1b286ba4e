import hashlib
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest

from flowstrata.llm.convtrie import oracle_sql, prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The trie by plain dictionaries, from the definition."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    rebuilt = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(base, [])[:h] + t[h:]
    nodes = {}
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            nodes.setdefault(tuple(t[:d]), []).append(c)
    kids = {k: [x for x in nodes if len(x) == len(k) + 1 and x[:-1] == k] for k in nodes}

    def sums(k):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        below = [sums(x) for x in kids[k]]
        return (sum(x[0] for x in below) or 1, (len(nodes[k]) - 1) * words + sum(x[1] for x in below))
    out = []
    for k, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(rebuilt[c]) == len(k))))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), len(kids[k]), *sums(k),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(-25, 90):
        n = rng.choice([1, 2, 3, 5, 8, 9, 14])
        same = rng.random() < 0.7
        turns = [("user" if i % 2 else "assistant", f"turn {i}\tof copies" if same and rng.random() < 0.9 else f"own {rng.random()}")
                 for i in range(n)]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(7, None, None, None), (7, None, None, None), (7, 3, "user", ""), (None, 1, "user", "lost"),
             (2**61, 5, "user", "é  x"), (2**61, 5, "a", "é  x"), (45, 0, None, "turn 0\tof copies")]
    rows += [(300 + i, i, "user", "word " * 400) for i in range(3)]
    rows += [(400 + i, j, "user", f"long {j}") for i in range(3) for j in range(23 + (i == 2))]
    rows += [(500, 0, "u|1:", "a|b"), (501, 0, "u", "|1:a|b")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_dictionaries(spark, seed):
    rows = conversations(seed)
    random.Random(seed).shuffle(rows)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, key string")
    expected = brute(rows)
    assert sorted(map(tuple, prefix_trie(frame).select(COLUMNS).collect()), key=str) == expected
    if seed == 1:
        assert sorted(map(tuple, prefix_trie(frame, block_turns=1).select(COLUMNS).collect()), key=str) == expected
        assert prefix_trie(frame.where("false")).count() == 0
        con = duckdb.connect()
        con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype(
            {"conv_id": "Int64", "turn": "Int64"}))
        got = con.execute(oracle_sql()).fetchall()
        assert sorted(map(tuple, got), key=str) == expected
