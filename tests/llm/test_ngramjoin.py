import random
import re

import pytest

from flowstrata.llm.ngramjoin import jaccard_join


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """All pairs, then a plain search for components."""
    s = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= 80 * len(s[i] | s[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(x), least.get(find(i)) if x else d) for i, ((d, _), x) in enumerate(zip(rows, s))), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]

    def text(n):
        return [rng.choice(words) for _ in range(n)]
    rows, common = [], text(40)
    for _ in range(12):  # groups of near copies around the threshold
        base = text(rng.choice([6, 12, 60, 200]))
        for _ in range(rng.randint(2, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    big = text(80)
    for _ in range(60):  # a large group
        copy = list(big)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append(" ".join(copy))
    rows += [" ".join(common + text(6)) for _ in range(25)]  # a shared passage, just below the threshold
    rows += [" ".join(common + text(2)) for _ in range(5)]
    rows += [" ".join(text(rng.randint(1, 9))) for _ in range(20)]
    rows += ["", None, " \n\t", "One two", "one TWO", "one two\x0bthree", "one two three", rows[0].upper(), rows[0], "É é", "é é",
             "so it goes on and on " * 4000]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return [*zip(ids, rows), (3, rows[5]), (None, rows[5]), (None, "no id here at all at all"), (2**62, rows[80])]


@pytest.mark.parametrize("seed, cells, cost", [(1, 4_000_000, 24), (2, 500, 1)])
def test_against_all_pairs(spark, seed, cells, cost):
    rows = corpus(seed)
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, sid int, n long, root string").repartition(5)
    history = []
    got = jaccard_join(docs, cell_shingles=cells, round_cost=cost, history=history)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    assert cost > 1 or {"pivot", "all"} == {h[0] for h in history}
    assert jaccard_join(docs.where("false")).count() == 0


def test_a_pair_is_met_about_once(spark):
    """Texts that share a long passage but are not linked, and near copies:
    the join of their lists makes about one row a pair, and loses no pair."""
    from pyspark.sql import functions as F

    from flowstrata.llm import ngramjoin as N
    rng = random.Random(9)
    codes = sorted(rng.randrange(-2**63, 2**63) for _ in range(300))
    rows = []
    for sid in range(40):
        have = [c for c in codes if rng.random() < 0.95]
        rows.append((sid, len(have), b"".join(c.to_bytes(8, "little", signed=True) for c in have), sid))
    sets = spark.createDataFrame(rows, "sid long, n long, rare_first binary, root long")
    a = N._posted(sets, 80, [*N._POSTING, *N._BEFORE])
    met = (a.alias("a").join(a.alias("b"), F.col("a.shingle") == F.col("b.shingle"))
           .where((F.col("a.sid") < F.col("b.sid")) & N._may_link(80)).select("a.sid", "b.sid", N._met_before().alias("again")))
    rows = [tuple(r) for r in met.collect()]
    kept = [r[:2] for r in rows if not r[2]]
    assert set(kept) == {r[:2] for r in rows} and len(kept) < 3 * len(set(kept)) < len(rows) / 3
