from collections import Counter
from fractions import Fraction
from math import ceil, floor

import pytest
from flowstrata.llm.pfair import exact_units, interleave, mixed, schedule
from pyspark.sql import functions as F


def edf(units):
    """Earliest deadline first over released blocks, step by step."""
    total, done, picks = sum(units), [0] * len(units), []
    for t in range(total):
        due = [(ceil((d + 1) * total / u), i) for i, (d, u) in enumerate(zip(done, units)) if floor(d * total / u) <= t]
        i = min(due)[1]
        done[i] += 1
        picks.append(i)
    return picks


@pytest.mark.parametrize("weights", [[1], [1, 1], [0.5, 0.3, 0.2], [0.36] + [0.034] * 19, [5, 1, 1, 1, 1, 1, 1], [97, 2, 1]])
def test_frame_meets_every_deadline(spark, weights):
    df = spark.createDataFrame([(f"1s{i:02d}", 6400, float(w)) for i, w in enumerate(weights)],
                               "name string, rows long, weight double")
    plan = {r["name"]: r for r in schedule(df, resolution=500).collect()}
    names = sorted(plan)
    total = plan[names[0]]["total"]
    units = [plan[n]["units"] for n in names]
    assert sum(units) == total
    assert all(abs(u / total - w / sum(weights)) < 0.01 for u, w in zip(units, weights))
    picks = [None] * total
    for i, n in enumerate(names):
        for t in plan[n]["slots"]:
            picks[t] = i
    assert picks == edf(units)
    done = [0] * len(units)
    for t, i in enumerate(picks):
        done[i] += 1
        assert all(abs(d - (t + 1) * u / total) < 1 for d, u in zip(done, units))


def rows_of(spark, sizes):
    return spark.createDataFrame([(k * 10_000 + j, s) for k, (s, n) in enumerate(sizes.items()) for j in range(n)],
                                 "doc_id long, source string")


def test_cover_uses_every_row_and_keeps_the_weights(spark):
    df = rows_of(spark, {"a": 3000, "b": 500, "c": 700, None: 60})
    rows = interleave(df, block_rows=10, resolution=1000).collect()
    first = [r["doc_id"] for r in rows if r["mix_epoch"] == 0]
    assert len(first) == len(set(first)) == df.count()
    slots = {}
    for r in rows:
        slots.setdefault(r["mix_slot"], []).append(r)
    assert sorted(slots) == list(range(len(slots)))  # every slot runs one block of one source
    assert all(len({r["source"] for r in b}) == 1 and len(b) <= 10 for b in slots.values())
    assert all(sorted(r["mix_place"] for r in b) == list(range(len(b))) for b in slots.values())
    sizes = {"a": 3000, "b": 500, "c": 700, None: 60}
    # the target weights are whole units of the tempered shares
    unit = {s: max(1, round(n ** 0.9 * 1000 / sum(m ** 0.9 for m in sizes.values()))) for s, n in sizes.items()}
    done = Counter()
    for t in sorted(slots):
        done[slots[t][0]["source"]] += 1
        for s, u in unit.items():
            assert abs(done[s] - Fraction((t + 1) * u, sum(unit.values()))) < 1


def test_given_weights_are_exact():
    assert exact_units({"a": 1 / 7, "b": 6 / 7}) == {"a": 1, "b": 6}
    assert exact_units({"a": Fraction(1, 3), "b": 2}) == {"a": 1, "b": 6}
    assert exact_units({"a": 1e-6, "b": 1 - 1e-6, "c": 0.0}) == {"a": 1, "b": 999_999}
    assert exact_units({}) == {}
    odd = exact_units({"a": 0.1234567891, "b": 0.3141592653, "c": 2.718281828})
    assert abs(sum(odd.values()) - 1_000_000) <= 2 and abs(odd["a"] / odd["c"] - 0.1234567891 / 2.718281828) < 1e-6


@pytest.mark.parametrize("weights", [{"a": 1 / 7, "b": 6 / 7}, {"a": 1e-6, "b": 1 - 1e-6},
                                     {"a": 1 / 3, "b": 1 / 6, "c": 1 / 2}])
def test_a_million_slots_stay_within_one_block(spark, weights):
    units = exact_units(weights)
    df = spark.createDataFrame([(k, 64 * 10 ** 9, u) for k, u in units.items()], "name string, rows long, units long")
    plan = schedule(df).collect()
    total = sum(units.values())
    assert sorted(t for r in plan for t in r["slots"]) == list(range(total))
    for r in plan:
        w, u = Fraction(weights[r["name"]]), r["units"]
        for j in {*range(min(u, 1000)), *range(max(0, u - 1000), u)}:
            j += (1_000_000 // total - 1) * u  # the last frame of a million slots
            t = j // u * total + r["slots"][j % u]
            assert abs(j - w * t) < 1 and abs(j + 1 - w * (t + 1)) < 1  # before and after the block
        # releases and deadlines of every block of the frame
        assert all(floor(Fraction(j * total, u)) <= t < ceil(Fraction((j + 1) * total, u)) for j, t in enumerate(r["slots"]))


def test_many_sources(spark):
    df = (spark.range(100_000).select(F.format_string("s%06d", "id").alias("name"), F.lit(64).cast("long").alias("rows"),
                                      F.when(F.col("id") < 20, 7 * F.col("id") + 3).otherwise(1).alias("units")))
    plan = schedule(df).collect()
    total = plan[0]["total"]
    assert len(plan) == 100_000 and total == sum(7 * i + 3 for i in range(20)) + 99_980
    assert sorted(t for r in plan for t in r["slots"]) == list(range(total))
    assert all(floor(j * total / r["units"]) <= t < ceil((j + 1) * total / r["units"])
               for r in plan for j, t in enumerate(r["slots"]))


def test_exact_weights_place_rows(spark):
    rows = interleave(rows_of(spark, {"a": 70, "b": 430, "c": 20}), {"a": 1 / 7, "b": 6 / 7}, block_rows=10).collect()
    slots = {r["mix_slot"]: r["source"] for r in rows}
    assert sorted(slots) == list(range(len(slots))) and set(slots.values()) == {"a", "b"}
    done = Counter()
    for t in range(len(slots)):
        done[slots[t]] += 1
        assert abs(done["a"] - Fraction(t + 1, 7)) < 1 and abs(done["b"] - Fraction(6 * (t + 1), 7)) < 1


def test_supply_never_repeats(spark):
    df = rows_of(spark, {"a": 400, "b": 100})
    rows = interleave(df, {"a": 1.0, "b": 1.0, "missing": 3.0}, block_rows=10, cover=False).collect()
    ids = [r["doc_id"] for r in rows]
    assert len(ids) == len(set(ids)) and {r["mix_epoch"] for r in rows} == {0}
    assert abs(Counter(r["source"] for r in rows)["a"] - 100) <= 10
    only = interleave(df, {"b": 1.0}).collect()
    assert {r["source"] for r in only} == {"b"} and len(only) == 100


def test_odd_rows(odd_docs):
    rows = interleave(odd_docs, block_rows=2).collect()
    assert len([r for r in rows if r["mix_epoch"] == 0]) == odd_docs.count()
    out = mixed(odd_docs)
    assert out.columns == odd_docs.columns and out.count() >= odd_docs.count()
    assert interleave(odd_docs.where("false")).count() == 0
    assert mixed(odd_docs.where("false")).count() == 0
