"""Uniform shuffle into shards of exact sizes by a communication matrix.

The number of rows that each block (partition of the input) sends to each
shard follows the multivariate hypergeometric law of a uniform permutation.
The matrix is drawn from the block counts and the exact shard sizes; every
block is permuted locally by a random key, its first rows go to shard 0, the
next to shard 1 and so on, as many as the matrix says; inside a shard the
rows are permuted again.  Every assignment of rows to slots is equally
likely, and shard sizes differ by one row at most.

All row work is DataFrame functions.  Only the matrix of block counts
(``max_blocks`` x ``shards`` numbers, a fixed bound) is drawn on the driver,
and it is broadcast for that reason.  The rows are written with their block
and place first, so a lost executor cannot change a drawn assignment.

Cases: an empty table gives an empty result; repeated rows and null ids are
rows like any other; fewer rows than shards leave the last shards empty."""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import fresh
from .numbering import rank_within, size_of

SHARDS, MAX_BLOCKS, SEED = 8, 8192, 20


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Number of good items among ``draws`` from ``good + bad``, by inversion
    outward from the mode (expected steps: a few standard deviations)."""
    lo, hi = max(0, draws - bad), min(draws, good)
    mode = min(hi, max(lo, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    up = down = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode)
                         - log_choose(good + bad, draws))
    right = left = mode
    rest = rng.random() - up
    while rest >= 0 and (left > lo or right < hi):
        if right < hi:
            up *= (good - right) * (draws - right) / ((right + 1) * (bad - draws + right + 1))
            right += 1
            rest -= up
            if rest < 0:
                return right
        if left > lo:
            down *= left * (bad - draws + left) / ((good - left + 1) * (draws - left + 1))
            left -= 1
            rest -= down
            if rest < 0:
                return left
    return mode


def communication_matrix(blocks: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each block sends to each shard; row sums are the block sizes,
    column sums the shard sizes (at most one apart)."""
    rng = random.Random(seed)
    total = sum(blocks)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for n in blocks:
        left, others, row = n, sum(room), []
        for s in range(shards):
            others -= room[s]
            row.append(hypergeometric(rng, room[s], others, left))
            left -= row[-1]
        room = [r - k for r, k in zip(room, row)]
        matrix.append(row)
    return matrix


def shuffle_shards(df: DataFrame, shards: int = SHARDS, seed: int = SEED,
                   max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``df`` with ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0).
    Input columns with these names are replaced."""
    df = df.drop("shard", "slot")
    spark = df.sparkSession
    key, at = fresh(df, "_key"), fresh(df, "_at")
    spread = df.coalesce(max_blocks)  # narrow; only with more partitions than that
    local = (spread.withColumn(key, F.xxhash64(F.lit(seed), F.monotonically_increasing_id()))
             .sortWithinPartitions(key)  # the local permutation
             .withColumn(at, F.monotonically_increasing_id())
             .withColumn(key, F.xxhash64(F.lit(seed + 1), F.col(at))))
    rows = stage(local, "permuted")
    block, place, ends = fresh(rows, "_block"), fresh(rows, "_place"), fresh(rows, "_ends")
    rows = (rows.withColumn(block, F.shiftright(at, 33))
            .withColumn(place, F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).drop(at))
    counted = rows.groupBy(block).count().orderBy(block).collect()  # one row a block
    matrix = communication_matrix([r["count"] for r in counted], shards, seed)
    limits = [(r[block], [sum(row[:s + 1]) for s in range(shards)]) for r, row in zip(counted, matrix)]
    table = spark.createDataFrame(limits, f"`{block}` long, `{ends}` array<long>")
    sent = (rows.join(F.broadcast(table), block)
            .withColumn("shard", F.size(F.filter(ends, lambda e: e <= F.col(place))))
            .drop(block, place, ends))
    return rank_within(sent, ["shard"], key, "slot").drop(key)


def shard_digest(docs: DataFrame) -> DataFrame:
    """The shuffle over ``doc_id, size, text_crc32`` (a null text counts as empty)."""
    rows = docs.select("doc_id", size_of(F.col("text")).alias("size"),
                       F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    out = shuffle_shards(rows)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
