"""Near copies by SimHash fingerprints and Golay-code fuzzy hashing.

A fingerprint (64 bits over word shingles) is cut into three segments of 22,
21 and 21 bits.  The perfect binary Golay code decodes every 23-bit word to
one of 4096 codewords at distance three or less; the keys of a segment are the
codeword indices of the segment and of all words one bit away, about five.
Two segments that differ in at most two bits have a word within one bit of
both, hence share a key.  With at most two differing bits over three segments
one segment is equal (pigeonhole) and the next one differs in at most two
bits: the pair shares the composite key (number of the equal segment, its
bits, codeword index of the next segment).  So a join on the composite keys
finds every linked pair, and the bit distance verifies it.

Keys with more than ``bucket`` fingerprints are not joined pair by pair.
Their members are grouped by all 65 words within one bit instead: two
fingerprints are linked at two bits exactly if they share such a word, a
word has at most 65 distinct members, and a star from the smallest member
keeps the components.  This is exact as well and linear in the members.

Nulls and ties: a null or word-less text has fingerprint zero and links like
any other; copies of one fingerprint are one node; rows with a null id take
part, and a component of null ids only has a null ``component_id``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release, stage
from .common import fresh, worker_cached
from .components import connected_components

SHINGLE_WORDS, MAX_BITS, BUCKET = 3, 2, 24
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
GENERATOR = 0b101011100011  # generator polynomial of the binary Golay code


# ---------------------------------------------------------- fingerprint ----

def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text as a signed 64-bit number (the definition of op2)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= shingle_words:
        starts, ends = starts[:len(words) - shingle_words + 1], ends[shingle_words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 65536):  # bounded memory for very long texts
        part = [digest(joined[a:b], 42)
                for a, b in zip(starts[at:at + 65536].tolist(), ends[at:at + 65536].tolist())]
        hashes = np.array(part, dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _fingerprints(batches, shingle_words):
    for b in batches:
        texts = b.column(b.num_columns - 1)
        fps = pa.array([fingerprint(t.as_py(), shingle_words) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], fps], names=[*b.schema.names[:-1], "fp"])


def with_fingerprint(df: DataFrame, keep: list[str], text: str = "text",
                     shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The ``keep`` columns and ``fp``; one narrow pass over the whole texts."""
    base = df.select(*keep, F.col(text).alias(fresh(df.select(*keep), "_text")))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    return base.mapInArrow(lambda it: _fingerprints(it, shingle_words), f"{types}, fp long")


# ----------------------------------------------------------- Golay code ----

def decode_table() -> np.ndarray:
    """Codeword index (its 12 message bits) for each of the 2^23 words."""
    syndrome_shift = range(11, -1, -1)
    messages = np.arange(4096, dtype=np.int64) << 11
    rest = messages.copy()
    for s in syndrome_shift:
        rest = np.where(rest >> (s + 11) & 1, rest ^ (GENERATOR << s), rest)
    words = messages | rest
    one = 1 << np.arange(23)
    errors = [np.zeros(1, np.int64), one,
              *(np.array([one[i] | one[j] for j in range(i)]) for i in range(1, 23)),
              *(np.array([one[i] | one[j] | one[k] for k in range(j)])
                for i in range(2, 23) for j in range(1, i))]
    table = np.full(1 << 23, -1, np.int16)
    for e in errors:
        table[(words[:, None] ^ e[None, :]).ravel()] = np.repeat(np.arange(4096), len(e))
    return table


def composite_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(key, fp)`` pairs, each pair once."""
    table = worker_cached("golay_table", decode_table)
    unsigned = fps.astype(np.int64).view(np.uint64)
    parts = [((unsigned >> np.uint64(a)) & np.uint64((1 << w) - 1)).astype(np.int64)
             for a, w in SEGMENTS]
    keys, owner = [], []
    for s in range(3):
        word, width = parts[(s + 1) % 3], SEGMENTS[(s + 1) % 3][1]
        near = np.column_stack([word, *(word ^ (1 << i) for i in range(width))])
        index = np.sort(table[near].astype(np.int64), axis=1)
        first = np.ones(index.shape, bool)
        first[:, 1:] = index[:, 1:] != index[:, :-1]
        row, col = np.nonzero(first)
        keys.append((np.int64(s) << 60) | (parts[s][row] << 12) | index[row, col])
        owner.append(fps[row])
    return np.concatenate(keys), np.concatenate(owner)


def _keys(batches):
    for b in batches:
        k, f = composite_keys(b.column(0).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(f)], names=["key", "fp"])


# ---------------------------------------------------------------- links ----

def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``(u, v)`` links that connect the distinct fingerprints ``fp`` exactly
    as all pairs at ``max_bits`` (at most 2) or fewer differing bits do."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the segment keys cover at most two differing bits")
    keys = fps.select("fp").mapInArrow(_keys, "key long, fp long")
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    multi = stage(keys.join(shared, "key"), "golay_keys")
    few = multi.where(F.col("members") <= bucket).select("key", "fp")
    a, b = few.toDF("key", "u"), few.toDF("key", "v")
    pairs = (a.join(b, "key").where("u < v")
             .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
             .select("u", "v"))
    hot = multi.where(F.col("members") > bucket).select("fp").distinct()
    if max_bits == 2:
        near = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
        stars = (hot.select("fp", F.explode(near).alias("word"))
                 .groupBy("word").agg(F.collect_list("fp").alias("members"))  # 65 at most
                 .where(F.size("members") > 1)
                 .select(F.array_min("members").alias("u"), F.explode("members").alias("v")))
    elif max_bits == 1:
        flip = F.expr("transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))")
        stars = (hot.select(F.col("fp").alias("u"), F.explode(flip).alias("v"))
                 .join(hot.select(F.col("fp").alias("v")), "v", "left_semi").select("u", "v"))
    else:
        stars = hot.select(F.col("fp").alias("u"), F.col("fp").alias("v"))
    out = stage(pairs.unionByName(stars).where("u <> v").distinct(), "golay_links")
    release(multi)
    return out


def fingerprint_roots(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, root)`` for every distinct fingerprint."""
    distinct = fps.select("fp").distinct()
    found = links(distinct, max_bits)
    labels = connected_components(found)
    release(found)
    return (distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id``: the smallest id reachable over
    links between fingerprints (see the module text for nulls and ties)."""
    rows = stage(with_fingerprint(df.select(F.col(doc_id).alias("doc_id"),
                                            F.col(text).alias("text")),
                                  ["doc_id"], "text", shingle_words), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp_nodes")
    rooted = stage(fingerprint_roots(nodes, max_bits).join(nodes, "fp"), "fp_roots")
    comp = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(comp, "root").select("fp", "component_id")
    return (rows.join(by_fp, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` with the smallest id of each component, all columns
    kept; exactly one row per component also where ids repeat or are null."""
    rid, fp = fresh(df, "_rid"), "fp"
    named = df.withColumn(rid, F.monotonically_increasing_id())
    # The row numbers are written with the rows, so every later read sees the same ones.
    rows = stage(named, "numbered")
    marks = stage(with_fingerprint(
        rows.select(F.col(doc_id).alias("id"), F.col(rid).alias("rid"), F.col(text).alias("text")),
        ["id", "rid"]), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("first")
    nodes = stage(marks.groupBy(fp).agg(first), "fp_nodes")
    kept = (fingerprint_roots(nodes).join(nodes, fp).groupBy("root").agg(F.min("first").alias("first"))
            .select(F.col("first.rid").alias(rid)))
    return rows.join(kept, rid, "left_semi").drop(rid)
