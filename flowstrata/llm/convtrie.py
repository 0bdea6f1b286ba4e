"""Prefix trie of conversations by fixed-length block hashing.

Conversations are cut into blocks of ``BLOCK_TURNS`` turns.  Round k groups
the conversations that share their first k blocks by the digest of the next
block: equal digests are one *variant*, whose members go on together.  A
conversation that is alone in its variant leaves the rounds, because the rest
of its turns is a plain chain; so there are as many rounds as blocks in the
longest prefix that two conversations share.  Turn boundaries are refined
afterwards and only where siblings diverge: a parent with one variant gives
its inner nodes directly, a parent with several has their turns grouped by
the digest of the prefix.

All work is on variants (distinct content), not on conversations: a third of
all conversations being copies is one variant.  Node sums over subtrees take
log2(depth) rounds of pointer doubling.  Joins on a node, which may be the
parent of a third of all rows, split hot keys.  The ids of the conversations
that end at a node are written as sorted chunks by range partitions, and a
digest reads the chunks of its node one after the other.

Rebuilt conversations: ``conv_id`` c starts with the first h turns of
conversation ``c - c % stride`` (h = crc32 of c as text, modulo ``spread``),
then come its own turns after the first h.

Cases: turns are ordered by turn (null first), then role, then text; null
role and text are empty; repeated rows are turns of their own; rows without a
``conv_id`` belong to no conversation and are left out; a conversation may
have no rebuilt turn and is then a member of the root only; an empty table
has no nodes, not even a root; other columns are not read."""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import split_join
from ..functions.ranking import ordinal_within
from ..session import release, stage

BLOCK_TURNS, STRIDE, SPREAD = 4, 20, 4
_CHUNK_IDS = 8192
_ROOT = ""


def rebuilt_turns(conversations: DataFrame, stride: int = STRIDE, spread: int = SPREAD) -> tuple[DataFrame, DataFrame]:
    """``(c, pos, n, td, words)`` per rebuilt turn (``td`` its digest, ``n``
    the turns of the conversation) and ``(c, n)`` per conversation; staged."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), "turn", role.alias("role"), text.alias("text"))
    ranked = ordinal_within(rows, ["c"], [F.col("turn").asc_nulls_first(), "role", "text"], "rank")
    own = stage(ranked.select(
        "c", "rank", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("td"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")), "own_turns")
    sizes = stage(own.groupBy("c").agg(F.count("*").alias("n_own")), "conversations")
    convs = (sizes.withColumn("base", F.col("c") - F.col("c") % stride)
             .withColumn("h", F.crc32(F.col("c").cast("string")) % spread)
             .join(sizes.select(F.col("c").alias("base"), F.col("n_own").alias("n_base")), "base", "left")
             .withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
             .withColumn("n", F.col("m") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))))
    convs = stage(convs.select("c", "base", "n_own", "h", "m", "n"), "conversations")
    heads = own.where(F.col("rank") < spread).withColumnRenamed("c", "base")  # spread - 1 turns a base at most
    borrowed = convs.join(heads, "base").where("rank <= h").select("c", F.col("rank").alias("pos"), "n", "td", "words")
    kept = (split_join(own, convs.select("c", "n_own", "h", "m", "n"), ["c"], "n_own", ["rank"])
            .where("rank > h").select("c", (F.col("rank") - F.col("h") + F.col("m")).alias("pos"), "n", "td", "words"))
    turns = stage(borrowed.unionByName(kept), "turns")
    release(own, sizes)
    return turns, convs.select("c", "n")


def _rounds(turns: DataFrame, convs: DataFrame, block_turns: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Variants of all blocks that conversations share, ``(key, c)`` of the
    conversations that end in them, and ``(c, n, upto)`` of those that go on
    alone after turn ``upto``."""
    blocks = stage(turns.groupBy("c", F.floor((F.col("pos") - 1) / block_turns).alias("block"))
                   .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "td", "words"))).alias("t")),
                   "blocks")  # block_turns turns at most
    keys = F.expr("slice(aggregate(t, array(node), (a, x) -> concat(a, array(md5(concat(element_at(a, -1), x.td))))), "
                  "2, size(t))")
    active = convs.where("n > 0").select("c", F.lit(_ROOT).alias("node"))
    variants, ends, alone, staged, k = [], [convs.where("n = 0").select(F.lit(_ROOT).alias("key"), "c")], [], [blocks], 0
    while True:
        done = block_turns * (k + 1)
        now = (active.join(blocks.where(F.col("block") == k), "c")
               .select("c", "node", "n", "t", F.md5(F.concat_ws(",", F.col("t.td"))).alias("d")))
        seen = stage(now.groupBy("node", "d").agg(F.count("*").alias("n_convs"), F.min("c").alias("conv_id"),
                                                  F.max("n").alias("n"), F.first("t").alias("t"))
                     .withColumn("keys", keys).withColumn("depth", F.lit(block_turns * k).cast("long"))
                     .withColumn("chain", (F.col("n_convs") == 1) & (F.col("n") > done)).drop("n"), "variants")
        ahead = stage(split_join(now.select("c", "node", "n", "d"),
                                 seen.select("node", "d", "n_convs", F.col("n_convs").alias("with"),
                                             F.element_at("keys", -1).alias("key")),
                                 ["node", "d"], "n_convs", ["c"]), "block_members")
        variants.append(seen)
        ends.append(ahead.where(F.col("n") <= done).select("key", "c"))
        alone.append(ahead.where((F.col("n") > done) & (F.col("with") == 1))
                     .select("c", "n", F.lit(done).cast("long").alias("upto")))
        staged.append(ahead)
        active = ahead.where((F.col("n") > done) & (F.col("with") > 1)).select("c", F.col("key").alias("node"))
        if active.isEmpty():
            break
        k += 1
    every = [stage(reduce(DataFrame.unionByName, frames), name)
             for frames, name in ((variants, "variants"), (ends, "conv_ends"), (alone, "conv_alone"))]
    release(*variants, *staged)
    return every[0], every[1], every[2]


def _turn_nodes(variants: DataFrame) -> DataFrame:
    """``(key, parent, depth, words, n_convs, conv_id, chain)`` per node below
    the root that rounds have seen."""
    def expanded(rows):
        return rows.select("n_convs", "conv_id", "chain", F.expr(
            "inline(transform(t, (x, i) -> named_struct('key', keys[i], 'parent', if(i = 0, node, keys[i - 1]), "
            "'depth', depth + i + 1, 'words', x.words, 'last', i = size(t) - 1)))")).withColumn(
                "chain", F.col("chain") & F.col("last")).drop("last")
    siblings = variants.groupBy("node").agg(F.count("*").alias("n")).withColumn("siblings", F.col("n"))
    marked = split_join(variants, siblings, ["node"], "n", ["d"])
    names = ["key", "parent", "depth", "words", "n_convs", "conv_id", "chain"]
    refined = (expanded(marked.where("siblings > 1")).groupBy("key", "parent", "depth", "words")
               .agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chain").alias("chain")))
    return expanded(marked.where("siblings = 1")).select(names).unionByName(refined.select(names))


def _subtree_sums(nodes: DataFrame, depth: int) -> DataFrame:
    """``(key, leaves, saved)``: own values of ``nodes`` (with ``parent``, null
    at the root) added up over subtrees.  After i rounds a node holds the sum
    of its descendants less than 2^i below and points 2^i up."""
    now, reach = stage(nodes.select("key", F.col("parent").alias("up"), "leaves", "saved"), "subtree"), 1
    while reach <= depth:
        below = (now.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("key"))
                 .agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"), F.count("*").alias("fan")))
        summed = stage(now.join(below, "key", "left").select(
            "key", "up", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), "fan"), "subtree_sums")
        hop = summed.where("fan > 0").select(F.col("key").alias("up"), "fan", F.col("up").alias("next"))
        after = stage(split_join(summed.drop("fan"), hop, ["up"], "fan", ["key"], "left")
                      .select("key", F.col("next").alias("up"), "leaves", "saved"), "subtree")
        release(now, summed)
        now, reach = after, 2 * reach
    return now.drop("up")


def _chunks(batches):
    """Sorted ``(key, c)`` to ``(key, first, ids)``: runs of a key as text."""
    key, ids = None, []
    schema = pa.schema([("key", pa.string()), ("first", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        out = []
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (k != key or len(ids) >= _CHUNK_IDS):
                out.append((key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = k
            ids.append(c)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in
                                          zip((key, ids[0], ",".join(map(str, ids))), schema)], schema=schema)


def _digests(batches):
    """Chunks in the order of key and first id to one digest a key."""
    key, digest = None, None
    for batch in batches:
        keys, shas = [], []
        for k, ids in zip(batch.column(0), batch.column(2)):
            k = k.as_py()
            if digest is not None and k == key:
                digest.update(b",")
            else:
                if digest is not None:
                    keys.append(key)
                    shas.append(digest.hexdigest())
                key, digest = k, hashlib.sha256()
            digest.update(ids.as_py().encode())
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.string()), "ends_sha256": pa.array(shas, pa.string())})
    if digest is not None:
        yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [digest.hexdigest()]})


def ends_digest(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` from ``(key, c)``."""
    chunks = (ends.repartitionByRange("key", "c").sortWithinPartitions("key", "c")
              .mapInArrow(_chunks, "key string, first long, ids string"))
    return (chunks.repartition("key").sortWithinPartitions("key", "first")
            .mapInArrow(_digests, "key string, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS, stride: int = STRIDE,
                spread: int = SPREAD) -> DataFrame:
    """One row per node of the trie: ``conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` (all defined in
    the module text and the operator's contract)."""
    turns, convs = rebuilt_turns(conversations, stride, spread)
    variants, ends, alone = _rounds(turns, convs, block_turns)
    root = (convs.agg(F.count("*").alias("n_convs"), F.min("c").alias("conv_id")).where("n_convs > 0")
            .select(F.lit(_ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
                    F.lit(0).cast("long").alias("words"), "n_convs", "conv_id", F.lit(False).alias("chain")))
    nodes = stage(_turn_nodes(variants).unionByName(root), "nodes")
    kids = nodes.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("kids"))
    nodes = stage(nodes.join(kids, "key", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
                  .withColumn("leaves", (F.col("kids") == 0).cast("long"))
                  .withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "nodes")
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    sums = _subtree_sums(nodes, depth)
    up = nodes.where("kids > 0").select(F.col("key").alias("parent"), "kids", F.col("conv_id").alias("parent_conv_id"))
    placed = split_join(nodes.select("key", "parent", "depth", "n_convs", "conv_id", "chain", F.col("kids").alias("own_kids")),
                        up, ["parent"], "kids", ["key"], "left")
    nobody = hashlib.sha256(b"").hexdigest()
    shared = (placed.join(sums, "key").join(ends_digest(ends), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", (F.col("own_kids") + F.col("chain").cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256")))
    # the turns a conversation has to itself: a chain with one member, whose last node is its leaf
    one, last = F.lit(1).cast("long"), F.col("pos") == F.col("n")
    chains = (split_join(turns.select("c", "pos", "n"), alone.withColumnRenamed("n", "_n"), ["c"], "_n", ["pos"])
              .where("pos > upto").select(
                  F.col("c").alias("conv_id"), F.col("pos").alias("depth"), F.col("c").alias("parent_conv_id"),
                  one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
                  F.lit(0).cast("long").alias("saved_tokens"),
                  F.when(last, F.sha2(F.col("c").cast("string"), 256)).otherwise(nobody).alias("ends_sha256")))
    return shared.unionByName(chains)


def oracle_sql(stride: int = STRIDE, spread: int = SPREAD) -> str:
    """The same table in DuckDB SQL, prefix by prefix."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), "
           "lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
           "lambda t, z: xor(t >> 1, (t & 1) * 3988292384))), 4294967295::BIGINT)")
    words = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
    return f"""
WITH own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
heads AS (SELECT c, {crc} % {spread} AS h, c - c % {stride} AS base FROM (SELECT DISTINCT c FROM own)),
borrowed AS (SELECT heads.c, own.r AS pos, role, text FROM heads JOIN own ON own.c = heads.base AND own.r <= h),
m AS (SELECT heads.c, h, coalesce(k, 0) AS k FROM heads LEFT JOIN (SELECT c, count(*) AS k FROM borrowed GROUP BY c) USING (c)),
turns AS (SELECT * FROM borrowed UNION ALL SELECT own.c, own.r - h + k, role, text FROM own JOIN m USING (c) WHERE own.r > h),
paths AS (SELECT c, pos, {words} AS words, string_agg(length(role) || ':' || length(text) || ':' || role || text, '|')
            OVER (PARTITION BY c ORDER BY pos) AS key FROM turns),
steps AS (SELECT c, pos, words, key, coalesce(lag(key) OVER (PARTITION BY c ORDER BY pos), '') AS parent,
                 pos = max(pos) OVER (PARTITION BY c) AS ends FROM paths
          UNION ALL SELECT c, 0, 0, '', NULL, NOT EXISTS (SELECT 1 FROM turns WHERE turns.c = heads.c) FROM heads),
nodes AS (SELECT key, pos AS depth, any_value(parent) AS parent, any_value(words) AS words, count(*) AS n_convs, min(c) AS conv_id,
                 sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
          FROM steps GROUP BY key, pos),
kids AS (SELECT parent AS key, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (SELECT up.key, up.pos AS depth, sum(CASE WHEN leaf AND low.conv_id = up.c THEN 1 ELSE 0 END) AS n_leaves,
                sum(CASE WHEN low.conv_id = up.c THEN low.saved ELSE 0 END) AS saved
         FROM steps AS up JOIN (SELECT s.c, s.pos, n.conv_id, k.n IS NULL AS leaf, (n.n_convs - 1) * n.words AS saved
                                FROM steps s JOIN nodes n ON n.key = s.key AND n.depth = s.pos LEFT JOIN kids k ON k.key = s.key) AS low
           ON low.c = up.c AND low.pos >= up.pos GROUP BY up.key, up.pos)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.key = n.key AND s.depth = n.depth
LEFT JOIN kids k ON k.key = n.key LEFT JOIN nodes p ON p.key = n.parent"""
