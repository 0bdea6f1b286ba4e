"""Jaccard join on word n-grams by rare-first prefix filtering.

A document's set are its distinct n-word shingles (64-bit hashes).  Two sets
are linked if ``100 |x & y| >= percent |x | y|``.  Sets are ordered from the
rarest shingle of the corpus to the most frequent; linked sets then share a
shingle in their prefixes of ``n - ceil(percent n / 100) + 1`` shingles.

1. Document frequencies, exact, over all documents: shingles are exchanged as
   packed arrays by ranges of the hash, cells of bounded size count them, and
   only shingles of two or more different sets come back, to their sets.  A
   shingle of one set cannot link anything; it only takes a place in front.
2. Sets whose prefix has no shared shingle are finished.  The others are
   written once, shared shingles in rare-first order; a posting per prefix
   shingle has the size, the place, and how many later shingles lie in each
   of eight hash cells.
3. Postings are joined on the shingle under the length filter
   (``min >= percent/100 max``), the positional filter (one match and what is
   left of the shorter rest) and the suffix filter (one match and the sum of
   the smaller cell counts must reach the needed overlap; exact at the first
   common shingle of a pair, hence no linked pair is lost).  In the join of all
   pairs a posting also has the least earlier prefix shingle in each of eight
   cells: two postings that agree in one are not the first of their pair.
4. Every surviving pair is verified once on the two sets.

The result are components, so pairs inside a component need no check.  A
first round links the sets of a few lists of each set, picked by least hashes,
to one pivot of the list.  While the pairs of different components in the
lists are many, more such rounds follow over all lists (linear in the
postings); then all pairs that are left between different components are
joined, in blocks of bounded size.  There is no cap: a list is finished when all its
members are in one component or all its remaining pairs have been judged.

Equal sets are one set from the first step on; documents follow their set.

Cases: null and word-less texts have an empty set and link with nothing;
fewer than n words make one shingle of the whole sequence; a null id takes
part, and a component of null ids only has a null ``component_id``; repeated
rows are equal sets; an empty table gives no rows; other columns are not
read.  Sets are equal where their 64-bit digests are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import split_join
from ..session import conf_override, release, stage
from .common import worker_cached
from .components import connected_components

NGRAM_WORDS, PERCENT = 5, 80
CELL_SHINGLES = 4_000_000  # shingles that one counting cell holds in memory
PICKS = 4  # lists per set in the first round
ROUND_COST = 24  # pairs left per posting up to which no more pivot rounds are worth while
_BATCH_SHINGLES, _MEMO_WORDS, _SUFFIX_CELLS, _BEFORE_CELLS, _BLOCK = 1_000_000, 400_000, 8, 8, 4096
_NONE = np.iinfo(np.int64).max  # no shingle in a cell
_MIX, _FINISH = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SMALL_FILES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}  # free a job's shuffle files with it


# -------------------------------------------------------------- shingles ----

class WordHashes(dict):
    """64-bit hash of a word, in a bounded memo."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 11)
        if len(self) < _MEMO_WORDS:
            self[word] = h
        return h


def shingles(text: str | None, n: int = NGRAM_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    memo = worker_cached("ngram_words", WordHashes)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    places = len(words) - width + 1
    with np.errstate(over="ignore"):
        out = np.full(places, width, np.uint64)
        for i in range(width):
            out = out * np.uint64(_MIX) + h[i:i + places]
        out ^= out >> np.uint64(32)
        out *= np.uint64(_FINISH)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def set_digest(s: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), len(s)))))


def _digests(batches, n):
    for b in batches:
        sets = [shingles(t.as_py(), n) for t in b.column(1)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_digest(s) for s in sets], pa.int64())],
            names=["doc_id", "n_shingles", "sid"])


def _packed(batches, n, cells):
    """Shingles of many documents, one row per counting cell: the sets, how
    many shingles each has in the cell, and the shingles one set after the other."""
    edges = np.array([(k << 64) // cells for k in range(1, cells)], np.uint64)
    held: dict[int, np.ndarray] = {}
    size = 0

    def rows():
        sids = np.array(list(held), np.int64)
        all_ = np.concatenate(list(held.values()))
        cell = np.searchsorted(edges, all_, "right")
        owner = np.repeat(np.arange(len(sids)), [len(s) for s in held.values()])
        order = np.lexsort((owner, cell))
        all_, cell, owner = all_[order], cell[order], owner[order]
        bounds = np.searchsorted(cell, np.arange(cells + 1))
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            lo, hi = bounds[k], bounds[k + 1]
            own, times = np.unique(owner[lo:hi], return_counts=True)
            yield pa.RecordBatch.from_pydict({"cell": pa.array([k], pa.int32()), "sids": [sids[own].tobytes()],
                                              "times": [times.astype("<u4").tobytes()], "shingles": [all_[lo:hi].tobytes()]})
    for b in batches:
        for t in b.column(0):
            s = shingles(t.as_py(), n)
            if len(s):
                sid = set_digest(s)
                if sid not in held:
                    held[sid] = s
                    size += len(s)
            if size >= _BATCH_SHINGLES:
                yield from rows()
                held, size = {}, 0
    if held:
        yield from rows()


def _binary(data: np.ndarray, counts: np.ndarray, width: int) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts * width))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _shared(table: pa.Table, bundles: int) -> pa.Table:
    """One counting cell: the shingles of two or more sets with their document
    frequencies, by bundles of sets."""
    def joined(name, kind):
        return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)] + [np.zeros(0, kind)])
    code = joined("shingles", "<u8")
    sid = np.repeat(joined("sids", "<i8"), joined("times", "<u4"))
    order = np.argsort(code, kind="stable")
    same = np.zeros(len(code), bool)  # not alone
    sorted_ = code[order]
    twice = sorted_[1:] == sorted_[:-1]
    same[1:] |= twice
    same[:-1] |= twice
    order = order[same]
    code, sid = code[order], sid[order]
    order = np.lexsort((sid, code))  # a set may come from several tasks: count it once
    code, sid = code[order], sid[order]
    first = np.ones(len(code), bool)
    first[1:] = (code[1:] != code[:-1]) | (sid[1:] != sid[:-1])
    code, sid = code[first], sid[first]
    _, inverse, df = np.unique(code, return_inverse=True, return_counts=True)
    df = df[inverse]
    keep = df > 1
    code, sid, df = code[keep], sid[keep], df[keep]
    bundle = (sid.view(np.uint64) >> np.uint64(1)).astype(np.int64) % bundles
    order = np.lexsort((sid, bundle))
    code, df, sid, bundle = code[order], df[order].astype("<u4"), sid[order], bundle[order]
    ids, counts = np.unique(bundle, return_counts=True)
    return pa.table({"bundle": pa.array(ids, pa.int64()), "sids": _binary(sid, counts, 8), "shingles": _binary(code, counts, 8),
                     "df": _binary(df, counts, 4)})


def _ordered(table: pa.Table, known: pa.Table, percent: int) -> pa.Table:
    """A bundle of sets: shared shingles of each in rare-first order; sets
    whose prefix has none of them are left out."""
    def joined(name, kind):
        return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)] + [np.zeros(0, kind)])
    sid, code, df = joined("sids", "<i8"), joined("shingles", "<u8"), joined("df", "<u4")
    known = np.stack([known.column("sid").to_numpy(), known.column("n").to_numpy()], axis=1)
    known = known[np.argsort(known[:, 0])]
    order = np.lexsort((code, df, sid))
    sid, code = sid[order], code[order]
    own, start, shared = np.unique(sid, return_index=True, return_counts=True)
    n = known[np.searchsorted(known[:, 0], own), 1]
    keep = n - shared < n + (-percent * n // 100) + 1
    return pa.table({"sid": pa.array(own[keep], pa.int64()), "n": pa.array(n[keep], pa.int64()),
                     "rare_first": pa.array([code[a:a + k].tobytes() for a, k in zip(start[keep], shared[keep])], pa.binary())})


# ------------------------------------------------------------- postings ----

_SUFFIX = [f"s{k}" for k in range(_SUFFIX_CELLS)]
_BEFORE = [f"b{k}" for k in range(_BEFORE_CELLS)]
_LIST = ["shingle", "sid", "root"]
_POSTING = [*_LIST, "n", "place", *_SUFFIX]


def _postings(batches, percent, names, picks=0):
    """Postings of the sets ``(sid, n, rare_first, root)``: of all prefix
    shingles that are shared, or of the ``picks`` of them with the least
    hashes (sets with like prefixes pick the same ones).  ``names`` are the
    columns wanted: of :data:`_LIST`, :data:`_POSTING` or that with
    :data:`_BEFORE`, the least earlier prefix shingle in each of some cells."""
    odd = [np.uint64((2 * k + 1) * _MIX & (1 << 64) - 1) for k in range(1, picks + 1)]
    for b in batches:
        cols: list[list[np.ndarray]] = [[] for _ in names]
        for sid, n, code, root in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
            code = np.frombuffer(code.as_buffer(), "<i8")
            first = n - len(code)
            k = min(len(code), n - -(-percent * n // 100) + 1 - first)
            at = np.arange(k)
            if picks:
                with np.errstate(over="ignore"):
                    at = np.unique([int(np.argmin(code[:k].view("<u8") * m >> np.uint64(20))) for m in odd])
            values = [code[at], np.full(len(at), sid), np.full(len(at), root)]
            if len(names) > len(_LIST):
                cell = (code >> 3) & (_SUFFIX_CELLS - 1)
                after = np.bincount(cell, minlength=_SUFFIX_CELLS) - np.cumsum(cell[:k, None] == np.arange(_SUFFIX_CELLS), axis=0)
                values += [np.full(len(at), n), first + at, *after[at].T]
            if len(names) > len(_POSTING):
                mine = (code[:k, None] >> 6) % _BEFORE_CELLS == np.arange(_BEFORE_CELLS)
                least = np.minimum.accumulate(np.where(mine, code[:k, None], _NONE), axis=0)
                values += np.concatenate((np.full((1, _BEFORE_CELLS), _NONE), least))[at].T.tolist()
            for c, x in zip(cols, values):
                c.append(x)
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in cols], names=names)


def _posted(tagged: DataFrame, percent: int, names: list[str], picks: int = 0) -> DataFrame:
    return tagged.mapInArrow(lambda it: _postings(it, percent, names, picks), ", ".join(f"{c} long" for c in names))


def _may_link(percent: int) -> Column:
    """Length, positional and suffix filter on the postings ``a`` and ``b``."""
    x, y = F.col("a.n"), F.col("b.n")
    least = F.ceil((x + y) * percent / (100 + percent))  # least overlap of linked sets of these sizes
    rest = F.lit(0)
    for s in _SUFFIX:
        rest = rest + F.least(F.col(f"a.{s}"), F.col(f"b.{s}"))
    return ((F.least(x, y) * 100 >= F.greatest(x, y) * percent)
            & (F.least(x - F.col("a.place"), y - F.col("b.place")) >= least) & (rest + 1 >= least))


def _met_before() -> Column:
    """Whether the sets of ``a`` and ``b`` are seen to share an earlier prefix
    shingle: their pair is found there too, at the first one by all means."""
    out = F.lit(False)
    for c in _BEFORE:
        out = out | ((F.col(f"a.{c}") == F.col(f"b.{c}")) & (F.col(f"a.{c}") != _NONE))
    return out


def _verified(batches, percent):
    for b in batches:
        keep = []
        for nu, nv, x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4), b.column(5)):
            x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
            both = np.sort(np.concatenate((x, y)))
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (nu + nv - shared))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of distinct ``(u, v)``, judged on the whole sets.  A
    pivot's many pairs are split."""
    out = pairs
    for side, name in (("u", "x"), ("v", "y")):
        uses = pairs.groupBy(F.col(side).alias("sid")).agg(F.count("*").alias("uses"))
        own = sets.join(uses, "sid").select(F.col("sid").alias(side), "uses", F.col("n").alias(f"n_{name}"),
                                            F.col("rare_first").alias(name))
        out = split_join(out, own, [side], "uses", ["u", "v"])
    return out.select("u", "v", "n_x", "n_y", "x", "y").mapInArrow(lambda it: _verified(it, percent), "u long, v long")


# ------------------------------------------------------------ components ----

def _lists(postings: DataFrame) -> DataFrame:
    """Posting lists with several components: members, the component with the
    most of them, and how many are outside it."""
    per = postings.groupBy("shingle", "root").agg(F.count("*").alias("k"))
    return (per.groupBy("shingle").agg(F.sum("k").alias("members"), F.max(F.struct("k", "root")).alias("top"))
            .withColumn("minor", F.col("members") - F.col("top.k")).where("minor > 0")
            .select("shingle", "members", "minor", F.col("top.root").alias("major")))


def _pairs(a: DataFrame, b: DataFrame, on: list[str], percent: int) -> DataFrame:
    met = a.alias("a").join(b.alias("b"), on).where((F.col("a.root") != F.col("b.root")) & _may_link(percent) & ~_met_before())
    return met.select(F.least("a.sid", "b.sid").alias("u"), F.greatest("a.sid", "b.sid").alias("v")).distinct()


def _star_pairs(open_: DataFrame, turn: int, percent: int) -> DataFrame:
    """Every member of a list with the list's pivot."""
    own = ["sid", "root", "n", "place", *_SUFFIX]
    pivot = (open_.groupBy("shingle").agg(F.min(F.struct(F.xxhash64("sid", F.lit(turn)).alias("_key"), *own)).alias("pivot"),
                                          F.count("*").alias("members")))
    met = split_join(open_.select("shingle", F.struct(*own).alias("a")), pivot.withColumnRenamed("pivot", "b"),
                     ["shingle"], "members", ["a.sid"])
    met = met.where((F.col("a.root") != F.col("b.root")) & _may_link(percent))
    return met.select(F.least("a.sid", "b.sid").alias("u"), F.greatest("a.sid", "b.sid").alias("v")).distinct()


def _rest_pairs(open_: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components in a list: members outside the
    largest component with all members, in blocks of both."""
    sized = split_join(open_, lists.withColumn("size", F.col("members")), ["shingle"], "members", ["sid"])
    rows, cols = F.ceil(F.col("minor") / _BLOCK).cast("int"), F.ceil(F.col("size") / _BLOCK).cast("int")
    left = (sized.where("root <> major").withColumn("i", F.pmod(F.xxhash64("sid"), rows).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), cols - 1))))
    right = (sized.withColumn("j", F.pmod(F.xxhash64("sid", F.lit(1)), cols).cast("int"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), rows - 1))))
    drop = ["size", "minor", "major"]
    return _pairs(left.drop(*drop), right.drop(*drop), ["shingle", "i", "j"], percent)


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``(sid, root)`` after new links between sets."""
    at = roots.select(F.col("sid").alias("u"), F.col("root").alias("ru"))
    lifted = (links.join(at, "u", "left").join(at.toDF("v", "rv"), "v", "left")
              .select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")))
    merged = connected_components(lifted).toDF("root", "top")
    touched = links.select(F.col("u").alias("sid")).union(links.select("v")).union(roots.select("sid")).distinct()
    return stage(touched.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
                 .join(merged, "root", "left").select("sid", F.coalesce("top", "root").alias("root")), "roots")


def set_components(sets: DataFrame, percent: int = PERCENT, round_cost: int = ROUND_COST,
                   history: list | None = None) -> DataFrame:
    """``(sid, root)`` for the sets ``(sid, n, rare_first)`` that are linked to
    others; ``history`` collects the kind, lists' cost, pairs and links of
    each round."""
    roots = stage(sets.select("sid", F.col("sid").alias("root")).where("false"), "roots")
    tried, turn, last = None, 0, float("inf")
    while True:
        tagged = sets.join(roots, "sid", "left").select("sid", "n", "rare_first", F.coalesce("root", "sid").alias("root"))
        final, cost, used = False, None, []
        if not turn:  # a few lists of every set first: they join large groups
            open_ = stage(_posted(tagged, percent, _POSTING, PICKS), "open")
            pairs = _star_pairs(open_, turn, percent)
        else:
            lists = stage(_lists(_posted(tagged, percent, _LIST)), "lists")
            used.append(lists)
            size = lists.agg(F.sum("members").alias("members"), F.sum(F.col("members") * F.col("minor")).alias("cost")).first()
            cost = size["cost"]
            if not cost:
                release(lists)
                break
            final = cost <= round_cost * size["members"] or cost > 0.7 * last
            last = cost
            postings = _posted(tagged, percent, [*_POSTING, *_BEFORE] if final else _POSTING)
            open_ = stage(split_join(postings, lists.select("shingle", "members"), ["shingle"], "members", ["sid"]), "open")
            pairs = _rest_pairs(open_, lists, percent) if final else _star_pairs(open_, turn, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["u", "v"], "left_anti")
        pairs = stage(pairs, "pairs")
        links = stage(verify(pairs, sets, percent), "links")
        if history is not None:
            history.append(("all" if final else "pivot", cost, pairs.count(), links.count()))
        after = _merged(roots, links)
        seen = stage(pairs if tried is None else tried.unionByName(pairs), "tried")
        release(open_, pairs, links, roots, *used, *([] if tried is None else [tried]))
        roots, tried, turn = after, seen, turn + 1
        if final:
            break
    release(tried)
    return roots


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ngram: int = NGRAM_WORDS,
                 percent: int = PERCENT, cell_shingles: int = CELL_SHINGLES, round_cost: int = ROUND_COST,
                 history: list | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row (see the module text)."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1 .. 100")
    spark = docs.sparkSession
    with conf_override(spark, _SMALL_FILES):
        rows = stage(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
                     .mapInArrow(lambda it: _digests(it, ngram), "doc_id long, n_shingles long, sid long"), "set_digests")
        whole = stage(rows.where("n_shingles > 0").groupBy("sid", F.col("n_shingles").alias("n"))
                      .agg(F.min("doc_id").alias("least"), F.count("*").alias("docs")), "sets")
        total = whole.agg(F.sum("n")).first()[0] or 0
        cells = max(1, -(-total // cell_shingles))
        packed = docs.select(F.col(text).alias("text")).mapInArrow(
            lambda it: _packed(it, ngram, cells), "cell int, sids binary, times binary, shingles binary")
        shared = packed.groupBy("cell").applyInArrow(
            lambda t: _shared(t, cells), "bundle long, sids binary, shingles binary, df binary")
        # a bundle has as many sets as there are to a cell, with what is shared of them
        of_bundle = whole.select("sid", "n", F.pmod(F.shiftrightunsigned("sid", 1), F.lit(cells)).alias("bundle"))
        sets = stage(shared.groupBy("bundle").cogroup(of_bundle.groupBy("bundle")).applyInArrow(
            lambda found, known: _ordered(found, known, percent), "sid long, n long, rare_first binary"), "rare_first")
        roots = set_components(sets, percent, round_cost, history)
        named = stage(whole.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid")), "set_roots")
        least = stage(named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n_sets")), "components")
        by_set = stage(split_join(named.select("sid", "docs", "root"), least, ["root"], "n_sets", ["sid"])
                       .select("sid", "docs", "component_id"), "set_components")
        release(whole, sets, roots, named, least)
    linked = split_join(rows, by_set, ["sid"], "docs", ["doc_id"], "left")
    return linked.select("doc_id", "n_shingles",
                         F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def oracle_sql(ngram: int = NGRAM_WORDS, percent: int = PERCENT) -> str:
    """The same table in DuckDB SQL: all pairs that share a shingle."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT r, doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
        ELSE list_transform(range(1, greatest(len(words) - {ngram - 1}, 1) + 1), lambda i: array_to_string(words[i:i + {ngram - 1}], ' ')) END) AS items FROM w),
sets AS (SELECT items, min(r) AS k, len(items) AS n FROM (SELECT r, list_sort(items) AS items FROM s) GROUP BY items),
tokens AS (SELECT k, n, unnest(items) AS t FROM sets),
pairs AS (SELECT a.k AS u, b.k AS v FROM tokens a JOIN tokens b ON a.t = b.t AND a.k < b.k
          GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
links AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach AS (SELECT k, k AS o FROM sets WHERE n > 0 UNION SELECT reach.k, links.v FROM reach JOIN links ON links.u = reach.o),
top AS (SELECT k, min(o) AS root FROM reach GROUP BY k),
member AS (SELECT s.r, s.doc_id, len(s.items) AS n, top.root FROM s JOIN sets ON sets.items = list_sort(s.items) LEFT JOIN top ON top.k = sets.k)
SELECT doc_id, n::BIGINT AS n_shingles,
       CASE WHEN n = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY CASE WHEN n = 0 THEN -r ELSE root END) END AS component_id
FROM member"""
