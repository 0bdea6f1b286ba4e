"""Alignment of two tokenizers by lockstep merging of their byte ends.

Every text is encoded by a byte-level BPE (A, given space + text) and a
sentencepiece BPE with byte fallback (B, which adds the space itself).  The
tokens of both tile the same bytes, so their ends form two sorted lists.  A
state vector holds the A and B pointers of *all* documents of a batch; every
step emits the current A-B pair of each document as a link (their byte ranges
overlap), cuts the document where both tokens end at the same byte, advances
the pointer whose token ends first (both at a cut), and drops finished
documents from the vector.  A document of n_a and n_b tokens takes fewer than
n_a + n_b steps and has one link a step.

Encoding: merges never cross a blank between two other characters, nor a line
end there, so a text is cut at both and the pieces are looked up in a bounded
memo per worker; new pieces go to the tokenizers.  If the piece vocabulary had
an entry that spans such a place, texts would not be cut there.

Corpus counts: each document's distinct id pairs are staged as packed numbers
(at most one a link); tasks add them up before the shuffle, then Spark sums
per pair.  The most frequent pairs, at most ``BROADCAST_PAIRS`` of them, are
broadcast as sorted arrays; links of rarer pairs are looked up by a join, in
which no pair owns many rows because the frequent ones are gone.  Both ways
are exact and used alike at every size.

Cases: null or empty texts, and texts whose tokens of A or B do not give back
the bytes of space + text, have no tokens: all numbers are 0 and
``groups_sha256`` is ''.  Repeated rows and ids are rows of their own and all
count; a null id stays null; an empty table gives no rows; other columns are
not read."""

from __future__ import annotations

import hashlib
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import conf_override, release, stage
from .common import worker_cached

BROADCAST_PAIRS = 1_000_000  # most frequent id pairs that are broadcast
PAIR_BITS = 32  # a pair is A's id * 2^32 + B's id
_GROUP_BYTES, _MEMO_PIECES, _MEMO_CHARS, _FLUSH_PAIRS = 1 << 20, 500_000, 40, 1 << 18
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}  # rows hold whole texts and their links
_BLANK = "▁"  # sentencepiece's mark of a space
_LINE = "\n"  # begins a piece that follows a line end in place of a blank
_INNER_BLANK = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"\s\s|^\s|\s$")


def byte_alphabet() -> dict[str, int]:
    """Character to byte of the byte-level alphabet: printable Latin-1 bytes
    stand for themselves, the others follow from U+0100 in byte order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """The two tokenizers: ids of a text in both, and the bytes of every id."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        to_byte = byte_alphabet()
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab().items():
            self.a_bytes[i] = piece.encode() if i in special else bytes(map(to_byte.__getitem__, piece))
        self.b_bytes, inner = [], False
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            inner |= _BLANK in piece.lstrip(_BLANK)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace(_BLANK, " ").encode())
        self.cut = not inner
        # a line end is only ever a byte piece, so what follows it is encoded alike after any text
        self.lines = self.cut and not any(b"\n" in x and len(x) > 1 for x in self.b_bytes)
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        # decimal ids with what may follow them: ',' inside a group, '|' or ';' at its end
        self.names = np.array([f"{i}{e}".encode() for n, end in ((len(self.a_bytes), "|"), (len(self.b_bytes), ";"))
                               for i in range(n) for e in (",", end)], object)
        self.memo: dict[str, tuple[bytes, bytes, bool]] = {}

    def _new(self, pieces: list) -> dict:
        out = {}
        for at in range(0, len(pieces), 2048):
            part = pieces[at:at + 2048]
            plain = [p if isinstance(p, str) else p[0] for p in part]
            line = [isinstance(p, str) and p.startswith(_LINE) for p in part]
            a = self.a.encode_batch_fast([p if x else " " + p for p, x in zip(plain, line)], add_special_tokens=False)
            b = self.b.encode(plain, num_threads=1)
            for p, text, after, x, y in zip(part, plain, line, a, b):
                x, y = x.ids, y[1:] if after else y  # the blank that B puts in front is not there after a line end
                raw = (text if after else " " + text).encode()
                whole = (b"".join([self.a_bytes[i] for i in x]) == raw and b"".join([self.b_bytes[i] for i in y]) == raw)
                out[p] = (np.array(x, "<u4").tobytes(), np.array(y, "<u4").tobytes(), whole)
        known = self.memo
        if len(known) < _MEMO_PIECES:
            known.update((p, x) for p, x in out.items() if isinstance(p, str) and len(p) <= _MEMO_CHARS)
        return out

    def _pieces(self, text: str) -> list:
        if not text or not self.cut:
            return [(text,)] if text else []
        if not _OTHER_SPACE.search(text):
            return (text.replace(_LINE, " " + _LINE) if self.lines else text).split(" ")
        first, *rest = _INNER_BLANK.split(text)
        return [(first,), *rest]  # may begin with a line end of its own

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B per text; empty arrays if the bytes do not come back."""
        cut = [self._pieces(t) for t in texts]
        known = self.memo.get
        found = [list(map(known, c)) for c in cut]
        new = self._new(list({p for c, f in zip(cut, found) if None in f for p, x in zip(c, f) if x is None}))
        out = []
        for t, c, f in zip(texts, cut, found):
            if None in f:
                f = [new[p] if x is None else x for p, x in zip(c, f)]
            a = np.frombuffer(b"".join([x[0] for x in f]), "<u4").astype(np.int64)
            b = np.frombuffer(b"".join([x[1] for x in f]), "<u4").astype(np.int64)
            if not all([x[2] for x in f]):
                raw = (" " + t).encode()
                if (b"".join([self.a_bytes[i] for i in a.tolist()]) != raw
                        or b"".join([self.b_bytes[i] for i in b.tolist()]) != raw):
                    a = b = a[:0]
            out.append((a, b))
        return out


def lockstep(a_ids: np.ndarray, b_ids: np.ndarray, a_end: np.ndarray, b_end: np.ndarray,
             a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge the token ends of all documents at once.

    ``a_end``/``b_end``: byte ends inside the document of the concatenated
    tokens; ``a_first``/``b_first``: first token of every document and one past
    the last.  Returns the pair of every link (in document order), the links
    of each document, and for every A and B token whether a group ends there."""
    docs = len(a_first) - 1
    room = a_first + b_first  # more links than this no document has
    pairs = np.empty(int(room[-1]), np.int64)
    a_cut, b_cut = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
    n_links = np.zeros(docs, np.int64)
    left, right = a_ids << PAIR_BITS, b_ids
    doc = np.flatnonzero(a_first[1:] > a_first[:-1])
    a, b, stop, out = a_first[doc], b_first[doc], a_first[doc + 1], room[doc]
    step = 0
    while len(doc):
        x, y = a_end[a], b_end[b]
        pairs[out + step] = left[a] | right[b]
        cut = x == y
        a_cut[a], b_cut[b] = cut, cut  # the last value written is that of the step that leaves the token
        a = a + (x <= y)
        b = b + (y <= x)
        step += 1
        going = a < stop
        if not going.all():
            n_links[doc[~going]] = step
            doc, a, b, stop, out = doc[going], a[going], b[going], stop[going], out[going]
    keep = np.arange(len(pairs)) - np.repeat(room[:-1], np.diff(room)) < np.repeat(n_links, np.diff(room))
    return pairs[keep], n_links, a_cut, b_cut


def _ends(lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(lengths)))
    return total[1:] - np.repeat(total[first[:-1]], np.diff(first))


def align(tokenizers: Pair, texts: list[str]) -> dict[str, list]:
    """Per text: numbers of tokens, groups and links, digest of the groups,
    and the distinct pairs with how often the text has them (packed)."""
    ids = tokenizers.encode(texts)
    a_first = np.concatenate(([0], np.cumsum([len(a) for a, _ in ids]))).astype(np.int64)
    b_first = np.concatenate(([0], np.cumsum([len(b) for _, b in ids]))).astype(np.int64)
    a_ids = np.concatenate([a for a, _ in ids] + [np.zeros(0, np.int64)])
    b_ids = np.concatenate([b for _, b in ids] + [np.zeros(0, np.int64)])
    pairs, n_links, a_cut, b_cut = lockstep(a_ids, b_ids, _ends(tokenizers.a_len[a_ids], a_first),
                                            _ends(tokenizers.b_len[b_ids], b_first), a_first, b_first)
    # a token's place in its text's list of groups: tokens of its kind before it, and of the other kind in earlier groups
    a_done, b_done = np.concatenate(([0], np.cumsum(a_cut))), np.concatenate(([0], np.cumsum(b_cut)))
    b_start = np.concatenate(([0], np.flatnonzero(b_cut) + 1))  # first B token of each group
    a_stop = np.flatnonzero(a_cut) + 1  # one past the last A token of each group
    codes = np.empty(len(a_ids) + len(b_ids), np.int64)
    codes[np.arange(len(a_ids)) + b_start[a_done[:-1]]] = 2 * a_ids + a_cut
    codes[np.arange(len(b_ids)) + (a_stop[b_done[:-1]] if len(b_ids) else 0)] = 2 * (len(tokenizers.a_bytes) + b_ids) + b_cut
    names = tokenizers.names[codes]
    at = np.concatenate(([0], np.cumsum(n_links)))
    out: dict[str, list] = {k: [] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")}
    for d in range(len(texts)):
        lo, hi = int(a_first[d] + b_first[d]), int(a_first[d + 1] + b_first[d + 1])
        own, times = np.unique(pairs[at[d]:at[d + 1]], return_counts=True)
        out["n_a"].append(int(a_first[d + 1] - a_first[d]))
        out["n_b"].append(int(b_first[d + 1] - b_first[d]))
        out["n_groups"].append(int(a_done[a_first[d + 1]] - a_done[a_first[d]]))
        out["n_links"].append(int(n_links[d]))
        out["groups_sha256"].append(hashlib.sha256(b"".join(names[lo:hi].tolist())[:-1]).hexdigest() if hi > lo else "")
        out["pairs"].append(own.astype("<i8").tobytes())
        out["times"].append(times.astype("<u4").tobytes())
    return out


_ALIGNED = ("doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs binary, times binary")
_ARROW = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                    ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())])


def aligned(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """``doc_id, row`` and the alignment of every ``(doc_id, row, text)``."""
    def run(batches):
        tokenizers = worker_cached(f"pair_{zlib.crc32(f'{a_file}|{b_file}'.encode()):08x}", lambda: Pair(a_file, b_file))
        for batch in batches:
            texts, at = batch.column(2), 0
            while at < batch.num_rows:
                group, held = [], 0
                while at + len(group) < batch.num_rows and held < _GROUP_BYTES:
                    group.append(texts[at + len(group)].as_py() or "")
                    held += len(group[-1])
                columns = align(tokenizers, group)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(group)), batch.column(1).slice(at, len(group)),
                     *(pa.array(columns[f.name], f.type) for f in list(_ARROW)[2:])], schema=_ARROW)
                at += len(group)
    return docs.mapInArrow(run, _ALIGNED)


def _added(batches):
    """Pairs of a task added up before the shuffle, in bounded memory."""
    held, times, size = [], [], 0

    def flush():
        pair, inverse = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(times)).astype(np.int64)
        held[:], times[:] = [pair], [total]
        return pair, total
    for batch in batches:
        for p, t in zip(batch.column(0), batch.column(1)):
            held.append(np.frombuffer(p.as_buffer(), "<i8"))
            times.append(np.frombuffer(t.as_buffer(), "<u4").astype(np.int64))
            size += len(held[-1])
            if size > 4 * _FLUSH_PAIRS:
                pair, total = flush()
                size = len(pair)
                if size > _FLUSH_PAIRS:
                    yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total)], names=["pair", "n"])
                    held, times, size = [], [], 0
    if held:
        pair, total = flush()
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total)], names=["pair", "n"])


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n, best``: links of each id pair in all documents, and whether
    no other pair of its B id has more."""
    counts = stage(rows.select("pairs", "times").mapInArrow(_added, "pair long, n long")
                   .groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << PAIR_BITS) - 1))
    # one row an id of the vocabulary of B: a proven bound
    top = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("top"))
    out = stage(counts.withColumn("b", b_id).join(F.broadcast(top), "b")
                .select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pair_best")
    release(counts)
    return out


def _frequent(counts: DataFrame, most: int) -> tuple[int, np.ndarray]:
    """The least count ``t`` with at most ``most`` pairs of ``t`` links or
    more, and those pairs, sorted, with their counts."""
    # counts by their size: one row a power of two
    sizes = {r["e"]: r["n"] for r in counts.groupBy(F.floor(F.log2("n")).alias("e")).agg(F.count("*").alias("n")).collect()}
    held, least = 0, 1 << (max(sizes, default=-1) + 1)
    for e in sorted(sizes, reverse=True):
        if held + sizes[e] > most:
            break
        held, least = held + sizes[e], 1 << e
    top = counts.where(F.col("n") >= least).toArrow()
    table = np.stack([top["pair"].to_numpy(), top["n"].to_numpy(), top["best"].cast(pa.int64()).to_numpy()])
    return least, table[:, np.argsort(table[0])]


_SCORED = _ALIGNED.replace("pairs binary, times binary", "n_best long, count_sum long, rest array<struct<pair:bigint,times:bigint>>")


def cross_tokenizer(docs: DataFrame, a_file: str, b_file: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` of every row (see the module text)."""
    spark = docs.sparkSession
    with conf_override(spark, _BATCHES):
        rows = stage(aligned(docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), "text"),
                             a_file, b_file), "aligned")
        counts = pair_counts(rows)
        least, table = _frequent(counts, broadcast_pairs)
        shared = spark.sparkContext.broadcast(table)
        schema = pa.schema([*list(_ARROW)[:7], ("n_best", pa.int64()), ("count_sum", pa.int64()),
                            ("rest", pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())])))])

        def score(batches):
            pair, n, best = shared.value
            for batch in batches:
                best_links, sums, rest = [], [], []
                for p, t in zip(batch.column(7), batch.column(8)):
                    own = np.frombuffer(p.as_buffer(), "<i8")
                    times = np.frombuffer(t.as_buffer(), "<u4").astype(np.int64)
                    k = np.minimum(np.searchsorted(pair, own), len(pair) - 1) if len(pair) else np.zeros(0, np.int64)
                    hit = pair[k] == own if len(pair) else np.zeros(len(own), bool)
                    k = k[hit] if len(pair) else k
                    best_links.append(int((times[hit] * best[k]).sum()))
                    sums.append(int((times[hit] * n[k]).sum()))
                    rest.append([{"pair": x, "times": y} for x, y in zip(own[~hit].tolist(), times[~hit].tolist())])
                yield pa.RecordBatch.from_arrays([*batch.columns[:7], *(pa.array(c, schema.field(i).type) for i, c in
                                                                        ((7, best_links), (8, sums), (9, rest)))], schema=schema)

        scored = stage(rows.mapInArrow(score, _SCORED), "scored")
    rare = (scored.select("row", F.explode("rest").alias("x")).select("row", "x.*")
            .join(counts.where(F.col("n") < least), "pair")
            .groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("more"),
                                F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")))
    release(rows)
    return (scored.drop("rest").join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256"))
