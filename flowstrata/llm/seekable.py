"""Token files: one zstandard frame per document with a trailing seek table.

A file holds, in ascending document order, one independent zstandard frame per
document (its token ids as little-endian unsigned 16- or 32-bit integers), an
index in a skippable frame (width, document ids) and the seek table of the
public zstd seekable format: for every frame its compressed size, its
decompressed size and the low 32 bits of the XXH64 of its content, closed by
the number of frames.  Any zstd tool can read the file as a whole; a reader
that wants some documents reads the last bytes, the table and the index, and
decompresses the frames of those documents only, each against its checksum.

Writing: the documents are range partitioned by id (ties by text hash and row
number, so one id of any number of rows is spread too) and every task streams
its sorted rows into one file in the shared folder, under a temporary name
until it is complete: a lost executor repeats its file.  The manifest has one
row a file.  A word is encoded once per worker and kept in a bounded memo:
the tokenizer drops white space, so the ids of a text are those of its blank-
separated pieces in order.

Cases: a null or empty text is the end id alone; null ids come first; repeated
ids keep one frame per row; an empty table has no files and no rows."""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path
from .common import worker_cached

# Fixed values of the zstd seekable format and of this file's index.
INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80
FOOTER, FOOTER_BYTES = "<IBI", 9      # frames, flags, magic number
INDEX_HEAD, INDEX_HEAD_BYTES = "<4sBQ", 13  # name, bytes of an id, documents

END_ID, LEVEL = 2, 3
_MEMO_WORDS, _MEMO_PIECES, _GROUP_BYTES = 900_000, 500_000, 4 << 20


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder as Spark names it."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


# ------------------------------------------------------------- encoding ----

class WordMemo:
    """Ids of texts by pieces: the tokenizer drops white space, so the ids of
    a text are those of its blank-separated pieces.  Pieces seen before come
    from a memo; others are cut into the tokenizer's own words (lower-cased
    letter runs, digits, symbol runs), of which only new ones are encoded by
    the tokenizer.  Both memos are bounded: once full they keep what they have."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        # How the vocabulary's pre-tokenizer splits lower-cased text.
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _words(self, piece: str) -> list[str]:
        """The tokenizer's words; the piece itself where its normalizer does
        more than lower-casing (special tokens, other scripts, marks)."""
        if piece.isascii():
            if piece.isalpha():  # one letter run
                return [piece.lower()]
            if "<|" in piece:
                return [piece]
        elif "<|" in piece or max(piece) >= "\u0300":
            return [piece]
        return self.split(piece.lower())

    def _encode_new(self, pieces: set[str]) -> dict[str, bytes]:
        cut = {p: self._words(p) for p in pieces}
        known = self.words
        new = list(set(chain.from_iterable(cut.values())).difference(known))
        ids: dict[str, bytes] = {}
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                found = e.ids
                ids[w] = struct.pack(f"<{len(found)}{self.code}", *found)
        done = {p: b"".join([known[w] if w in known else ids[w] for w in ws]) for p, ws in cut.items()}
        if len(known) < _MEMO_WORDS:
            known.update(ids)
        if len(self.pieces) < _MEMO_PIECES:  # pieces of words seen before, which are likely to come again
            self.pieces.update((p, done[p]) for p, ws in cut.items() if ids.keys().isdisjoint(ws))
        return done

    def encode(self, texts: list[str | None]) -> list[bytes]:
        known = self.pieces.get
        cut = [(t or "").replace("\n", " ").split(" ") for t in texts]
        found = [list(map(known, p)) for p in cut]
        new = {w for p, f in zip(cut, found) if None in f for w, x in zip(p, f) if x is None}
        done = self._encode_new(new) if new else {}
        return [b"".join(f if None not in f else [done[w] if x is None else x for w, x in zip(p, f)])
                for p, f in zip(cut, found)]


def encoder(vocabulary: str) -> WordMemo:
    return worker_cached(f"words_{zlib.crc32(vocabulary.encode()):08x}", lambda: WordMemo(vocabulary))


# ------------------------------------------------------------ file parts ----

class Writer:
    """Writes the frames of one file to an open binary stream."""

    def __init__(self, out, width: int, level: int = LEVEL):
        self.out, self.width = out, width
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.table, self.ids, self.nulls = bytearray(), [], bytearray()

    def add(self, doc_id: int | None, content: bytes) -> None:
        frame = self.pack.compress(content)
        self.out.write(frame)
        self.table += struct.pack("<III", len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF)
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)

    def close(self) -> None:
        index = struct.pack(INDEX_HEAD, b"TOKS", self.width, len(self.ids)) + self.pack.compress(
            np.array(self.ids, "<i8").tobytes() + bytes(self.nulls))
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.table += struct.pack("<III", len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        frames = len(self.table) // 12
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(self.table) + FOOTER_BYTES) + self.table
                       + struct.pack(FOOTER, frames, CHECKSUM_FLAG, FOOTER_MAGIC))


class Reader:
    """Random access to one file: ``ids`` (None for null), ``sizes`` and
    :meth:`document`, which reads and checks one frame."""

    def __init__(self, stream, size: int):
        self.stream = stream
        stream.seek(size - FOOTER_BYTES)
        frames, flags, magic = struct.unpack(FOOTER, stream.read(FOOTER_BYTES))
        if magic != FOOTER_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a seekable file with checksums")
        stream.seek(size - FOOTER_BYTES - 12 * frames - 8)
        magic, length = struct.unpack("<II", stream.read(8))
        if magic != SEEK_MAGIC or length != 12 * frames + FOOTER_BYTES:
            raise ValueError("broken seek table")
        table = np.frombuffer(stream.read(12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.sizes, self.sums = table[:-1, 0], table[:-1, 1], table[:-1, 2]
        self.offsets = np.concatenate(([0], np.cumsum(self.packed)))
        stream.seek(int(self.offsets[-1]))
        magic, length = struct.unpack("<II", stream.read(8))
        if magic != INDEX_MAGIC:
            raise ValueError("broken index")
        head = stream.read(INDEX_HEAD_BYTES)
        _, self.width, n = struct.unpack(INDEX_HEAD, head)
        self.unpack = zstandard.ZstdDecompressor()
        raw = self.unpack.decompress(stream.read(length - INDEX_HEAD_BYTES), max_output_size=9 * n + 1)
        ids, nulls = np.frombuffer(raw[:8 * n], "<i8"), raw[8 * n:]
        self.ids = [None if z else int(i) for i, z in zip(ids, nulls)]

    def content(self, k: int, frame: bytes) -> bytes:
        data = self.unpack.decompress(frame, max_output_size=int(self.sizes[k]) + 1)
        if len(data) != self.sizes[k] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"checksum of frame {k} does not match")
        return data

    def document(self, k: int) -> np.ndarray:
        """Token ids of document ``k`` of the file; reads that frame only."""
        self.stream.seek(int(self.offsets[k]))
        return np.frombuffer(self.content(k, self.stream.read(int(self.packed[k]))), f"<u{self.width}")

    def documents(self, piece: int = 4 << 20):
        """All documents in order, read in pieces of bounded size."""
        k = 0
        while k < len(self.ids):
            to = max(k + 1, int(np.searchsorted(self.offsets, self.offsets[k] + piece, "right")) - 1)
            self.stream.seek(int(self.offsets[k]))
            data = self.stream.read(int(self.offsets[to] - self.offsets[k]))
            for j in range(k, to):
                a = int(self.offsets[j] - self.offsets[k])
                yield self.ids[j], np.frombuffer(self.content(j, data[a:a + int(self.packed[j])]), f"<u{self.width}")
            k = to


# ------------------------------------------------------------ Spark jobs ----

def _write_part(batches: Iterable[pa.RecordBatch], folder: str, vocabulary: str, end_id: int):
    memo = encoder(vocabulary)
    end = np.array([end_id], memo.dtype).tobytes()
    task = TaskContext.get()
    fs, path = file_system(folder)
    name = f"part-{task.partitionId():06d}.tok.zst"
    unfinished = f"{path}/.{name}.{task.taskAttemptId()}"
    docs = tokens = 0
    out = writer = None
    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1)
        at = 0
        while at < len(ids):
            group, held = [], 0
            while at + len(group) < len(ids) and held < _GROUP_BYTES:
                group.append(texts[at + len(group)].as_py())
                held += len(group[-1] or "")
            if writer is None:
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(unfinished)
                writer = Writer(out, memo.width)
            for doc_id, content in zip(ids[at:at + len(group)], memo.encode(group)):
                writer.add(doc_id, content + end)
                docs += 1
                tokens += len(content) // memo.width + 1
            at += len(group)
    if writer is not None:
        writer.close()
        out.close()
        fs.move(unfinished, f"{path}/{name}")
        yield pa.RecordBatch.from_pydict({"file": [name], "docs": [docs], "tokens": [tokens]})


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID,
                      files: int | None = None) -> list[tuple[str, int, int]]:
    """Write ``doc_id, text`` in ascending ``doc_id`` order; returns the
    manifest ``(file, documents, tokens)`` in file order, one entry a file."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"),
                       F.monotonically_increasing_id().alias("row"))
    order = ("doc_id", "tie", "row")
    ranged = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    written = ranged.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(
        lambda it: _write_part(it, folder, vocabulary, end_id), "file string, docs long, tokens long")
    return sorted((r["file"], r["docs"], r["tokens"]) for r in written.collect())


def read_token_files(spark: SparkSession, folder: str, manifest: list[tuple[str, int, int]]) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, one task a file."""
    starts = np.concatenate(([0], np.cumsum([m[2] for m in manifest], dtype=np.int64))).tolist()
    names = [m[0] for m in manifest]

    def read(batches):
        fs, path = file_system(folder)
        for b in batches:
            for k in b.column(0).to_pylist():
                at = starts[k]
                rows = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                where = f"{path}/{names[k]}"
                with fs.open_input_file(where) as stream:
                    for doc_id, ids in Reader(stream, fs.get_file_info(where).size).documents():
                        rows["doc_id"].append(doc_id)
                        rows["start"].append(at)
                        rows["n_tokens"].append(len(ids))
                        rows["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                        at += len(ids)
                        if len(rows["start"]) >= 20_000:
                            yield pa.RecordBatch.from_pydict(rows, schema=schema)
                            rows = {c: [] for c in rows}
                yield pa.RecordBatch.from_pydict(rows, schema=schema)

    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])
    tasks = spark.range(0, len(manifest), 1, max(1, len(manifest)))
    return tasks.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Encode, write, read back: one row per document (see the module text)."""
    spark = docs.sparkSession
    folder = staging_path(spark, f"tokens-{uuid.uuid4().hex[:6]}")
    return read_token_files(spark, folder, write_token_files(docs, folder, vocabulary, end_id))
