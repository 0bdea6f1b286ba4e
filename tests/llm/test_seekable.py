import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from flowstrata.llm.seekable import Reader, WordMemo, Writer, token_files
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = ["Ñ <|endoftext|>x <|startoftext|> a", "a b ć ́x", "ΑΣ ΟΔΟΣ. İI ǅ", "  ", "", "a\x85b\x1cc\r\nd\x0b e\tf",
       "1234567 it's 'S don'T x²½ ª", "𝔘𝔫𝔦 🙂👍🏽 漢字", "é 각", "É<|x", "ſ's 'ſ K", "x" * 3000, "a\u00a0b\u2003c"]


def test_memo_equals_whole_texts():
    memo, plain = WordMemo(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    rng = random.Random(6)
    pool = list("abcÉéßſΣσ'’ \n\t\u0301²½٣漢<|>#!1") + [" the ", "n't", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(600)]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # with an empty and with a full memo
        assert [np.frombuffer(x, memo.dtype).tolist() for x in memo.encode(texts)] == want


def test_letter_runs_are_not_split():
    memo, plain = WordMemo(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    memo.split = None  # not called
    ids = plain.encode("Hello token FILES a", add_special_tokens=False).ids
    assert np.frombuffer(memo.encode(["Hello token FILES a"])[0], memo.dtype).tolist() == ids


@pytest.fixture
def written():
    docs = [(None, [2]), (-3, [5, 2]), (7, list(range(1000)) + [2]), (7, [2]), (9, [65535, 2])]
    out = io.BytesIO()
    w = Writer(out, 2)
    for i, ids in docs:
        w.add(i, np.array(ids, "<u2").tobytes())
    w.close()
    return docs, out.getvalue()


def test_round_trip_and_random_access(written):
    docs, data = written
    r = Reader(io.BytesIO(data), len(data))
    assert r.ids == [i for i, _ in docs]
    assert [(i, ids.tolist()) for i, ids in r.documents(piece=50)] == docs
    assert r.document(2).tolist() == docs[2][1] and r.document(0).tolist() == [2]


def test_reads_only_the_requested_frame(written):
    docs, data = written

    class Counting(io.BytesIO):
        got = 0

        def read(self, n=-1):
            x = super().read(n)
            self.got += len(x)
            return x

    stream = Counting(data)
    r = Reader(stream, len(data))
    before = stream.got
    r.document(4)
    assert stream.got - before == r.packed[4]


def test_any_zstd_tool_reads_the_whole(written):
    docs, data = written
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as s:
        assert s.read() == b"".join(np.array(ids, "<u2").tobytes() for _, ids in docs)


def test_damage_is_found(written):
    docs, data = written
    r = Reader(io.BytesIO(data), len(data))
    broken = bytearray(data)
    broken[int(r.offsets[2]) + 30] ^= 1
    bad = Reader(io.BytesIO(bytes(broken)), len(data))
    assert bad.document(1).tolist() == [5, 2]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        bad.document(2)


def test_files_against_the_tokenizer(spark, odd_docs, make_docs):
    docs = odd_docs.unionByName(make_docs([(100 + i, t, "en", "s") for i, t in enumerate(ODD)]))
    plain = Tokenizer.from_file(VOCABULARY)
    ids = {}
    for r in docs.collect():
        ids.setdefault(r["doc_id"], []).append(plain.encode(r["text"] or "", add_special_tokens=False).ids + [2])
    rows = sorted(token_files(docs, VOCABULARY).collect(), key=lambda r: r["start"])
    assert len(rows) == docs.count()
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        crcs = {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[r["doc_id"]]}
        assert (r["n_tokens"], r["ids_crc32"]) in crcs
    assert token_files(docs.where("false"), VOCABULARY).count() == 0
