import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from flowstrata.llm.crosstok import Pair, cross_tokenizer

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return Pair(A, B)


def tokens(pair, text):
    """Whole-text ids by the tokenizers themselves."""
    if not text:
        return [], []
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(pair.a_bytes[i] for i in a) != raw or b"".join(pair.b_bytes[i] for i in b) != raw:
        return [], []
    return a, b


def spans(ids, table):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(table[i]), i))
        at += len(table[i])
    return out


def brute(pair, rows):
    """All overlaps of byte ranges, pair by pair."""
    docs, total = [], Counter()
    for doc_id, text in rows:
        a, b = tokens(pair, text)
        sa, sb = spans(a, pair.a_bytes), spans(b, pair.b_bytes)
        links = [(x[2], y[2]) for x in sa for y in sb if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
        groups, last = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for s, e, i in sa if last < e <= c) + "|"
                          + ",".join(str(i) for s, e, i in sb if last < e <= c))
            last = c
        total.update(links)
        docs.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    best = {}
    for (_, b), n in total.items():
        best[b] = max(best.get(b, 0), n)
    return sorted((str(d), na, nb, ng, len(l), sum(total[x] == best[x[1]] for x in l), sum(total[x] for x in l),
                   hashlib.sha256(g.encode()).hexdigest() if na else "") for d, na, nb, ng, l, g in docs)


TEXTS = ["The quick brown fox's den.", "naïve café — déjà vu 漢字 🙂🙂", "tabs\tand\nlines\n\n  two  spaces   three ",
         " leading", "trailing ", "a", "<|endoftext|> and </s> <s> <0x41>", "▁x", "x\x1cy \x1d z", "  b　c",
         "", None, "ﬁne ½ Ⅷ", "1234567 8,9.10 foo'll don't", "é combined", "a \n b\n \nc", "word " * 300, "\r\n x"]


def test_against_all_overlaps(spark, pair):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, "null id"), (None, TEXTS[1])]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows],
                                 "doc_id long, text string, row int, n_a int, pairs string")
    expected = brute(pair, rows)
    for broadcast_pairs in (1_000_000, 40, 0):  # all pairs by broadcast, some or none of them
        got = cross_tokenizer(docs, A, B, broadcast_pairs).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == expected
    assert cross_tokenizer(docs.where("false"), A, B).count() == 0


def test_pieces_give_the_ids_of_whole_texts(pair):
    rng = random.Random(3)
    space = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    alphabet = ["a", "The", "é", "漢", "'s", "9", "<s>", ".", "▁", "​", *space, *[" "] * 30]
    lines = ["", "\n", "a\n", "\na", "a\nb", "\x00", "a\x00b\nc", "The end.\nThe fox's\n9 é\n漢", "a \nb", "a\n b", "a\n\nb", "x\n▁y\n z"]
    texts = lines + ["\n".join(["The", "a.", "é'll", "9,"][rng.randrange(4)] + rng.choice(["", " ok", " 漢"]) for _ in range(6)) for _ in range(300)]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for text, (a, b) in zip(texts, pair.encode(texts)):
        assert (a.tolist(), b.tolist()) == tuple(map(list, tokens(pair, text)))
