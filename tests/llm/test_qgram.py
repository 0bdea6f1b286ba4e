import random

import pytest
from flowstrata.llm.qgram import (ItemIndex, LeakFinder, align, edit_budget, find_leaks, folded, leaked_pairs, normalised, qgram_codes,
                                  without_leaks)
import numpy as np


def plain_distance(item, text):
    """Fewest edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def mutate(rng, x, edits):
    x = bytearray(x)
    for _ in range(edits):
        j, kind = rng.randrange(len(x)), rng.random()
        if kind < 0.34:
            x[j] = rng.choice(b"abcxyz ")
        elif kind < 0.67:
            del x[j]
        else:
            x.insert(j, rng.choice(b"abcxyz "))
    return bytes(x)


def sentence(rng, n):
    return b" ".join(b"".join(rng.choice([b"th", b"er", b"on", b"an", b"re", b"ti", b"en"]) for _ in range(rng.randint(1, 4)))
                     for _ in range(n))


def test_qgram_codes_are_equal_exactly_for_equal_grams():
    a = np.frombuffer(b"abracadabra abracadabra", np.uint8)
    for q in (3, 8, 10, 13):
        codes = qgram_codes(a, q)
        assert len(codes) == len(a) - q + 1
        for i in range(len(codes)):
            for j in range(len(codes)):
                assert (codes[i] == codes[j]) == (bytes(a[i:i + q]) == bytes(a[j:j + q]))
    assert len(qgram_codes(a[:4], 10)) == 0


def test_filter_and_alignment_against_brute_force():
    rng = random.Random(1)
    items = [sentence(rng, rng.randint(6, 40)) for _ in range(12)]
    index = ItemIndex(items, 10, 0.08)
    texts = []
    for k in range(120):
        x = items[k % len(items)]
        part = mutate(rng, x, rng.randint(0, 2 * max(1, int(index.budget[k % len(items)]))))
        texts.append(sentence(rng, rng.randint(0, 30)) + b" " + part + b" " + sentence(rng, rng.randint(0, 30)))
    found = find_leaks(index, texts)
    hits = 0
    for text, got in zip(texts, found):
        got = {i: e for i, e, _ in got}
        for i, x in enumerate(items):
            best = plain_distance(x, text)
            if best <= index.budget[i]:
                hits += 1
                assert got.get(i) == best
            else:
                assert i not in got
    assert hits > 50


def test_align_outside_of_the_text():
    assert align(b"abcdefghij", b"", -5, 10, 1) is None
    assert align(b"abcdefghij", b"abcdefghij", -3, 7, 1) == (0, 10)


def test_every_length_and_script_against_brute_force():
    """Items of 1 to 60 characters in three alphabets: the whole budget of
    8 % of the characters is found, short items as whole words only."""
    rng = random.Random(5)

    def words(letters, size):
        x = "".join(rng.choice(letters + "  ") for _ in range(2 * size + 9))
        return folded(x)[:size].strip() or letters[0]
    hits = edited = 0
    for letters in ("abcdefg", "бвгджзя", "語言模型資料集"):
        items = [words(letters, n) for n in range(1, 61)]
        finder = LeakFinder(items, 10, 0.08)
        texts = [""]
        for k in [*range(60)] * 4:
            x, budget = items[k], int(0.08 * len(items[k]))
            y = list(x)
            for _ in range(rng.randint(0, budget + 1)):
                y[rng.randrange(len(y))] = rng.choice(letters)
            texts.append(folded(words(letters, rng.randint(0, 40)) + rng.choice([" ", ""]) + "".join(y) + " " + words(letters, 12)))
        for text, got in zip(texts, finder.find(texts)):
            got = {i: e for i, e, _ in got}
            for i, x in enumerate(items):
                if len(x) < 10:
                    want = 0 if f" {x} " in f" {text} " else None
                else:
                    best = plain_distance(x, text)
                    want = best if best <= int(0.08 * len(x)) else None
                hits, edited = hits + (want is not None), edited + bool(want)
                assert got.get(i) == want, (x, text)
    assert hits > 600 and edited > 100


def test_short_items_never_match_and_budget():
    assert edit_budget(9) < 0 and edit_budget(10) == 0 and edit_budget(100) == 8
    assert find_leaks(ItemIndex([b"short"], 10, 0.08), [b"a short text that is long"]) == [[]]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_pairs_and_stage(spark, odd_docs, make_docs, block_bytes):
    rng = random.Random(3)
    passage = sentence(rng, 30).decode()
    other = sentence(rng, 25).decode()
    docs = odd_docs.unionByName(make_docs([(50, f"Intro. {passage.upper()}! End.", "en", "z"), (51, "clean text " * 30, "en", "z"),
                                           (52, f"{other}\n{passage}", "en", "z"), (50, passage, "en", "z")]))
    items = spark.createDataFrame([(1, passage), (2, other), (3, None), (4, ""), (None, passage), (5, "so it")],
                                  "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"] or 0, r["edits"]) for r in leaked_pairs(docs, items, block_bytes=block_bytes).collect())
    assert got == [(50, 0, 0), (50, 0, 0), (50, 1, 0), (50, 1, 0), (52, 0, 0), (52, 1, 0), (52, 2, 0)]
    kept = without_leaks(docs, items, block_bytes=block_bytes)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert normalised(None) == b""
    assert without_leaks(docs, items.where("false")).count() == docs.count()
    assert leaked_pairs(docs.where("false"), items).count() == 0


def test_short_items_as_whole_words(spark, make_docs):
    docs = make_docs([(1, "Say: SO, it goes", "en", "z"), (2, "so  it", "en", "z"), (3, "also it", "en", "z"), (4, "so item", "en", "z"),
                      (5, "", "en", "z"), (6, None, "en", "z"), (7, "что-то", "ru", "z"), (8, "so it so it", "en", "z")])
    items = spark.createDataFrame([(1, "So it"), (2, "то"), (3, "?!"), (None, "so  IT")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"] or 0, r["edits"], r["region_end"])
                 for r in leaked_pairs(docs, items, short_items=True).collect())
    assert got == [(1, 0, 0, 9), (1, 1, 0, 9), (2, 0, 0, 5), (2, 1, 0, 5), (7, 2, 0, 6), (8, 0, 0, 5), (8, 1, 0, 5)]
    kept = without_leaks(docs, items, short_items=True)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6]
    assert leaked_pairs(docs, items).count() == 0
