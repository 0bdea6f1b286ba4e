import itertools
import random
import re
import tracemalloc

import numpy as np
import pytest
from flowstrata.llm.common import table
from flowstrata.llm.linecrf import (DEFAULT, FEATURES, Model, content_lines, crf_gradient, fit, judge, line_quality,
                                    repeat_words)


def plain_base(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
            len(words) < 20 or 100 * len(hit) > 30 * len(words))


def test_base_counts_by_definition():
    rng = random.Random(3)
    pieces = ["a", "b", "c", "é", "##", "|", "x\x1cy", "\n", " ", "\t", "\x0b", "\n\n", "\u00a0", "漢字"]
    for _ in range(300):
        text = "".join(rng.choice(pieces) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(0, 120)))
        assert judge(text, Model(DEFAULT, np.zeros((2, 2)), 0.0))[:6] == plain_base(text)
    assert judge(None, Model(DEFAULT, np.zeros((2, 2)), 0.0))[:7] == (0, 0, 0, 0, 0, True, False)


def test_repeat_words_of_overlapping_windows():
    assert repeat_words(["a"] * 9) == 9 and repeat_words(["a"] * 8) == 0
    w = list("abcdefgh")
    assert repeat_words(w + ["x"] + w) == 16


def paths(model, bits):
    def score(y):
        s = model.start * y[0] + sum(model.move[a, b] for a, b in zip(y, y[1:]))
        return s + sum(sum(w for i, w in enumerate(model.emission) if b >> i & 1) for b, v in zip(bits, y) if v)
    return {y: score(y) for y in itertools.product((0, 1), repeat=len(bits))}


def test_viterbi_and_likelihood_against_all_labellings():
    rng = np.random.default_rng(2)
    for _ in range(30):
        model = Model(rng.normal(size=len(FEATURES)), rng.normal(size=(2, 2)), float(rng.normal()))
        bits = rng.integers(0, 1 << len(FEATURES), rng.integers(1, 8)).tolist()
        all_paths = paths(model, bits)
        assert abs(all_paths[tuple(model.decode(bits))] - max(all_paths.values())) < 1e-9
        x = np.array([[[b >> i & 1 for i in range(len(FEATURES))] for b in bits]], float)
        y = rng.integers(0, 2, (1, len(bits)))
        loss = crf_gradient(x, y, np.ones((1, len(bits)), bool), model)[0]
        assert abs(loss - (np.logaddexp.reduce(list(all_paths.values())) - all_paths[tuple(y[0])])) < 1e-8


def test_gradient_by_differences():
    rng = np.random.default_rng(4)
    model = Model(rng.normal(size=len(FEATURES)), rng.normal(size=(2, 2)), 0.3)
    x = rng.integers(0, 2, (3, 5, len(FEATURES))).astype(float)
    mask = np.arange(5) < np.array([[5], [2], [3]])
    y = rng.integers(0, 2, (3, 5)) * mask
    x *= mask[:, :, None]
    loss, ge, gm, gs = crf_gradient(x, y, mask, model)
    for place, grad in [((model.emission, 2), ge[2]), ((model.move, (0, 1)), gm[0, 1]), ((model.move, (1, 1)), gm[1, 1])]:
        a, i = place
        a[i] += 1e-5
        assert abs((crf_gradient(x, y, mask, model)[0] - loss) / 1e-5 - grad) < 1e-3
        a[i] -= 1e-5
    model.start += 1e-5
    assert abs((crf_gradient(x, y, mask, model)[0] - loss) / 1e-5 - gs) < 1e-3


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    got = line_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))
    rows = got.join(table(spark, sf, "labels"), "doc_id").where("crc32(cast(doc_id as string)) % 5 = 0 and not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 1), (None, 0, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    rows = line_quality(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert [r["base_failed"] for r in rows if r["doc_id"] == 5] == [True]
    assert line_quality(odd_docs.where("false"), labels.where("false")).count() == 0
    out = content_lines(odd_docs, fit([]))
    assert out.count() == odd_docs.count()
    with pytest.raises(IndexError):
        Model(DEFAULT, np.zeros((2, 2)), 0.0).decode([1])[1]


def labelled(rng, lengths):
    return [(rng.choice([1, 17, 19, 3, 2049], n), i % 2) for i, n in enumerate(lengths)]


def test_fit_adds_the_gradients_of_blocks():
    documents = labelled(np.random.default_rng(6), [1, 40, 3, 7, 7, 25, 2, 60, 5, 11])
    one, many = fit(documents, steps=8), fit(documents, steps=8, cells=16)
    assert np.allclose(one.emission, many.emission, atol=1e-9) and np.allclose(one.move, many.move, atol=1e-9)
    assert abs(one.start - many.start) < 1e-9


def test_one_long_document_does_not_pad_the_others():
    documents = labelled(np.random.default_rng(7), [30_000] + [20] * 300)
    tracemalloc.start()
    fit(documents, steps=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # padded to the longest: 301 * 30,000 * 14 * 8 bytes = 1 GB
