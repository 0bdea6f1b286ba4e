import random

import numpy as np
from flowstrata.llm.toxfm import Model, document_terms, fit, toxicity, word_order


def fitted(texts, labels):
    return fit([document_terms(t) for t in texts], np.array(labels), [word_order(t) for t in texts])


def marked(model, texts):
    index = model.index
    return np.array([model.score([index[t] for t in document_terms(x).tolist() if t in index]) >= 0.5 for x in texts])


def noise(rng, kinds, n):
    return [f"n{rng.randrange(kinds)}" for _ in range(n)]


def test_label_of_the_pair_alone():
    """Insult and group agree or not: no single term says anything."""
    rng, texts, labels = random.Random(4), [], []
    for _ in range(1500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = noise(rng, 50, 20) + ["zzinsult" if insult else "friendly", "qqgroup" if group else "aaother"]
        rng.shuffle(words)
        texts.append(" ".join(words))
        labels.append(int(insult == group))
    got = marked(fitted(texts[:1000], labels[:1000]), texts[1000:])
    assert np.mean(got == np.array(labels[1000:])) > 0.95


def test_few_labels_do_not_mark_everything():
    rng = random.Random(2)
    for k in (5, 12, 40):
        texts = [" ".join(noise(rng, 300, 30) + ["badword"] * y) for y in [0, 1] * k]
        got = marked(fitted(texts, [0, 1] * k), [" ".join(noise(rng, 300, 30) + ["badword"] * y) for y in [0, 1] * 100])
        assert got[1::2].mean() > 0.95 and got[::2].mean() < 0.05
    # nothing to learn: no text has a sign of toxicity
    assert not marked(fitted(["a b", "c d", "a d", "c b"], [0, 1, 1, 0]), ["a", "zzz", ""]).any()


def test_rare_insults_are_found():
    rng = random.Random(3)
    rows = [(noise(rng, 5000, 60) + [f"q{j}insult"], 1) for j in range(200) for _ in range(10)]
    rows += [(noise(rng, 5000, 60), 0) for _ in range(2000)]
    model = fitted([" ".join(w) for w, _ in rows], [y for _, y in rows])
    assert marked(model, [" ".join(noise(rng, 5000, 60) + [f"q{j}insult"]) for j in range(200)]).mean() > 0.95
    assert marked(model, [" ".join(noise(rng, 5000, 60)) for _ in range(300)]).mean() < 0.02


def test_pairs_need_the_factors():
    """A label that holds only for two terms together is learned."""
    rng = random.Random(0)
    texts, labels = [], []
    for _ in range(1500):
        words = [f"n{rng.randrange(50)}" for _ in range(20)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["zzinsult"] * insult + ["qqgroup"] * group
        texts.append(" ".join(words))
        labels.append(int(insult and group))
    model = fit([document_terms(t) for t in texts[:1000]], np.array(labels[:1000]))
    index = model.index
    got = [model.score([index[t] for t in document_terms(x).tolist() if t in index]) >= 0.5 for x in texts[1000:]]
    assert np.mean(np.array(got) == np.array(labels[1000:])) > 0.97


def test_score_is_the_pairwise_sum():
    rng = np.random.default_rng(1)
    w, v = rng.normal(size=5), rng.normal(size=(5, 3))
    m = Model({}, 0.3, w, v)
    rows = [0, 2, 4]
    z = 0.3 + w[rows].sum() + sum(v[i] @ v[j] for a, i in enumerate(rows) for j in rows[a + 1:])
    assert abs(m.score(rows) - 1 / (1 + np.exp(-z))) < 1e-12


def test_held_out_quality(spark):
    from flowstrata.llm.common import table
    sf = "/root/testdata/sf0.1"
    got = toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")).join(table(spark, sf, "labels"), "doc_id")
    rows = got.where("held_out").select("predicted", "toxic").collect()
    hit = sum(r["predicted"] == 1 == r["toxic"] for r in rows)
    assert hit >= 0.85 * sum(r["toxic"] == 1 for r in rows)
    assert sum(r["predicted"] == 1 and r["toxic"] == 0 for r in rows) <= 0.01 * len(rows)


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (5, 1, 0), (None, 1, 1), (3, None, None), (99, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = toxicity(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    empty = toxicity(odd_docs, labels.where("false")).collect()
    assert all(r["score"] < 1e-9 for r in empty)
    assert toxicity(odd_docs.where("false"), labels).count() == 0
