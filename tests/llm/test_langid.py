import numpy as np
from flowstrata.llm.common import table
from flowstrata.llm.langid import UNKNOWN, fit, identify, language_table, ngram_counts, train


def test_ngrams_by_hand():
    """Words are counted with their edges; digits and marks are blanks."""
    where, counts = ngram_counts("Ab1ab")
    again, same = ngram_counts("ab, AB!")
    assert (where == again).all() and (counts == same).all()
    # one-grams a b, two-grams " a" "ab" "b ", three-grams " ab" "ab ", each twice
    assert counts.sum() == 14 and set(counts.tolist()) <= {2, 4}
    assert len(ngram_counts(None)[0]) == len(ngram_counts("12 !? ٣")[0]) == 0


def test_nearest_centroid_against_brute_force():
    texts = {"aa": ["hello there world", "the world over there"], "bb": ["bonjour le monde", "le monde entier"]}
    vectors = {k: [ngram_counts(t) for t in v] for k, v in texts.items()}
    df = np.zeros(1 << 14)
    for v in vectors.values():
        for where, _ in v:
            df[where] += 1
    model = fit(vectors, df, 4, clusters=2)
    for text in ("the world", "monde", "hello bonjour hello", "zz"):
        where, counts = ngram_counts(text)
        x = np.zeros(1 << 14)
        x[where] = (1 + np.log(counts)) * (np.log(5 / (1 + df[where])) + 1)
        x /= np.linalg.norm(x)
        cosines = [float(c @ x) for c in model.centroids]
        lang, score, rejected = model.predict(text)
        assert lang == model.langs[int(np.argmax(cosines))] and abs(score - max(cosines)) < 1e-5
    assert model.predict("zz")[2] and not model.predict("hello there world")[2]
    assert model.predict("12") == (UNKNOWN, 0.0, True)


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    rows = language_table(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.98


def test_odd_rows(odd_docs):
    rows = language_table(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] is not None
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4)} == {UNKNOWN}
    assert language_table(odd_docs.where("false")).count() == 0
    unlabelled = language_table(odd_docs.where("lang is null"))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {UNKNOWN}
    out = identify(odd_docs, train(odd_docs))
    assert out.columns == [*odd_docs.columns, "language"] and out.count() == odd_docs.count()
