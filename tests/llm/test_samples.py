"""Training samples stay bounded when one id fills much of the table."""

import pytest
from flowstrata.llm import langid, linecrf, toxfm

WORDS = "ant bee cat dog eel fox gnu hen ibis jay kite lark".split()


def texts(n):
    return [" ".join(WORDS[(i >> k) % 12] for k in range(8)) + "\nx" * (i % 50) for i in range(n)]


@pytest.fixture
def crowded(make_docs):
    """Id 1 on 300 rows with texts of their own, 20 other ids once."""
    rows = [(1, t, "en", "a") for t in texts(300)]
    return make_docs(rows + [(i, t, "en", "a") for i, t in zip(range(2, 22), texts(20))])


@pytest.mark.parametrize("module, options", [
    (langid, {"per_lang": 10}), (linecrf, {"per_class": 10}), (toxfm, {"per_class": 10})])
def test_sample_of_a_crowded_id(spark, crowded, monkeypatch, module, options):
    got = []
    monkeypatch.setattr(module, "fit", lambda *a, **b: got.append(a[0]))
    labels = spark.createDataFrame([(i, 1, 1) for i in range(1, 22)], "doc_id long, quality int, toxic int")
    module.train(crowded, *([] if module is langid else [labels]), **options)
    sample = got[0]["en"] if module is langid else got[0]
    assert 0 < len(sample) <= 10
