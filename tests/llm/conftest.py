import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, _row long, shard int, fp long, mix_slot int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names clash with the operators' own."""
    def make(rows):
        full = [(i, t, l, s, None if t is None else len(t), 0.5, 7, 3, 9, 1) for i, t, l, s in rows]
        return spark.createDataFrame(full, DOC)
    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and very long texts, repeated rows."""
    long_text = "so it goes on and on without an end " * 6000
    rows = [(1, "one two three four five", "en", "a"), (1, "one two three four five", "en", "a"),
            (2, None, "en", "a"), (None, "ein zwei drei vier", "de", None), (None, None, None, None),
            (3, "", "de", "b"), (4, "   \n\t ", None, "b"), (5, long_text, "en", "c"), (6, "12 34 !!", "en", "c"),
            (7, "ΑΣ ΟΔΟΣ \U0001F642 漢字 é", "el", "d"), (2**62, "x", "en", "e")]
    return make_docs(rows)
