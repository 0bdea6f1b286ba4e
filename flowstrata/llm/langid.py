"""Language by nearest centroid over TF-IDF n-gram vectors.

A text is lower-cased, everything but letters becomes a blank, and its one-,
two- and three-letter n-grams (word edges included) are counted in 2^14 hash
buckets.  A vector holds (1 + log count) * idf, scaled to length one.  Every
language has up to ``clusters`` centroids, found by spherical k-means, so that
registers or scripts of one language need not share a mean.  A text belongs to
the language of the centroid with the highest cosine; it is rejected if it is
farther from that centroid than all but ``reject_share`` of the rows that
formed it.

Learning: document frequencies are counted over all learnable rows in one
Spark pass.  The centroids are fitted on a bounded sample, at most
``per_lang`` rows of each language, the smallest by a hash of the id (this
bounds what reaches the driver).  Labels, sources and ids are never inputs of
a prediction.

Cases: a text that is null or has no letter is ``und`` with score 0.0 and
counts as rejected; rows with a null label or id are never learned from; with
nothing to learn from every text is ``und``; equal cosines go to the first
label in order."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, fresh, id_remainder, worker_cached

DIMS_BITS, PER_LANG, CLUSTERS, REJECT_SHARE, SEED = 14, 400, 4, 0.01, 3
DIMS = 1 << DIMS_BITS
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hash buckets of the n-grams of a text and their counts."""
    letters = worker_cached("letters", letter_table)
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    keep = letters[raw]
    if not keep.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.zeros(len(raw) + 2, np.uint64)  # zero: not a letter
    c[1:-1] = np.where(keep, raw, 0)
    one, two = c[1:-1], c[:-1] * np.uint64(0x1F3D5B79) + c[1:]
    three = two[:-1] * np.uint64(0x1F3D5B79) + c[2:]
    grams = np.concatenate([one[one > 0],
                            two[(c[:-1] > 0) | (c[1:] > 0)] + np.uint64(1 << 61),
                            three[c[1:-1] > 0] + np.uint64(1 << 62)])
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0x9E3779B97F4A7C15)
    counts = np.bincount((grams >> np.uint64(64 - DIMS_BITS)).astype(np.int64), minlength=DIMS)
    where = np.flatnonzero(counts)
    return where, counts[where]


@dataclass
class Model:
    langs: list[str]       # language of each centroid
    centroids: np.ndarray  # one row a centroid, length one
    floor: np.ndarray      # cosine below which the centroid rejects
    idf: np.ndarray

    def vector(self, where: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = (1 + np.log(counts)) * self.idf[where]
        return (v / np.linalg.norm(v)).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Nearest language, its cosine, and whether the text is rejected."""
        where, counts = ngram_counts(text)
        if not len(where) or not self.langs:
            return UNKNOWN, 0.0, True
        cosines = self.centroids[:, where] @ self.vector(where, counts)
        k = int(cosines.argmax())
        return self.langs[k], float(min(1.0, max(0.0, cosines[k]))), bool(cosines[k] < self.floor[k])


def spherical_kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12):
    """Centroids of length one and the cosine of every row to its own."""
    k = min(k, len(x))
    centroids = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = (x @ centroids.T).argmax(1)
        sums = np.stack([x[own == j].sum(0) if (own == j).any() else centroids[j] for j in range(k)])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    cosine = x @ centroids.T
    return centroids, cosine.argmax(1), cosine.max(1)


def fit(vectors: dict[str, list[tuple[np.ndarray, np.ndarray]]], df: np.ndarray, n: int,
        clusters: int = CLUSTERS, reject_share: float = REJECT_SHARE, seed: int = SEED) -> Model:
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    model = Model([], np.zeros((0, DIMS), np.float32), np.zeros(0), idf)
    rows, floors = [], []
    for lang in sorted(vectors):
        x = np.zeros((len(vectors[lang]), DIMS), np.float32)
        for i, (where, counts) in enumerate(vectors[lang]):
            x[i, where] = model.vector(where, counts)
        if not len(x):
            continue
        centroids, own, cosine = spherical_kmeans(x, clusters, np.random.default_rng(seed))
        for j in range(len(centroids)):
            if (own == j).any():
                model.langs.append(lang)
                rows.append(centroids[j])
                floors.append(float(np.quantile(cosine[own == j], reject_share)) - 1e-5)  # rounding
    if rows:
        model.centroids, model.floor = np.stack(rows).astype(np.float32), np.array(floors)
    return model


def _document_frequency(batches):
    """One row per bucket and task: in how many texts it occurs; bucket -1
    counts the texts."""
    total, n = np.zeros(DIMS, np.int64), 0
    for b in batches:
        for t in b.column(0):
            where, _ = ngram_counts(t.as_py())
            total[where] += 1
            n += bool(len(where))
    hit = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": np.append(hit, -1), "texts": np.append(total[hit], n)})


def train(docs: DataFrame, folds: int = 4, held_out_fold: int = 2, per_lang: int = PER_LANG,
          **options) -> Model:
    """Learn from rows with a label and an id outside the held-out fold."""
    learn = (docs.select("doc_id", "text", "lang")
             .where(F.col("lang").isNotNull() & (id_remainder(F.col("doc_id"), folds) != held_out_fold)))
    counted = (learn.select("text").mapInArrow(_document_frequency, "bucket long, texts long")
               .groupBy("bucket").agg(F.sum("texts").alias("texts")).collect())  # at most DIMS + 1 rows
    df, n = np.zeros(DIMS), 0
    for r in counted:
        if r["bucket"] < 0:
            n = r["texts"]
        else:
            df[r["bucket"]] = r["texts"]
    # The sample: of each language the per_lang smallest by a hash of the id.
    langs = [r["lang"] for r in learn.select("lang").distinct().orderBy("lang").collect()]
    picked = None
    for lang in langs:
        part = (learn.where(F.col("lang") == lang).select("doc_id", "lang").distinct()
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_lang))
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        return fit({}, df, n, **options)
    wanted = [(r["doc_id"], r["lang"]) for r in picked.collect()]
    ids = docs.sparkSession.createDataFrame(wanted, "doc_id long, lang string")

    @F.udf("binary")
    def counts_of(text):
        where, counts = ngram_counts(text)
        return np.concatenate([where, counts]).astype("<i4").tobytes()

    found = (learn.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")  # per_lang ids a language
             .select("doc_id", "lang", counts_of("text").alias("v")))
    rows = bounded_sample(found, "lang").collect()
    vectors: dict[str, list] = {}
    for lang, v in sorted((r["lang"], bytes(r["v"])) for r in rows):
        flat = np.frombuffer(v, "<i4").astype(np.int64)
        if len(flat):
            vectors.setdefault(lang, []).append((flat[:len(flat) // 2], flat[len(flat) // 2:]))
    return fit(vectors, df, n, **options)


def language_column(model: Model, text: Column) -> Column:
    """``struct(lang, score, rejected)`` of each whole text."""
    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score", "rejected"])

    return predict(text)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``language``: the nearest language, or ``und`` where the
    text is rejected; an input column of that name is replaced."""
    got = fresh(docs, "_got")
    return (docs.drop("language").withColumn(got, language_column(model, F.col("text")))
            .withColumn("language", F.when(F.col(got)["rejected"], UNKNOWN).otherwise(F.col(got)["lang"]))
            .drop(got))


def language_table(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``: the nearest language
    of every document, and whether the distance rule rejects it."""
    model = train(docs)
    return (docs.select("doc_id", "text")
            .select("doc_id", F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
                    language_column(model, F.col("text")).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.rejected"))
