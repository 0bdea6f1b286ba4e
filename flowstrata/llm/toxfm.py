"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where x_i
marks that a hashed term occurs in the text.  Terms are the lower-cased words
and their first four and five bytes; the factors learn pairs (an insult next
to a group name), which additive weights miss.

Terms of the machine: every term with at least ``LEAST_ROWS`` rows of the
sample that shows any evidence, alone (two-proportion z of ``LEAST_Z`` or
more) or together with another word: two words at most ``WINDOW`` words apart
whose joint rows differ from what each word's own rows let expect, by
``PAIR_Z`` standard errors from both.  So a word that says nothing alone gets
factors if a partner makes it speak.  There is no limit on their number.  The
fit decides on the weights; a term's column is scaled by its evidence
(``z / FULL_Z``, at most 1; 1 for members of pairs), so weak terms are held
back like by a stronger ridge, and only terms of full scale get factors.

Fitting uses a bounded sample of labelled rows: at most ``PER_CLASS`` ids of
each label, the smallest by a hash of the id (the documented bound; it also
bounds what reaches the driver and the id list that is broadcast).  Scoring is
one narrow pass over the whole texts.

Cases: a text without a term of the machine (null and word-less texts too) has
no sign of toxicity and scores below 0.5; rows without an id, without a label
or with an id that is held out are never learned from; an id with several
labels counts as toxic if one of them is; with labels of one class only every
score is 0.0 or 1.0 (that class), with none it is 0.0."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, id_remainder, worker_cached

BITS, PER_CLASS, FACTORS, STEPS = 22, 4000, 6, 400
LEAST_ROWS, LEAST_Z, FULL_Z = 2, 3.0, 5.0  # evidence of a single term
WINDOW, PAIR_ROWS, PAIR_Z = 16, 12, 6.0  # evidence of a pair of words
RIDGE_W, RIDGE_V = 1e-4, 1e-4
_PAIR_BITS, _PAIR_CHUNK = 20, 250_000
_NO_SIGN = -1e-6  # largest log-odds of a text without a term
_MEMO_ENTRIES = 400_000

# ASCII punctuation and control characters separate words.
_SPACE = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> set[bytes]:
    return set((text or "").lower().encode("utf-8", "replace").translate(_SPACE).split())


def hashed_terms(word: bytes) -> tuple[int, ...]:
    """Hash buckets of one word: the word itself and its short prefixes."""
    mask = (1 << BITS) - 1
    out = [zlib.crc32(word) & mask]
    out += [zlib.crc32(word[:n], n) & mask for n in (4, 5) if len(word) > n]
    return tuple(out)


def document_terms(text: str | None) -> np.ndarray:
    found: set[int] = set()
    for w in words_of(text):
        found.update(hashed_terms(w))
    return np.array(sorted(found), np.int32)


def word_order(text: str | None) -> np.ndarray:
    """Hash buckets of the words of a text in their order."""
    mask, memo = (1 << BITS) - 1, {}
    words = (text or "").lower().encode("utf-8", "replace").translate(_SPACE).split()
    return np.array([memo.get(w) or memo.setdefault(w, zlib.crc32(w) & mask) for w in words], np.int32)


def _near_pairs(order: list[np.ndarray], window: int):
    """Chunks ``(document, pair)``: distinct pairs of different words at most
    ``window`` apart, both packed into one number."""
    held, owner, size = [], [], 0
    for d, seq in enumerate([*order, None]):
        if held and (seq is None or size > _PAIR_CHUNK):
            yield np.concatenate(owner), np.concatenate(held)
            held, owner, size = [], [], 0
        if seq is None:
            return
        seq = seq.astype(np.int64)
        parts = [(np.minimum(seq[k:], seq[:-k]) << BITS) | np.maximum(seq[k:], seq[:-k])
                 for k in range(1, min(window, len(seq) - 1) + 1)]
        if parts:
            pair = np.unique(np.concatenate(parts))
            pair = pair[(pair >> BITS) != (pair & ((1 << BITS) - 1))]
            held.append(pair)
            owner.append(np.full(len(pair), d))
            size += len(pair)


def paired_words(order: list[np.ndarray], labels: np.ndarray, rate: dict[int, float],
                 window: int = WINDOW) -> np.ndarray:
    """Words with a partner whose joint rows have another share of label 1
    than the rows (``rate``) of either alone."""
    def slot(pair):
        return ((pair * np.int64(-7046029254386353131)) >> np.int64(64 - _PAIR_BITS)) & ((1 << _PAIR_BITS) - 1)
    seen, toxic = np.zeros(1 << _PAIR_BITS, np.int32), np.zeros(1 << _PAIR_BITS, np.int32)
    with np.errstate(over="ignore"):
        for doc, pair in _near_pairs(order, window):  # counts per hash slot: no less than those of a pair
            k = slot(pair)
            seen += np.bincount(k, minlength=len(seen)).astype(np.int32)
            toxic += np.bincount(k[labels[doc] > 0], minlength=len(seen)).astype(np.int32)
        share = labels.mean()
        apart = np.abs(toxic - seen * share) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
        good = (seen >= PAIR_ROWS) & (apart >= PAIR_Z / 2)
        kept, hits = [], []
        for doc, pair in _near_pairs(order, window):  # exact counts of the pairs in those slots
            at = good[slot(pair)]
            kept.append(pair[at])
            hits.append(labels[doc[at]] > 0)
    if not kept:
        return np.zeros(0, np.int64)
    pair, inverse, rows = np.unique(np.concatenate(kept), return_inverse=True, return_counts=True)
    ones = np.bincount(inverse, weights=np.concatenate(hits))
    enough = rows >= PAIR_ROWS
    pair, rows, ones = pair[enough], rows[enough], ones[enough]
    apart = np.full(len(pair), np.inf)
    sides = (pair >> BITS, pair & ((1 << BITS) - 1))
    for side in sides:
        own = np.clip(np.array([rate[w] for w in side.tolist()]), 0.02, 0.98)
        z = (ones - rows * own) / np.sqrt(rows * own * (1 - own)) if len(pair) else apart
        apart = np.minimum(apart, np.abs(z))
    return np.unique(np.concatenate([side[apart >= PAIR_Z] for side in sides]))


@dataclass
class Model:
    index: dict[int, int]  # hash bucket -> row of the weights
    w0: float
    w: np.ndarray
    v: np.ndarray

    def score(self, rows: list[int]) -> float:
        if not rows:
            z = min(self.w0, _NO_SIGN)
        else:
            v = self.v[rows]
            total = v.sum(axis=0)
            z = self.w0 + self.w[rows].sum() + 0.5 * float((total * total - (v * v).sum(axis=0)).sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -35, 35))))


def fit(terms: list[np.ndarray], labels: np.ndarray, order: list[np.ndarray] | None = None,
        factors: int = FACTORS, steps: int = STEPS, seed: int = 7) -> Model:
    """Full-batch Adam on the logistic loss, both classes with equal weight in
    all.  ``terms``: the hashed terms of each row; ``order``: its words in
    their order (without it the terms count as near each other as they are
    listed)."""
    labels = np.asarray(labels, np.float32)
    pos, neg = int(labels.sum()), int(len(labels) - labels.sum())
    if not pos or not neg:
        z = 35.0 if pos else -35.0
        return Model({}, z, np.zeros(0), np.zeros((0, factors)))
    flat = np.concatenate(terms) if terms else np.zeros(0, np.int32)
    owner = np.repeat(np.arange(len(terms), dtype=np.int32), [len(t) for t in terms])
    rows, n1 = (np.bincount(flat, w, 1 << BITS) for w in (None, labels[owner]))
    buckets = np.flatnonzero(rows)
    rows, n1 = rows[buckets], n1[buckets]
    share = rows / len(labels)
    z = (np.abs(n1 / pos - (rows - n1) / neg)
         / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / pos + 1 / neg)))
    pairs = paired_words(terms if order is None else order, labels, dict(zip(buckets.tolist(), (n1 / rows).tolist())))
    paired = np.isin(buckets, pairs)
    chosen = np.flatnonzero(((z >= LEAST_Z) & (rows >= LEAST_ROWS)) | paired)
    scale = np.where(paired[chosen], 1.0, np.minimum(1.0, z[chosen] / FULL_Z)).astype(np.float32)
    column = np.full(1 << BITS, -1, np.int32)
    column[buckets[chosen]] = np.arange(len(chosen))
    x = np.zeros((len(labels), len(chosen)), np.float32)
    at = column[flat]
    hit = at >= 0
    x[owner[hit], at[hit]] = scale[at[hit]]
    del flat, owner, at, hit, column
    strong = np.flatnonzero(scale >= 1)  # only these pair up
    pairing = x[:, strong]
    rng = np.random.default_rng(seed)
    w0 = np.zeros(1, np.float32)
    w = np.zeros(len(chosen), np.float32)
    v = rng.normal(0, 0.02, (len(strong), factors)).astype(np.float32)
    params, moments = [w0, w, v], [(np.zeros_like(p), np.zeros_like(p)) for p in (w0, w, v)]
    weight = np.where(labels > 0, 0.5 / pos, 0.5 / neg).astype(np.float32)
    for step in range(1, steps + 1):
        s = pairing @ v
        logit = w0[0] + x @ w + 0.5 * ((s * s).sum(1) - pairing @ (v * v).sum(1))
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        g = ((p - labels) * weight).astype(np.float32)
        grads = [np.array([g.sum()], np.float32), x.T @ g + RIDGE_W * w,
                 pairing.T @ (g[:, None] * s) - (pairing.T @ g)[:, None] * v + RIDGE_V * v]
        for param, grad, (m, q) in zip(params, grads, moments):
            m += 0.1 * (grad - m)
            q += 0.01 * (grad * grad - q)
            param -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.99 ** step)) + 1e-8)
    factors_of = np.zeros((len(chosen), factors))
    factors_of[strong] = v
    return Model({int(buckets[c]): i for i, c in enumerate(chosen)}, float(w0[0]), (w * scale).astype(np.float64), factors_of)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
          folds: int = 5, held_out_fold: int = 0) -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    rest = id_remainder(F.col("doc_id"), folds)
    usable = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (rest != held_out_fold))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    picked = None
    for label in (0, 1):  # the ids of the sample, at most per_class each
        part = (usable.where(F.col("toxic") == label)
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class))
        picked = part if picked is None else picked.unionByName(part)
    wanted = {r["doc_id"]: r["toxic"] for r in picked.collect()}
    if not wanted:
        return fit([], np.zeros(0))
    spark = docs.sparkSession
    ids = spark.createDataFrame(list(wanted.items()), "doc_id long, toxic long")
    order = F.udf(lambda t: (lambda a, b: len(a).to_bytes(4, "little") + a.tobytes() + b.tobytes())(
        document_terms(t), word_order(t)), "binary")
    found = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
             .select("doc_id", "toxic", order("text").alias("v")))
    sample = bounded_sample(found, "toxic").toArrow().combine_chunks().sort_by("doc_id")
    held = [np.frombuffer(v.as_buffer(), np.int32) for v in sample.column("v")]
    both = [(v[1:], int(v[0])) for v in held]
    return fit([a[:n] for a, n in both], np.array([wanted[i] for i in sample.column("doc_id").to_pylist()]),
               [a[n:] for a, n in both])


def score_column(model: Model, text: Column) -> Column:
    """Score of each whole text as an Arrow-batched function."""
    index = model.index
    token = f"toxfm_{zlib.crc32(repr((sorted(index), model.w0)).encode()):08x}"

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        memo: dict[bytes, tuple[int, ...]] = worker_cached(token, dict)
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            rows: set[int] = set()
            for w in words_of(text):
                hit = memo.get(w)
                if hit is None:
                    hit = tuple(index[t] for t in hashed_terms(w) if t in index)
                    if len(memo) >= _MEMO_ENTRIES:
                        memo.clear()
                    memo[w] = hit
                if hit:
                    rows.update(hit)
            out[i] = model.score(sorted(rows))
        return pd.Series(out)

    return score(text)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    model = train(docs, labels)
    return (docs.select("doc_id", "text")
            .select("doc_id",
                    F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                    score_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int")))
