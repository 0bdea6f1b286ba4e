"""Line sequence labelling: content or boilerplate by a linear-chain CRF.

Every line with a word gets binary features (length, sentence end, shares of
symbols, capitals, digits and list marks, license words, repeated line).  A
linear-chain conditional random field with two states scores the line
sequence; Viterbi decoding gives the best labelling, and a document is kept if
its base rules pass and at least ``KEEP_SHARE`` of its words are in content
lines.

Training: a bounded sample of documents with a quality label (at most
``per_class`` of each label, the smallest by a hash of the id).  A logistic
regression of the document's label on its lines' features labels the lines;
the CRF is then fitted to these line sequences by maximum likelihood
(forward-backward), so its transitions reflect how runs of such lines follow
each other.  Without labels of both kinds the fixed ``DEFAULT`` weights serve.

Cases: a null or word-less text has no lines, fails the base rules (fewer than
20 words) and is not kept; of equally good labellings the one that says
content is taken; scoring needs one narrow pass and no shuffle."""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, id_remainder

PER_CLASS, KEEP_SHARE, MIN_WORDS, WINDOW = 800, 0.5, 20, 8
#: Lines, padding included, that the fit holds in arrays at a time (unless one document has more).
CELLS = 1 << 14

FEATURES = ("bias", "words_1_2", "words_3_5", "words_over_30", "sentence_end", "symbols_02", "symbols_10",
            "capitals_30", "capitals_70", "digits_20", "bars", "shouts", "license", "repeated")
#: Used without training data: points for content, in the order of FEATURES.
DEFAULT = np.array([1.0, -0.8, -0.2, 0.5, 0.8, -1.5, -2.5, -1.0, -2.0, -1.5, -2.5, -2.0, -2.5, -2.0])
_LICENSE = re.compile(rb"licen[sc]e|copyright|all rights reserved|terms of (?:use|service)|privacy policy|cookies?\b",
                      re.IGNORECASE)
_SYMBOLS, _CAPITALS, _DIGITS = b"#*$%&|<>", bytes(range(65, 91)), b"0123456789"
_MULT = np.random.default_rng(8).integers(1, 1 << 62, WINDOW, dtype=np.int64) | 1


# ------------------------------------------------------------ base rules ----

def repeat_words(words: list) -> int:
    """Words in 8-word windows that occur twice or more (first included)."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words))
    with np.errstate(over="ignore"):
        h = sum(codes[j:j + n] * _MULT[j] for j in range(WINDOW))
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order][1:] == h[order][:-1])
    if not len(same):
        return 0
    twice = np.zeros(n, bool)
    for a, b in zip(order[same].tolist(), order[same + 1].tolist()):
        if words[a:a + WINDOW] != words[b:b + WINDOW]:  # a hash collision: count exactly
            return _repeat_words_exact(words, n)
        twice[a] = twice[b] = True
    return _covered(twice, len(words))


def _covered(starts: np.ndarray, words: int) -> int:
    step = np.zeros(words + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(step, at, 1)
    np.add.at(step, at + WINDOW, -1)
    return int((np.cumsum(step)[:words] > 0).sum())


def _repeat_words_exact(words: list, n: int) -> int:
    places: dict[tuple, list[int]] = {}
    for i in range(n):
        places.setdefault(tuple(words[i:i + WINDOW]), []).append(i)
    twice = np.zeros(n, bool)
    for p in places.values():
        if len(p) > 1:
            twice[p] = True
    return _covered(twice, len(words))


# ----------------------------------------------------------- line features ----

def line_features(lines: list[bytes]) -> tuple[list[int], list[int], int]:
    """Of the lines with a word: feature bits and number of words; and how
    many of them repeat an earlier line."""
    bits, sizes, repeats = [], [], 0
    seen: set[bytes] = set()
    for line in lines:
        words = line.split()
        if not words:
            continue
        n, length = len(words), sum(map(len, words))
        symbols = length - sum(map(len, (line.translate(None, _SYMBOLS)).split()))
        capitals = len(line) - len(line.translate(None, _CAPITALS))
        digits = len(line) - len(line.translate(None, _DIGITS))
        again = line in seen
        repeats += again
        seen.add(line)
        last = words[-1][-1:]
        flags = (True, n <= 2, 3 <= n <= 5, n > 30, last in b".!?\"", 50 * symbols >= length, 10 * symbols >= length,
                 10 * capitals >= 3 * length, 10 * capitals >= 7 * length, 5 * digits >= length,
                 5 * line.count(b"|") >= n, 5 * line.count(b"!!") >= n, _LICENSE.search(line) is not None, again)
        bits.append(sum(1 << i for i, f in enumerate(flags) if f))
        sizes.append(n)
    return bits, sizes, repeats


def _matrix(bits: np.ndarray) -> np.ndarray:
    return (bits[:, None] >> np.arange(len(FEATURES)) & 1).astype(np.float64)


# ------------------------------------------------------------------- CRF ----

@dataclass
class Model:
    """Log-linear scores: ``emission`` points for content per feature,
    ``move[a][b]`` from state a to b (0 boilerplate, 1 content), ``start``."""
    emission: np.ndarray
    move: np.ndarray
    start: float

    def decode(self, bits: list[int]) -> list[int]:
        """Viterbi labelling of a line sequence."""
        if not bits:
            return []
        memo: dict[int, float] = {}
        for b in set(bits):
            memo[b] = float(sum(w for i, w in enumerate(self.emission.tolist()) if b >> i & 1))
        (m00, m01), (m10, m11) = self.move.tolist()
        zero, one = 0.0, self.start + memo[bits[0]]
        back = []
        for b in bits[1:]:
            from0, from1 = m10 + one >= m00 + zero, m11 + one >= m01 + zero
            back.append((from0, from1))
            zero, one = (m10 + one if from0 else m00 + zero), (m11 + one if from1 else m01 + zero) + memo[b]
        state = int(one >= zero)
        labels = [state]
        for step in reversed(back):
            state = int(step[state])
            labels.append(state)
        return labels[::-1]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 300) -> np.ndarray:
    w = np.zeros(x.shape[1])
    m, q = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((p - y) * weight) + 1e-3 * w
        m += 0.1 * (g - m)
        q += 0.01 * (g * g - q)
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(q / (1 - 0.99 ** t)) + 1e-8)
    return w


def crf_gradient(x: np.ndarray, y: np.ndarray, mask: np.ndarray, model: Model):
    """Negative log-likelihood of padded sequences and its gradient; ``x`` is
    (sequences, lines, features), ``y`` and ``mask`` (sequences, lines)."""
    loss, excess, g_move, g_start = _forward_backward(x @ model.emission, y, mask, model)
    return loss, np.einsum("nt,ntf->f", excess, x), g_move, g_start


_SAME = np.array([[0.0, -np.inf], [-np.inf, 0.0]])


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices of log values."""
    return np.logaddexp(a[..., :, :1] + b[..., :1, :], a[..., :, 1:] + b[..., 1:, :])


def _prefix(steps: np.ndarray) -> np.ndarray:
    """Products of the first 1, 2, ... of (sequences, lines, 2, 2) matrices, in
    about twice the square root of the lines as many array operations."""
    n, length = steps.shape[:2]
    width = max(1, isqrt(length))
    out = np.empty((n, -(-length // width) * width, 2, 2))
    out[:, :length], out[:, length:] = steps, _SAME
    out = out.reshape(n, -1, width, 2, 2)
    for j in range(1, width):
        out[:, :, j] = _times(out[:, :, j - 1], out[:, :, j])
    for k in range(1, out.shape[1]):
        out[:, k] = _times(out[:, k - 1, -1:], out[:, k])
    return out.reshape(n, -1, 2, 2)[:, :length]


def _forward_backward(points: np.ndarray, y: np.ndarray, mask: np.ndarray, model: Model):
    """Of padded sequences with ``points`` for content per line: negative
    log-likelihood, expected minus given content of every line, and the
    gradients of the moves and of the start."""
    n, length = points.shape
    e = np.stack([np.zeros((n, length)), points], axis=2)
    # a line after the end leaves the scores as they are
    steps = np.where(mask[:, 1:, None, None], model.move + e[:, 1:, None, :], _SAME)
    alpha = np.empty((n, length, 2))
    alpha[:, 0] = e[:, 0] + np.array([0.0, model.start])
    alpha[:, 1:] = np.logaddexp.reduce(alpha[:, :1, :, None] + _prefix(steps), axis=2)
    total = np.logaddexp.reduce(alpha[:, -1], axis=1)
    beta = np.zeros((n, length, 2))
    beta[:, :-1] = np.logaddexp.reduce(_prefix(steps[:, ::-1].swapaxes(2, 3)), axis=2)[:, ::-1]
    both = mask[:, 1:]
    inner = (e + beta)[:, 1:, None, :]
    pair = (np.exp(alpha[:, :-1, :, None] + model.move + inner - total[:, None, None, None])
            * both[:, :, None, None]).sum((0, 1))
    content = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None]) * mask
    seen = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)])
    score = (e[:, :, 1] * y * mask).sum() + model.start * y[:, 0].sum() + (seen * model.move).sum()
    return total.sum() - score, content - y * mask, pair - seen, content[:, 0].sum() - y[:, 0].sum()


def _blocks(lengths: list[int], cells: int) -> list[list[int]]:
    """Sequences by length, in blocks that take at most ``cells`` lines when
    padded to their longest; a longer sequence is a block of its own."""
    out: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        if out and lengths[out[-1][0]] * (len(out[-1]) + 1) <= cells:
            out[-1].append(i)
        else:
            out.append([i])
    return out


def fit(documents: list[tuple[np.ndarray, int]], steps: int = 60, cells: int = CELLS) -> Model:
    """From (feature bits of the lines, quality label) of documents.

    A line counts by its feature bits alone, so no matrix over all lines is
    built; forward-backward runs over blocks of documents of about the same
    length (``cells`` padded lines at a time) and their gradients are added."""
    documents = [(np.asarray(b), q) for b, q in documents if len(b)]
    good = sum(q for _, q in documents)
    if not good or good == len(documents):
        return Model(DEFAULT.copy(), np.array([[1.0, 0.0], [0.0, 1.0]]), 0.0)
    kinds = _matrix(np.arange(1 << len(FEATURES)))
    # every document counts once, both labels the same in all
    weight = np.zeros((2, len(kinds)))
    for b, q in documents:
        weight[q] += np.bincount(b, minlength=len(kinds)) * (0.5 / len(b) / (good if q else len(documents) - good))
    label, kind = np.nonzero(weight)
    line = _logistic(kinds[kind], label, weight[label, kind])
    blocks = _blocks([len(b) for b, _ in documents], cells)
    content = kinds @ line > 0
    model = Model(line.copy(), np.zeros((2, 2)), 0.0)
    state = [np.zeros(len(FEATURES)), np.zeros(len(FEATURES)), np.zeros((2, 2)), np.zeros((2, 2))]
    n, lines = len(documents), sum(len(b) for b, _ in documents)
    for t in range(1, steps + 1):
        points = kinds @ model.emission
        by_kind, gm, gs = np.zeros(len(kinds)), np.zeros((2, 2)), 0.0
        for block in blocks:
            bits = np.zeros((len(block), len(documents[block[0]][0])), np.int64)
            mask = np.zeros(bits.shape, bool)
            for row, i in enumerate(block):
                b = documents[i][0]
                bits[row, :len(b)], mask[row, :len(b)] = b, True
            _, excess, move, start = _forward_backward(points[bits], content[bits] & mask, mask, model)
            by_kind += np.bincount(bits.ravel(), weights=excess.ravel(), minlength=len(kinds))
            gm, gs = gm + move, gs + start
        ge = by_kind @ kinds
        for p, g, m, q in ((model.emission, ge / lines + 1e-2 * (model.emission - line), state[0], state[1]),
                           (model.move, gm / lines + 1e-2 * model.move, state[2], state[3])):
            m += 0.1 * (g - m)
            q += 0.01 * (g * g - q)
            p -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(q / (1 - 0.99 ** t)) + 1e-8)
        model.start -= 0.05 * float(np.clip(gs / n, -1, 1))
    return model


# ------------------------------------------------------------ Spark jobs ----

def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = 5,
          held_out_fold: int = 0) -> Model:
    """Fit on labelled documents outside the held-out fold."""
    usable = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)
                           & (id_remainder(F.col("doc_id"), folds) != held_out_fold))
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    parts = [usable.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
             for q in (0, 1)]
    wanted = {r["doc_id"]: r["quality"] for r in parts[0].unionByName(parts[1]).collect()}
    if not wanted:
        return fit([])
    ids = docs.sparkSession.createDataFrame(list(wanted.items()), "doc_id long, quality long")

    @F.udf("binary")
    def bits_of(text):
        bits, _, _ = line_features((text or "").encode("utf-8", "replace").split(b"\n"))
        return np.array(bits, "<u2").tobytes()

    found = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
             .select("doc_id", "quality", bits_of("text").alias("v")))
    rows = sorted((r["doc_id"], bytes(r["v"])) for r in bounded_sample(found, "quality").collect())
    return fit([(np.frombuffer(b, "<u2"), wanted[i]) for i, b in rows])


def judge(text: str | None, model: Model) -> tuple:
    """Base counts and verdict of a whole text, and its lines' labels."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    blanks = sum(text.count(c) for c in " \t\n\r\x0b\x0c")
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    repeats = repeat_words(words)
    bits, sizes, dup = line_features(raw.split(b"\n"))
    failed = len(words) < MIN_WORDS or 100 * repeats > 30 * len(words)
    labels = model.decode(bits)
    content = sum(n for n, y in zip(sizes, labels) if y)
    share = content / len(words) if words else 0.0
    return (len(words), len(text) - blanks, symbols, dup, repeats, failed,
            not failed and share >= KEEP_SHARE, share, labels)


_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, content_share double")


def line_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and ``content_share`` of every document."""
    model = train(docs, labels)
    names = [c.split()[0] for c in _SCHEMA.split(", ")]

    def run(batches):
        for b in batches:
            rows = [judge(t.as_py(), model)[:-1] for t in b.column(1)]
            columns = list(zip(*rows)) if rows else [[] for _ in names[1:]]
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


def content_lines(docs: DataFrame, model: Model, name: str = "content") -> DataFrame:
    """``docs`` with the text of the lines labelled content (a null text stays null)."""
    @F.udf("string")
    def content(text):
        if text is None:
            return None
        lines = [x for x in text.split("\n") if x.encode("utf-8", "replace").split()]
        return "\n".join(x for x, y in zip(lines, judge(text, model)[-1]) if y)

    return docs.withColumn(name, content("text"))
