"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are lower-cased and reduced to words with single
blanks.  An item of L characters leaks into a text if a region of the text is
within ``e = floor(rate * L)`` edits of the whole item.  Such a
region shares at least ``L + 1 - q (e + 1)`` q-grams with the item on
diagonals (text position minus item position) that differ by at most ``e``.
So shared q-grams are counted in bands of ``2 (e + 1)`` diagonals that overlap
by half, bands that reach the bound are kept, and a banded alignment decides.
Items whose bound is not positive with ``q`` are indexed apart with shorter
q-grams, ``floor(L / (e + 1))`` characters, so the filter never loses a region
within the budget.  Items shorter than ``q`` characters allow no edit; with
``short_items`` they are matched exactly, as whole words.

The items are the query set: they go to the workers in blocks of at most
``block_bytes`` (a proven bound on what a task holds and on what is shipped);
more blocks mean more evaluations in the same pass over the texts.  Whole
texts are read once, nothing is shuffled.

Cases: null or empty texts have no leak; items that are null or without a
letter or digit, and those shorter than ``q`` characters without ``short_items``,
name no passage and never match; items with the same text are reported each; a null item id stays null in the result."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, worker_cached

Q, RATE, BLOCK_BYTES = 10, 0.08, 8 << 20
_BUFFER_BYTES, _CHUNK, _SLICE = 2 << 20, 1 << 16, 2_000_000
_SPACE = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_ODD = 0x9E3779B97F4A7C15


def normalised(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode("utf-8", "replace").translate(_SPACE).split())


def folded(text: str | None) -> str:
    """:func:`normalised` as characters."""
    return normalised(text).decode("utf-8")


def points(text: str | bytes) -> np.ndarray:
    """The characters (of bytes: the bytes) as numbers."""
    if isinstance(text, bytes):
        return np.frombuffer(text, np.uint8)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def edit_budget(length: int, q: int = Q, rate: float = RATE) -> int:
    """Edits of an item that q-grams of length ``q`` can find; negative if it
    is too short for them."""
    return min(int(rate * length), length // q - 1)


def gram_length(length: int, q: int = Q, rate: float = RATE) -> int:
    """The longest q-grams that find every region within ``rate`` edits."""
    return min(q, length // (int(rate * length) + 1))


def qgram_codes(a: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram of the characters ``a`` (by doubling)."""
    n = len(a) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power, base = {1: a.astype(np.uint64) + np.uint64(1)}, {1: np.uint64(_ODD)}
        w = 1
        while 2 * w <= q:
            x = power[w]
            power[2 * w] = x[:-w] * base[w] + x[w:]
            base[2 * w] = base[w] * base[w]
            w *= 2
        out, done = None, 0
        for w in sorted(power, reverse=True):
            if done + w <= q:
                part = power[w][done:done + n]
                out = part.copy() if out is None else out * base[w] + part
                done += w
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
    return out


class ItemIndex:
    """q-grams of a block of items: sorted codes with (item, offset) postings."""

    def __init__(self, items: list[str] | list[bytes], q: int, rate: float):
        self.items, self.q = items, q
        self.points = [points(x) for x in items]
        self.budget = np.array([edit_budget(len(x), q, rate) for x in items], np.int64)
        self.least = np.array([len(x) + 1 - q * (e + 1) for x, e in zip(items, self.budget)], np.int64)
        codes, item, offset = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, x in enumerate(items):
            if self.budget[k] >= 0:
                c = qgram_codes(self.points[k], q)
                codes.append(c)
                item.append(np.full(len(c), k))
                offset.append(np.arange(len(c)))
        code = np.concatenate(codes)
        order = np.argsort(code, kind="stable")
        self.item, self.offset = np.concatenate(item)[order], np.concatenate(offset)[order]
        self.code, self.start, self.count = np.unique(code[order], return_index=True, return_counts=True)
        self.bits = max(16, min(24, int(len(self.code)).bit_length() + 6))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.code >> np.uint64(64 - self.bits)] = True

    def hits(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the buffer whose q-gram is an item's, and its place."""
        where, which = [], []
        for at in range(0, len(buffer), _CHUNK):
            c = qgram_codes(buffer[at:at + _CHUNK + self.q - 1], self.q)
            p = np.flatnonzero(self.seen[c >> np.uint64(64 - self.bits)])
            k = np.searchsorted(self.code, c[p])
            k[k == len(self.code)] = 0
            real = self.code[k] == c[p]
            where.append(p[real] + at)
            which.append(k[real])
        return np.concatenate(where), np.concatenate(which)

    def bands(self, buffer: np.ndarray) -> list[tuple[int, int]]:
        """``(item, band)`` whose shared q-grams reach the item's bound."""
        if not len(self.code) or len(buffer) < self.q:
            return []
        where, which = self.hits(buffer)
        if not len(where):
            return []
        shift = len(buffer) + 1  # makes diagonals positive
        keys, counts = [], []
        ends = np.cumsum(self.count[which])
        at = 0
        while at < len(where):  # slices bound the memory of frequent q-grams
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _SLICE)))
            n = self.count[which[at:to]]
            post = np.repeat(self.start[which[at:to]], n) + (
                np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            item = self.item[post]
            step = self.budget[item] + 1
            band = (np.repeat(where[at:to], n) - self.offset[post] + shift) // step
            key = item * np.int64(1 << 40) + band
            k, c = np.unique(np.concatenate([key, key - 1]), return_counts=True)
            keys.append(k)
            counts.append(c)
            at = to
        k, inv = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inv, weights=np.concatenate(counts)).astype(np.int64)
        item = (k + 1) >> 40  # a band number is at least -1 after the shift by one
        good = total >= self.least[item]
        return [(int(i), int(x - (i << 40))) for i, x in zip(item[good], k[good])]


def align(item, region, lo: int, width: int, budget: int) -> tuple[int, int] | None:
    """Best ``(edits, end)`` of the whole item in ``region`` (texts or their
    :func:`points`) on diagonals ``lo .. lo + width - 1``, or None if above
    ``budget``; free ends in the region."""
    item, src = (x if isinstance(x, np.ndarray) else points(x) for x in (item, region))
    r = np.full(len(item) + width + 1, -1, np.int32)
    a, b = max(lo, 0), min(len(src), lo + len(r))
    if b > a:
        r[a - lo:b - lo] = src[a:b]
    ramp = np.arange(width)
    outside = ramp + lo  # region position before row i is lo + i + k
    d = np.where((outside >= 0) & (outside <= len(src)), 0, budget + 1).astype(np.int64)
    for i, ch in enumerate(item.tolist()):
        t = d + (r[i:i + width] != ch)
        t[:-1] = np.minimum(t[:-1], d[1:] + 1)
        d = np.minimum.accumulate(t - ramp) + ramp
        if d.min() > budget:
            return None
    end = lo + len(item) + ramp
    d = np.where((end >= 0) & (end <= len(src)), d, budget + 1)
    k = int(d.argmin())
    return (int(d[k]), int(end[k])) if d[k] <= budget else None


def find_leaks(index: ItemIndex, texts: list[str] | list[bytes]) -> list[list[tuple[int, int, int]]]:
    """Per text the ``(item, edits, end)`` of every leaked item, best first found."""
    q = index.q
    starts, pieces, at = [], [], 0
    for t in texts:
        starts.append(at)
        pieces.append(t)
        at += len(t) + 1
    if not pieces:
        return []
    buffer = points((b"\x00" if isinstance(pieces[0], bytes) else "\x00").join(pieces))  # no normalised text holds a zero
    first = np.array(starts)
    best: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
    shift = len(buffer) + 1
    for item, band in index.bands(buffer):
        e = int(index.budget[item])
        x = index.items[item]
        lo = band * (e + 1) - shift
        width = 2 * (e + 1)
        a, b = max(0, lo), min(len(buffer) - 1, lo + width + len(x))
        for doc in range(int(np.searchsorted(first, a, "right")) - 1,
                         int(np.searchsorted(first, b, "right"))):
            text, base = texts[doc], int(first[doc])
            if len(text) < q:
                continue
            had = best[doc].get(item)
            if had is not None and had[0] == 0:
                continue
            at = text.find(x, max(0, lo - base - e), max(0, lo - base + width + e + len(x)))
            got = (0, at + len(x)) if at >= 0 else align(index.points[item], buffer[base:base + len(text)],
                                                         lo - base - e, width + 2 * e, e)
            if got is not None and (had is None or got < had):
                best[doc][item] = got
    return [[(i, *v) for i, v in sorted(b.items())] for b in best]


class LeakFinder:
    """All items of a block: long ones by q-grams of length ``q``, those that
    need it by shorter ones, the shortest as whole words."""

    def __init__(self, items: list[str], q: int, rate: float):
        classes: dict[int, list[int]] = {}
        self.words: dict[tuple[str, ...], list[int]] = {}
        for k, x in enumerate(items):
            if len(x) < q and int(rate * len(x)) == 0:
                self.words.setdefault(tuple(x.split(" ")), []).append(k)
            else:
                classes.setdefault(gram_length(len(x), q, rate), []).append(k)
        self.indexes = [(numbers, ItemIndex([items[k] for k in numbers], size, rate)) for size, numbers in sorted(classes.items())]
        self.sizes = sorted({len(w) for w in self.words})

    def find(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text the ``(item, edits, end)`` of every leaked item."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for numbers, index in self.indexes:
            for found, leaks in zip(out, find_leaks(index, texts)):
                found += [(numbers[i], edits, end) for i, edits, end in leaks]
        for found, text in zip(out, texts if self.sizes else ()):
            found += self._whole_words(text)
        return [sorted(x) for x in out]

    def _whole_words(self, text: str) -> list[tuple[int, int, int]]:
        words = text.split(" ") if text else []
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        first: dict[int, int] = {}
        for n in self.sizes:
            for i in range(len(words) - n + 1):
                for k in self.words.get(tuple(words[i:i + n]), ()):
                    first.setdefault(k, int(ends[i + n - 1]))
        return [(k, 0, end) for k, end in first.items()]


def _leak_column(ids: list, items: list[str], q: int, rate: float, text: Column) -> Column:
    """Four numbers per leak: whether the item has an id, the id, edits, end."""
    token = f"qgram_{zlib.crc32(repr((ids, items, q, rate)).encode()):08x}"

    @F.pandas_udf("array<bigint>")
    def leaks(texts: pd.Series) -> pd.Series:
        index = worker_cached(token, lambda: LeakFinder(items, q, rate))
        out: list[list[int]] = []
        group: list[str] = []
        size = 0

        def flush():
            for found in index.find(group):
                out.append([x for i, edits, end in found
                            for x in (int(ids[i] is not None), ids[i] or 0, edits, end)])
            group.clear()

        for t in texts:
            n = folded(t)
            if group and size + len(n) > _BUFFER_BYTES:
                flush()
                size = 0
            group.append(n)
            size += len(n) + 1
        flush()
        return pd.Series(out, dtype=object)

    return leaks(text)


def _leak_structs(flat: Column) -> Column:
    return F.array_compact(F.transform(flat, lambda x, i: F.when(i % 4 == 0, F.struct(
        F.when(x == 1, F.get(flat, i + 1)).alias("item_id"),
        F.get(flat, i + 2).cast("int").alias("edits"),
        F.get(flat, i + 3).alias("end")))))


def item_blocks(benchmark: DataFrame, q: int, block_bytes: int, short_items: bool = False):
    """The items in blocks ``(ids, folded texts)`` of bounded size."""
    ids, items, held = [], [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        x = folded(r["text"])
        size = len(x.encode("utf-8"))
        if not x or (len(x) < q and not short_items):
            continue
        if held and held + size > block_bytes:
            yield ids, items
            ids, items, held = [], [], 0
        ids.append(r["item_id"])
        items.append(x)
        held += size
    yield ids, items


def with_leaks(df: DataFrame, benchmark: DataFrame, name: str, text: str = "text", q: int = Q,
               rate: float = RATE, block_bytes: int = BLOCK_BYTES, short_items: bool = False) -> DataFrame:
    """``df`` with the array column ``name`` of ``struct(item_id, edits, end)``:
    each item that leaks into the text with its fewest edits and where that
    region ends (character of the normalised text)."""
    out, flats = df, []
    for ids, items in item_blocks(benchmark, q, block_bytes, short_items):
        flats.append(fresh(out, "_flat"))
        out = out.withColumn(flats[-1], _leak_column(ids, items, q, rate, F.col(text)))
    return out.withColumn(name, F.concat(*[_leak_structs(F.col(f)) for f in flats])).drop(*flats)


def leaked_pairs(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id, edits, region_end``: every (document, item) leak."""
    found = with_leaks(docs.select("doc_id", "text"), benchmark, "leaks", **options)
    return (found.select("doc_id", F.explode("leaks").alias("leak"))
            .select("doc_id", "leak.item_id", "leak.edits", F.col("leak.end").alias("region_end")))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents into which no item leaks, all columns kept."""
    name = fresh(docs, "_leaks")
    return with_leaks(docs, benchmark, name, **options).where(F.size(name) == 0).drop(name)
