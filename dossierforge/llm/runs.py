"""Periodic runs of words: a stretch that repeats its first few words again and again, found and collapsed to them."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common
from .common import Words, covered

#: A run has so many words at least, and so many times its period.
MIN_LENGTH, EXPONENT = 6, 4
#: Pairs of a middle and a period that are tried at once.
PAIRS = 1 << 20


def gram_length(min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> int:
    """A run of period q equals itself q words on over so many words at least, whatever q: each of its words lies in a window of that length found twice."""
    if exponent < 2 or min_length < 2:
        raise ValueError("a run has two words and two periods at least")
    return min(max(min_length, exponent * q) - q for q in range(1, min_length + 1))


class _Names:
    """Numbers for all windows of 1, 2, 4, ... symbols that lie inside one segment; equal windows have equal numbers."""

    def __init__(self, sym: np.ndarray, stop: np.ndarray):
        """stop: where each symbol's segment ends."""
        n = len(sym)
        room = stop - np.arange(n)
        self.by = [np.unique(sym, return_inverse=True)[1].reshape(-1).astype(np.int32)]
        while 2 << len(self.by) - 1 <= room.max(initial=0):
            half = 1 << len(self.by) - 1
            at = np.flatnonzero(room >= 2 * half)
            last = self.by[-1].astype(np.int64)
            name = np.full(n, -1, dtype=np.int32)
            name[at] = np.unique(last[at] << 32 | last[at + half], return_inverse=True)[1].reshape(-1)
            self.by.append(name)
        self.log = np.zeros(max(n, 1) + 1, dtype=np.int8)
        for j in range(1, len(self.by)):
            self.log[1 << j :] = j

    def equal(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the windows of `size` symbols at x and at y, each inside one segment, are equal."""
        out, level = np.zeros(len(x), dtype=bool), self.log[size]
        for j in range(len(self.by)):
            at = np.flatnonzero(level == j)
            a, b, rest = x[at], y[at], size[at] - (1 << j)
            out[at] = (self.by[j][a] == self.by[j][b]) & (self.by[j][a + rest] == self.by[j][b + rest])
        return out

    def ahead(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many symbols from x and from y on are equal, `most` at most."""
        size = np.zeros(len(x), dtype=np.int64)
        for j in range(len(self.by) - 1, -1, -1):
            at = np.flatnonzero(size + (1 << j) <= most)
            same = self.by[j][x[at] + size[at]] == self.by[j][y[at] + size[at]]
            size[at[same]] += 1 << j
        return size

    def behind(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many symbols right before x and right before y are equal, `most` at most."""
        size = np.zeros(len(x), dtype=np.int64)
        for j in range(len(self.by) - 1, -1, -1):
            at = np.flatnonzero(size + (1 << j) <= most)
            same = self.by[j][x[at] - size[at] - (1 << j)] == self.by[j][y[at] - size[at] - (1 << j)]
            size[at[same]] += 1 << j
        return size


def main_lorentz(sym: np.ndarray, first: np.ndarray, stop: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs inside the segments [first, stop) of sym, by start and end.

    Segments are halved; a run lies inside the first part whose middle it crosses, and reaches a period beyond that middle to the right or to the left. All parts
    of a depth are tried together. For each period, half of what a run needs must be equal on one side of the middle: one comparison of numbered windows.
    What passes is extended as far as it goes.
    """
    begin_of, end_of = np.repeat(first, stop - first), np.repeat(stop, stop - first)
    names = _Names(sym, end_of)
    word = names.by[0]
    found = [np.empty((3, 0), dtype=np.int64)]

    def tried(lo: np.ndarray, mid: np.ndarray, hi: np.ndarray) -> None:
        many = (hi - lo) // exponent
        total = np.cumsum(many)
        q = np.arange(total[-1]) - np.repeat(total - many, many) + 1
        lo, mid, hi = np.repeat(lo, many), np.repeat(mid, many), np.repeat(hi, many)
        need = np.maximum(min_length, exponent * q) - q  # words that equal the word q further on
        half = -(-need // 2)
        for shift in (0, 1):  # the period right of the middle, or left of it
            x, y = mid - shift * q, mid + (1 - shift) * q
            most_right, most_left = hi - y, x - lo
            able = np.flatnonzero((y <= hi) & (x >= lo) & (most_left + most_right >= need))
            x, y, n, h, left, right, p, a, b = (v[able] for v in (x, y, need, half, most_left, most_right, q, lo, hi))
            fit = np.zeros(len(able), dtype=bool)
            at = np.flatnonzero(right >= h)
            fit[at] = names.equal(x[at], y[at], h[at])
            at = np.flatnonzero((left >= h) & ~fit)
            fit[at] |= names.equal(x[at] - h[at], y[at] - h[at], h[at])
            x, y, n, left, right, p, a, b = (v[fit] for v in (x, y, n, left, right, p, a, b))
            back, on = names.behind(x, y, left), names.ahead(x, y, right)
            start, end = x - back, y + on
            # what goes on beyond the part is found in a larger one
            cut = (start == a) & (start > begin_of[start])
            cut[cut] = word[start[cut] - 1] == word[start[cut] - 1 + p[cut]]
            over = (end == b) & (end < end_of[end - 1])
            over[over] = word[end[over]] == word[end[over] - p[over]]
            good = (back + on >= n) & ~cut & ~over
            found.append(np.stack([start[good], end[good], p[good]]))

    lo, hi = first, stop
    while True:
        on = hi - lo >= min_length
        lo, hi = lo[on], hi[on]
        if not len(lo):
            break
        mid = (lo + hi) // 2
        some = np.flatnonzero((hi - lo) // exponent > 0)
        share = np.cumsum((hi[some] - lo[some]) // exponent) // PAIRS
        for part in np.split(some, np.flatnonzero(np.diff(share)) + 1):
            if len(part):
                tried(lo[part], mid[part], hi[part])
        lo, hi = np.concatenate([lo, mid]), np.concatenate([mid, hi])
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # a run is found with multiples of its period as well
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def _repeated(h: np.ndarray, w: Words, k: int) -> np.ndarray:
    """Which words lie in a window of k words that is found twice or more in their text."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(len(h), dtype=bool)
    doc = w.doc()
    at = np.flatnonzero(np.arange(n) + k <= w.bound[1:][doc[:n]])
    key = common.mix(common.rolling(h, k)[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return covered(at[twice], k, len(h))


def find_runs(h: np.ndarray, w: Words, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of all texts of w, as word numbers over all texts; h: a hash for each word."""
    inside = _repeated(h, w, gram_length(min_length, exponent))
    joined = np.zeros(len(h) + 1, dtype=bool)  # whether a word goes on the segment of the word before
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[w.bound] = False
    first, stop = np.flatnonzero(inside & ~joined[:-1]), np.flatnonzero(inside & ~joined[1:]) + 1
    long = stop - first >= min_length
    first, stop = first[long], stop[long]
    size = stop - first
    moved = np.cumsum(size) - size  # segments one behind the other
    back = np.repeat(first - moved, size)
    start, end, period = main_lorentz(h[np.arange(len(back)) + back], moved, moved + size, min_length, exponent)
    return start + back[start], end + back[start], period


class Found:
    """The runs of some texts. source: the word that each word is (texts may be rewritten before); kept: words that stay."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rewrite: Callable[[Words], np.ndarray] | None, min_length: int, exponent: int):
        self.words = w = Words(data, offsets)
        self.source = rewrite(w) if rewrite else np.arange(len(w.hash))
        self.start, self.end, self.period = find_runs(w.hash[self.source], w, min_length, exponent)
        edge = np.zeros(len(w.hash) + 1, dtype=np.int64)
        np.add.at(edge, self.start + self.period, 1)
        np.add.at(edge, self.end, -1)
        self.kept = np.cumsum(edge[:-1]) == 0
        self.bound = np.searchsorted(self.start, w.bound)  # the runs of text d are bound[d]:bound[d+1]

    def runs(self, d: int) -> list[tuple[int, int, int]]:
        """(start, length, period) of a text's runs, counted from its first word, by start, then period."""
        a, b, base = self.bound[d], self.bound[d + 1], self.words.bound[d]
        return sorted(zip((self.start[a:b] - base).tolist(), (self.end[a:b] - self.start[a:b]).tolist(), self.period[a:b].tolist(), strict=True), key=lambda r: (r[0], r[2], r[1]))

    def collapsed(self) -> list[bytes]:
        """Each text's words, those of a run after its first period left out, one space between."""
        w = self.words
        at, doc = np.flatnonzero(self.kept), w.doc()[self.kept]
        asis = self.source[at] == at
        # a kept word whose left neighbour in its text is kept as well stays where it is, behind one byte of white space; others are rebuilt
        rebuilt = np.unique(doc[~asis])
        keep = np.zeros(len(w.data), dtype=bool)
        size = w.end[at] - w.start[at]
        keep[np.repeat(w.start[at] - np.cumsum(size) + size, size) + np.arange(size.sum())] = True
        later = np.zeros(len(at), dtype=bool)
        later[1:] = doc[1:] == doc[:-1]
        out = w.data.copy()
        out[w.start[at[later]] - 1] = 0x20
        keep[w.start[at[later]] - 1] = True
        cut = np.concatenate([[0], np.cumsum(keep)])[w.offsets].tolist()
        out = out[keep].tobytes()
        texts = [out[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        raw = w.data.tobytes() if len(rebuilt) else b""
        for d in rebuilt.tolist():
            a, b = np.searchsorted(doc, [d, d + 1])
            src = self.source[at[a:b]]
            texts[d] = b" ".join(raw[x:y] for x, y in zip(w.start[src].tolist(), w.end[src].tolist(), strict=True))
        return texts


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """(doc_id, runs, collapsed) for each row of docs(doc_id, text).

    Words are runs of bytes that are no ASCII white space. A run is a stretch of words with smallest period q, at least min_length words and exponent
    times q long, which no neighbouring word continues with that period. runs: its start (word number), length and period, by start, then period; collapsed: the
    text's words without those that stand in a run after its first q, one space between.

    Null and empty texts have no runs and an empty text. doc_id is carried as it is, null or repeated. Other columns are ignored, whatever their names. An
    empty table gives an empty result. Texts are searched whole; a text needs some hundred bytes of memory for each word that lies in a repeated window.
    """
    common.ensure_importable(docs.sparkSession)
    gram_length(min_length, exponent)
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in common.text_chunks(batch, 1):
                f = Found(data, offsets, None, min_length, exponent)
                runs = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in f.runs(d)] for d in range(hi - lo)], run_type)
                yield pa.RecordBatch.from_arrays([common.column(batch, 0, lo, hi), runs, pa.array([t.decode() for t in f.collapsed()], pa.string())], names=["doc_id", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length by period, compared exactly; of equal ones the first by start, then period."""
    best = None
    for r in runs:  # in that order
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def _planted(ids: list[int | None]) -> Callable[[Words], np.ndarray]:
    """The query's rule that makes the end of one text in ten periodic; a text without doc_id stays as it is."""

    def rewrite(w: Words) -> np.ndarray:
        source = np.arange(len(w.hash))
        for d, (i, n, lo) in enumerate(zip(ids, w.counts.tolist(), w.bound.tolist(), strict=False)):
            if i is None or n == 0:
                continue
            h = zlib.crc32(str(i).encode())
            if h % 10 == 0:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                source[lo + a : lo + n] = lo + a + np.arange(n - a) % p
        return source

    return rewrite


def run_digests(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT, plant: bool = False) -> DataFrame:
    """periodic_runs() with digests in place of the runs and texts, and the run of greatest exponent. plant: rewrite one text in ten first (see _planted).

    Rows as in periodic_runs(); doc_id must be an integer for planting.
    """
    common.ensure_importable(docs.sparkSession)
    gram_length(min_length, exponent)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in common.text_chunks(batch, 1):
                ids = common.column(batch, 0, lo, hi)
                f = Found(data, offsets, _planted(ids.to_pylist()) if plant else None, min_length, exponent)
                rows = []
                for d, text in enumerate(f.collapsed()):
                    runs = f.runs(d) if f.bound[d] < f.bound[d + 1] else []
                    start, length, period = _strongest(runs) or (None, None, None)
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                    rows.append((len(runs), start, length, period, 1000 * length // period if runs else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest()))
                cols = [pa.array(c, pa.int64() if i < 5 else pa.string()) for i, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays([ids, *cols], names=names)

    longs = ", ".join(f"{c} bigint" for c in names[1:6])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {longs}, runs_sha256 string, collapsed_sha256 string")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(common.table(spark, sf_dir, "documents"), plant=True)
