"""Shared pieces: stage tables in the cluster's shared folder, and word tables computed on Arrow buffers with numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..operators.shipping import ensure_importable
from ..sources.keyed import shared_dir

#: Bytes of text that are worked on at once; a longer text is one piece of its own.
CHUNK_BYTES = 1 << 20
#: Rows that a Python worker is sent at once by actions inside small_batches(); both sides hold a batch as a whole.
BATCH_ROWS = 1000
#: Largest row count of a table that may be broadcast, checked by counting before it is.
BROADCAST_ROWS = 1_000_000

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path  # for drop()
    return out


def drop(*frames: DataFrame) -> None:
    """Delete stage tables that nothing reads any more."""
    for df in frames:
        spark, path = df.sparkSession, df._stored_at
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Actions inside send texts to Python in batches of so many rows; the session's setting comes back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    return df.limit(limit + 1).count() <= limit


def plain_names(df: DataFrame, *kept: str) -> DataFrame:
    """df with all columns but those in `kept` named by their place, so that working columns can't clash with them; toDF() gives the names back."""
    return df.toDF(*(c if c in kept else f"c{i}" for i, c in enumerate(df.columns)))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- hashing


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], dtype=_U))[0])


#: A random 64-bit value for each byte; polynomial base and its inverse modulo 2**64.
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the array is kept and grown."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=_U)
        have[0] = 1
        have = np.cumprod(have, dtype=_U)
        if n <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Separators of plain words: every ASCII byte that is neither letter nor digit.
_PLAIN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class Words:
    """The words of several texts that lie one behind the other in a byte buffer.

    start, end: byte positions; bound: the words of text d are bound[d]:bound[d+1]; hash: 64 bits a word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, plain: bool = False):
        self.data, self.offsets = data, offsets
        n = len(data)
        if lower or plain:
            data = _LOWER[data]
        inside = ~(_PLAIN if plain else _SPACE)[data]
        before = np.empty(n, dtype=bool)
        after = np.empty(n, dtype=bool)
        if n:
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
            cuts = offsets[1:-1]
            before[cuts[cuts < n]] = False
            after[cuts[cuts > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.bound = np.searchsorted(self.start, offsets)
        if len(self.start):
            self._total = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(_BYTE[data] * powers(_BASE, n), dtype=_U)])
            self.hash = self._hash(self.start, self.end)
        else:
            self.hash = np.empty(0, dtype=_U)

    def _hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._total[end] - self._total[start]) * powers(_INVERSE, len(self.data))[start])

    def prefixes(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash of its first k bytes) of the words that are longer."""
        at = np.flatnonzero(self.end - self.start > k)
        return at, mix(self._hash(self.start[at], self.start[at] + k) + _U(k)) if len(at) else np.empty(0, dtype=_U)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bound)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bound) - 1), self.counts)

    def code_points(self) -> np.ndarray:
        """Code points of each word: its bytes that don't continue a UTF-8 sequence."""
        heads = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        return heads[self.end] - heads[self.start]

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the k-word windows that lie inside one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=_U)
        last = np.repeat(self.bound[1:], self.counts)
        at = np.flatnonzero(np.arange(n) + k <= last[:n])
        return at, rolling(self.hash, k)[at]


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all windows of k symbols, one subtraction a window from running sums."""
    n = len(h)
    total = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(h * powers(_BASE, n), dtype=_U)])
    return mix((total[k:] - total[: n - k + 1]) * powers(_INVERSE, n)[: n - k + 1] + _U(k))


def give_back() -> None:
    """Return freed memory to the system. Python workers outlive a task, and would keep their peak through later stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def text_chunks(batch: pa.RecordBatch, column: int, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows with about size bytes; null texts are empty."""
    texts = batch.column(column)
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n = len(texts)
    _, offsets, data = texts.buffers()
    if n == 0:
        return
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def column(batch: pa.RecordBatch, i: int, lo: int, hi: int) -> pa.Array:
    return batch.column(i).slice(lo, hi - lo)


def segment_sums(values: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Sums of values[bound[d]:bound[d+1]]."""
    total = np.concatenate([np.zeros(1, dtype=values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values, dtype=values.dtype if values.dtype.kind == "f" else np.int64)])
    return total[bound[1:]] - total[bound[:-1]]


def covered(at: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of n positions lie in a window of k that starts at one of at."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    return np.cumsum(edge[:n]) > 0
