"""Vector codes: each part of a vector is the number of its codebook's nearest entry; codebooks are learned from all rows by Lloyd's rounds with heaps."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Bytes of whole-number vectors in one block; a block's heaps lie in one row with it.
BLOCK_BYTES = 4 << 20
#: Rows whose distances to all entries are held at once.
SCAN_ROWS = 4096
#: Row groups of block tables.
GROUP_BYTES = 32 << 20


@dataclass
class Codebooks:
    """entries[p]: the codebook of part p, a row each; slack[p, a]: by how much, in all rounds so far, what assigns parts to entry a may have shrunk."""

    entries: np.ndarray
    slack: np.ndarray
    rescanned: list[int] = field(default_factory=list)

    def moved(self, count: np.ndarray, total: np.ndarray) -> Codebooks:
        """Entries go to the floor of their parts' mean; unused ones stay. A part's own entry drifts off and some other comes nearer, so both drifts count."""
        used = count > 0
        entries = np.where(used[..., None], total // np.where(used, count, 1)[..., None], self.entries).astype(np.int64)
        drift = np.sqrt(((entries - self.entries).astype(np.float64) ** 2).sum(-1))
        other = np.zeros_like(drift)  # the largest drift of any other entry
        if drift.shape[1] > 1:
            order = np.argsort(drift, axis=1)
            part = np.arange(len(drift))
            other[:] = drift[part, order[:, -1]][:, None]
            other[part, order[:, -1]] = drift[part, order[:, -2]]
        return Codebooks(entries, self.slack + drift + other, self.rescanned)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x and c."""
    most = int(max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)))
    bound = x.shape[1] * (2 * most) ** 2
    if bound < 2**52:  # whole numbers that doubles hold exactly, sums included
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    if bound >= 2**63:
        raise OverflowError("squared distances don't fit 64 bits")
    x, c = x.astype(np.int64), c.astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in c], axis=1) if len(x) else np.empty((0, len(c)), dtype=np.int64)


class Block:
    """Some rows of one partition. vectors: whole numbers; of[p]: each row's entry; heaps[p][a]: (key, row) of the rows assigned to entry a.

    A key is how much farther the second nearest entry was than the nearest, plus the entry's slack when that was measured. While it is more than the
    entry's slack, the assignment stands whatever the other entries did.
    """

    def __init__(self, vectors: np.ndarray, of: np.ndarray, heaps: list[list[list[tuple[float, int]]]]):
        self.vectors, self.of, self.heaps = vectors, of, heaps

    @classmethod
    def fresh(cls, vectors: np.ndarray, parts: int, entries: int) -> Block:
        return cls(vectors, np.full((parts, len(vectors)), -1, dtype=np.int16), [[[] for _ in range(entries)] for _ in range(parts)])

    def assign(self, books: Codebooks) -> tuple[int, np.ndarray, np.ndarray]:
        """Pop and rescan the rows whose bounds are violated. (rescanned, change of counts, change of sums)"""
        parts, entries, width = books.entries.shape
        count, total, scanned = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, width), dtype=np.int64), 0
        for p, heaps in enumerate(self.heaps):
            x, c, of = self.vectors[:, p * width : (p + 1) * width], books.entries[p], self.of[p]
            if (of < 0).all():
                rows = np.arange(len(x))
            else:
                popped = []
                for heap, slack in zip(heaps, books.slack[p].tolist(), strict=True):
                    most = slack + 1e-9 * (1 + slack)  # room for rounding; a key carries the slack of its time
                    while heap and heap[0][0] <= most:
                        popped.append(heapq.heappop(heap)[1])
                rows = np.array(popped, dtype=np.int64)
            scanned += len(rows)
            for lo in range(0, len(rows), SCAN_ROWS):
                at = rows[lo : lo + SCAN_ROWS]
                d = _distances(x[at], c)
                near = d.argmin(1)  # the lower of equals
                least = d[np.arange(len(at)), near]
                if entries > 1:
                    d[np.arange(len(at)), near] = np.iinfo(np.int64).max
                    far = np.sqrt(least.astype(np.float64))
                    key = (np.sqrt(d.min(1).astype(np.float64)) - far) - 1e-12 * far + books.slack[p][near]
                else:
                    key = np.full(len(at), np.inf)
                for k, a, i in zip(key.tolist(), near.tolist(), at.tolist(), strict=True):
                    heapq.heappush(heaps[a], (k, i))
                was, new = of[at], near.astype(np.int16)
                gone = was != new
                for sign, of_what, which in ((-1, was, gone & (was >= 0)), (1, new, gone)):
                    np.add.at(count[p], of_what[which], sign)
                    np.add.at(total[p], of_what[which], sign * x[at[which]].astype(np.int64))
                of[at] = new
        return scanned, count, total

    def errors(self, books: Codebooks) -> np.ndarray:
        """The squared distance of each row to its entries."""
        width = books.entries.shape[2]
        out = np.zeros(len(self.vectors), dtype=np.int64)
        for p, of in enumerate(self.of):
            d = self.vectors[:, p * width : (p + 1) * width].astype(np.int64) - books.entries[p][of]
            out += (d * d).sum(1)
        return out

    # as one row of a table

    def cells(self) -> list[bytes]:
        flat = [h for heaps in self.heaps for h in heaps]
        keys, rows = np.array([k for h in flat for k, _ in h], dtype="<f8"), np.array([i for h in flat for _, i in h], dtype="<i4")
        return [self.vectors.astype("<i4").tobytes(), self.of.astype("<i2").tobytes(), np.array([len(h) for h in flat], dtype="<i4").tobytes(), keys.tobytes(), rows.tobytes()]

    @classmethod
    def of_cells(cls, cells: list[bytes], books: Codebooks) -> Block:
        parts, entries, width = books.entries.shape
        vectors = np.frombuffer(cells[0], dtype="<i4").reshape(-1, parts * width)
        ends = np.cumsum(np.frombuffer(cells[2], dtype="<i4")).tolist()
        pairs = list(zip(np.frombuffer(cells[3], dtype="<f8").tolist(), np.frombuffer(cells[4], dtype="<i4").tolist(), strict=True))
        flat = [pairs[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]  # in the order of a heap, as they were
        return cls(vectors, np.frombuffer(cells[1], dtype="<i2").reshape(parts, -1).copy(), [flat[p * entries : (p + 1) * entries] for p in range(parts)])


class _Sums:
    """What a task's blocks change, a row for each part and entry."""

    def __init__(self, books: Codebooks):
        parts, entries, width = books.entries.shape
        self.scanned, self.count, self.total = 0, np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, width), dtype=np.int64)

    def add(self, scanned: int, count: np.ndarray, total: np.ndarray) -> None:
        self.scanned, self.count, self.total = self.scanned + scanned, self.count + count, self.total + total

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        at = np.argwhere((self.count != 0) | (self.total != 0).any(-1))
        rows = [(-1, -1, self.scanned, []), *((p, a, int(self.count[p, a]), self.total[p, a].tolist()) for p, a in at.tolist())]
        cols = dict(zip(("part", "entry", "n", "total"), zip(*rows, strict=True), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(cols.get(f.name, [None] * len(rows)), f.type) for f in schema], schema=schema)


_STATE = ["vectors", "of", "sizes", "keys", "rows"]


def _schemas(df: DataFrame) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [T.StructField("ids", T.ArrayType(df.schema["i"].dataType)), T.StructField("labels", T.ArrayType(df.schema["l"].dataType)), *(T.StructField(c, T.BinaryType()) for c in _STATE)]
    fields += [T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("total", T.ArrayType(T.LongType()))]
    schema = T.StructType(fields)
    return schema, to_arrow_schema(schema)


def _plain(batch: pa.RecordBatch, dim: int, scale: int) -> np.ndarray:
    """Whole-number vectors of a batch (i, l, v)."""
    v = batch.column(2)
    if len(v) and (np.diff(v.offsets.to_numpy()) != dim).any():
        raise ValueError(f"vectors of other lengths than {dim}")
    x = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dim)
    if (np.abs(x) >= 2**31).any():
        raise OverflowError("components don't fit 32 bits when scaled")
    return x.astype(np.int32)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = common.shared_dir(df.sparkSession, name)
    df.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def _blocks(state: DataFrame) -> DataFrame:
    return state.where("part IS NULL").select("ids", "labels", *_STATE)


def _changes(state: DataFrame, shape: tuple[int, ...]) -> tuple[int, np.ndarray, np.ndarray]:
    """Sums over all tasks, as whole numbers of any size: entries x width numbers, whatever the rows."""
    parts = state.where("part IS NOT NULL").select("part", "entry", F.col("n").cast("decimal(38,0)").alias("x"), F.posexplode_outer("total").alias("at", "y"))
    count, total, scanned = np.zeros(shape[:2], dtype=object), np.zeros(shape, dtype=object), 0
    for p, a, at, x, y in parts.groupBy("part", "entry", "at").agg(F.sum("x"), F.sum(F.col("y").cast("decimal(38,0)"))).collect():
        if p < 0:
            scanned = int(x)
        else:
            count[p, a], total[p, a, at] = int(x), int(y)
    return scanned, count, total


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[Codebooks | None, DataFrame | None]:
    """(codebooks, blocks): learned from all rows of vectors(i, l, v), which are finite and of one length; None if there are none.

    Codebooks start as the parts of the rows with the smallest i (null last, equal ones by v). Each round is one pass over blocks that lie in the shared folder
    with their heaps, and writes them anew; the pass before is deleted then. The driver gets a sum for each number of the codebooks, nothing that grows with the rows.
    """
    if not 0 < entries <= 256 or parts < 1:
        raise ValueError("a code is two hex digits, so a codebook has 256 entries at most")
    start = vectors.orderBy(F.col("i").asc_nulls_last(), F.col("v")).limit(entries).select("v").collect()
    if not start:
        return None, None
    dim = len(start[0]["v"])
    if not dim or dim % parts or any(len(r["v"]) != dim for r in start):
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts, or have several lengths")
    first = np.floor(scale * np.array([r["v"] for r in start], dtype=np.float64))
    if (np.abs(first) >= 2**31).any():
        raise OverflowError("components don't fit 32 bits when scaled")
    books = Codebooks(np.stack(np.split(first.astype(np.int64), parts, axis=1)), np.zeros((parts, len(start))))
    schema, arrow = _schemas(vectors)
    block_rows = max(1, BLOCK_BYTES // (4 * dim))

    def cells(ids: pa.Array, labels: pa.Array, block: Block) -> pa.RecordBatch:
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        cols = [one(ids), one(labels), *(pa.array([c], pa.binary()) for c in block.cells()), *(pa.array([None], f.type) for f in list(arrow)[2 + len(_STATE) :])]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held, n = _Sums(books), [], 0

        def closed() -> pa.RecordBatch:
            block = Block.fresh(np.concatenate([x for _, _, x in held]), *books.entries.shape[:2])
            sums.add(*block.assign(books))
            return cells(pa.concat_arrays([i for i, _, _ in held]), pa.concat_arrays([k for _, k, _ in held]), block)

        for batch in batches:
            for lo in range(0, len(batch), block_rows):
                b = batch.slice(lo, block_rows)
                if n and n + len(b) > block_rows:
                    yield closed()
                    held, n = [], 0
                held.append((b.column(0), b.column(1), _plain(b, dim, scale)))
                n += len(b)
        if n:
            yield closed()
        yield sums.batch(arrow)

    def again(books: Codebooks):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = _Sums(books)
            for batch in batches:
                for r in range(len(batch)):
                    block = Block.of_cells([batch.column(2 + c)[r].as_buffer() for c in range(len(_STATE))], books)
                    sums.add(*block.assign(books))
                    yield cells(batch.column(0)[r].values, batch.column(1)[r].values, block)
            yield sums.batch(arrow)

        return run

    state, count, total = _stored(vectors.select("i", "l", "v").mapInArrow(begin, schema), "codebooks"), 0, 0
    for k in range(rounds):
        scanned, n, s = _changes(state, books.entries.shape)
        books.rescanned.append(scanned)
        count, total = count + n, total + s
        books = books.moved(count, total)
        if k + 1 < rounds:
            last, state = state, _stored(_blocks(state).mapInArrow(again(books), schema), "codebooks")
            common.drop(last)
    return books, state


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for each row of vectors(vec_id, embedding, label) that takes part.

    Each component x becomes floor(scale * x); vectors are cut into `parts` equal parts, and a code has two hex digits for each part's nearest entry, the lower of
    equally near ones. error: the squared distances summed over parts; label_error: error summed over the rows of one label, null being a label too.

    Rows whose vector is null or holds null or non-finite components are left out. vec_id may be null or repeated; equal rows get equal codes. Other columns are
    ignored, whatever their names. An empty table, or one where no row takes part, gives an empty result. Vectors of several lengths, or of a length that can't be cut,
    raise ValueError; scaled components beyond 32 bits, or distances beyond 64, raise OverflowError.
    """
    spark = vectors.sparkSession
    common.ensure_importable(spark)
    rows = vectors.select(F.col("vec_id").alias("i"), F.col("label").alias("l"), F.col("embedding").alias("v"))
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in "il")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    books, state = fit(rows.where(F.col("v").isNotNull() & ~odd), parts, entries, rounds, scale)
    if books is None:
        return spark.createDataFrame([], f"vec_id {id_type}, code string, error bigint, label_error bigint, codebooks_sha256 string")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                block = Block.of_cells([batch.column(2 + c)[r].as_buffer() for c in range(len(_STATE))], books)
                block.assign(books)
                digits = block.of.T.astype(np.uint8).tobytes().hex()
                codes = [digits[at : at + 2 * parts] for at in range(0, len(digits), 2 * parts)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[r].values, batch.column(1)[r].values, pa.array(codes, pa.string()), pa.array(block.errors(books), pa.int64())], names=["i", "l", "code", "error"])

    coded = common.store(_blocks(state).mapInArrow(last, f"i {id_type}, l {label_type}, code string, error bigint"), "codes")
    common.drop(state)
    sums = common.store(coded.groupBy("l").agg(F.sum("error").alias("label_error")), "label-errors")
    other = sums.withColumnRenamed("l", "k")
    other = F.broadcast(other) if common.small(sums) else other  # counted; else a join that Spark can split at a hot label
    out = coded.join(other, coded["l"].eqNullSafe(other["k"]))
    return out.select(F.col("i").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(common.table(spark, sf_dir, "embeddings"))
