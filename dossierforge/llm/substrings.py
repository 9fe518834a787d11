"""Substring dedup: windows of words that also start earlier are found by matching statistics on FM-index shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import Words, rolling, text_chunks
from .fmindex import FMIndex

#: Words of a window, and of the anchors that route windows to shards.
WINDOW = 20
ANCHOR = 6
#: Words that a shard of the index holds, on average.
SHARD_WORDS = 150_000
#: Bytes of text that are hashed at once, and rows that are cut at once.
CHUNK_BYTES, CUT_ROWS = 1 << 18, 1000


def _records(w: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, windows, anchor hash, content hash) of runs of windows that have the same anchor.

    A window's anchor is the first of its `anchor`-word sequences with the least hash, so equal windows have equal anchors,
    wherever they stand. A record is a run of windows with one anchor in common.
    """
    n = len(w.hash)
    empty = np.empty(0, dtype=np.int64)
    if n < window:
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams = rolling(w.hash, anchor)
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = window - anchor + 1  # anchors of a window
    low, width = key, 1
    while width < span:
        step = min(width, span - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    last = np.repeat(w.bound[1:], w.counts)[: n - window + 1]
    ok = np.flatnonzero(np.arange(n - window + 1) + window <= last)
    at = (low[ok] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(ok):
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    new = np.ones(len(ok), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (ok[1:] != ok[:-1] + 1)
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(ok)))
    first = ok[head]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hash * common.powers(common._BASE, n), dtype=np.uint64)])
    stop = first + count + window - 1
    content = common.mix((total[stop] - total[first]) * common.powers(common._INVERSE, n)[first] + stop.astype(np.uint64) - first.astype(np.uint64))
    return first, count, grams[at[head]], content


def _keyed(docs: DataFrame) -> DataFrame:
    """Add __th, which tells rows of one doc_id apart: 0, or the text's hash where ids repeat."""
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0
    return docs.withColumn("__th", F.xxhash64("text") if repeated else F.lit(0).cast("long"))


def _with(docs: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the row key; other has doc_id and __th as o_id and o_th."""
    return docs.join(other, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("__th") == F.col("o_th")), how)


def _touched(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs whose key is in keys, without a shuffle of texts where the keys are few enough to be broadcast."""
    return _with(docs, F.broadcast(keys), "left_semi") if common.small(keys) else docs


def find_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, __th, runs array<struct<first,windows,mask>>): which windows of docs(doc_id, __th, text) also start earlier.

    Windows fall into records by anchor; only anchors found twice can hold repeats. Equal records are merged before anything
    is gathered, and the first of them stands for all. The distinct records of an anchor go to one shard, whose FM-index
    is searched backward with each record: where a match reaches the window's length, the suffixes with those words are an
    interval between borders of the LCP array, and the earliest of them is the window's origin.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    if id_type not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"doc_id has to be an integer, not {id_type}")
    if window - anchor + 1 > 62:
        raise ValueError("a record's windows have to fit into a mask of 62 bits")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "__th", "text")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch, 0, CHUNK_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array(_records(Words(data, offsets), window, anchor)[2].view(np.int64))], names=["h"])
            common.give_back()

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, 2, CHUNK_BYTES):
                w = Words(data, offsets)
                first, count, h, content = _records(w, window, anchor)
                doc = np.searchsorted(w.bound, first, "right") - 1
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(content.view(np.int64)), common.column(batch, 0, lo, hi).take(rows), common.column(batch, 1, lo, hi).take(rows), pa.array((first - w.bound[doc]).astype(np.int32)), pa.array(count.astype(np.int32))],
                    names=["h", "content", "doc_id", "__th", "first", "windows"],
                )
            common.give_back()

    # stored, so that the join deals both its sides anew and can split an anchor that very many texts have
    spark = docs.sparkSession
    with common.small_batches(spark):
        twice = common.store(docs.select("text").mapInArrow(anchors, "h bigint").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-anchors")
    found = docs.select("doc_id", "__th", "text").mapInArrow(records, "h bigint, content bigint, doc_id bigint, __th bigint, first int, windows int")
    with common.small_batches(spark):
        candidates = common.store(found.join(twice, "h", "left_semi"), "repeat-candidates")

    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "__th", "first")
    distinct = candidates.groupBy("h", "content").agg(F.min(place).alias("origin"), F.first("windows").alias("windows"), F.count("*").alias("n"))
    distinct = common.store(distinct.select("h", "content", "windows", "n", "origin.doc_id", "origin.__th", "origin.first"), "repeat-records")

    # every occurrence of a record but its first
    origin = distinct.where("n > 1").select(F.col("h").alias("o_h"), F.col("content").alias("o_content"), F.col("doc_id").alias("o_id"), F.col("__th").alias("o_th"), F.col("first").alias("o_first"))
    full = F.lit((1 << (window - anchor + 1)) - 1).cast("long")
    later = candidates.join(origin, (F.col("h") == F.col("o_h")) & (F.col("content") == F.col("o_content")))
    later = later.where(~(F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("__th") == F.col("o_th")) & (F.col("first") == F.col("o_first")))).select("doc_id", "__th", "first", "windows", full.alias("mask"))

    size = distinct.agg(F.sum(F.col("windows") + window - 1)).first()[0] or 0
    shards = max(1, -(-size // SHARD_WORDS))
    wanted = distinct.select("doc_id", "__th", F.struct("first", "windows", F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int").alias("shard")).alias("r"))
    wanted = wanted.groupBy(F.col("doc_id").alias("o_id"), F.col("__th").alias("o_th")).agg(F.collect_list("r").alias("wanted"))
    own = _touched(docs, distinct.select(F.col("doc_id").alias("o_id"), F.col("__th").alias("o_th")).distinct())
    met = _with(own, wanted)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, 2, CHUNK_BYTES):
                w = Words(data, offsets)
                lists = common.column(batch, 3, lo, hi)
                flat = lists.flatten()
                row = np.repeat(np.arange(hi - lo), np.asarray(lists.value_lengths()))
                first, count, shard = (np.asarray(flat.field(k)) for k in range(3))
                start = w.bound[row] + first
                stop = start + count + window - 1
                raw = w.hash.astype("<u8").tobytes()
                body = [raw[8 * a : 8 * b] for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(shard), common.column(batch, 0, lo, hi).take(rows), common.column(batch, 1, lo, hi).take(rows), pa.array(first), pa.array(count), pa.array(body, pa.binary())], names=["shard", "doc_id", "__th", "first", "windows", "words"])
            common.give_back()

    shipped = met.select("doc_id", "__th", "text", "wanted").mapInArrow(words, "shard int, doc_id bigint, __th bigint, first int, windows int, words binary")
    reused = shipped.groupBy("shard").applyInArrow(lambda t: search_shard(t, window), "doc_id bigint, __th bigint, first int, windows int, mask bigint")
    return reused.unionByName(later).groupBy(F.col("doc_id").alias("o_id"), F.col("__th").alias("o_th")).agg(F.collect_list(F.struct("first", "windows", "mask")).alias("runs"))


def search_shard(records: pa.Table, window: int) -> pa.Table:
    """The records of a shard some of whose windows start earlier in another record, with a mask of those windows."""
    sequences = [np.frombuffer(x.as_buffer(), dtype="<u8") for x in records["words"].combine_chunks()]
    index = FMIndex(sequences)
    first = np.asarray(records["first"]).astype(np.int64)
    count = np.asarray(records["windows"]).astype(np.int64)
    doc = records["doc_id"].combine_chunks()
    known = ~np.asarray(doc.is_null())
    ids, th = np.asarray(doc.fill_null(0)), np.asarray(records["__th"])
    order = np.lexsort((th, ids, known))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (known[order][1:] != known[order][:-1]) | (ids[order][1:] != ids[order][:-1]) | (th[order][1:] != th[order][:-1])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new)
    # where each suffix that begins a window stands in the corpus
    record = np.repeat(np.arange(len(sequences)), np.diff(index.start))
    within = np.arange(index.n) - index.start[record]
    place = np.where(within < count[record], (rank[record] << 32) + first[record] + within, np.iinfo(np.int64).max)
    group = np.cumsum(index.lcp[: index.n] < window) - 1
    heads = np.flatnonzero(index.lcp[: index.n] < window)
    origin = np.minimum.reduceat(place[index.sa], heads) if index.n else place
    mask = np.zeros(len(sequences), dtype=np.int64)
    for who, position, length, lo, _ in index.matching_statistics(sequences):
        on = (length >= window) & (position < count[who])
        who, position, lo = who[on], position[on], lo[on]
        earlier = origin[group[lo]] < (rank[who] << 32) + first[who] + position
        np.bitwise_or.at(mask, who[earlier], np.int64(1) << position[earlier])
    hit = pa.array(np.flatnonzero(mask))
    del index, place, origin, group, heads, sequences
    common.give_back()
    return records.select(["doc_id", "__th", "first", "windows"]).take(hit).append_column("mask", pa.array(mask[np.asarray(hit)]))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """docs with text cut to the words that no repeated window covers, joined by one space, and n_words and n_removed.

    A window is repeated if its words also start earlier: in a smaller doc_id (null is the smallest), or before it in the same
    row. Windows are judged on the input. Rows that share a doc_id count by the hash of their texts; rows equal in both
    are one document and get the same result. Nulls and texts of less than a window have nothing to remove; a null
    text becomes empty. Other columns are kept as they are, but for n_words and n_removed, which are replaced.
    """
    docs = docs.drop("n_words", "n_removed")
    given = [*docs.columns, "n_words", "n_removed"]
    docs = _keyed(common.plain_names(docs, "doc_id", "text"))
    names = docs.columns
    found = find_repeats(docs, window, anchor)
    with common.small_batches(docs.sparkSession):
        runs = common.store(found, "repeat-runs")
    at, th = names.index("text"), names.index("__th")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, CUT_ROWS) for b in batches for lo in range(0, b.num_rows, CUT_ROWS)):
            texts, n_words, n_removed = [], [], []
            lists = batch.column(len(names)) if batch.num_columns > len(names) else None
            for i in range(batch.num_rows):
                words = (batch.column(at)[i].as_py() or "").encode().split()
                n_words.append(len(words))
                found = lists[i].as_py() if lists is not None else None
                if found:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    for r in found:
                        for k in range(r["windows"]):
                            if r["mask"] >> k & 1:
                                edge[r["first"] + k] += 1
                                edge[r["first"] + k + window] -= 1
                    keep = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    words = [words[k] for k in keep.tolist()]
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words).decode())
            cols = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(len(names)) if k != th]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], names=[*(c for c in names if c != "__th"), "n_words", "n_removed"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "__th") + ", n_words bigint, n_removed bigint"
    keys = runs.select("o_id", "o_th")
    if common.small(keys):  # texts without repeats needn't move
        keys = F.broadcast(keys)
        some = _with(_with(docs, keys, "left_semi"), runs).drop("o_id", "o_th")
        rest = _with(docs, keys, "left_anti")
        return some.mapInArrow(cut, schema).unionByName(rest.mapInArrow(cut, schema)).toDF(*given)
    return _with(docs, runs, "left").drop("o_id", "o_th").mapInArrow(cut, schema).toDF(*given)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"))
