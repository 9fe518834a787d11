"""Packing token ids into sequences of a fixed length by deficit round-robin over the sources, so that windows hold target proportions."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .tokens import CHUNK_BYTES, encoder

SEQUENCE = 1024
#: Tokens that a round of the deficit round-robin gives out as credit: a mixture window.
WINDOW = 64 * SEQUENCE
#: Rounds whose starts are summed up together.
SPAN = 4096


def given_out(totals: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(levels, tokens): how many tokens all queues have been credited once a queue of weight w has w * level; straight between.

    A queue gets no more credit than it has tokens. So the line bends where one runs empty, and from there on the others share
    what it leaves: every window is filled while there are tokens.
    """
    level = np.divide(totals, weights, out=np.zeros(len(totals)), where=weights > 0)
    turn = np.argsort(level, kind="stable")
    level, weight, total = level[turn], weights[turn].astype(float), totals[turn].astype(float)
    open_ = weight.sum() - np.cumsum(weight) + weight
    return np.concatenate([[0.0], level]), np.concatenate([[0.0], np.cumsum(total) - total + level * open_])


def place(total: int, sequence: int) -> np.ndarray:
    """Where the sequences after the last full ones begin, and the end: their lengths are powers of two, which need no padding."""
    rest = total % sequence
    tails = [1 << b for b in reversed(range(sequence.bit_length())) if rest >> b & 1]
    return total // sequence * sequence + np.concatenate([[0], np.cumsum(tails)]).astype(np.int64)


def cut(first: np.ndarray, n: np.ndarray, edge: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start in it, length, sequence_id, offset) of the pieces of documents that lie at first .. first+n-1 of the stream."""
    full = int(edge[0])
    last = first + n
    a, b = np.minimum(first, full), np.minimum(last, full)
    whole = np.where(b > a, -(-b // sequence) - a // sequence, 0)  # full sequences that it reaches into
    ta, tb = np.maximum(first, full), np.maximum(last, full)
    short = np.where(tb > ta, np.searchsorted(edge, tb, "left") - np.searchsorted(edge, ta, "right") + 1, 0)
    count = whole + short
    doc = np.repeat(np.arange(len(first)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    in_full = k < whole[doc]
    seq = np.where(in_full, a[doc] // sequence + k, full // sequence + np.searchsorted(edge, ta[doc], "right") - 1 + k - whole[doc])
    nth = np.clip(seq - full // sequence, 0, max(len(edge) - 2, 0))
    begin = np.where(in_full, seq * sequence, edge[nth])
    end = np.where(in_full, begin + sequence, edge[np.minimum(nth + 1, len(edge) - 1)])
    lo, hi = np.maximum(begin, first[doc]), np.minimum(end, last[doc])
    return doc, lo - first[doc], hi - lo, seq, lo - begin


def _running(df: DataFrame, value: str, by: list[str], order: list[Column]) -> Column:
    """The sum of value over the rows before, in groups that are small."""
    return F.coalesce(F.sum(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _turns(sent: DataFrame) -> DataFrame:
    """sent(round, source, n) with `before`: the tokens of all earlier turns, round by round and in a round source by source.

    The sums go over the sources of a round, the rounds of a span and the spans, so that only the last is in one task: a row for
    SPAN rounds, which are SPAN * WINDOW tokens.
    """
    rounds = sent.groupBy("round").agg(F.sum("n").alias("n")).withColumn("span", F.floor(F.col("round") / SPAN))
    spans = rounds.groupBy("span").agg(F.sum("n").alias("n"))
    spans = spans.select(F.col("span"), _running(spans, "n", [], [F.col("span")]).alias("s_before"))
    rounds = rounds.withColumn("r_before", _running(rounds, "n", ["span"], [F.col("round")])).join(spans, "span").select("round", (F.col("r_before") + F.col("s_before")).alias("r_before"))
    sent = sent.withColumn("before", _running(sent, "n", ["round"], [F.col("source").asc_nulls_first()]))
    return sent.join(rounds, "round").withColumn("before", F.col("before") + F.col("r_before")).drop("r_before")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, sequence: int = SEQUENCE, window: int = WINDOW, weights: dict[str | None, float] | None = None) -> DataFrame:
    """One row per piece of docs(doc_id, text, source): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue, ids.

    Each source, null included, is a queue that holds its documents by doc_id. A round credits the queues with `window` tokens, shared by
    weight among those that aren't empty; a document is sent in the round in which its queue's credit, summed over all rounds, covers its
    last token, and what is left over is carried on. That round follows from the document's place in its queue alone, so that any
    partition can tell it, whatever the number of sources. Weights are the sources' shares of a window, by default their shares of the
    corpus, with which all queues end together; weights need a value above 0 for each source with tokens.

    The rounds make one stream, which is cut into sequences. All are full but for the last ones, which are powers of two, so that
    none has padding. Null or empty texts are the end id alone. Rows with equal doc_id are packed each, in the order of source and text.
    Without a column source all rows are one queue. Extra columns are ignored; without rows there are no pieces.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    source = F.col("source") if "source" in docs.columns else F.lit(None)
    n = common.partitions(spark)
    rows = docs.select("doc_id", "text", source.cast("string").alias("source"))
    ordered = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "source", "text")
    end = np.array([end_id], dtype=np.uint32)
    narrow = encoder(tokenizer_path).tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, enc, sent = TaskContext.get().partitionId(), encoder(tokenizer_path), {}
        for batch in batches:
            for lo, hi, data, offsets in common.text_chunks(batch, 1, CHUNK_BYTES):
                ids, bounds = enc.encode_chunk(data, offsets, end)
                sources, sizes = common.column(batch, 2, lo, hi), np.diff(bounds)
                firsts = []
                for s, size in zip(sources.to_pylist(), sizes.tolist(), strict=True):
                    firsts.append(sent.get(s, 0))
                    sent[s] = firsts[-1] + size
                ids = ids.astype("<u2") if narrow else ids
                body = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((bounds * ids.itemsize).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(hi - lo, pid, np.int32)), common.column(batch, 0, lo, hi), sources, pa.array(firsts, pa.int64()), pa.array(sizes, pa.int64()), body], names=["pid", "doc_id", "source", "first", "n", "ids"])

    stored = common.store(ordered.mapInArrow(encode, f"pid int, doc_id {id_type}, source string, first bigint, n bigint, ids binary"), "packing-ids")

    # what a part's rows have before them in their queue, and the queue's tokens: a row for each part and source in it
    parts = stored.groupBy("source", "pid").agg(F.sum("n").alias("n"))
    base = parts.select(F.col("source").alias("b_source"), F.col("pid").alias("b_pid"), _running(parts, "n", ["source"], [F.col("pid")]).alias("base"), F.sum("n").over(Window.partitionBy("source")).alias("queued"))
    base = common.store(base, "packing-queues")
    total = int(base.where("base = 0").agg(F.sum("queued")).first()[0] or 0)  # parts hold tokens, so only a queue's first part has none before it
    credit = F.col("last") * F.lit(float(total)) / F.col("queued")
    if weights is not None:
        sizes = {r["b_source"]: r["queued"] for r in base.where("base = 0").collect()}  # the sources that the caller has named
        if any(not weights.get(s, 0) > 0 for s in sizes):
            raise ValueError("each source with tokens needs a weight above 0")
        levels, tokens = given_out(np.array(list(sizes.values()), dtype=float), np.array([weights[s] for s in sizes], dtype=float))

        @F.pandas_udf("double")
        def credit_of(source, last):
            import pandas as pd

            return pd.Series(np.interp(last.to_numpy() / np.array([weights[s] for s in source.where(source.notna(), None)], dtype=float), levels, tokens))

        credit = credit_of("source", "last")
    placed = stored.join(_few(base), (F.col("pid") == F.col("b_pid")) & F.col("source").eqNullSafe(F.col("b_source")))
    placed = placed.withColumn("first", F.col("base") + F.col("first")).withColumn("last", F.col("first") + F.col("n"))
    placed = placed.withColumn("round", F.greatest(F.ceil(credit / window) - 1, F.lit(0)).cast("long"))

    # all documents that a queue sends in a round stand one after another, from the least `first` on
    sent = placed.groupBy("round", "source").agg(F.sum("n").alias("n"), F.min("first").alias("low"))
    turns = common.store(_turns(common.store(sent, "packing-turns")), "packing-turns").select(F.col("round").alias("t_round"), F.col("source").alias("t_source"), (F.col("before") - F.col("low")).alias("shift"))
    met = placed.join(_few(turns), (F.col("round") == F.col("t_round")) & F.col("source").eqNullSafe(F.col("t_source")))
    edge = place(total, sequence)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                first, size = (np.asarray(part.column(i)) for i in (2, 3))
                doc, start, length, seq, off = cut(first, size, edge, sequence)
                whole = [np.frombuffer(x.as_buffer(), dtype="<u2" if narrow else "<u4").astype("<u4") for x in part.column(4)]
                own = [whole[d][a:b].tobytes() for d, a, b in zip(doc.tolist(), start.tolist(), (start + length).tolist(), strict=True)]
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in own], pa.int64()), pa.array(size[doc]), pa.array(seq), pa.array(off), part.column(1).take(at), pa.array(own, pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue", "ids"],
                )

    rows = met.select("doc_id", "source", (F.col("first") + F.col("shift")).alias("first"), "n", "ids")
    return rows.mapInArrow(pieces, f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, queue string, ids binary")


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if common.small(df) else df


def op4_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents")
    return pack(docs, tokenizer or public_tokenizers.path("byte_bpe_50k.json")).drop("ids", "queue")
