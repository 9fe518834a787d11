"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, trained from document labels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import Words, rolling, text_chunks

#: Labelled rows of each class that a model is fitted on at most, those with the least hash of doc_id.
TRAIN_ROWS = 3000
#: A word or word pair becomes a feature if so many training texts hold it.
MIN_TEXTS = 4
#: It also has to be more (or less) frequent in toxic texts by so many standard errors.
MIN_DEVIATION = 3.0
#: Bytes of the word stems that are features, for languages that inflect.
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.3


@dataclass
class Model:
    """Hashes of the features, sorted, with their weights; the bias of a sentence."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")), F.lit(4))


def _sentences(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(sentence of each word, text of each sentence). A sentence ends with . ! ? or a line feed, and with its text."""
    stop = np.isin(w.data, np.frombuffer(b".!?\n", dtype=np.uint8))
    marks = np.concatenate([[0], np.cumsum(stop)])[w.start]
    doc = w.doc()
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (marks[1:] != marks[:-1]) | (doc[1:] != doc[:-1])
    return np.cumsum(new) - 1, doc[new]


def _grams(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(first word, hash) of single words, of pairs inside a text, and of the stems of longer words."""
    n = len(w.hash)
    single = (np.arange(n), rolling(w.hash, 1)) if n else (np.empty(0, np.int64), w.hash)
    return [single, w.grams(2), *(w.prefixes(k) for k in STEMS)]


def _look_up(hashes: np.ndarray, model: Model) -> np.ndarray:
    if not len(model.features) or not len(hashes):
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(model.features, hashes), len(model.features) - 1)
    return np.where(model.features[at] == hashes, model.weights[at], 0.0)


def sentence_scores(w: Words, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score of each sentence, text of each sentence, sentence of each word)."""
    sentence, doc = _sentences(w)
    z = np.full(len(doc), model.bias)
    for at, h in _grams(w):
        z += np.bincount(sentence[at], weights=_look_up(h, model), minlength=len(doc))
    return 1 / (1 + np.exp(-np.clip(z, -30, 30))), doc, sentence


def noisy_or(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """1 - product of (1 - p) of each text; 0 for a text without sentences."""
    return -np.expm1(np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, toxic, weight): at most `most` rows of each class, from the folds that aren't held out.

    A doc_id with several labels is toxic if one of them says so; a null label is none. weight is how many rows of the
    class each sampled row stands for. Of rows that share a doc_id, the one with the least text is taken.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(fold(F.col("doc_id")) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = common.store(known, "labels")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumn("weight", F.lit(max(1.0, n / most))) for y, n in sorted(counts.items()) if y in (0, 1)]
    if not parts:
        return known.withColumn("weight", F.lit(1.0)).limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # no more than 2 * most rows, so that broadcasting them is safe
    met = docs.select("doc_id", "text").join(F.broadcast(out), "doc_id")
    return met.groupBy("doc_id", "toxic", "weight").agg(F.min("text").alias("text")).select("text", F.col("toxic").cast("int"), "weight")


def _select(sample: DataFrame) -> np.ndarray:
    """Hashes of the features worth a weight, from counts over the sample that the executors make and add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, 0):
                w = Words(data, offsets, plain=True)
                doc = w.doc()
                of = np.concatenate([doc[at] for at, _ in _grams(w)])
                hashes = np.concatenate([h for _, h in _grams(w)])
                order = np.lexsort((of, hashes))
                of, hashes = of[order], hashes[order]
                one = np.ones(len(of), dtype=bool)
                one[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
                toxic = np.asarray(common.column(batch, 1, lo, hi))[of[one]]
                h, at, n = np.unique(hashes[one], return_index=True, return_counts=True)
                k = np.add.reduceat(toxic, at) if len(at) else at
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(k.astype(np.int64))], names=["hash", "n", "k"])

    sizes = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).first()
    all_n, all_k = sizes["n"], sizes["k"] or 0
    if all_k in (0, all_n):
        return np.empty(0, np.uint64)
    counts = sample.mapInArrow(run, "hash bigint, n bigint, k bigint").groupBy("hash").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).where(F.col("n") >= MIN_TEXTS)
    p = F.col("n") / all_n
    apart = F.abs(F.col("k") / all_k - (F.col("n") - F.col("k")) / (all_n - all_k))
    error = F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / all_k + 1 / (all_n - all_k)))
    chosen = counts.where(apart >= MIN_DEVIATION * error).select("hash").toPandas()["hash"]  # few: the sample is bounded
    return np.sort(chosen.to_numpy(dtype=np.int64).view(np.uint64))


def _featurise(sample: DataFrame, features: np.ndarray) -> list:
    """(label, weight, sentences, the sentence and number of each feature found) of each text; no text reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, 0):
                w = Words(data, offsets, plain=True)
                sentence, doc = _sentences(w)
                n = np.bincount(doc, minlength=hi - lo)
                first = np.concatenate([[0], np.cumsum(n)])
                sent, feat = [], []
                for at, h in _grams(w):
                    k = np.minimum(np.searchsorted(features, h), max(len(features) - 1, 0))
                    on = features[k] == h if len(features) else np.zeros(len(h), bool)
                    sent.append(sentence[at[on]])
                    feat.append(k[on])
                sent, feat = np.concatenate(sent), np.concatenate(feat)
                order = np.lexsort((feat, sent))
                sent, feat = sent[order], feat[order]
                cut = np.searchsorted(sent, first)
                own = [(sent[a:b] - f, feat[a:b]) for a, b, f in zip(cut[:-1], cut[1:], first, strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [common.column(batch, 1, lo, hi), common.column(batch, 2, lo, hi), pa.array(n.astype(np.int64)), pa.array([x.astype("<u4").tobytes() for x, _ in own], pa.binary()), pa.array([x.astype("<u4").tobytes() for _, x in own], pa.binary())],
                    names=["toxic", "weight", "n", "sentences", "features"],
                )

    return sample.mapInArrow(run, "toxic int, weight double, n bigint, sentences binary, features binary").collect()


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, epochs: int = 8, rate: float = 0.5, decay: float = 1e-5, seed: int = 8) -> Model:
    """Fit the sentence scorer on a bounded sample of labelled rows; the loss is that of the noisy-or of each document.

    Without a row of either class the model has no features, and a score that is the same for all sentences.
    """
    rows_of = common.store(training_rows(docs, labels, most), "sample")
    features = _select(rows_of)
    if not len(features):
        return Model(np.empty(0, np.uint64), np.empty(0), -12.0)
    sample = _featurise(rows_of, features)
    # the order in which the rows came must not decide
    sample.sort(key=lambda r: (bytes(r["features"]), bytes(r["sentences"]), r["n"], r["toxic"]))
    y = np.array([r["toxic"] for r in sample], dtype=float)
    weight = np.array([r["weight"] for r in sample])
    rows = [(np.frombuffer(r["sentences"], dtype="<u4").astype(np.int64), np.frombuffer(r["features"], dtype="<u4").astype(np.int64), r["n"]) for r in sample]
    w, grad2 = np.zeros(len(features)), np.full(len(features), 1e-2)
    bias, bias2 = -5.0, 1e-2
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), 32):
            part = order[lo : lo + 32]
            start = np.concatenate([[0], np.cumsum([rows[i][2] for i in part])])
            sent = np.concatenate([rows[i][0] + start[k] for k, i in enumerate(part)])
            feat = np.concatenate([rows[i][1] for i in part])
            doc = np.repeat(np.arange(len(part)), np.diff(start))
            z = np.bincount(sent, weights=w[feat], minlength=int(start[-1])) + bias
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            whole = np.clip(noisy_or(p, doc, len(part)), 1e-6, 1)
            # d loss / d z of a sentence is p * (1 - y / P)
            g = p * (1 - y[part] / whole)[doc] * weight[part][doc] / len(part)
            gw = np.bincount(feat, weights=g[sent], minlength=len(w)).astype(float)  # whole numbers if no feature is there
            hit = gw != 0
            gw[hit] += decay * w[hit]
            grad2[hit] += gw[hit] ** 2
            w[hit] -= rate * gw[hit] / np.sqrt(grad2[hit])
            gb = g.sum()
            bias2 += gb**2
            bias -= rate * gb / np.sqrt(bias2)
    return Model(features, w, float(bias))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, locate: bool = False) -> DataFrame:
    """doc_id and score (0 to 1) of docs(doc_id, text); with locate also the offending sentences.

    Null and empty texts have no sentence and score 0. doc_id may be null or repeated; extra columns are ignored. spans
    are (start, end, score) of sentences at or over the threshold, as code point positions in the text.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # features of a bounded sample
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, 1):
                w = Words(data, offsets, plain=True)
                p, doc, sentence = sentence_scores(w, shared.value)
                cols = [common.column(batch, 0, lo, hi), pa.array(noisy_or(p, doc, hi - lo))]
                if locate:
                    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    first = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]]) if len(sentence) else np.empty(0, np.int64)
                    last = np.append(first[1:], len(sentence)) - 1 if len(first) else first
                    spans = [[] for _ in range(hi - lo)]
                    for k in np.flatnonzero(p >= threshold):
                        d = doc[k]
                        spans[d].append({"start": int(heads[w.start[first[k]]] - heads[offsets[d]]), "end": int(heads[w.end[last[k]]] - heads[offsets[d]]), "score": float(p[k])})
                    cols.append(pa.array(spans, span_type))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "spans"][: len(cols)])

    more = ", spans array<struct<start:bigint,end:bigint,score:double>>" if locate else ""
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double{more}")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose score is under the threshold.

    Null and empty texts score 0 and stay; repeated rows stay or go alike. Other columns may have any names and any values."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, at):
                p, doc, _ = sentence_scores(Words(data, offsets, plain=True), shared.value)
                yield batch.slice(lo, hi - lo).filter(pa.array(noisy_or(p, doc, hi - lo) < threshold))

    return docs.mapInArrow(run, docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs, common.table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
