"""Quality rules: repetition coverage by rolling hashes of several n-gram lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common
from .common import Words, covered, segment_sums, text_chunks

#: Largest share of a text's word characters that may lie inside repeated n-grams, by n (published filtering rules for web text).
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of a text's word characters that may lie in lines seen before in it.
LINE_LIMIT = 0.20
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def _repeats(w: Words, at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows are found twice or more in their text; which of those are not the first."""
    key = common.mix(h + w.doc()[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice, later = np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=bool)
    later[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, later


def _lines(w: Words, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: lines with a word that equal an earlier line, and the word characters in them."""
    n_docs = len(w.bound) - 1
    ends = np.flatnonzero(w.data == 10)
    # every text begins a line, and so does what follows a line feed
    starts = np.unique(np.concatenate([w.offsets[:-1], ends + 1]))
    starts = starts[starts < len(w.data)]
    if not len(starts):
        return np.zeros(n_docs, dtype=np.int64), np.zeros(n_docs, dtype=np.int64)
    stops = np.append(starts[1:], len(w.data))
    feed = w.data[stops - 1] == 10
    stops = stops - feed  # a line's bytes without its line feed
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(common._BYTE[w.data] * common.powers(common._BASE, len(w.data)), dtype=np.uint64)])
    h = (total[stops] - total[starts]) * common.powers(common._INVERSE, len(w.data))[starts]
    doc = np.searchsorted(w.offsets, starts, "right") - 1
    first = np.searchsorted(w.start, starts)
    last = np.searchsorted(w.start, stops)
    wordy = last > first
    key = common.mix(h + common.mix(doc.astype(np.uint64) + (stops - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    later = np.zeros(len(starts), dtype=bool)
    later[order[1:]] = key[order][1:] == key[order][:-1]
    later &= wordy
    upto = np.concatenate([[0], np.cumsum(chars)])
    return np.bincount(doc[later], minlength=n_docs), np.bincount(doc[later], weights=(upto[last] - upto[first])[later], minlength=n_docs).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    w = Words(data, offsets)
    chars = w.code_points()
    out = {"n_words": w.counts, "word_chars": segment_sums(chars, w.bound)}
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]
    out["n_dup_lines"], out["dup_line_chars"] = _lines(w, chars)
    for k in lengths:
        at, h = w.grams(k)
        twice, later = _repeats(w, at, h) if len(at) else (at, at)
        if k == 5:
            inside = covered(at[twice], k, len(chars)) if len(at) else np.zeros(len(chars), dtype=bool)
            out["n_repeat_words"] = segment_sums(inside.astype(np.int64), w.bound)
        inside = covered(at[later], k, len(chars)) if len(at) else np.zeros(len(chars), dtype=bool)
        out[f"dup_{k}gram_chars"] = segment_sums(np.where(inside, chars, 0), w.bound)
    return out


def repetition_rules(docs: DataFrame, ngram_limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT) -> DataFrame:
    """One row per row of docs(doc_id, text): counts, the characters inside repeated n-grams and lines, and the verdict.

    A window counts as repeated where the same words stood earlier in the text, so a text's first use of a phrase is
    never held against it. Nulls and empty texts have no words and fail the base rule; doc_id is carried as it is, null
    or repeated. Other columns are ignored, whatever their names. An empty table gives an empty result. Long texts are
    measured whole.
    """
    limits = dict(ngram_limits or NGRAM_LIMITS)
    lengths = tuple(sorted({5, *limits}))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup_{k}gram_chars" for k in lengths)]
    schema = f"doc_id {id_type}, {', '.join(f'{c} bigint' for c in longs[:5])}, base_failed boolean, kept boolean, {', '.join(f'{c} bigint' for c in longs[5:])}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, 1):
                f = features(data, offsets, lengths)
                failed = (f["n_words"] < 10) | (100 * f["n_repeat_words"] > 20 * f["n_words"])
                bad = failed | (f["dup_line_chars"] > line_limit * f["word_chars"])
                for k, most in limits.items():
                    bad |= f[f"dup_{k}gram_chars"] > most * f["word_chars"]
                cols = [common.column(batch, 0, lo, hi), *(pa.array(f[c], pa.int64()) for c in longs[:5]), pa.array(failed), pa.array(~bad), *(pa.array(f[c], pa.int64()) for c in longs[5:])]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *longs[:5], "base_failed", "kept", *longs[5:]])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op1_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(common.table(spark, sf_dir, "documents"))
