"""Periodic runs against a quadratic search."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest

from dossierforge.llm import common, runs
from tests.llm.test_llm import SCHEMA, TEXTS, words
from tests.test_oracles import SF


def brute(w, min_length=6, exponent=4):
    """Every period at every place."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, exponent * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def made(rng):
    letters = int(rng.integers(1, 6))
    if rng.random() < 0.3:
        return [f"w{x}" for x in rng.integers(0, 2, rng.integers(0, 120))]
    out = []
    for _ in range(rng.integers(0, 6)):
        block = rng.integers(0, letters, rng.integers(1, 8)).tolist()
        out += block * int(rng.integers(1, 9)) + block[: rng.integers(0, len(block) + 1)]
    return [f"w{x}" for x in out]


@pytest.mark.parametrize(("min_length", "exponent"), [(6, 4), (2, 2), (5, 3), (9, 2)])
def test_runs_equal_a_quadratic_search(min_length, exponent):
    rng = np.random.default_rng(min_length)
    texts = [made(rng) for _ in range(400)]
    raw = [" \n".join(w).encode() for w in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    f = runs.Found(np.frombuffer(b"".join(raw), np.uint8), offsets, None, min_length, exponent)
    for d, (w, got) in enumerate(zip(texts, f.collapsed(), strict=True)):
        want = brute(w, min_length, exponent)
        assert f.runs(d) == want and got.decode() == collapsed(w, want)


def test_few_pairs_at_once_and_thue_morse(monkeypatch):
    monkeypatch.setattr(runs, "PAIRS", 7)
    w = ["ab"[bin(i).count("1") % 2] for i in range(600)] + ["x", "y", "z"] * 40 + ["a"] * 50  # sums of powers of two of two letters take such texts for periodic
    raw = " ".join(w).encode()
    f = runs.Found(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), None, 6, 4)
    assert f.runs(0) == brute(w)


def test_gram_length():
    assert runs.gram_length() == 5 and runs.gram_length(2, 2) == 1
    for m, e in ((6, 4), (20, 2), (5, 3)):
        assert runs.gram_length(m, e) == min(max(m, e * q) - q for q in range(1, 500))
    with pytest.raises(ValueError, match="two"):
        runs.gram_length(1, 4)


def test_frames(spark):
    again = [(20, "so " * 9), (21, "x a b c a b c a b c a b c y"), (22, "ü é " * 5), (22, "ü é " * 5)]
    docs = spark.createDataFrame([(i, t, "en", None, 0, "x", 1, "y") for i, t in [*TEXTS, *again]], SCHEMA)
    got = sorted((r["doc_id"] or -1, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(docs).collect())
    assert got == sorted((i or -1, b := brute(words(t)), collapsed(words(t), b)) for i, t in [*TEXTS, *again])
    digests = {(r["doc_id"], r["collapsed_sha256"]): r for r in runs.run_digests(docs).collect()}
    for i, t in [*TEXTS, *again]:
        b = brute(words(t))
        r = digests[i, hashlib.sha256(collapsed(words(t), b).encode()).hexdigest()]
        assert r["n_runs"] == len(b) and (r["start"] is None) == (not b)
    assert runs.periodic_runs(docs.limit(0)).count() == runs.run_digests(docs.limit(0), plant=True).count() == 0
    assert runs.run_digests(docs, plant=True).count() == len(TEXTS) + 4


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: words(r["text"]) for r in common.table(spark, SF, "documents").collect()}
    rows = runs.op12_periodic_runs(spark, SF).collect()
    assert len(rows) == len(texts) and sum(r["n_runs"] > 0 for r in rows) > len(rows) // 20
    for r in rows:
        w = texts[r["doc_id"]]
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 2000:
            continue  # the quadratic search takes long; SQL has them all
        b = brute(w)
        best = min(b, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if b else (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(b), *best, 1000 * best[1] // best[2] if b else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in b).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, b).encode()).hexdigest()
