"""Vector codes against Lloyd's rounds that compute every distance."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossierforge.llm import codebooks

SCHEMA = "vec_id long, embedding array<float>, label int, i string, part int, text string"


def brute(rows, parts, entries, rounds, scale):
    """In whole numbers of any size."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]] for p in range(parts)]
    d = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    assign = lambda: [[min(range(len(b)), key=lambda a: (d(cut(v, p), b[a]), a)) for p, b in enumerate(books)] for _, v, _ in kept]
    for _ in range(rounds):
        of = assign()
        for p, b in enumerate(books):
            for a in range(len(b)):
                mine = [cut(v, p) for (_, v, _), o in zip(kept, of, strict=True) if o[p] == a]
                if mine:
                    b[a] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out = [(i, "".join(f"{a:02x}" for a in o), sum(d(cut(v, p), books[p][a]) for p, a in enumerate(o)), k) for (i, v, k), o in zip(kept, assign(), strict=True)]
    by = defaultdict(int)
    for _, _, e, k in out:
        by[k] += e
    return [(i, c, e, by[k], digest) for i, c, e, k in out]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize(("rows", "entries", "spread"), [(300, 16, 1.0), (40, 256, 0.01), (200, 1, 5.0), (250, 30, 100_000.0)])
def test_codes_equal_plain_rounds(spark, monkeypatch, rows, entries, spread):
    monkeypatch.setattr(codebooks, "BLOCK_BYTES", 8 * 4 * 23)
    monkeypatch.setattr(codebooks, "SCAN_ROWS", 7)
    rng = np.random.default_rng(rows)
    some = [(int(i), (spread * rng.normal(size=8)).astype(np.float32).tolist(), None if i % 5 == 0 else int(i % 3)) for i in rng.permutation(rows)]
    some += [(3, some[0][1], 7), (None, some[1][1], 1), *some[:20]]  # repeated ids, rows and vectors, a null id
    some += [(1000, None, 1), (1001, [1.0] * 7 + [None], 1), (1002, [float("nan")] * 8, 1), (1003, [float("inf")] + [0.0] * 7, 1), (1004, [0.0] * 8, 2), (1005, [-0.0] * 8, 2)]
    got = codebooks.compress(vectors(spark, some).repartition(3), 4, entries, 4, 1024)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert key(got.collect()) == key(brute(some, 4, entries, 4, 1024))


def test_heaps_leave_most_parts_alone(spark):
    """Groups far from one another: after the first rounds few bounds are violated, and codes are as without bounds."""
    rng = np.random.default_rng(2)
    some = [(i, (np.repeat((i % 10) * 10.0, 8) + rng.normal(size=8)).astype(np.float32).tolist(), 0) for i in range(600)]
    rows = vectors(spark, some).select(F.col("vec_id").alias("i"), F.col("label").alias("l"), F.col("embedding").alias("v"))
    books, state = codebooks.fit(rows, 4, 10, 4, 1024)
    assert books.rescanned[0] == 4 * 600 and sum(books.rescanned[1:]) < 2 * 600
    assert key(codebooks.compress(vectors(spark, some), 4, 10).collect()) == key(brute(some, 4, 10, 4, 1024))


def test_empty_and_impossible(spark):
    assert codebooks.compress(vectors(spark, [])).count() == codebooks.compress(vectors(spark, [(1, None, 1), (2, [float("nan")] * 4, 1)])).count() == 0
    for bad in ([(1, [0.0] * 6, 1)], [(1, [0.0] * 8, 1), (2, [0.0] * 4, 1)], [(1, [], 1)]):
        with pytest.raises(ValueError, match="components"):
            codebooks.compress(vectors(spark, bad))
    with pytest.raises(OverflowError):
        codebooks.compress(vectors(spark, [(1, [1e30] * 8, 1)]))
    with pytest.raises(ValueError, match="256"):
        codebooks.compress(vectors(spark, []), entries=300)


def test_no_rounds(spark):
    some = [(i, [float(i), 0.0, 1.0, 2.0], None) for i in range(9)]
    assert key(codebooks.compress(vectors(spark, some), 2, 3, 0, 4).collect()) == key(brute(some, 2, 3, 0, 4))
