"""Toxicity and sharding against plain versions of themselves."""

import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from dossierforge.llm import common, queries, sharding, toxicity
from tests.test_oracles import SF

# ---------------------------------------------------------------- toxicity


def sentences(text):
    """Lists of words: lower-case runs of letters, digits and what isn't ASCII. A sentence ends at . ! ? and line feeds; those without words are none."""
    parts = re.split(r"[.!?\n]", text or "")
    found = [re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), p.encode())) for p in parts]
    return [f for f in found if f]


def features(text):
    """(sentence, feature) of words, of pairs (which belong to the sentence of their first word), and of the starts of longer words."""
    found = sentences(text)
    flat = [(i, w) for i, s in enumerate(found) for w in s]
    out = [(i, ("word", w)) for i, w in flat] + [(i, ("pair", a + b" " + b)) for (i, a), (_, b) in zip(flat[:-1], flat[1:], strict=True)]
    return out + [(i, ("stem", w[:k])) for i, w in flat for k in toxicity.STEMS if len(w) > k], len(found)


_hashes = {}


def number(feature):
    """The operator's hash of a feature, taken from a text that consists of it."""
    if feature not in _hashes:
        kind, text = feature
        raw = np.frombuffer(text + b"x" if kind == "stem" else text, dtype=np.uint8)
        grams = toxicity._grams(common.Words(raw, np.array([0, len(raw)]), plain=True))
        at = 0 if kind == "word" else 1 if kind == "pair" else 2 + toxicity.STEMS.index(len(text))
        _hashes[feature] = int(grams[at][1][0])
    return _hashes[feature]


def plain_score(text, model):
    weights = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    found, n = features(text)
    z = [model.bias] * n
    for i, f in found:
        z[i] += weights.get(number(f), 0.0)
    clean = 1.0
    for x in z:
        clean *= 1 - 1 / (1 + math.exp(-min(30, max(-30, x))))
    return 1 - clean


def loss(z, y):
    whole = min(1.0, max(1e-6, 1 - math.prod(1 - 1 / (1 + math.exp(-x)) for x in z)))
    return -math.log(whole) if y else -sum(math.log(1 - 1 / (1 + math.exp(-x))) for x in z)


def corpus():
    rng = np.random.default_rng(11)
    rows, labels = [], []
    for i in range(240):
        s = [" ".join(f"term{x}" for x in rng.integers(0, 60, 6)) for _ in range(int(rng.integers(1, 5)))]
        if i % 3 == 0:
            s[-1] += " Horribly vile"
        rows.append((i, "! ".join(s) + (".\n" if i % 2 else "")))
        labels.append((i, int(i % 3 == 0)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    d, y = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    return dict(rows), dict(labels), d, y, toxicity.fit(d, y, epochs=2)


def test_features_are_chosen_from_the_folds_that_are_not_held_out(fitted):
    texts, labels, _, _, model = fitted
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 4 != 2]
    assert 0 < len(train) < len(texts)
    n, k = Counter(), Counter()
    for i in train:
        for f in {number(f) for _, f in features(texts[i])[0]}:
            n[f] += 1
            k[f] += labels[i]
    all_n, all_k = len(train), sum(labels[i] for i in train)
    want = set()
    for f in n:
        p = n[f] / all_n
        error = math.sqrt(max(p * (1 - p), 1e-12) * (1 / all_k + 1 / (all_n - all_k)))
        if n[f] >= toxicity.MIN_TEXTS and abs(k[f] / all_k - (n[f] - k[f]) / (all_n - all_k)) >= toxicity.MIN_DEVIATION * error:
            want.add(f)
    assert set(model.features.tolist()) == want and number(("word", b"vile")) in want and number(("pair", b"horribly vile")) in want


def test_scores_equal_a_plain_noisy_or(spark, fitted):
    texts, _, d, _, model = fitted
    got = {r["doc_id"]: r["score"] for r in toxicity.score(d, model).collect()}
    assert all(got[i] == pytest.approx(plain_score(t, model), abs=1e-9) for i, t in texts.items())
    odd = ["", None, "...", "vile", "Vile! vile? vile\nvile", "horribly. vile", "é vileness vilée", "term1 " * 5000 + "vile."]
    d = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(d, model).collect()}
    assert [got[i] for i in range(len(odd))] == [pytest.approx(plain_score(t, model), abs=1e-9) for t in odd]


def test_fit_goes_down_the_slope_of_the_loss(fitted):
    """The same steps, with every derivative measured: the loss of a document a little to both sides of each sentence's sum."""
    _, _, d, y, model = fitted
    sample = toxicity._featurise(toxicity.training_rows(d, y), model.features)
    sample.sort(key=lambda r: (bytes(r["features"]), bytes(r["sentences"]), r["n"], r["toxic"]))
    rows = [(np.frombuffer(r["sentences"], "<u4").tolist(), np.frombuffer(r["features"], "<u4").tolist(), r["n"], r["toxic"], r["weight"]) for r in sample]
    w, grad2 = [0.0] * len(model.features), [1e-2] * len(model.features)
    bias, bias2, rng, step = -5.0, 1e-2, np.random.default_rng(8), 1e-5
    for _ in range(2):
        order = rng.permutation(len(rows)).tolist()
        for lo in range(0, len(order), 32):
            part, slope, slope_bias = order[lo : lo + 32], defaultdict(float), 0.0
            for i in part:
                sent, feat, n, toxic, weight = rows[i]
                z = [bias] * n
                for s, f in zip(sent, feat, strict=True):
                    z[s] += w[f]
                g = [(loss([*z[:s], z[s] + step, *z[s + 1 :]], toxic) - loss([*z[:s], z[s] - step, *z[s + 1 :]], toxic)) / (2 * step) * weight / len(part) for s in range(n)]
                slope_bias += sum(g)
                for s, f in zip(sent, feat, strict=True):
                    slope[f] += g[s]
            for f, g in slope.items():
                g += 1e-5 * w[f]
                grad2[f] += g * g
                w[f] -= 0.5 * g / math.sqrt(grad2[f])
            bias2 += slope_bias**2
            bias -= 0.5 * slope_bias / math.sqrt(bias2)
    assert bias == pytest.approx(model.bias, abs=1e-3) and w == pytest.approx(model.weights.tolist(), abs=1e-3)


def test_query_folds(spark):
    rows = queries.QUERIES["op8_toxicity"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


# ---------------------------------------------------------------- sharding


def jump(key, shards):
    last, at = -1, 0
    while at < shards:
        last, key = at, (key * 2862933555777941757 + 1) % 2**64
        at = int((last + 1) * (2**31 / ((key >> 33) + 1)))
    return last


def test_jump_hash_equals_the_published_loop():
    rng = np.random.default_rng(7)
    keys = np.concatenate([rng.integers(0, 2**64, 3000, dtype=np.uint64), np.array([0, 1, 2**64 - 1], dtype=np.uint64)])
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]


def test_every_row_of_the_query_is_where_its_key_says(spark):
    rows = queries.QUERIES["op6_sharding"](spark, SF).collect()
    for r in rows:
        key = xxhash.xxh64_intdigest(struct.pack("<q", r["doc_id"]), seed=42)
        assert (r["shard"], r["grown_shard"]) == (jump(key, 16), jump(key, 17))
    moved = sum(r["shard"] != r["grown_shard"] for r in rows)
    assert 0 < moved < len(rows) / 8  # about one in 17


def test_shards_with_ties(spark):
    d = spark.createDataFrame([(i % 7 if i % 5 else None, f"t{i % 3}", i) for i in range(200)], "k long, t string, i int")
    rows = sharding.assign_shards(d, "k", 4, ("t",)).collect()
    by, where = defaultdict(list), defaultdict(set)
    for r in rows:
        by[r["shard"]].append((r["slot"], (r["k"] is not None, r["k"] or 0, r["t"])))
        where[r["k"]].add(r["shard"])
    assert len(rows) == 200 and all(len(x) == 1 for x in where.values())
    for found in by.values():
        found.sort()
        assert [s for s, _ in found] == list(range(len(found))) and [o for _, o in found] == sorted(o for _, o in found)
