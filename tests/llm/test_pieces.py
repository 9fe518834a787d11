"""SentencePiece encoding and decoding against the library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from dossierforge.llm import pieces
from tests.llm.test_llm import LONG, SCHEMA, TEXTS

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "   a  b ", "\n x", " \n\n x\r\ny\r\r z", "a▁b▁▁ c▁", "▁", "<s> hi <unk> </s> <0x41>", "\x00x \x00", "ÿ🙂 日本語 한국어 \U000e0001", "﻿a\xa0b c", "x" * 300 + " " + "ab" * 200 + "   ", "\t\t a\tb \x0b \x0c c", "    " * 10 + "end", "();\r\n  };\r", "é é", "\n\n   \n", " " * 2000 + "q", "the " * 50, "aaaaaaaaaaaaaaa " * 9, LONG]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("whole", [False, True])
def test_encoder_equals_the_library(library, whole):
    enc = pieces.PieceEncoder(PATH)
    enc.whole = whole
    want = [library.encode(t) for t in ODD]
    for _ in range(2):  # the second time from memory
        assert enc.encode_all(ODD) == want and enc.encode_all([]) == []
        assert [enc.encode_all([t])[0] for t in ODD] == want
    assert enc.decode_all(want) == [library.decode(i) for i in want]


def test_one_agenda_and_many_agree_with_a_full_memory(library, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_WORDS", 3)
    want = [library.encode(t) for t in ODD]
    for long in (1, 4, 10_000):
        monkeypatch.setattr(pieces, "LONG_SYMBOLS", long)
        enc = pieces.PieceEncoder(PATH)
        assert [x for _ in range(2) for x in enc.encode_all(ODD)] == want * 2 and enc.known.held <= 3


def test_random_texts_and_ids(library):
    rng = np.random.default_rng(5)
    letters = list("ab \n\r\t▁é日🙂th;){")
    texts = ["".join(rng.choice(letters, rng.integers(0, 90))) for _ in range(500)]
    enc = pieces.PieceEncoder(PATH)
    assert enc.encode_all(texts) == [library.encode(t) for t in texts]
    ids = [rng.integers(0, n, rng.integers(0, 12)).tolist() for n in (10, 259, enc.size) for _ in range(700)]
    assert enc.decode_all(ids) == [library.decode(i) for i in ids]
    with pytest.raises(IndexError):
        enc.decode_all([[enc.size]])


def test_a_difference_from_the_library_raises():
    enc = pieces.PieceEncoder(PATH)
    enc.pair_rank = enc.pair_rank.max() - enc.pair_rank  # worst pairs first
    with pytest.raises(ValueError, match="other ids"):
        enc.encode_all(["something quite ordinary, international understanding"])


def test_other_vocabularies_are_refused(tmp_path):
    with open(PATH, "rb") as f:
        model = f.read()
    at = model.index(b"\x12\x00\x18\x01\x20\x00", model.rindex(b"identity"))  # no character map, a space before texts, spaces kept
    (tmp_path / "m.model").write_bytes(model[:at] + b"\x12\x00\x18\x00\x20\x00" + model[at + 6 :])
    with pytest.raises(ValueError, match="normalises"):
        pieces.PieceEncoder(str(tmp_path / "m.model"))


def test_frames(spark, library):
    docs = spark.createDataFrame([(i, t, "en", None, 0, "x", 1, "y") for i, t in [*TEXTS, *enumerate(ODD, 100)]], SCHEMA)
    ids = pieces.encode(docs, PATH)
    texts = [t or "" for _, t in TEXTS] + ODD
    got = sorted((r["doc_id"] or -1, r["ids"]) for r in ids.collect())
    assert got == sorted((i or -1, library.encode(t)) for i, t in zip([i for i, _ in TEXTS] + list(range(100, 100 + len(ODD))), texts, strict=True))
    back = sorted((r["doc_id"] or -1, r["text"]) for r in pieces.decode(ids, PATH).collect())
    assert back == sorted((i, library.decode(x)) for i, x in got)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    trip = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in pieces.round_trip(docs, PATH).collect())
    assert trip == sorted((i, len(x), digest(",".join(map(str, x))), digest(library.decode(x))) for i, x in got)
    assert pieces.encode(docs.limit(0), PATH).count() == pieces.round_trip(docs.limit(0), PATH).count() == pieces.decode(ids.limit(0), PATH).count() == 0


def test_query_equals_the_library(spark, library):
    from dossierforge.llm import common
    from tests.test_oracles import SF

    texts = {r["doc_id"]: r["text"] or "" for r in common.table(spark, SF, "documents").collect()}
    rows = pieces.op11_piece_codec(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
