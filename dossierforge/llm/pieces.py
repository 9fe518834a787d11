"""SentencePiece ids and back, for merge-type vocabularies: adjacent pairs of symbols are joined in the order of their scores."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common
from .tokens import KNOWN_WORDS, WORD_BYTES, _Known

#: Bytes of text that are encoded at once.
CHUNK_BYTES = 1 << 18
#: Segments of more symbols have an agenda of their own; shorter ones take one pair each per pass, many segments at once.
LONG_SYMBOLS = 64
#: Lengths of runs of spaces whose ids are remembered.
SPACES = 1000

SPACE = "▁"  # fixed value: what stands for a space in a piece
_NEVER = np.int64(2**62)
_U = np.uint64


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("dossierforge-one-each", _one_each)


def _valid(text: bytes) -> bytes:
    """UTF-8 in which each byte of no character has become a replacement character."""
    try:
        text.decode()
    except UnicodeDecodeError:
        return text.decode(errors="dossierforge-one-each").encode()
    return text


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = message[at : at + size], at + size
        yield key >> 3, value


class _Segments(common.Words):
    """Texts cut into runs of bytes that are no space; a byte of `alone` is a run of its own. lead: how many spaces stand right before each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, alone: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside, apart = data != 0x20, alone[data]
        before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)  # joined with the byte before, after
        if n:
            joined = inside[:-1] & inside[1:] & ~apart[:-1] & ~apart[1:]
            before[1:], after[:-1] = joined, joined
            cuts = offsets[1:-1]
            before[cuts[cuts < n]] = False
            after[cuts[cuts > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.bound = np.searchsorted(self.start, offsets)
        before_it = np.concatenate([[0], self.end[:-1]]) if len(self.end) else self.end
        self.lead = self.start - np.maximum(before_it, offsets[:-1][self.doc()])
        if len(self.start):
            self._total = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(common._BYTE[data] * common.powers(common._BASE, n), dtype=_U)])
            self.hash = self._hash(self.start, self.end)
        else:
            self.hash = np.empty(0, dtype=_U)


class PieceEncoder:
    """Ids equal to those of the sentencepiece library's encode(), and texts equal to those of its decode().

    The vocabulary must be of the merge type with byte fallback, texts not normalised but for a space put before them; anything else raises.
    Where no piece holds a space behind another character, a text can be cut before every run of spaces, and at characters that are in no
    piece of several: no pair that is ever joined lies across such a cut, so that the segments' agendas don't touch one another. Each distinct
    segment goes through its agenda once and is remembered by a 64-bit hash, in a table of bounded size. With any other vocabulary a text is
    one segment. Every segment that goes through an agenda is checked against the library if `check` is set; a difference raises.
    """

    def __init__(self, path: str, check: bool = True):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.check = check
        with open(path, "rb") as f:
            parts = list(_fields(f.read()))
        trainer = dict(_fields(next((v for k, v in parts if k == 2), b"")))
        normalizer = dict(_fields(next((v for k, v in parts if k == 3), b"")))
        # fixed values: numbers of the fields in the library's format, and their defaults
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError(f"{path} is no merge-type vocabulary with byte fallback and spaces before words")
        if normalizer.get(2, b"") or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError(f"{path} normalises texts in ways that are not supported")
        self.unknown = trainer.get(44, " ⁇ ".encode())
        entries = [dict(_fields(v)) for k, v in parts if k == 1]
        names = [e[1].decode() for e in entries]
        kinds = np.array([e.get(3, 1) for e in entries])  # 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte
        if np.isin(kinds, (4, 5)).any():
            raise ValueError(f"{path} has user-defined or unused pieces")
        self.size = len(names)
        normal = np.flatnonzero(kinds == 1)
        number = {names[i]: i for i in normal.tolist()}
        self.byte_id = np.zeros(256, dtype=np.int32)
        for i in np.flatnonzero(kinds == 6).tolist():
            self.byte_id[int(names[i][3:5], 16)] = i
        # characters of pieces that are no pieces themselves have numbers from `size` on
        for c in sorted({c for i in normal.tolist() for c in names[i]} - number.keys()):
            number[c] = self.size + sum(x >= self.size for x in number.values())
        self.chars = np.full(0x110000, -1, dtype=np.int32)
        for name, i in number.items():
            if len(name) == 1:
                self.chars[ord(name)] = i
        self.extra = {i: name for name, i in number.items() if i >= self.size}
        scores = np.array([np.frombuffer(e.get(2, b"\0\0\0\0"), dtype="<f4")[0] for e in entries])
        rank = np.unique(-scores, return_inverse=True)[1].reshape(-1)
        pairs = [(number[a], number[b], i) for i in normal.tolist() for k in range(1, len(names[i])) if (a := names[i][:k]) in number and (b := names[i][k:]) in number]
        left, right, joined = np.array(pairs or np.empty((0, 3)), dtype=np.int64).T
        order = np.argsort(left << 32 | right)
        self.pair_key, self.pair_to, self.pair_rank = (left << 32 | right)[order], joined[order].astype(np.int32), rank[joined[order]].astype(np.int64)
        # how texts may be cut
        self.whole = any(re.search(f"[^{SPACE}]{SPACE}", x) for x in number)
        held = {c for x in number if len(x) > 1 for c in x}
        self.alone = np.zeros(256, dtype=bool)
        self.alone[[b for b in range(1, 32) if chr(b) not in held]] = True
        surface = [self.unknown if k == 2 else b"" if k == 3 else bytes([int(x[3:5], 16)]) if k == 6 else x.replace(SPACE, " ").encode() for x, k in zip(names, kinds.tolist(), strict=True)]
        self.surface, self.decimal = _Strings(surface), _Strings([f"{i},".encode() for i in range(self.size)])
        self.stripped = np.array([k == 1 and x.startswith(SPACE) for x, k in zip(names, kinds.tolist(), strict=True)])
        self.known = _Known(np.uint16 if self.size <= 1 << 16 else np.uint32)
        self.spaces: dict[int, np.ndarray] = {}

    # ------------------------------------------------------------ agendas

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, joined symbol) of pairs; a pair that is no piece is never joined."""
        if not len(self.pair_key):
            return np.full(len(left), _NEVER), np.zeros(len(left), dtype=np.int32)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)  # a symbol below 0 gives a key below 0 or a right half that no piece has
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        there = (self.pair_key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(there, self.pair_rank[at], _NEVER), self.pair_to[at]

    def agenda(self, symbols: list[int]) -> list[int]:
        """One segment: its pairs wait in a heap by score and place; the best is joined and its new neighbours are put in."""
        sym = list(symbols)
        n = len(sym)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        rank, joined = self._find(np.array(sym[:-1], dtype=np.int32), np.array(sym[1:], dtype=np.int32)) if n > 1 else (np.empty(0), np.empty(0))
        heap = [(r, i, sym[i], sym[i + 1], j) for i, (r, j) in enumerate(zip(rank.tolist(), joined.tolist(), strict=True)) if r < _NEVER]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, j = heapq.heappop(heap)
            k = after[i]
            if sym[i] != a or k < 0 or sym[k] != b:
                continue  # one of the two was joined with another meanwhile
            sym[i], sym[k], after[i] = j, None, after[k]
            if after[k] >= 0:
                before[after[k]] = i
            sides = [(x, y) for x, y in ((before[i], i), (i, after[i])) if x >= 0 and y >= 0]
            if sides:
                rank, joined = self._find(np.array([sym[x] for x, _ in sides]), np.array([sym[y] for _, y in sides]))
                for (x, y), r, to in zip(sides, rank.tolist(), joined.tolist(), strict=True):
                    if r < _NEVER:
                        heapq.heappush(heap, (r, x, sym[x], sym[y], to))
        return [s for s in sym if s is not None]

    def agendas(self, sym: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Many short segments at once: each pass joins the best pair of every segment that has one. (symbols, counts) afterwards."""
        where = np.arange(len(count))  # of the segments still at work
        done, done_at, done_count = [], [], []
        seg = np.repeat(where, count)
        pair = np.append(seg[1:] == seg[:-1], False)  # whether a symbol's successor is in its segment
        rank, to = np.full(len(sym), _NEVER), np.zeros(len(sym), dtype=np.int32)
        at = np.flatnonzero(pair)
        rank[at], to[at] = self._find(sym[at], sym[at + 1])
        while len(sym):
            first = np.cumsum(count) - count
            best = np.minimum.reduceat(np.where(rank < _NEVER, rank << 32 | np.arange(len(sym)), _NEVER), first)
            live = best < _NEVER
            if not live.all():
                stay = np.repeat(live, count)
                done.append(sym[~stay]), done_at.append(where[~live]), done_count.append(count[~live])
                moved = np.cumsum(stay) - 1
                sym, rank, to, pair = sym[stay], rank[stay], to[stay], pair[stay]
                where, count, best = where[live], count[live], best[live]
                at = moved[best & 0xFFFFFFFF]
            else:
                at = best & 0xFFFFFFFF
            if not len(sym):
                break
            sym[at] = to[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            pair[at] = pair[at + 1]
            moved = np.cumsum(keep) - 1
            sym, rank, to, pair, count, at = sym[keep], rank[keep], to[keep], pair[keep], count - 1, moved[at]
            rank[at] = _NEVER
            changed = np.zeros(len(sym), dtype=bool)
            changed[at] = changed[np.maximum(at - 1, 0)] = True
            again = np.flatnonzero(changed & pair)
            rank[again], to[again] = self._find(sym[again], sym[again + 1])
        if not done:
            return sym, count
        all_sym, all_at, all_count = map(np.concatenate, (done, done_at, done_count))
        order = np.argsort(all_at, kind="stable")
        return all_sym[_spread(np.cumsum(all_count) - all_count, all_count, order)], all_count[order]

    def _ids(self, sym: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols: a character that is no piece becomes its bytes."""
        odd = np.flatnonzero((sym < 0) | (sym >= self.size))
        if not len(odd):
            return sym.astype(np.uint32), count
        raw = [(chr(-1 - s) if s < 0 else self.extra[s]).encode() for s in sym[odd].tolist()]
        size = np.ones(len(sym), dtype=np.int64)
        size[odd] = [len(r) for r in raw]
        first = np.cumsum(size) - size
        out = np.repeat(sym, size)
        out[_spread(first, size, odd)] = self.byte_id[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        return out.astype(np.uint32), common.segment_sums(size, np.concatenate([[0], np.cumsum(count)]))

    def _new(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, count) of segments, their spaces written out."""
        points = np.frombuffer("".join(texts).replace(" ", SPACE).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        count = np.array([len(t) for t in texts], dtype=np.int64)
        sym = self.chars[points]
        sym = np.where(sym < 0, -1 - points, sym).astype(np.int32)
        first = np.cumsum(count) - count
        long = np.flatnonzero(count > LONG_SYMBOLS)
        short = np.flatnonzero((count <= LONG_SYMBOLS) & (count > 0))
        a, n = self.agendas(sym[_spread(first, count, short)], count[short]) if len(short) else (sym[:0], count[:0])
        alone = [np.array(self.agenda(sym[first[i] : first[i] + count[i]].tolist()), dtype=np.int32) for i in long.tolist()]
        ids, size = self._ids(np.concatenate([a, *alone]).astype(np.int32), np.concatenate([n, [len(x) for x in alone]]).astype(np.int64))
        place, held = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        turn = np.concatenate([short, long])
        place[turn], held[turn] = np.cumsum(size) - size, size
        if self.check:
            self._checked(texts, ids, place, held)
        return ids, place, held

    def _checked(self, texts: list[str], ids: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
        """The library puts a space before each text; a segment without one, or of one alone, goes behind a line feed, which is cut off again."""
        spaced = [len(t) > 1 and t[0] == " " for t in texts]
        if not all(s or t == "" for s, t in zip(spaced, texts, strict=True)) and (self.whole or not self.alone[10]):
            raise ValueError("segments without a space can't be checked with this vocabulary")
        found = self.library.encode([t[1:] if s else t and "\n" + t for t, s in zip(texts, spaced, strict=True)], num_threads=1)
        for t, s, want, a, n in zip(texts, spaced, found, first.tolist(), count.tolist(), strict=True):
            if (want if s else want[2:]) != ids[a : a + n].tolist():
                raise ValueError(f"the library gives other ids for {t[:80]!r}")

    def _spaces(self, n: int) -> np.ndarray:
        ids = self.spaces.get(n)
        if ids is None:
            ids = self._new([" " * n])[0]
            if n <= SPACES:
                self.spaces[n] = ids
        return ids

    # ------------------------------------------------------------ texts

    def encode_chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of each text in the byte buffer, and where they lie."""
        n, known = len(offsets) - 1, self.known
        if (raw := data.tobytes()).find(SPACE.encode()) >= 0:  # the same as a space
            texts = [raw[a:b].replace(SPACE.encode(), b" ") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            raw, offsets = b"".join(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            data = np.frombuffer(raw, dtype=np.uint8)
        if self.whole:
            texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            ids, first, count = self._new([" " + t if t else "" for t in texts])
            return ids[_spread(first, count, np.arange(n))], np.concatenate([[0], np.cumsum(count)])
        w = _Segments(data, offsets, self.alone)
        begins = np.flatnonzero(w.counts)
        lead = w.lead
        lead[w.bound[:-1][begins]] += 1  # the space put before a text
        key = common.mix(w.hash + lead.astype(_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
        held = known.used  # what is put behind it goes again, unless the table takes it
        there, at, size = known.find(key)
        short = (w.end - w.start <= WORD_BYTES) & (lead <= WORD_BYTES)
        there &= short
        new = np.flatnonzero(~there)
        if len(new):
            brief = new[short[new]]
            _, one, back = np.unique(key[brief], return_index=True, return_inverse=True)
            each = np.concatenate([brief[one], new[~short[new]]])  # long ones each for itself, not by their hash
            ids, new_at, new_size = self._new([" " * k + raw[a:b].decode() for k, a, b in zip(lead[each].tolist(), w.start[each].tolist(), w.end[each].tolist(), strict=True)])
            new_at += known.append(ids)
            at[brief], size[brief] = new_at[: len(one)][back.reshape(-1)], new_size[: len(one)][back.reshape(-1)]
            at[each[len(one) :]], size[each[len(one) :]] = new_at[len(one) :], new_size[len(one) :]
            if known.held + len(one) <= KNOWN_WORDS and len(one) == len(each):  # frequent segments come early, so a full table stays as it is
                known.add(key[brief[one]], new_at, new_size)
                held = known.used
        # spaces at the end of a text, or a text of nothing else
        last = np.where(w.counts > 0, w.end[np.maximum(w.bound[1:] - 1, 0)] if len(w.end) else 0, offsets[:-1])
        tail = offsets[1:] - last
        tails = np.flatnonzero(tail > 0)
        ends = [self._spaces(int(tail[d] + (w.counts[d] == 0))) for d in tails.tolist()]
        end_size = np.array([len(x) for x in ends], dtype=np.int64)
        end_at = known.append(np.concatenate(ends)) + np.cumsum(end_size) - end_size if ends else end_size
        place = np.concatenate([2 * w.start + 1, 2 * last[tails] + 2])
        turn = np.argsort(place, kind="stable") if ends else slice(None)
        at, size = np.concatenate([at, end_at])[turn], np.concatenate([size, end_size])[turn]
        doc = np.concatenate([w.doc(), tails])[turn]
        total = np.cumsum(size)
        ids = known.pool[np.repeat(at - total + size, size) + np.arange(total[-1] if len(total) else 0)].astype(np.uint32)
        known.used = held
        return ids, np.concatenate([[0], np.cumsum(np.bincount(doc, weights=size, minlength=n).astype(np.int64))])

    def decode_chunk(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The text of each run of ids, as UTF-8."""
        if len(ids) and int(ids.max()) >= self.size:
            raise IndexError(f"id {int(ids.max())} of {self.size}")
        raw, cut = self.surface.gather(ids)
        ends = np.concatenate([[0], cut])[bounds]
        # the space before a text goes: it is the first byte of the first id that says anything
        said = np.flatnonzero(self.surface.size[ids] > 0)
        lead = np.searchsorted(said, bounds[:-1])
        has = lead < np.searchsorted(said, bounds[1:])
        strip = np.zeros(len(bounds) - 1, dtype=np.int64)
        strip[has] = self.stripped[ids[said[lead[has]]]]
        data, out = raw.tobytes(), []
        silent = np.flatnonzero(self.surface.size[ids] == 0)  # bytes on both sides of a control piece make no character
        for d, (a, b) in enumerate(zip((ends[:-1] + strip).tolist(), ends[1:].tolist(), strict=True)):
            lo, hi = np.searchsorted(silent, bounds[d : d + 2])
            at = [a, *cut[silent[lo:hi]].clip(a).tolist(), b]
            out.append(b"".join(_valid(data[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)))
        return out

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        raw = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        ids, bounds = self.encode_chunk(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
        return [x.tolist() for x in np.split(ids, bounds[1:-1])] if texts else []

    def decode_all(self, ids: list[list[int]]) -> list[str]:
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        return [x.decode() for x in self.decode_chunk(np.array([i for x in ids for i in x], dtype=np.int64), bounds)]


def _spread(first: np.ndarray, size: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The positions of all members of the chosen runs, run after run."""
    n = size[chosen]
    total = np.cumsum(n)
    return np.repeat(first[chosen] - total + n, n) + np.arange(total[-1] if len(total) else 0)


class _Strings:
    """Byte strings by number, in one buffer."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.size = np.array([len(s) for s in strings], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings one behind the other, and where each ends."""
        return self.data[_spread(self.first, self.size, numbers)], np.cumsum(self.size[numbers])


_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, check: bool = True) -> PieceEncoder:
    """The worker's encoder for this vocabulary; it drops those of others."""
    if (path, check) not in _encoders:
        _encoders.clear()
        _encoders[path, check] = PieceEncoder(path, check)
    return _encoders[path, check]


def encode(docs: DataFrame, path: str, check: bool = True) -> DataFrame:
    """(doc_id, ids) for each row of docs(doc_id, text).

    Null and empty texts have no ids; doc_id is carried as it is, null or repeated, and rows are neither joined nor dropped. Texts are encoded
    whole, however long. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    common.ensure_importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, check)
        for batch in batches:
            for lo, hi, data, offsets in common.text_chunks(batch, 1, CHUNK_BYTES):
                ids, bounds = enc.encode_chunk(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([common.column(batch, 0, lo, hi), lists], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) for each row of rows(doc_id, ids array<int>). A null list gives an empty text; a null id or one outside the vocabulary raises."""
    common.ensure_importable(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, False)
        for batch in batches:
            ids = [x or [] for x in batch.column(1).to_pylist()]
            if any(i is None or not 0 <= i < enc.size for x in ids for i in x):
                raise IndexError("a list holds null or an id outside the vocabulary")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(enc.decode_all(ids), pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, check: bool = True) -> DataFrame:
    """encode() and decode() in one pass: the number of ids of each row of docs(doc_id, text), and digests of the ids and of the text that they decode to.

    Rows as in encode().
    """
    common.ensure_importable(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, check)
        for batch in batches:
            for lo, hi, data, offsets in common.text_chunks(batch, 1, CHUNK_BYTES):
                ids, bounds = enc.encode_chunk(data, offsets)
                said, cut = enc.decimal.gather(ids)
                ends = np.concatenate([[0], cut])[bounds].tolist()
                said = said.tobytes()
                lists = [hashlib.sha256(said[a : max(a, b - 1)]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                texts = [hashlib.sha256(t).hexdigest() for t in enc.decode_chunk(ids, bounds)]
                yield pa.RecordBatch.from_arrays([common.column(batch, 0, lo, hi), pa.array(np.diff(bounds), pa.int64()), pa.array(lists, pa.string()), pa.array(texts, pa.string())], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(common.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
