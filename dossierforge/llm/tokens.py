"""Token ids by the tokenizers library, and a directly addressable binary format for them."""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Bytes of text that are encoded at once.
CHUNK_BYTES = 1 << 18
#: Slots of a worker's table of known words (28 MB), the words it takes, and the bytes that one may have.
SLOTS, KNOWN_WORDS, WORD_BYTES = 1 << 21, 1_200_000, 48
#: Words that go to the tokenizer in one text.
JOINED = 1000

# The shapes of the two vocabularies whose texts may be cut into words, as their files state them.
_LETTERS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_BY_LETTERS = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _LETTERS}, "behavior": "Removed", "invert": True}, _BYTE_LEVEL | {"use_regex": False}]}
_LOWER_CASE = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}

#: First bytes of white space that isn't ASCII's (or is 0x1C to 0x1F), which a pattern may join with ASCII white space.
_MAYBE_SPACE = np.zeros(256, dtype=bool)
_MAYBE_SPACE[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class _Known:
    """Ids by 64-bit key, in an open-addressing table of fixed size over one pool of ids."""

    def __init__(self, dtype: type):
        self.keys = np.zeros(SLOTS, dtype=np.uint64)
        self.first = np.zeros(SLOTS, dtype=np.uint32)
        self.count = np.zeros(SLOTS, dtype=np.uint16)
        self.pool = np.empty(1 << 16, dtype=dtype)
        self.used = self.held = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, or the free slot where it would go."""
        at = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (SLOTS - 1)
            there = self.keys[at[open_]]
            open_ = open_[(there != keys[open_]) & (there != 0)]
        return at

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, first, count) of keys, none of which is 0."""
        at = self._slots(keys)
        return self.keys[at] == keys, self.first[at].astype(np.int64), self.count[at].astype(np.int64)

    def append(self, ids: np.ndarray) -> int:
        """Put ids at the end of the pool; where they begin."""
        if self.used + len(ids) > len(self.pool):
            wider = np.empty(2 * (self.used + len(ids)), dtype=self.pool.dtype)
            wider[: self.used] = self.pool[: self.used]
            self.pool = wider
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def add(self, keys: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
        """Distinct keys that aren't in the table."""
        todo = np.arange(len(keys))
        while len(todo):
            at = self._slots(keys[todo])
            self.keys[at] = keys[todo]
            on = self.keys[at] == keys[todo]  # of keys that want one slot, one gets it
            self.first[at[on]], self.count[at[on]] = first[todo[on]], count[todo[on]]
            todo = todo[~on]
        self.held += len(keys)


class Encoder:
    """Ids equal to those of the tokenizer's own encode with add_special_tokens=False.

    With a pre-tokenizer known to cut at white space, each distinct word goes through the tokenizer once and is remembered by a 64-bit
    hash, in a table of bounded size; the ids of a chunk of texts are then gathered in numpy. With any other pre-tokenizer, and for texts that
    hold an added token's string or other white space, whole texts go through it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = self.fast = Tokenizer.from_file(path)
        shape = json.loads(self.tokenizer.to_str())
        self.added = [t["content"].encode() for t in shape["added_tokens"]]
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and t["content"] for t in shape["added_tokens"])
        self.lower = plain and shape["pre_tokenizer"] == _BY_LETTERS and shape["normalizer"] == _LOWER_CASE  # white space never reaches an id
        self.bytes = plain and shape["pre_tokenizer"] == _BYTE_LEVEL and shape["normalizer"] is None
        if self.lower:
            # ASCII words are changed by the normalizer to lower case alone, which str.lower does as well, faster
            self.fast = Tokenizer.from_file(path)
            self.fast.normalizer = None
            self.fast.encode_special_tokens = True  # words that hold an added token's string don't come here; in lower case they may
        # what stands between words that are encoded together, and its id, which none of them has
        self.between = " \x01 " if self.lower else "\n"
        mark = self._ids([self.between.strip(" ")])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        self.known = _Known(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.gaps: dict[tuple[bytes, bool], np.ndarray] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, count) of words, each with the space before it if it has one."""
        if self.mark is None:
            joins = [False] * len(words)
        elif self.lower:
            joins = [w.isascii() and "\x01" not in w for w in words]
        else:
            joins = [w[0] == " " for w in words]
        together, alone = (np.flatnonzero(np.array(joins, dtype=bool) == x) for x in (True, False))
        parts, sizes = [], []
        for lo in range(0, len(together), JOINED):
            text = self.between.join([words[i] for i in together[lo : lo + JOINED].tolist()])
            ids = np.array(self.fast.encode_batch_fast([text.lower() if self.lower else text], add_special_tokens=False)[0].ids, dtype="<u4")
            cut = np.flatnonzero(ids == self.mark)
            sizes.append(np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1)
            parts.append(np.delete(ids, cut))
        each = self._ids([words[i] for i in alone.tolist()])
        size = np.concatenate([*sizes, [len(x) for x in each]]).astype(np.int64)
        first, count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        turn = np.concatenate([together, alone])
        first[turn], count[turn] = np.cumsum(size) - size, size
        return np.concatenate([*parts, *each, np.empty(0, "<u4")]), first, count

    def _gap(self, gap: bytes, spaced: bool) -> np.ndarray:
        """The ids of a run of white space before a word (which may have taken its last space)."""
        ids = self.gaps.get((gap, spaced))
        if ids is None:
            ids = self._ids([gap.decode() + (" a" if spaced else "a")])[0][:-1]
            if len(self.gaps) < 10_000 and len(gap) <= WORD_BYTES:
                self.gaps[gap, spaced] = ids
        return ids

    def _odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The texts that have to go through the tokenizer whole."""
        n = len(offsets) - 1
        if not (self.lower or self.bytes):
            return np.arange(n)
        raw, found = data.tobytes(), set()
        for a in self.added:
            at = raw.find(a)
            while at >= 0:
                found.add(int(np.searchsorted(offsets, at, "right")) - 1)
                at = raw.find(a, at + 1)
        maybe = np.unique(np.searchsorted(offsets, np.flatnonzero(_MAYBE_SPACE[data]), "right") - 1)
        found.update(d for d in maybe.tolist() if _OTHER_SPACE.search(raw[offsets[d] : offsets[d + 1]].decode()))
        return np.array(sorted(found), dtype=np.int64)

    def encode_chunk(self, data: np.ndarray, offsets: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of each text in the byte buffer, with the ids `end` behind it, and where they lie."""
        n, known = len(offsets) - 1, self.known
        odd = self._odd(data, offsets)
        held = known.used  # what is put behind it goes again, unless the table takes it
        order, first, count = [], [], []  # what the output is made of: its place in the text, and a run of the pool

        def put(place: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
            order.append(place), first.append(at), count.append(size)

        def put_all(place: list[int], ids: list[np.ndarray]) -> None:
            size = np.array([len(x) for x in ids], dtype=np.int64)
            at = known.append(np.concatenate(ids)) if ids else 0
            put(np.array(place, dtype=np.int64), at + np.cumsum(size) - size, size)

        if len(odd) < n:
            w = common.Words(data, offsets)
            start, stop, doc = w.start, w.end, w.doc()
            key = w.hash | np.uint64(1)
            begin = np.concatenate([[0], stop[:-1]]) if len(stop) else stop
            begin = np.maximum(begin, offsets[doc])  # of the white space before each word
            spaced = np.zeros(len(start), dtype=bool)
            if self.bytes:
                spaced[start > begin] = data[start[start > begin] - 1] == 0x20
                key = np.where(spaced, key ^ np.uint64(0x9E3779B97F4A7C16), key)
            if len(odd):
                on = ~np.isin(doc, odd)
                start, stop, key, begin, spaced = start[on], stop[on], key[on], begin[on], spaced[on]
            there, at, size = known.find(key)
            there &= stop - start <= WORD_BYTES
            new = np.flatnonzero(~there)
            if len(new):
                _, one, back = np.unique(key[new], return_index=True, return_inverse=True)
                long = stop[new] - start[new] > WORD_BYTES
                if long.any():  # long words each for itself, not by their hash
                    one, back = np.arange(len(new)), np.arange(len(new))
                a, b = start[new[one]] - spaced[new[one]], stop[new[one]]
                raw = data.tobytes()
                ids, new_at, new_size = self._new([raw[x:y].decode() for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                new_at += known.append(ids)
                at[new], size[new] = new_at[back], new_size[back]
                if known.held + len(one) <= KNOWN_WORDS and not long.any():  # frequent words come early, so a full table stays as it is
                    known.add(key[new[one]], new_at, new_size)
                    held = known.used
            put(2 * start, at, size)
            if self.bytes:
                raw = data.tobytes()
                gap = np.flatnonzero(start - spaced > begin)
                put_all((2 * begin[gap]).tolist(), [self._gap(raw[a:b], c) for a, b, c in zip(begin[gap].tolist(), (start - spaced)[gap].tolist(), spaced[gap].tolist(), strict=True)])
                last = offsets[:-1].copy()
                np.maximum.at(last, np.searchsorted(offsets, stop - 1, "right") - 1, stop)
                tail = np.setdiff1d(np.flatnonzero(last < offsets[1:]), odd)
                put_all((2 * last[tail]).tolist(), self._ids([raw[a:b].decode() for a, b in zip(last[tail].tolist(), offsets[1:][tail].tolist(), strict=True)]))
        if len(odd):
            put_all((2 * offsets[odd]).tolist(), self._ids([data[offsets[d] : offsets[d + 1]].tobytes().decode() for d in odd.tolist()]))
        # ends of texts stand before what begins at the same byte; those of empty texts keep their order
        put(2 * offsets[1:] - 1, np.full(n, known.append(end)), np.full(n, len(end)))
        place, at, size = map(np.concatenate, (order, first, count))
        turn = np.argsort(place, kind="stable")
        at, size = at[turn], size[turn]
        total = np.cumsum(size)
        ids = known.pool[np.repeat(at - total + size, size) + np.arange(total[-1] if len(total) else 0)].astype("<u4")
        known.used = held
        return ids, np.concatenate([[0], total[turn >= len(place) - n]])

    def encode_all(self, texts: list[str], end: tuple[int, ...] = ()) -> list[np.ndarray]:
        """The ids of each text, with those of end behind them."""
        raw = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        ids, bounds = self.encode_chunk(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets, np.array(end, dtype=np.uint32))
        return np.split(ids, bounds[1:-1]) if texts else []


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for this tokenizer; it drops those of other tokenizers."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ---------------------------------------------------------------- directly addressable codes

#: Bits of a rank directory entry's span; bitmaps are padded to whole spans.
RANK_SPAN = 512
_MAGIC = b"DAC2"


def _pack_bits(flags: np.ndarray) -> tuple[bytes, bytes]:
    """The bitmap and its rank directory: how many ones stand before each span."""
    bits = np.zeros((len(flags) // RANK_SPAN + 1) * RANK_SPAN // 8, dtype=np.uint8)
    packed = np.packbits(flags, bitorder="little")
    bits[: len(packed)] = packed
    spans = np.bitwise_count(bits.view("<u8")).reshape(-1, RANK_SPAN // 64).sum(axis=1, dtype=np.int64)
    return bits.tobytes(), (np.cumsum(spans) - spans).astype("<u4").tobytes()


def dac_encode(ids: np.ndarray, chunk_bits: int = 8) -> bytes:
    """Split ids into chunks of 8 or 16 bits, one level a chunk, least significant first.

    A level holds a chunk of every id that reaches it, a bitmap of the ids that go on, and the bitmap's rank directory;
    the place of id i in the next level is the rank of i in this bitmap.
    """
    kind = {8: np.uint8, 16: np.dtype("<u2")}[chunk_bits]
    rest = np.asarray(ids, dtype=np.uint64)
    levels = []
    while True:
        more = rest >> np.uint64(chunk_bits)
        goes_on = more > 0
        levels.append(((rest & np.uint64(2**chunk_bits - 1)).astype(kind).tobytes(), *_pack_bits(goes_on)))
        rest = more[goes_on]
        if not len(rest):
            break
    head = _MAGIC + struct.pack("<BBQ", chunk_bits, len(levels), len(ids))
    body = b""
    for parts in levels:
        head += struct.pack("<QQQ", *map(len, parts))
        body += b"".join(parts)
    return head + body


class Dac:
    """A reader of dac_encode's bytes; nothing is copied before it is asked for."""

    def __init__(self, data: bytes):
        if bytes(data[:4]) != _MAGIC:
            raise ValueError("not a block of directly addressable codes")
        self.bits, n_levels, self.size = struct.unpack_from("<BBQ", data, 4)
        kind = np.uint8 if self.bits == 8 else np.dtype("<u2")
        at = 14 + 24 * n_levels
        self.levels = []
        for i in range(n_levels):
            sizes = struct.unpack_from("<QQQ", data, 14 + 24 * i)
            parts = []
            for size, dtype in zip(sizes, (kind, np.dtype("<u8"), np.dtype("<u4")), strict=True):
                parts.append(np.frombuffer(data, dtype=dtype, count=size // np.dtype(dtype).itemsize, offset=at))
                at += size
            self.levels.append(parts)

    def __len__(self) -> int:
        return self.size

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before each position: the directory's count, and those of at most one span."""
        span, word = at // RANK_SPAN, at >> 6
        of = span[:, None] * (RANK_SPAN // 64) + np.arange(RANK_SPAN // 64)
        held = np.bitwise_count(bitmap[of]) * (of < word[:, None])
        own = bitmap[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return ranks[span].astype(np.int64) + held.sum(axis=1, dtype=np.int64) + np.bitwise_count(own)

    def get(self, positions: np.ndarray) -> np.ndarray:
        """The ids at these positions, by one rank a level; no other id is decoded."""
        at = np.asarray(positions, dtype=np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.size):
            raise IndexError("position outside the block")
        out = np.zeros(len(at), dtype=np.uint64)
        who = np.arange(len(at))
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            out[who] |= chunks[at].astype(np.uint64) << np.uint64(level * self.bits)
            on = (bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            who, at = who[on], at[on]
            if not len(who):
                break
            at = self._rank(bitmap, ranks, at)
        return out.astype(np.uint32)

    def runs(self, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each run bounds[i]:bounds[i+1], one after another; outside the run asked for nothing is decoded.

        Where a run lies in a level, its ids that go on lie in a run of the next, between the ranks of both its ends, which the
        directories give for all runs at once.
        """
        ends = [np.asarray(bounds, dtype=np.int64)]
        for _, bitmap, ranks in self.levels[:-1]:
            ends.append(self._rank(bitmap, ranks, ends[-1]))
        ends = np.stack(ends, axis=1).tolist() if len(bounds) > 1 else []
        for lo, hi in zip(ends[:-1], ends[1:], strict=True):
            values = np.empty(0, dtype=np.uint32)
            for (chunks, bitmap, _), a, b in zip(reversed(self.levels), reversed(lo), reversed(hi), strict=True):
                here = chunks[a:b].astype(np.uint32)
                if len(values):
                    words = bitmap[a >> 6 : (b + 63) >> 6]
                    on = np.unpackbits(words.view(np.uint8), bitorder="little")[a & 63 : (a & 63) + b - a].view(bool)
                    here[on] |= values << np.uint32(self.bits)
                values = here
            yield values

    def decode(self) -> np.ndarray:
        """All ids."""
        return next(self.runs(np.array([0, self.size])))


# ---------------------------------------------------------------- files

#: Ids a segment holds at least before it is closed, at the end of a document.
SEGMENT_IDS = 1 << 18


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int | None, chunk_bits: int = 8) -> None:
    """Encode docs(doc_id, text) and write their ids under path, in ascending doc_id order.

    A file is a Parquet container, which every store Spark knows can hold, of segments (pid, segment, doc_ids, bounds,
    first, payload): whole documents whose ids payload has as directly addressable codes; `first` counts the ids before the
    segment in its part, and parts follow each other by pid. Null doc_id comes first, ties in doc_id by text. Null and
    empty texts have the end id alone. Extra columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([] if end_id is None else [end_id], dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, enc = TaskContext.get().partitionId(), encoder(tokenizer_path)
        doc_ids, parts, lengths, first, held, segment = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal first, held, segment
            payload = dac_encode(np.concatenate(parts), chunk_bits)
            of, bounds = pa.concat_arrays(doc_ids), np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([pid], pa.int32()), pa.array([segment], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(of)], pa.int32()), of),
                    pa.ListArray.from_arrays(pa.array([0, len(bounds)], pa.int32()), pa.array(bounds, pa.int64())), pa.array([first], pa.int64()), pa.array([payload], pa.binary()),
                ],
                names=["pid", "segment", "doc_ids", "bounds", "first", "payload"],
            )
            first, segment, held = first + held, segment + 1, 0
            doc_ids.clear(), parts.clear(), lengths.clear()
            return out

        for batch in batches:
            for lo, hi, data, offsets in common.text_chunks(batch, 1, CHUNK_BYTES):
                ids, bounds = enc.encode_chunk(data, offsets, end)
                doc_ids.append(common.column(batch, 0, lo, hi))
                parts.append(ids)
                lengths.append(np.diff(bounds))
                held += len(ids)
                if held >= SEGMENT_IDS:
                    yield close()
        if doc_ids:
            yield close()

    n = common.partitions(docs.sparkSession)
    ordered = docs.select("doc_id", "text").repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(run, f"pid int, segment int, doc_ids array<{id_type}>, bounds array<bigint>, first bigint, payload binary").write.parquet(path)


def _part_starts(segments: DataFrame) -> dict[int, int]:
    """Ids before each part: one row a part reaches the driver, and there are as many parts as shuffle partitions."""
    rows = segments.groupBy("pid").agg(F.sum(F.element_at("bounds", -1)).alias("n")).collect()
    starts, at = {}, 0
    for pid, n in sorted((r["pid"], r["n"]) for r in rows):
        starts[pid], at = at, at + n
    return starts


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the files at path, each document by itself."""
    segments = spark.read.parquet(path)
    starts = _part_starts(segments)
    id_type = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pid, ids, bounds, first, payload = (batch.column(k)[i] for k in range(5))
                bounds = np.asarray(bounds.values)
                crc = [zlib.crc32(x.astype("<u4", copy=False)) for x in Dac(payload.as_buffer()).runs(bounds)]
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(starts[pid.as_py()] + first.as_py() + bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments.select("pid", "doc_ids", "bounds", "first", "payload").mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, column: str = "position") -> DataFrame:
    """The id at each position of the whole corpus, by random access into the segments that hold them."""
    segments = spark.read.parquet(path)
    starts = _part_starts(segments)
    begin = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("pid")) + F.col("first") if starts else F.lit(0)
    spans = segments.select(begin.alias("begin"), (begin + F.element_at("bounds", -1)).alias("stop"), "payload")
    cell = SEGMENT_IDS  # a segment reaches over few cells, so that positions meet segments by equality of the cell
    spans = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("begin") / cell), F.floor((F.col("stop") - 1) / cell))))
    asked = positions.select(F.col(column).cast("long").alias("position")).withColumn("cell", F.floor(F.col("position") / cell))
    met = asked.join(spans, "cell").where("position >= begin AND position < stop").groupBy("begin").agg(F.collect_list("position").alias("positions"), F.first("payload").alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked = np.asarray(batch.column(1)[i].values)
                got = Dac(batch.column(2)[i].as_buffer()).get(asked - batch.column(0)[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(asked), pa.array(got.astype(np.int64))], names=["position", "token"])

    return met.select("begin", "positions", "payload").mapInArrow(run, "position bigint, token bigint")


def op2_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    path = common.shared_dir(spark, "token-files")
    write_token_files(common.table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"), path, end_id=2)
    return read_token_files(spark, path)
