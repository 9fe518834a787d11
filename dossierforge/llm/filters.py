"""A Bloom filter of fixed size, built by the executors block by block, that spares rows a shuffle. It never loses a key."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 16 MB, whatever the number of keys; with too many keys it lets more rows pass, and the join behind it decides.
BLOCKS, BLOCK_BITS, PROBES = 2048, 1 << 16, 3


def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block, bits in the block) of hashed keys."""
    block = (keys >> np.uint64(53)).astype(np.int64)
    return block, np.stack([(keys >> np.uint64(16 * i)) & np.uint64(BLOCK_BITS - 1) for i in range(PROBES)]).astype(np.int64)


@dataclass
class Bloom:
    bits: np.ndarray  # BLOCKS x BLOCK_BITS / 8 bytes

    def has(self, keys: np.ndarray) -> np.ndarray:
        block, bits = _places(keys)
        out = np.ones(len(keys), dtype=bool)
        for b in bits:
            out &= (self.bits[block, b >> 3] >> (b & 7).astype(np.uint8)) & 1 == 1
        return out


def bloom(keys: DataFrame, column: str) -> Bloom:
    """The filter of a column of 64-bit hashes."""

    def block(table: pa.Table) -> pa.Table:
        flags = np.zeros(BLOCK_BITS, dtype=bool)
        flags[np.asarray(table["place"])] = True
        return pa.table({"block": table["block"].slice(0, 1), "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    k = F.col(column)
    places = F.explode(F.array(*(F.shiftrightunsigned(k, 16 * i).bitwiseAND(BLOCK_BITS - 1).cast("int") for i in range(PROBES))))
    # a block has BLOCK_BITS places, so that no group is larger
    distinct = keys.select(F.shiftrightunsigned(k, 53).cast("int").alias("block"), places.alias("place")).distinct()
    out = np.zeros((BLOCKS, BLOCK_BITS // 8), dtype=np.uint8)
    for r in distinct.groupBy("block").applyInArrow(block, "block int, bits binary").collect():
        out[r["block"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return Bloom(out)
