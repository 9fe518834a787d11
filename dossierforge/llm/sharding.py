"""Sharding by jump consistent hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each 64-bit key: the last jump below n_shards of the key's own sequence (Lamping and Veach)."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    key = keys.astype(np.uint64)
    shard = np.zeros(len(key), dtype=np.int64)
    going = np.arange(len(key))
    while len(going):
        key[going] = key[going] * np.uint64(2862933555777941757) + np.uint64(1)
        jump = ((shard[going] + 1) * (float(1 << 31) / ((key[going] >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        on = jump < n_shards
        going = going[on]
        shard[going] = jump[on]
    return shard


def _key(column: Column, kind: str) -> Column:
    """A 64-bit key; the hash spreads keys that differ in few bits. Null is a key like others."""
    return F.xxhash64(column.cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else column.cast("string"))


def assign_shards(df: DataFrame, key: str, n_shards: int, order_by: tuple[str, ...] = (), shard: str = "shard", grown: str = "grown_shard", slot: str = "slot") -> DataFrame:
    """Add shard, slot (gapless from 0 in the shard, in the order of key and order_by) and grown_shard (with one shard more).

    The key's value and the shard count alone decide, so equal keys, repeated rows and all nulls share a shard; from n to
    n + 1 shards, rows move only into the new one. Slots come from the running counts of range partitions, so that no
    task holds a whole shard. Columns named like the added ones are replaced.
    """
    spark = df.sparkSession
    df = df.drop(shard, grown, slot)
    given, kind = df.columns, df.schema[key].dataType.simpleString()
    df, place = common.plain_names(df), {c: F.col(f"c{i}") for i, c in enumerate(given)}

    @F.pandas_udf("struct<a:int,b:int>")
    def shards(keys):
        import pandas as pd

        k = keys.to_numpy().astype(np.int64).view(np.uint64)
        return pd.DataFrame({"a": jump_hash(k, n_shards).astype(np.int32), "b": jump_hash(k, n_shards + 1).astype(np.int32)})

    put = df.withColumn("both", shards(_key(place[key], kind))).withColumns({"shard": F.col("both.a"), "grown": F.col("both.b")}).drop("both")
    by = [F.col("shard"), place[key].asc_nulls_first(), *(place[c].asc_nulls_first() for c in order_by)]
    put = put.repartitionByRange(common.partitions(spark), *by).sortWithinPartitions(*by)
    names = [*put.columns]
    at = names.index("shard")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            s = np.asarray(batch.column(at))
            slots = np.empty(len(s), dtype=np.int64)
            # rows are sorted by shard, so a batch holds a few runs
            for lo, hi in zip(starts := np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else [], [*starts[1:], len(s)] if len(s) else [], strict=True):
                first = seen.get(int(s[lo]), 0)
                slots[lo:hi] = first + np.arange(hi - lo)
                seen[int(s[lo])] = first + int(hi - lo)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(slots), pa.array(np.full(len(s), pid, np.int32))], names=[*names, "slot", "pid"])

    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in put.schema.fields) + ", slot bigint, pid int"
    stored = common.store(put.mapInArrow(number, out_schema), "shards")
    counts = stored.groupBy(F.col("shard").alias("of"), F.col("pid").alias("part")).agg(F.count("*").alias("n"))
    # a row for each partition and shard it holds: about partitions + shards
    before = counts.withColumn("start", F.coalesce(F.sum("n").over(Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    before = F.broadcast(before) if common.small(before) else before
    met = stored.join(before, (F.col("shard") == F.col("of")) & (F.col("pid") == F.col("part")))
    return met.withColumn("slot", F.col("slot") + F.col("start")).select(*names, "slot").toDF(*given, shard, grown, slot)


def write_shards(df: DataFrame, key: str, n_shards: int, path: str) -> None:
    """Write df with one folder a shard, rows as many files as its partitions."""
    assign_shards(df, key, n_shards).write.partitionBy("shard").parquet(path)


def op6_sharding(spark: SparkSession, sf_dir: str, n_shards: int = 16) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.encode("text", "utf-8"), F.encode(F.lit(""), "utf-8"))).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return assign_shards(docs, "doc_id", n_shards, ("text_crc32", "size")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
