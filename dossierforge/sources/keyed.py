"""Tables with one row per key that batches merge into: a name guard, versions, and a commit that is one rename."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import records as R

BUCKETS, TRIES = 16, 5


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share. Where that is unset, a temporary one is set on a single machine, and anything else raises."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no folder that executors can read")
        root = tempfile.mkdtemp(prefix="dossierforge-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Clash(ValueError):
    """A key is stored, or given, under another name."""


class _Files:
    """What Hadoop's file systems do, by path."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self.path(path).getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self.path(path))

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs(path).listStatus(self.path(path))] if self.exists(path) else []

    def delete(self, path: str) -> None:
        self._fs(path).delete(self.path(path), True)

    def read(self, path: str) -> str:
        stream = self._fs(path).open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Make a file with all its text or not at all; False if another writer made it first."""
        rough = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self._fs(rough).create(self.path(rough), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(path).toUri(), self.conf) if "://" in path else self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.conf)
        kind = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.jvm.java.lang.reflect.Array.newInstance(kind.NONE.getClass(), 1)
        options[0] = kind.NONE
        try:
            context.rename(self.path(rough), self.path(path), options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            self.delete(rough)
            return False
        return True


class KeyedTable:
    """One row per key under `path`, kept in buckets of keys.

    A version is a file of `_log` that says in which folder each bucket lies. upsert() merges a batch with the stored rows of the buckets that it touches, writes
    those anew beside the old, and commits by renaming the version's file into place: a reader sees the old table or the new one, a writer that dies leaves the
    old one, and of two writers that began from one version the second merges again. Commits need a file system whose rename fails where the target is.

    name: a column that must not change for a key (None: no guard). Rows of a batch whose key is null or whose name is blank are left out. Of several rows of one
    key the greatest by `order` stays, then by its JSON, so that a rerun stores the same.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "company_id", name: str | None = "name", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.name, self.buckets = spark, path.rstrip("/"), key, name, buckets
        self.files = _Files(spark)

    # ------------------------------------------------------------ versions

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/_log") if n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self.versions())

    def _entry(self, version: int | None = None) -> dict:
        there = self.versions()
        if version is None:
            version = there[-1] if there else 0
        if version == 0:
            return {"version": 0, "buckets": {}, "schema": None, "batches": {}, "count": self.buckets}
        return json.loads(self.files.read(f"{self.path}/_log/{version:010d}.json"))

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, the last if none is given."""
        entry = self._entry(version)
        if entry["schema"] is None:
            raise ValueError(f"no table at {self.path}")
        return self._rows(entry, entry["buckets"])

    def _rows(self, entry: dict, buckets: Iterable[str]) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        folders = [f"{self.path}/{entry['buckets'][b]}" for b in buckets if b in entry["buckets"]]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _commit(self, before: dict, buckets: dict[str, str], schema: T.StructType, batch: tuple[str, int] | None) -> int | None:
        version = before["version"] + 1
        batches = before["batches"] | ({batch[0]: batch[1]} if batch else {})
        entry = {"version": version, "buckets": buckets, "schema": json.loads(schema.json()), "batches": batches, "count": before["count"]}
        return version if self.files.create(f"{self.path}/_log/{version:010d}.json", json.dumps(entry)) else None

    def vacuum(self, keep: int = 2) -> None:
        """Forget all but the last versions, and delete what no version names, remains of dead writers included. No writer may be at work."""
        there = self.versions()
        for v in there[:-keep]:
            self.files.delete(f"{self.path}/_log/{v:010d}.json")
        used = {f.split("/")[1] for v in there[-keep:] for f in self._entry(v)["buckets"].values()}
        for folder in self.files.names(f"{self.path}/data"):
            if folder not in used:
                self.files.delete(f"{self.path}/data/{folder}")

    # ------------------------------------------------------------ merging

    def _one_each(self, batch: DataFrame, order: str | None, schema: T.StructType, count: int) -> tuple[DataFrame, Observation | None]:
        """(k, bucket, b): one row a key, as a struct, and what watches its names."""
        whole = F.struct(*((F.col(f.name) if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))
        turn = F.struct(*([F.col(order)] if order else []), F.to_json(whole, {"ignoreNullFields": "false"}))
        d = batch.where(F.col(self.key).isNotNull())
        sums = [F.max_by(whole, turn).alias("b")]
        if self.name:
            d = d.where(F.trim(self.name) != "")
            sums += [F.min(self.name).alias("low"), F.max(self.name).alias("high")]
        d = d.groupBy(F.col(self.key).alias("k")).agg(*sums).withColumn("bucket", F.pmod(F.xxhash64("k"), F.lit(count)).cast("int"))
        watch = Observation() if self.name else None
        if watch:
            d = self._watched(d, watch, F.col("low") != F.col("high"), "low", "high")
        return d.select("k", "bucket", "b"), watch

    def _watched(self, d: DataFrame, watch: Observation, clash: Column, one: str, other: str) -> DataFrame:
        """Counted while d is written, so that the guard reads nothing twice."""
        clash = F.coalesce(clash, F.lit(False))
        return d.observe(watch, F.count_if(clash).alias("n"), F.min(F.when(clash, F.to_json(F.struct("k", F.col(one).alias("one"), F.col(other).alias("other"))))).alias("example"))

    def _checked(self, watch: Observation | None, *folders: str) -> None:
        found = watch.get if watch else {"n": 0}
        if found["n"]:
            for f in folders:
                self.files.delete(f"{self.path}/{f}")
            raise Clash(f"{found['n']} keys of {self.path} stand for two names, such as {found['example']}")

    def upsert(self, batch: DataFrame, order: str | None = None, batch_id: tuple[str, int] | None = None) -> int:
        """Merge a batch; the version that holds it. A name that differs from the stored one raises Clash and changes nothing.

        batch_id: (source, number); a source's batch with that number or a lower one than its last is in the table already and is left out.
        """
        return self._write(batch, order, batch_id, anew=False)

    def replace(self, rows: DataFrame, order: str | None = None) -> int:
        """Make the table anew out of these rows."""
        return self._write(rows, order, None, anew=True)

    def _write(self, batch: DataFrame, order: str | None, batch_id: tuple[str, int] | None, anew: bool) -> int:
        staged = None  # the batch as it was written beside the table, its schema, and the buckets that it touches
        for _ in range(TRIES):
            before = self._entry()
            if batch_id and before["batches"].get(batch_id[0], -1) >= batch_id[1]:
                return before["version"]
            old = T.StructType.fromJson(before["schema"]) if before["schema"] and not anew else T.StructType()
            schema = T.StructType([*old.fields, *(f for f in batch.schema if f.name not in old.names)])
            data, watch = f"data/{uuid.uuid4().hex}", None
            if anew or not before["buckets"]:
                new, watch = self._one_each(batch, order, schema, before["count"])
                merged, touched = new.select("bucket", "b.*"), None
            else:
                if staged is None or staged[1] != schema:
                    new, watch = self._one_each(batch, order, schema, before["count"])
                    folder = f"data/{uuid.uuid4().hex}-batch"
                    new.write.parquet(f"{self.path}/{folder}")
                    self._checked(watch, folder)
                    buckets = self.spark.read.parquet(f"{self.path}/{folder}").select("bucket").distinct().collect()
                    staged = folder, schema, sorted(str(r["bucket"]) for r in buckets)
                touched = staged[2]
                stored = self._rows(before, touched)
                s = F.struct(*(F.col(f.name) if f.name in stored.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema)).alias("s")
                both = stored.select(F.col(self.key).alias("k"), s).join(self.spark.read.parquet(f"{self.path}/{staged[0]}"), "k", "full")
                watch = Observation() if self.name else None
                if watch:
                    both = both.withColumns({"was": F.col(f"s.{self.name}"), "now": F.col(f"b.{self.name}")})
                    both = self._watched(both, watch, F.col("was") != F.col("now"), "was", "now")
                bucket = F.pmod(F.xxhash64("k"), F.lit(before["count"])).cast("int")
                merged = both.select(bucket.alias("bucket"), F.coalesce("b", "s").alias("r")).select("bucket", "r.*")
            if touched is None or touched:
                merged.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{data}")
                self._checked(watch, data, *(staged or ())[:1])
            if touched is None:
                touched = sorted(n[7:] for n in self.files.names(f"{self.path}/{data}") if n.startswith("bucket="))
            buckets = ({} if anew else dict(before["buckets"])) | {b: f"{data}/bucket={b}" for b in touched}
            same = not touched and before["version"] and not anew and not batch_id
            version = before["version"] if same else self._commit(before, buckets, schema, batch_id)
            if version is not None:
                if staged:
                    self.files.delete(f"{self.path}/{staged[0]}")
                return version
            self.files.delete(f"{self.path}/{data}")  # another writer was first
        raise RuntimeError(f"{TRIES} tries to commit to {self.path} met other writers")


def update_lifecycle(table: KeyedTable, records: DataFrame, run_at: str, order: str | None = None, batch_id: tuple[str, int] | None = None) -> int:
    """records(key, content_hash) into the lifecycle table(key, created_at, updated_at, content_hash): new and changed rows alone are written.

    Of several rows of a key the latest by `order` counts, then the greatest hash. A table that was updated by a run that died later marks its rows unchanged in the next.
    """
    key = table.key
    if order:
        records = records.groupBy(key).agg(F.max_by("content_hash", F.struct(order, "content_hash")).alias("content_hash"))
    columns = [F.col(key), F.col("content_hash")]
    prior = table.read() if table.exists() else records.sparkSession.createDataFrame([], T.StructType([records.schema[key], *(T.StructField(c, T.StringType()) for c in ("created_at", "updated_at", "content_hash"))]))
    changed = R.lifecycle(records.select(*columns), prior, run_at, key).where("change <> 'unchanged'").drop("change")
    return table.upsert(changed.select(key, "created_at", "updated_at", "content_hash"), batch_id=batch_id)
