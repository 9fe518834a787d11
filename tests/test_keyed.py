"""Keyed tables: merging, the name guard, versions, writers that die and writers that meet."""

import pytest
from pyspark.sql import functions as F

from dossierforge.sources import keyed
from dossierforge.sources.keyed import Clash, KeyedTable

SCHEMA = "company_id string, name string, x int, m map<string,int>"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), buckets=3)


def batch(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def rows(t, version=None):
    return sorted((r["company_id"], r["name"], r["x"]) for r in t.read(version).collect())


def test_merge_is_keyed_and_idempotent(spark, table):
    with pytest.raises(ValueError, match="no table"):
        table.read()
    first = batch(spark, ("a", "A", 1, {"p": 1}), ("b", "B", 2, None), (None, "N", 3, None), ("c", " ", 3, None), ("d", None, 3, None), ("a", "A", 0, None), ("a", "A", 1, {"p": 1}))
    assert table.upsert(first) == 1
    assert rows(table) == [("a", "A", 1), ("b", "B", 2)]
    second = batch(spark, ("a", "A", 5, None), ("e", "E", 6, None))
    for _ in range(2):
        table.upsert(second)
        assert rows(table) == [("a", "A", 5), ("b", "B", 2), ("e", "E", 6)]
    assert rows(table, 1) == [("a", "A", 1), ("b", "B", 2)]  # older versions stay
    table.upsert(batch(spark, ("e", "E", 1, None), ("e", "E", 9, None), ("e", "E", 3, None)), order="x")
    assert rows(table)[-1] == ("e", "E", 9)


def test_order_and_new_columns(spark, table):
    table.upsert(batch(spark, ("a", "A", 1, None)))
    table.upsert(batch(spark, ("b", "B", 7, "new"), schema="company_id string, name string, x long, extra string"))
    got = {r["company_id"]: (r["x"], r["extra"]) for r in table.read().collect()}
    assert got == {"a": (1, None), "b": (7, "new")}


def test_names_are_guarded(spark, table):
    table.upsert(batch(spark, ("a", "A", 1, None), ("b", "B", 2, None)))
    data = set(table.files.names(f"{table.path}/data"))
    with pytest.raises(Clash, match='"now":"Z"|"other":"Z"'):
        table.upsert(batch(spark, ("b", "Z", 5, None), ("n", "New", 5, None)))
    with pytest.raises(Clash):
        table.upsert(batch(spark, ("q", "Y", 5, None), ("q", "Z", 5, None)))
    assert rows(table) == [("a", "A", 1), ("b", "B", 2)] and table.versions() == [1]
    assert set(table.files.names(f"{table.path}/data")) == data  # nothing is left behind


def test_a_writer_that_dies_leaves_the_old_table(spark, table, monkeypatch):
    table.upsert(batch(spark, ("a", "A", 1, None)))

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(table, "_commit", dies)
    with pytest.raises(KeyboardInterrupt):
        table.upsert(batch(spark, ("a", "A", 2, None), ("b", "B", 2, None)))
    monkeypatch.undo()
    assert rows(table) == [("a", "A", 1)]
    table.upsert(batch(spark, ("a", "A", 2, None), ("b", "B", 2, None)))
    table.vacuum(1)
    assert rows(table) == [("a", "A", 2), ("b", "B", 2)] and table.versions() == [2]
    assert len(table.files.names(f"{table.path}/data")) <= 2


def test_a_task_that_fails_leaves_the_old_table(spark, table):
    table.upsert(batch(spark, ("a", "A", 1, None)))
    bad = batch(spark, ("a", "A", 2, None)).withColumn("x", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(bad)
    assert rows(table) == [("a", "A", 1)]


def test_writers_that_meet(spark, table, monkeypatch):
    table.upsert(batch(spark, ("a", "A", 1, None)))
    other, once, commit = KeyedTable(spark, table.path), [1], table._commit

    def late(*args):
        if once:
            once.pop()
            other.upsert(batch(spark, ("a", "A", 8, None), ("o", "O", 8, None)))
        return commit(*args)

    monkeypatch.setattr(table, "_commit", late)
    assert table.upsert(batch(spark, ("b", "B", 2, None))) == 3
    assert rows(table) == [("a", "A", 8), ("b", "B", 2), ("o", "O", 8)]


def test_batches_count_once(spark, table):
    assert table.upsert(batch(spark, ("a", "A", 1, None)), batch_id=("s", 0)) == 1
    assert table.upsert(batch(spark, ("a", "A", 2, None)), batch_id=("s", 0)) == 1
    assert table.upsert(batch(spark), batch_id=("s", 1)) == 2  # an empty batch is remembered as well
    assert table.upsert(batch(spark, ("a", "A", 3, None)), batch_id=("s", 1)) == 2
    assert table.upsert(batch(spark, ("a", "A", 4, None)), batch_id=("other", 0)) == 3
    assert rows(table) == [("a", "A", 4)] and table.upsert(batch(spark)) == 3


def test_replace_and_untouched_buckets(spark, table):
    table.upsert(batch(spark, *((f"k{i}", "n", i, None) for i in range(60))))
    before = table._entry()["buckets"]
    table.upsert(batch(spark, ("k1", "n", -1, None)))
    after = table._entry()["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1 and table.read().count() == 60
    table.replace(batch(spark, ("z", "Z", 1, None)))
    assert rows(table) == [("z", "Z", 1)]


def test_shared_dir(spark):
    assert keyed.shared_dir(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
