"""Versioned tables: old rows or new ones, never a mixture."""

import pytest
from pyspark.sql import functions as F

from bidscope.sources.versioned import ConcurrentWrite, VersionedStore
from tests.conftest import rows

SCHEMA = "id long, day string, n long, x double"


@pytest.fixture
def store(spark, tmp_path):
    return VersionedStore(spark, f"file://{tmp_path}/store")


@pytest.fixture
def frame(spark):
    return lambda *data: spark.createDataFrame(list(data), SCHEMA)


def held(df):
    return sorted(((r["id"], r["day"], r["n"]) for r in rows(df)), key=str)


def broken(df):
    """Fails in the last of many tasks, when others have written their files."""
    many = df.sparkSession.range(0, 1000, 1, 8).select(
        F.col("id"), F.lit("a").alias("day"), F.when(F.col("id") == 999, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).cast("long").alias("n"), F.lit(0.0).alias("x")
    )
    return many


def test_replace_append_fail_and_as_of(store, frame):
    assert store.load(frame((1, "a", 1, 0.5), (2, None, 2, None)), "t").rows == 2
    store.load(frame((3, "b", 3, 0.0)), "t", "append")
    store.load(frame((4, "c", 4, 0.0)), "t", "replace")
    assert held(store.table("t")) == [(4, "c", 4)]
    assert held(store.table("t", as_of=2)) == [(1, "a", 1), (2, None, 2), (3, "b", 3)]
    assert held(store.table("t", as_of=1)) == [(1, "a", 1), (2, None, 2)]
    assert store.table("t").columns == ["id", "day", "n", "x"] and store.tables() == ["t"]
    with pytest.raises(ValueError, match="There is"):
        store.load(frame(), "t", "fail")
    with pytest.raises(ValueError, match="no version 9"):
        store.table("t", as_of=9)
    with pytest.raises(ValueError, match="no table"):
        store.table("u")
    assert [(r["version"], r["rows_written"]) for r in rows(store.history("t"))] == [(1, 2), (2, 1), (3, 1)]


@pytest.mark.parametrize("layout", [(), ("day",)])
def test_a_write_that_fails_leaves_the_old_rows(spark, store, frame, layout):
    store.load(frame((1, "a", 1, 0.5), (2, "b", 2, 0.5)), "t", partition_by=layout)
    before = spark.conf.getAll if not callable(spark.conf.getAll) else spark.conf.getAll()
    for write in (
        lambda: store.load(broken(frame()), "t", partition_by=layout),
        lambda: store.load(broken(frame()), "t", "append"),
        lambda: store.merge(broken(frame()), "t", ["id"]),
    ):
        with pytest.raises(Exception, match="midway"):
            write()
        assert held(store.table("t")) == [(1, "a", 1), (2, "b", 2)] and store.versions("t") == [1]
    after = spark.conf.getAll if not callable(spark.conf.getAll) else spark.conf.getAll()
    assert before == after


def test_readers_keep_their_version(store, frame):
    store.load(frame((1, "a", 1, 0.5)), "t", partition_by=["day"])
    reader = store.table("t")
    store.load(frame((2, "a", 2, 0.5)), "t", partition_by=["day"])
    store.merge(frame((2, "b", 3, 0.5)), "t", ["id"])
    assert held(reader) == [(1, "a", 1)] and held(store.table("t")) == [(2, "b", 3)]


def test_merges_write_touched_partitions_only(store, frame):
    days = [(i, f"d {i // 10}/%=+", i, 0.0) for i in range(40)] + [(100, None, 1, 0.0), (101, "", 1, 0.0)]
    first = store.load(frame(*days), "t", partition_by=["day"])
    # One moved from a day to a new one, one changed, one added to the rows without a day.
    second = store.merge(frame((5, "new", -5, 0.0), (15, "d 1/%=+", -15, 0.0), (102, None, 2, 0.0)), "t", ["id"])
    changed = {p for p in second.parts if second.parts[p] != first.parts.get(p)}
    assert len(changed) == 4 and len(first.parts) - len(changed - {"day=new"}) == 2
    want = {i: (i, d or None, n) for i, d, n, _ in days} | {5: (5, "new", -5), 15: (15, "d 1/%=+", -15), 102: (102, None, 2)}
    assert held(store.table("t")) == sorted(want.values(), key=str)
    # A partition that loses its last row goes.
    third = store.merge(frame((5, "d 0/%=+", 5, 0.0)), "t", ["id"])
    assert "day=new" not in third.parts and store.table("t").where("day = 'new'").isEmpty()
    with pytest.raises(ValueError, match="repeat"):
        store.merge(frame((1, "a", 1, 0.0), (1, "b", 1, 0.0)), "t", ["id"])
    assert store.versions("t") == [1, 2, 3]


def test_merge_of_a_table_without_partitions_and_without_rows(store, frame):
    store.load(frame(), "t")
    assert held(store.table("t")) == []
    store.merge(frame((1, "a", 1, 0.0)), "t", ["id"])
    store.merge(frame((1, "b", 2, 0.0), (None, "c", 3, 0.0)), "t", ["id"])
    assert held(store.table("t")) == [(1, "b", 2), (None, "c", 3)]
    empty = store.load(frame(), "u", partition_by=["day"])
    assert not empty.parts and store.table("u").schema == store.table("t").schema and store.table("u").count() == 0
    assert held(store.table("u").union(frame((1, "a", 1, 0.0)))) == [(1, "a", 1)]


def test_parts_are_replaced_and_read_alone(spark, store, frame):
    store.load(frame(*[(i, str(i % 4), i, 0.0) for i in range(12)]), "t", partition_by=["day"])
    store.replace_parts(frame((50, "1", 50, 0.0)), "t", ["day=1", "day=2", "day=9"], notes={"why": "test"})
    assert held(store.table("t")) == sorted([(i, str(i % 4), i) for i in range(12) if i % 4 in (0, 3)] + [(50, "1", 50)], key=str)
    with pytest.raises(ValueError, match="not to be replaced"):
        store.replace_parts(frame((1, "0", 1, 0.0)), "t", ["day=1"])
    some = store.table("t", parts=["day=1", "day=7"])
    assert held(some) == [(50, "1", 50)] and len(some.inputFiles()) == 1
    assert store.version("t").notes == {"why": "test"}


def test_the_second_of_two_writers_fails(store, frame):
    store.load(frame((1, "a", 1, 0.0)), "t")
    seen = store.version("t")
    store.load(frame((2, "a", 1, 0.0)), "t")
    store.version = lambda table, as_of=None: seen
    with pytest.raises(ConcurrentWrite):
        store.load(frame((3, "a", 1, 0.0)), "t")
    del store.version
    assert held(store.table("t")) == [(2, "a", 1)] and store.versions("t") == [1, 2]


def test_old_versions_expire(store, frame):
    for i in range(4):
        store.load(frame((i, "a", 1, 0.0)), "t", "append")
    store.load(frame((9, "a", 1, 0.0)), "t")
    assert store.expire("t", keep=2) == 0 and store.versions("t") == [4, 5]
    assert store.expire("t") == 4 and held(store.table("t")) == [(9, "a", 1)]
