import pytest
from pyspark.sql import functions as F

from bidscope.operators import key_filters, quality
from bidscope.session import scratch_path

KEY, BY = ["id"], ["day"]


def _stored(spark, days=30, per_day=200):
    path = scratch_path(spark, "filtered-table")
    rows = spark.range(days * per_day).select(
        F.concat(F.lit("k"), "id").alias("id"), (F.col("id") / per_day).cast("int").alias("day"), F.lit(1).alias("x")
    )
    rows.write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def _new(spark, ids):
    return spark.createDataFrame([(i, 99, 2) for i in ids], "id string, day int, x int")


def test_no_stored_key_is_missed_and_wrong_hits_are_rare(spark):
    stored = _stored(spark)
    blocks = key_filters.blocks_for(200)
    filters = key_filters.build_filters(stored, KEY, BY, blocks).persist()
    hits = key_filters.possible_hits(stored, filters, KEY, BY, blocks)
    own = stored.select("id", F.col("day").alias("stored_day"))
    assert own.exceptAll(hits).isEmpty()
    absent = _new(spark, [f"absent{i}" for i in range(5000)])
    # 150,000 looks at about one wrong hit in 170,000.
    assert key_filters.possible_hits(absent, filters, KEY, BY, blocks).count() < 20


def test_only_hit_partitions_are_read(spark):
    stored = _stored(spark)
    blocks = key_filters.blocks_for(200)
    filters = key_filters.build_filters(stored, KEY, BY, blocks)
    new = _new(spark, ["k7", "k7", "k399", "fresh", "twice", "twice", None, None])
    found = key_filters.check_append(new, stored, filters, "t", KEY, BY, blocks)
    line = found.first().asDict()
    assert (line["repeated_keys"], line["rows_with_repeated_key"], line["rows_without_key"]) == (3, 7, 2)
    assert line["partitions_stored"] == 30 and 2 <= line["partitions_read"] <= 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [day" in plan


def test_as_the_full_check_says(spark):
    stored, blocks = _stored(spark, days=5), key_filters.blocks_for(200)
    filters = key_filters.build_filters(stored, KEY, BY, blocks)
    new = _new(spark, [f"k{i}" for i in range(0, 2000, 3)] + [None])
    line = key_filters.check_append(new, stored, filters, "t", KEY, BY, blocks).first().asDict()
    whole = quality.check_primary_key(stored.unionByName(new), "t", KEY).first().asDict()
    assert {name: line[name] for name in whole} == whole


def test_merged_filters_are_those_of_all_rows(spark):
    stored, blocks = _stored(spark, days=4), 16
    parts = [key_filters.build_filters(stored.where(f"day % 2 = {i} OR day = 0"), KEY, BY, blocks) for i in (0, 1)]
    whole = key_filters.build_filters(stored, KEY, BY, blocks)
    merged = key_filters.merge_filters(parts, BY)
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()


def test_partition_in_the_key_and_null_partitions(spark):
    ddl = "id string, day int"
    stored = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), ("c", None), (None, 3)], ddl)
    new = spark.createDataFrame([("a", 1), ("a", 3), ("b", None), ("c", 4)], ddl)
    by_both = key_filters.build_filters(stored, ["id", "day"], BY, 1)
    line = key_filters.check_append(new, stored, by_both, "t", ["id", "day"], BY, 1).first()
    assert (line["repeated_keys"], line["rows_with_repeated_key"], line["rows_without_key"]) == (1, 2, 1)
    by_id = key_filters.build_filters(stored, ["id"], BY, 1)
    line = key_filters.check_append(new, stored, by_id, "t", ["id"], BY, 1).first()
    # a: twice here and twice there, b and c: one each; the null partition is read too.
    assert (line["repeated_keys"], line["rows_with_repeated_key"], line["partitions_read"]) == (3, 8, 3)


@pytest.mark.parametrize("empty", ["new", "stored", "both"])
def test_empty_tables(spark, empty):
    stored = _stored(spark, days=2, per_day=5).where("true" if empty == "new" else "false")
    new = _new(spark, [] if empty in ("new", "both") else ["k1", "k1"])
    filters = key_filters.build_filters(stored, KEY, BY, 1)
    line = key_filters.check_append(new, stored, filters, "t", KEY, BY, 1).first()
    assert (line["repeated_keys"], line["partitions_read"]) == ((1, 0) if empty == "stored" else (0, 0))
