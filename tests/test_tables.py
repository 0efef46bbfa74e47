"""CSV folders, catalog tables, merges, the ETL run and quality checks."""

import pytest
from pyspark.sql import functions as F

from bidscope.operators import quality
from bidscope.operators.merge import merge_rows
from bidscope.plans import registered
from bidscope.plans.etl import extract, run_etl
from bidscope.session import scratch_path, shared_dir
from bidscope.sources import star
from bidscope.sources.csv_files import list_csv, read_all_csv, read_csv, write_csv
from bidscope.sources.frames import frame
from tests.conftest import SF_DIR, rows


@pytest.fixture
def raw(spark):
    return {
        "auctions": registered.raw_auctions(spark, SF_DIR),
        "advertisers": star.dim_advertiser(spark, SF_DIR),
        "campaigns": star.dim_campaign(spark, SF_DIR),
        "supply": registered.raw_supply(spark, SF_DIR),
    }


@pytest.fixture
def store(spark):
    return registered.own_database(spark)


def test_shared_folder_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_csv_matches_columns_by_name(spark, tmp_path):
    (tmp_path / "supply.csv").write_text("page_load_ms,extra,supply_event_id,timestamp\n70,x,s1,2024-01-02 03:04:05\n")
    row = read_csv(spark, str(tmp_path), "supply").first()
    assert row["page_load_ms"] == 70 and row["extra"] == "x" and row["timestamp"].hour == 3


def test_whole_numbers_may_have_a_point(spark, tmp_path):
    (tmp_path / "supply.csv").write_text("supply_event_id,page_load_ms\ns1,3.0\ns2,\ns3,4\n")
    assert [r["page_load_ms"] for r in read_csv(spark, str(tmp_path), "supply").collect()] == [3, None, 4]


@pytest.mark.parametrize("line", ["s1,abc,0.5", "s1,3.5,0.5", "s1,3,abc", "s1,3"])
def test_cells_that_do_not_parse_end_the_read(spark, tmp_path, line):
    (tmp_path / "supply.csv").write_text(f"supply_event_id,page_load_ms,fill_rate\n{line}\n")
    with pytest.raises(Exception, match="page_load_ms|[Mm]alformed"):
        read_csv(spark, str(tmp_path), "supply").collect()


def test_part_files_in_another_column_order_end_the_read(spark, tmp_path):
    folder = tmp_path / "supply.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("placement_type,device_type\ntop,mobile\n")
    (folder / "b.csv").write_text("device_type,placement_type\nmobile,top\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path), "supply").collect()


def test_unknown_csv_is_inferred(spark, tmp_path):
    (tmp_path / "other.csv").write_text("a,b\n1,x\n2,y\n")
    assert read_csv(spark, str(tmp_path), "other").agg(F.sum("a")).first()[0] == 3


def test_missing_csv(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path), "auctions")


def test_csv_folder_round_trip(spark, raw, tmp_path):
    folder = str(tmp_path)
    write_csv({"campaigns": raw["campaigns"], "advertisers": raw["advertisers"]}, folder)
    assert list_csv(spark, folder) == ["advertisers", "campaigns"]
    back = read_all_csv(spark, folder)
    assert back["campaigns"].schema == raw["campaigns"].schema
    assert back["campaigns"].exceptAll(raw["campaigns"]).count() == 0


def test_frames():
    with pytest.raises(KeyError, match="nope"):
        frame({}, "nope")


def test_modes_and_counts(spark, store):
    df = spark.range(50)
    assert store.load(df, "t") == 50 and store.load(df, "t", "append") == 50
    assert rows(store.table_info()) == [{"table": "t", "row_count": 100}]
    with pytest.raises(Exception, match="already exists"):
        store.load(df, "t", "fail")
    with pytest.raises(ValueError, match="Unknown mode"):
        store.load(df, "t", "upsert")
    assert store.load(df, "t", "replace") == 50 and store.table("t").count() == 50


def test_statements_scripts_and_parameters(spark, store, tmp_path):
    store.load(spark.range(10), "t")
    script = tmp_path / "views.sql"
    script.write_text(
        "-- two statements; one comment\n"
        f"CREATE OR REPLACE VIEW {store.name('low')} AS SELECT id, 'a;b' AS s FROM {store.name('t')} WHERE id < 4;\n"
        f"CREATE OR REPLACE VIEW {store.name('lower')} AS SELECT * FROM {store.name('low')} WHERE id < 2;\n"
    )
    store.execute_script(str(script))
    assert store.tables() == ["low", "lower", "t"]
    assert store.query(f"SELECT * FROM {store.name('low')} WHERE id >= ? AND s = ?", [3, "a;b"]).count() == 1
    store.execute(f"DROP VIEW {store.name('lower')}")
    assert [r["table"] for r in rows(store.summary())] == ["t", "low"]


def test_empty_database(store):
    assert store.table_info().collect() == []


def test_merge_into_a_table(spark, store):
    store.load(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "t")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert store.merge(new, "t", ["k"]) == 3
    assert {(r["k"], r["v"]) for r in rows(store.table("t"))} == {(1, "a"), (2, "B"), (3, "C")}


def test_merge_keeps_the_layout_and_refuses_repeated_keys(spark, store):
    store.load(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, d int"), "t", partition_by=["d"])
    assert store.merge(spark.createDataFrame([(2, "B", 1)], "k int, v string, d int"), "t", ["k"]) == 2
    assert [c.name for c in spark.catalog.listColumns(store.name("t")) if c.isPartition] == ["d"]
    kept = {(1, "a", 1), (2, "B", 1)}
    assert {(r["k"], r["v"], r["d"]) for r in rows(store.table("t"))} == kept
    with pytest.raises(ValueError, match="repeat"):
        store.merge(spark.createDataFrame([(3, "x", 1), (3, "y", 2)], "k int, v string, d int"), "t", ["k"])
    assert {(r["k"], r["v"], r["d"]) for r in rows(store.table("t"))} == kept


def test_merge_writes_touched_partitions_only(spark, store):
    kinds = "k int, v string, d int"
    store.load(spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 2), (4, "n", None)], kinds), "t", partition_by=["d"])

    def files():
        at = store.table("t").select("d", F.col("_metadata.file_path").alias("f")).distinct()
        return {r["d"]: r["f"] for r in rows(at)}

    before = files()
    assert store.merge(spark.createDataFrame([(2, "B", 2), (5, "e", 3)], kinds), "t", ["k"]) == 3
    after = files()
    assert after[1] == before[1] and after[None] == before[None] and after[2] != before[2]
    wanted = {(1, "a", 1), (2, "B", 2), (3, "c", 2), (4, "n", None), (5, "e", 3)}
    assert {(r["k"], r["v"], r["d"]) for r in rows(store.table("t"))} == wanted
    store.merge(spark.createDataFrame([(4, "N", None)], kinds), "t", ["k"])
    assert {(r["k"], r["v"], r["d"]) for r in rows(store.table("t"))} == wanted - {(4, "n", None)} | {(4, "N", None)}


def test_rules_of_derived_tables_can_fail(spark):
    day = spark.createDataFrame([(2024, 5, 13, 1, None, 2, 0)], "year int, quarter int, month int, week int, day_of_week string, is_weekend int, is_holiday int")
    found = {r["rule"]: r["violations"] for r in rows(quality.check_rules(day, "dim_date"))}
    assert [found[r] for r in ("quarter_1_4", "month_1_12", "is_weekend_0_1", "day_of_week_not_null", "year_not_null")] == [1, 1, 1, 1, 0]
    hour = spark.createDataFrame([(None, 1, "x"), (None, 1, "x")], "date date, hour int, placement_type string")
    assert {r["rule"]: r["violations"] for r in rows(quality.check_rules(hour, "kpi_hourly"))}["date_not_null"] == 2
    place = spark.createDataFrame([("a|b", None, "b"), ("a|b", "a", "b")], "placement_key string, placement_type string, device_type string")
    assert rows(quality.check_rules(place, "dim_placement"))[0]["violations"] == 1
    assert rows(quality.check_primary_key(place, "dim_placement"))[0]["repeated_keys"] == 1


def test_merge_on_two_keys(spark):
    old = spark.createDataFrame([(1, "x", 1), (1, "y", 1)], "a int, b string, n int")
    new = spark.createDataFrame([(1, "y", 2)], "a int, b string, n int")
    assert {tuple(r) for r in merge_rows(old, new, ["a", "b"]).collect()} == {(1, "x", 1), (1, "y", 2)}


def test_etl_from_frames(store, raw):
    stats = run_etl(store, raw)
    counts = {r["table"]: r["row_count"] for r in rows(store.table_info())}
    assert counts["fact_auctions"] == stats["auction_rows"] == raw["auctions"].count()
    assert counts["kpi_daily"] + counts["kpi_hourly"] == stats["kpi_rows"]
    assert stats["supply_rows"] == counts["fact_supply"] and stats["duration_sec"] > 0
    total = store.table("kpi_daily").agg(F.sum("total_auctions")).first()[0]
    assert total == stats["auction_rows"]


def test_etl_from_csv_and_without_supply(spark, store, raw, tmp_path):
    write_csv(raw, str(tmp_path))
    assert set(extract(store, csv_folder=str(tmp_path))) == {"auctions", "supply", "advertisers", "campaigns"}
    del raw["supply"]
    stats = run_etl(store, raw)
    assert stats["supply_rows"] == 0 and "fact_supply" not in store.tables()
    with pytest.raises(KeyError):
        extract(store, {"auctions": raw["auctions"]})
    with pytest.raises(ValueError):
        extract(store)


def test_rules_count_violations_but_not_unknowns(make_auctions):
    df = make_auctions([{"auction_depth": 0}, {"auction_depth": None}, {"filled": 2}, {"placement_type": None}, {}])
    found = {r["rule"]: r["violations"] for r in rows(quality.check_rules(df, "fact_auctions"))}
    assert found["auction_depth_positive"] == 1 and found["auction_depth_not_null"] == 1
    assert found["filled_0_1"] == 1 and found["placement_type_not_null"] == 1 and found["hour_0_23"] == 0


def test_rules_on_absent_columns_are_reported_as_skipped(make_auctions):
    lines = rows(quality.check_rules(make_auctions([{"auction_depth": 0}]).drop("treatment"), "fact_auctions"))
    assert [(r["rule"], r["violations"]) for r in lines if r["severity"] == "skipped"] == [("treatment_0_1", None)]
    assert {r["rule"]: r["violations"] for r in lines}["auction_depth_positive"] == 1


def test_clicks_without_fill_are_information(make_auctions):
    df = make_auctions([{"clicked": 1, "filled": 0}])
    line = [r for r in rows(quality.check_rules(df, "fact_auctions")) if r["rule"] == "click_needs_fill"][0]
    assert line["violations"] == 1 and line["severity"] == "info"


def test_repeated_and_missing_keys(make_auctions):
    df = make_auctions([{"auction_id": "a"}, {"auction_id": "a"}, {"auction_id": "b"}, {"auction_id": None}])
    row = rows(quality.check_primary_key(df, "fact_auctions"))[0]
    assert (row["repeated_keys"], row["rows_with_repeated_key"], row["rows_without_key"]) == (1, 2, 1)


def test_orphans(spark):
    campaigns = spark.createDataFrame([("c1", "v1"), ("c2", "gone"), ("c3", "gone"), ("c4", None)], "c string, v string")
    owners = spark.createDataFrame([("v1",), ("v1",)], "v string")
    row = rows(quality.check_foreign_key(campaigns, owners, "v", ("dim_campaign", "dim_advertiser")))[0]
    assert row["orphan_keys"] == 1 and row["orphan_rows"] == 2


def test_calendar(make_auctions):
    days = make_auctions([{"timestamp": "2023-12-30 00:00:00"}, {"timestamp": "2024-01-02 00:00:00"}])
    result = rows(quality.dim_date(days).orderBy("date_key"))
    assert [r["is_weekend"] for r in result] == [1, 1, 0, 0] and result[2]["week"] == 1
    assert {r["is_holiday"] for r in result} == {0}
