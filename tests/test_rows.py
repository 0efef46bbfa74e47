"""Row-level columns, labels, bins and the traps of zero bids, lone rows and missing keys."""

import datetime

import pytest
from pyspark.sql import functions as F

from bidscope.functions.labels import depth_bin, depth_level
from bidscope.functions.timebins import fill_empty_bins, time_bin
from bidscope.operators.enrich import enrich_auctions, enrich_supply
from tests.conftest import rows


def test_missing_columns_are_named(make_auctions):
    with pytest.raises(ValueError, match="Missing required columns.*filled"):
        make_auctions([{}], drop=["filled"])


def test_zero_bid_has_spread_zero(make_auctions):
    row = rows(make_auctions([{"winning_bid_usd": 0.0, "clearing_price_usd": 0.0}]))[0]
    assert row["bid_spread"] == 0.0 and row["below_floor"] is True


def test_unfilled_row_has_spread_one_and_no_ctr(make_auctions):
    row = rows(make_auctions([{"filled": 0, "clearing_price_usd": 0.0, "clicked": 1, "converted": 1}]))[0]
    assert row["bid_spread"] == 1.0 and row["ctr"] is None and row["cvr"] == 1.0


def test_optional_columns(make_auctions):
    df = make_auctions([{}], drop=["clicked", "converted", "bid_floor_usd"])
    row = rows(df)[0]
    assert row["has_click"] is False and row["has_conversion"] is False and row["cvr"] is None
    assert "below_floor" not in df.columns


def test_time_columns(make_auctions):
    row = rows(make_auctions([{"timestamp": "2024-12-29 23:30:00"}]))[0]
    assert (row["day_of_week"], row["week"], row["month"], row["hour"]) == ("Sunday", 52, 12, 23)
    assert row["is_weekend"] is True and row["date"] == datetime.date(2024, 12, 29)


def test_zscores_of_lone_constant_and_missing_groups(make_auctions):
    data = [{"placement_type": "lone"}]
    data += [{"placement_type": "flat"}, {"placement_type": "flat"}]
    data += [{"placement_type": None, "winning_bid_usd": 9.0}]
    data += [{"placement_type": "wide"} for _ in range(30)] + [{"placement_type": "wide", "winning_bid_usd": 50.0}]
    result = rows(enrich_auctions(make_auctions(data, derive=False)))
    by_place = {}
    for row in result:
        by_place.setdefault(row["placement_type"], []).append(row)
    for place in ("lone", "flat", None):
        assert all(r["bid_z_score"] is None and r["is_bid_anomaly"] is False for r in by_place[place])
    assert sum(r["is_bid_anomaly"] for r in by_place["wide"]) == 1 and len(result) == 35


def test_enrichment_can_run_twice(make_auctions):
    once = enrich_auctions(make_auctions([{}, {"winning_bid_usd": 2.0}], derive=False))
    assert rows(enrich_auctions(once).select(once.columns).orderBy("auction_id")) == rows(once.orderBy("auction_id"))


def test_supply_health_is_relative_to_the_highest_floor(spark):
    df = spark.createDataFrame(
        [("s1", "p", "d", 4, 0.5, 1.0, 100), ("s2", "p", "d", 2, 0.25, 0.5, 100)],
        "supply_event_id string, placement_type string, device_type string, available_slots int, "
        "fill_rate double, floor_price_usd double, page_load_ms int",
    ).withColumn("timestamp", F.expr("timestamp_ntz '2024-01-01 00:00:00'"))
    result = {r["supply_event_id"]: r for r in rows(enrich_supply(df))}
    assert result["s1"]["supply_health"] == 0.35 and result["s2"]["supply_health"] == 0.325
    assert result["s1"]["monetized_slots"] == 2.0


def test_depth_edges(spark):
    df = spark.createDataFrame([(d,) for d in (0, 1, 2, 3, 9, 100, 101, None)], "d int")
    bins = [r[0] for r in df.select(depth_bin("d")).collect()]
    assert bins == [None, "2", "2", "3-4", "9+", "9+", None, None]
    levels = [r[0] for r in df.select(depth_level("d")).collect()]
    assert levels[0] == "low (1-2)" and levels[6] == levels[7] == "extreme (9+)"


def test_weeks_end_on_sunday_and_empty_bins_stay(spark):
    days = ["2024-01-01 05:00:00", "2024-01-07 23:59:59", "2024-01-22 00:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    binned = df.withColumn("b", time_bin(F.col("t"), "W")).groupBy("b").agg(
        F.count(F.lit(1)).alias("n"), F.max("t").alias("last")
    )
    result = rows(fill_empty_bins(binned, "b", "W", zero=["n"]).orderBy("b"))
    assert [r["b"].day for r in result] == [7, 14, 21, 28]
    assert [r["n"] for r in result] == [2, 0, 0, 1] and result[1]["last"] is None


def test_empty_bins_are_per_key(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01"), ("a", "2024-01-04"), ("b", "2024-01-02")], "k string, d string"
    ).select("k", F.col("d").cast("timestamp_ntz").alias("b"), F.lit(1).alias("n"))
    result = rows(fill_empty_bins(df, "b", "D", ["k"], zero=["n"]))
    assert len([r for r in result if r["k"] == "a"]) == 4 and len([r for r in result if r["k"] == "b"]) == 1


def test_unknown_frequency():
    with pytest.raises(ValueError, match="Unknown frequency"):
        time_bin(None, "Q")
