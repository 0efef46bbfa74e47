import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bidscope.operators import detect
from bidscope.session import stage_table
from tests.conftest import rows


def test_zscore_finds_some_but_not_all(auctions):
    found = detect.detect(auctions, "winning_bid_usd").where("is_anomaly").count()
    assert 0 < found < auctions.count()


def test_unknown_method(auctions):
    with pytest.raises(ValueError, match="not 'median'"):
        detect.detect(auctions, "ecpm", "median")
    with pytest.raises(ValueError, match="not 'median'"):
        detect.scan_kpis(auctions, method="median")


def test_lone_values_are_no_anomaly(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("b", 2.0)], "k string, x double")
    assert detect.detect(df, "x", keys=["k"]).where("is_anomaly").count() == 0
    assert detect.detect(df, "x", "iqr", ["k"]).where("is_anomaly").count() == 0


def test_scan_fills_gaps_with_the_median(spark):
    series = [(i, "k", 1.0 + (i % 2) * 0.1) for i in range(30)] + [(30, "k", None), (31, "k", 90.0)]
    df = spark.createDataFrame(series, "timestamp int, kpi string, value double")
    result = {r["timestamp"]: r for r in rows(detect.scan_kpis(df))}
    assert result[31]["is_anomaly"] and not result[30]["is_anomaly"] and result[30]["anomaly_score"] is None


def test_baselines_and_rate(auctions):
    baselines = stage_table(detect.bid_baselines(auctions))
    assert baselines.count() == 4 and baselines.where("p99 IS NULL").count() == 0
    share = rows(detect.anomaly_share(detect.score_bids(auctions, baselines)))[0]
    assert 0 < share["anomaly_share"] < 0.10


def test_unseen_lone_and_flat_placements(spark, make_auctions):
    known = make_auctions(
        [{"placement_type": "lone"}] + [{"placement_type": "flat"}] * 2 + [{"winning_bid_usd": b} for b in (1.0, 2.0)]
    )
    scored = detect.score_bids(
        make_auctions(
            [
                {"placement_type": "new", "winning_bid_usd": 99.0},
                {"placement_type": "lone", "winning_bid_usd": 99.0},
                {"placement_type": "flat", "winning_bid_usd": 1.1},
                {"winning_bid_usd": 1.5},
            ]
        ),
        stage_table(detect.bid_baselines(known)),
    )
    result = {(r["placement_type"], r["bid_is_anomaly"], r["bid_z_score"] is None) for r in rows(scored)}
    assert result == {
        ("new", False, True),
        ("lone", False, True),
        ("flat", True, False),
        ("top_of_search", False, False),
    }


def test_top_k_is_ordered(auctions):
    scored = detect.score_bids(auctions, stage_table(detect.bid_baselines(auctions)))
    top = [(-r["bid_z_score"], r["auction_id"]) for r in rows(detect.top_bid_anomalies(scored, 5))]
    assert top == sorted(top) and len(top) == 5


@pytest.mark.parametrize("back,chunk", [(5, 7), (10, 10), (50, 400)])
def test_rolling_equals_a_window_across_chunks(spark, back, chunk):
    rng = random.Random(1)
    # One placement holds most rows; a stretch of equal bids has no spread at all.
    data = [
        (f"i{i:04d}", "hot" if i % 5 else f"p{i % 3}", i // 3, 2.5 if 100 < i < 180 else rng.lognormvariate(0, 1))
        for i in range(600)
    ]
    df = spark.createDataFrame(data, "auction_id string, placement_type string, s int, winning_bid_usd double")
    df = df.withColumn("timestamp", F.expr("timestampadd(SECOND, s, timestamp_ntz '2024-01-01 00:00:00')"))
    window = Window.partitionBy("placement_type").orderBy("timestamp", "auction_id").rowsBetween(-back, -1)
    want = df.select(
        "auction_id",
        F.avg("winning_bid_usd").over(window).alias("m"),
        F.stddev_samp("winning_bid_usd").over(window).alias("s"),
    )
    result = {r["auction_id"]: r for r in rows(detect.rolling_baseline(df, back, chunk))}
    assert len(result) == 600
    for row in rows(want):
        mine = result[row["auction_id"]]
        assert mine["rolling_mean"] == (None if row["m"] is None else pytest.approx(row["m"], abs=1e-9))
        assert mine["rolling_std"] == (None if row["s"] is None else pytest.approx(row["s"], abs=1e-7))
        if row["s"] is not None and row["s"] < 1e-12:
            assert mine["rolling_std"] == 0.0 and mine["rolling_z"] is None


def test_histogram_counts_every_row(auctions):
    bins = rows(detect.score_histogram(auctions, "ecpm", 12))
    assert len(bins) == 12 and sum(b["n_rows"] for b in bins) == auctions.count()


def test_histogram_of_one_value(make_auctions):
    bins = rows(detect.score_histogram(make_auctions([{}, {}]), "ecpm", 3))
    assert [b["n_rows"] for b in bins] == [2, 0, 0]
