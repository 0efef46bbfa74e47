"""Rolling limits on a stream: in order of time as in a batch, late rows as defined."""

import random

import pytest

from bidscope.operators import detect
from bidscope.operators.enrich import derive_auction_columns
from bidscope.streaming import rolling
from bidscope.streaming.runs import table_stream
from tests.conftest import rows


@pytest.fixture
def landing(spark, make_auctions, tmp_path):
    def land(*batches):
        for batch in batches:
            made = make_auctions(batch, derive=False)
            made.coalesce(1).write.mode("append").parquet(str(tmp_path / "auctions.parquet"))

    def run(**options):
        stream = derive_auction_columns(table_stream(spark, str(tmp_path), "auctions", files_per_trigger=1))
        rolling.roll_stream(stream, str(tmp_path / "rolling"), **options)
        return {r["auction_id"]: r for r in rows(rolling.rolled_flags(spark, str(tmp_path / "rolling")))}

    return land, run


def bids(n, seed=1):
    rng = random.Random(seed)
    return [
        {
            "auction_id": f"b{i:04d}",
            "timestamp": f"2024-01-01 10:{i // 60:02d}:{i % 60:02d}",
            "placement_type": "hot" if rng.random() < 0.7 else f"p{i % 3}",
            "winning_bid_usd": 50.0 if i % 41 == 40 else rng.choice([1.0, 1.0, rng.lognormvariate(0, 0.3), None]),
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("triggers", [1, 3, 7])
def test_in_order_of_time_it_equals_the_batch(landing, make_auctions, triggers):
    land, run = landing
    data = bids(240)
    size = -(-len(data) // triggers)
    land(*[data[i : i + size] for i in range(0, len(data), size)])
    got = run(rows_back=20, chunk_rows=25)
    batch = {r["auction_id"]: r for r in rows(detect.rolling_baseline(make_auctions(data), 20, 25))}
    assert got.keys() == batch.keys() and any(r["is_rolling_anomaly"] for r in batch.values())
    for key, row in batch.items():
        for name in ("rolling_mean", "rolling_std", "rolling_limit"):
            assert got[key][name] == (pytest.approx(row[name], abs=1e-9) if row[name] is not None else None), (key, name)
        assert got[key]["is_rolling_anomaly"] == row["is_rolling_anomaly"]


def test_runs_go_on_where_the_last_ended(landing, make_auctions):
    land, run = landing
    data = bids(120, 5)
    land(data[:50])
    first = run(rows_back=15, chunk_rows=40)
    land(data[50:90], data[90:])
    got = run(rows_back=15, chunk_rows=40)
    assert len(first) == 50 and all(got[k] == r for k, r in first.items())
    batch = rows(detect.rolling_baseline(make_auctions(data), 15, 40))
    assert all(got[r["auction_id"]]["is_rolling_anomaly"] == r["is_rolling_anomaly"] for r in batch)


def test_late_bids_see_what_is_kept_and_change_nothing_written(landing):
    land, run = landing

    def bid(i, second, value):
        return {"auction_id": f"b{i}", "timestamp": f"2024-01-01 10:00:{second:02d}", "winning_bid_usd": value}

    land([bid(0, 0, 1.0), bid(1, 10, 2.0), bid(2, 20, 3.0), bid(3, 30, 4.0)])
    before = run(rows_back=2, chunk_rows=10)
    land([bid(4, 25, 9.0), bid(5, 5, 7.0), bid(6, 40, 5.0)])
    got = run(rows_back=2, chunk_rows=10)
    assert all(got[k] == r for k, r in before.items())
    assert got["b4"]["rolling_mean"] == pytest.approx(5.0)  # b5, which came late itself, and b2
    assert got["b5"]["rolling_mean"] is None  # older than all that is kept
    assert got["b6"]["rolling_mean"] == pytest.approx(6.5)  # b4 and b3
