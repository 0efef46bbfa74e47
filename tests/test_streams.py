import json

import pytest
from pyspark.sql import functions as F

from bidscope.functions.kpis import BY_NAME
from bidscope.operators import detect
from bidscope.operators.enrich import derive_auction_columns
from bidscope.session import stage_table
from bidscope.streaming import kpi_windows
from bidscope.streaming.runs import run_append, run_update, table_stream
from tests.conftest import rows

KPIS = [BY_NAME["fill_rate"]]


def at(minute, filled=1, day=1):
    return {"timestamp": f"2024-01-0{day} 10:{minute:02d}:30", "filled": filled}


@pytest.fixture
def stream_of(spark, make_auctions, tmp_path):
    """A stream with one trigger per batch of rows."""

    def make(*batches):
        folder = tmp_path / "auctions.parquet"
        for number, batch in enumerate(batches):
            made = make_auctions([{"auction_id": f"{number}-{i}", **row} for i, row in enumerate(batch)], derive=False)
            made.coalesce(1).write.mode("append").parquet(str(folder))
        return derive_auction_columns(table_stream(spark, str(tmp_path), "auctions", files_per_trigger=1))

    return make


def test_windows_of_a_stream_equal_those_of_a_batch(stream_of, make_auctions):
    data = [at(1), at(2, 0), at(7), at(13, 0)]
    stream = run_update(kpi_windows.windowed_kpis(stream_of(data[:3], data[3:])).drop("window"), "window_start")
    batch = kpi_windows.windowed_kpis(make_auctions(data)).drop("window")
    columns = ["window_start", "window_end", "n_samples", "fill_rate", "ecpm"]
    assert sorted(map(tuple, stream.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))


def test_late_rows_are_dropped_only_behind_a_watermark(stream_of):
    data = [at(1), at(50)], [at(55)], [at(2), at(56)]
    late = kpi_windows.windowed_kpis(stream_of(*data), watermark="10 minutes").drop("window")
    result = {r["window_start"].minute: r["n_samples"] for r in rows(run_update(late, "window_start"))}
    assert result == {0: 1, 50: 1, 55: 2}


def test_rows_in_any_order_all_count(stream_of):
    windows = kpi_windows.windowed_kpis(stream_of([at(1), at(50)], [at(55)], [at(2), at(56)])).drop("window")
    result = {r["window_start"].minute: r["n_samples"] for r in rows(run_update(windows, "window_start"))}
    assert result == {0: 2, 50: 1, 55: 2}


def gap_rows():
    """Alert, fine, alert, alert, no window, alert, alert."""
    return [at(1, 0), at(6, 1), at(11, 0), at(16, 0), at(26, 0), at(31, 0)]


def test_consecutive_alerts_batch(make_auctions):
    status = kpi_windows.window_status(kpi_windows.windowed_kpis(make_auctions(gap_rows()), kpis=KPIS), KPIS)
    found = rows(kpi_windows.consecutive_alerts(status).orderBy("window_start"))
    assert [r["window_start"].minute for r in found] == [15, 30]


@pytest.mark.parametrize("triggers", [1, 4, 16])
def test_windows_and_alerts_of_a_stream_equal_the_batch_at_any_number_of_triggers(spark, make_auctions, stream_of, triggers):
    # Event times in no order: neighbours in time are days and triggers apart.
    data = [at(m, int(m % 3 == 0), day) for m in range(1, 60, 4) for day in (9, 1, 5)] + gap_rows()
    data.sort(key=lambda row: row["timestamp"][::-1])
    stream = kpi_windows.windowed_kpis(stream_of(*[data[i::triggers] for i in range(triggers)]), kpis=KPIS)
    latest = kpi_windows.without_zone(run_update(stream.drop("window"), "window_start"))
    batch = kpi_windows.without_zone(kpi_windows.windowed_kpis(make_auctions(data), kpis=KPIS))
    columns = ["window_start", "n_samples", "fill_rate"]
    assert sorted(map(tuple, latest.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))
    found, wanted = (
        sorted(map(tuple, kpi_windows.consecutive_alerts(kpi_windows.window_status(w, KPIS)).collect()))
        for w in (latest, batch)
    )
    assert found == wanted and found


def test_an_alert_joins_windows_whatever_came_between(stream_of):
    late = stream_of([at(1, 0)], [at(1, 1, 9)], [at(6, 0)])
    latest = run_update(kpi_windows.windowed_kpis(late, kpis=KPIS).drop("window"), "window_start")
    found = rows(kpi_windows.consecutive_alerts(kpi_windows.window_status(latest, KPIS)))
    assert [r["window_start"].minute for r in found] == [5]


def test_bids_are_scored_as_in_a_batch(stream_of, make_auctions):
    data = [{"winning_bid_usd": b} for b in (1.0, 1.1, 0.9, 9.0)] + [{"placement_type": "new"}]
    baselines = stage_table(detect.bid_baselines(make_auctions(data[:3])))
    scored = run_append(detect.score_bids(stream_of(data[:2], data[2:]), baselines))
    columns = ["placement_type", "winning_bid_usd", "bid_z_score", "bid_is_anomaly"]
    batch = detect.score_bids(make_auctions(data), baselines)
    left = sorted(json.dumps(list(r)) for r in scored.select(columns).collect())
    assert left == sorted(json.dumps(list(r)) for r in batch.select(columns).collect())


def test_statuses_only_of_kpis_that_can_alert(make_auctions):
    status = kpi_windows.window_status(kpi_windows.windowed_kpis(make_auctions([at(1)])))
    assert status.where(F.col("kpi").isin("ecpm", "revenue_per_auction")).count() == 0
    assert status.count() == 6
