"""Alerts of a running stream, trigger by trigger."""

import pytest

from bidscope.functions.kpis import BY_NAME
from bidscope.operators.enrich import derive_auction_columns
from bidscope.streaming import kpi_windows, live_alerts
from bidscope.streaming.runs import table_stream
from tests.conftest import rows

KPIS = [BY_NAME["fill_rate"]]


def at(time, filled=1, day=1):
    return {"timestamp": f"2024-01-{day:02d} {time}:30", "filled": filled}


@pytest.fixture
def landing(spark, make_auctions, tmp_path):
    """Land batches of rows one by one; each landing is followed by a run of both queries."""
    folder, number = tmp_path / "auctions.parquet", iter(range(1000))

    def land(batch):
        i = next(number)
        made = make_auctions([{"auction_id": f"{i}-{k}", **row} for k, row in enumerate(batch)], derive=False)
        made.coalesce(1).write.mode("append").parquet(str(folder))

    def run(watermark=None, kpis=KPIS):
        stream = derive_auction_columns(table_stream(spark, str(tmp_path), "auctions", files_per_trigger=1))
        windows = kpi_windows.windowed_kpis(stream, kpis=kpis).drop("window")
        raised = live_alerts.run_live_alerts(windows, str(tmp_path / "live"), kpis, watermark)
        return sorted((r["window_start"].strftime("%d %H:%M"), r["value"]) for r in rows(raised))

    return land, run


def test_an_alert_comes_with_the_second_window_and_goes_when_it_recovers(landing):
    land, run = landing
    land([at("10:01", 0)])
    assert run() == []
    land([at("10:06", 0)])
    assert run() == [("01 10:05", 0.0)]
    # A third window, and a row that changes the second one's value but not its status.
    land([at("10:11", 0), at("10:07", 0), at("10:08", 1)])
    assert run() == [("01 10:05", pytest.approx(1 / 3)), ("01 10:10", 0.0)]
    # The second window recovers: neither it nor the third has two in a row any more.
    land([at("10:09", 1) for _ in range(20)])
    assert run() == []
    # A late row before the first window's end does not matter, one that breaches a window between does.
    land([at("10:16", 0), at("10:02", 0)])
    assert run() == [("01 10:15", 0.0)]
    assert run() == [("01 10:15", 0.0)]


def test_blocks_hand_over_their_last_window(landing):
    land, run = landing
    land([at("00:01", 0, 2)])
    land([at("23:56", 0, 1)])
    land([at("23:51", 0, 1), at("23:56", 0, 2), at("00:01", 0, 3), at("00:01", 0, 5)])
    assert run() == [("01 23:55", 0.0), ("02 00:00", 0.0), ("03 00:00", 0.0)]


@pytest.mark.parametrize("triggers", [1, 4, 16])
def test_the_end_is_that_of_a_batch_at_any_number_of_triggers(landing, make_auctions, triggers):
    land, run = landing
    data = [at(f"{h:02d}:{m:02d}", int(m % 3 == 0), day) for m in range(1, 60, 4) for day in (9, 1, 5) for h in (0, 23)]
    data.sort(key=lambda row: row["timestamp"][::-1])
    for i in range(triggers):
        land(data[i::triggers])
    batch = kpi_windows.without_zone(kpi_windows.windowed_kpis(make_auctions(data), kpis=KPIS))
    wanted = rows(kpi_windows.consecutive_alerts(kpi_windows.window_status(batch, KPIS)))
    assert run() == sorted((r["window_start"].strftime("%d %H:%M"), r["value"]) for r in wanted) and wanted


def test_a_watermark_lets_blocks_go(landing):
    land, run = landing
    land([at("10:01", 0), at("10:06", 0)])
    assert run("1 hour") == [("01 10:05", 0.0)]
    land([at("10:01", 1, 9)])
    land([at("10:02", 1, 9)])
    assert run("1 hour") == [("01 10:05", 0.0)]
    # Far behind the watermark: the block has ended, so the statuses of its windows change nothing.
    land([at("10:11", 0)])
    assert run("1 hour") == [("01 10:05", 0.0)]


def test_several_kpis_and_no_rows(spark, landing, tmp_path):
    land, run = landing
    land([])
    assert run(kpis=[BY_NAME["fill_rate"], BY_NAME["bid_spread"]]) == []
    land([{**at("10:01", 0), "clearing_price_usd": 0.0}, {**at("10:06", 0), "clearing_price_usd": 0.1}])
    assert [w for w, _ in run(kpis=[BY_NAME["fill_rate"], BY_NAME["bid_spread"]])] == ["01 10:05", "01 10:05"]
    assert rows(live_alerts.open_alerts(spark, str(tmp_path / "nowhere"))) == []
