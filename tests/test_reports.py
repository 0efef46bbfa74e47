"""KPI reports, snapshots, auction and supply analyses: invariants and small frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.functions.kpis import KPI, REGISTRY
from bidscope.operators import auctions as ops
from bidscope.operators import causal, kpi_reports, snapshots
from bidscope.operators import supply as supply_ops
from bidscope.plans import registered
from bidscope.streaming import kpi_windows
from tests.conftest import CHECK_DIR, rows


def test_scorecard_has_every_kpi(auctions):
    card = rows(kpi_reports.scorecard(auctions))
    assert [r["kpi"] for r in card] == [k.name for k in REGISTRY]
    assert all(r["value"] is not None for r in card)
    assert {r["status"] for r in card} <= {"ok", "alert", "on_target", "below_target"}


@pytest.mark.parametrize("as_column", [False, True])
def test_kpi_of_ones_own_in_every_report(auctions, as_column):
    measure = F.avg(F.col("clicked") * 1.0) if as_column else "avg(clicked * 1.0)"
    own = KPI("click share", measure, "ratio", "own", "Clicks per request.", ("clicked",), target=2.0, alert_threshold=1.5)
    total = auctions.agg(F.avg("clicked")).first()[0]
    found = rows(kpi_reports.alerts(auctions, kpis=[own, "fill_rate"]))
    assert found[0]["kpi"] == "click share" and found[0]["value"] == pytest.approx(total, abs=1e-6)
    by = rows(kpi_reports.by_segment(auctions, "device_type", [own, "fill_rate"]))
    assert sum(r["value"] * r["n_samples"] for r in by if r["kpi"] == own.name) == pytest.approx(total * auctions.count(), rel=1e-4)
    line = rows(kpi_reports.trend(auctions, own, "W"))
    assert {r["kpi"] for r in line} == {"click share"} and max(r["value"] or 0 for r in line) > 0
    status = kpi_windows.window_status(kpi_windows.without_zone(kpi_windows.windowed_kpis(auctions, kpis=[own])), [own])
    assert status.where("kpi = 'click share' AND status <> 'alert'").isEmpty()
    absent = rows(kpi_reports.scorecard(auctions.drop("clicked"), kpis=[own]))
    assert (absent[0]["value"], absent[0]["status"]) == (None, "ok")


def test_segment_equals_direct_filter(auctions):
    card = rows(kpi_reports.scorecard(auctions, {"placement_type": "top_of_search"}))
    direct = auctions.where("placement_type = 'top_of_search'").agg(F.avg("filled")).first()[0]
    assert card[0]["value"] == pytest.approx(direct, abs=1e-6)


def test_alerts_are_part_of_the_scorecard(auctions):
    found = rows(kpi_reports.alerts(auctions))
    assert all(r["status"] == "alert" for r in found) and len(found) <= len(REGISTRY)


def test_no_rows_no_card(auctions):
    nobody = auctions.where("false")
    assert kpi_reports.scorecard(nobody).collect() == []
    assert kpi_reports.alerts(nobody).columns[:2] == ["kpi", "value"]
    assert kpi_reports.trend(nobody, "fill_rate").collect() == []


def test_absent_columns(make_auctions):
    card = {r["kpi"]: r for r in rows(kpi_reports.scorecard(make_auctions([{}], drop=["bid_floor_usd", "clicked"])))}
    assert card["below_floor_rate"]["value"] == 0.0 and card["below_floor_rate"]["status"] == "on_target"
    assert card["ctr"]["value"] is None and card["ctr"]["status"] == "ok"


def test_own_kpi_and_quotes(auctions):
    kpi = KPI("top_bid", "max(winning_bid_usd)", "USD", "revenue", "The day's best", ("winning_bid_usd",), target=1.0)
    row = rows(kpi_reports.scorecard(auctions, kpis=[kpi]))[0]
    assert row["description"] == "The day's best" and row["value"] > 1


def test_segments_and_subset(auctions):
    result = rows(kpi_reports.by_segment(auctions, "placement_type", ["fill_rate", "ecpm"]))
    assert {r["kpi"] for r in result} == {"fill_rate", "ecpm"} and len({r["placement_type"] for r in result}) == 4


def test_rolling_mean_skips_empty_days_and_stays_in_its_group(make_auctions):
    data = [
        {"timestamp": "2024-01-01 00:00:00", "filled": 1},
        {"timestamp": "2024-01-04 00:00:00", "filled": 0},
        {"timestamp": "2024-01-01 00:00:00", "filled": 0, "placement_type": "other"},
    ]
    result = rows(kpi_reports.trend(make_auctions(data), "fill_rate", "D", "placement_type"))
    top = [r for r in result if r["placement_type"] == "top_of_search"]
    assert [r["value"] for r in top] == [1.0, None, None, 0.0]
    assert [r["rolling_avg"] for r in top] == [1.0, 1.0, 1.0, 0.5]
    assert [r["rolling_avg"] for r in result if r["placement_type"] == "other"] == [0.0]


def test_snapshot_weighs_back_to_the_fill_rate(auctions):
    daily = snapshots.kpi_snapshot(auctions)
    total = daily.agg(F.sum("total_auctions"), F.sum("filled_auctions")).first()
    weighted = daily.agg(F.sum(F.col("fill_rate") * F.col("total_auctions"))).first()[0]
    assert total[0] == auctions.count() and weighted / total[0] == pytest.approx(total[1] / total[0], abs=0.01)
    keys = snapshots.DAILY_GRAIN
    assert daily.dropna(subset=[*keys, "fill_rate", "total_revenue_usd", "p50_winning_bid"]).count() == daily.count()


def test_snapshots_drop_missing_keys_and_do_not_mix_grains(make_auctions):
    frame = make_auctions([{}, {"placement_type": None}, {"clicked": 1}])
    both = rows(snapshots.all_snapshots(frame))
    assert {(r["grain"], r["total_auctions"]) for r in both} == {("daily", 2), ("hourly", 2)}
    assert all(r["ctr"] == 0.5 and r["cpc_usd"] == 1.8 for r in both)


def test_approximate_quantiles_are_near(auctions):
    exact = snapshots.kpi_snapshot(auctions, ["placement_type"]).orderBy("placement_type")
    near = snapshots.kpi_snapshot(auctions, ["placement_type"], approximate=True).orderBy("placement_type")
    for a, b in zip(rows(exact), rows(near)):
        assert a["p90_winning_bid"] == pytest.approx(b["p90_winning_bid"], rel=0.02)


@pytest.mark.parametrize("grain", [snapshots.HOURLY_GRAIN, ["placement_type"]])
def test_snapshots_are_the_same_however_large_the_groups(auctions, grain):
    small, large = (
        {tuple(r[k] for k in grain): r for r in rows(snapshots.kpi_snapshot(auctions, grain, gathered_rows=limit))}
        for limit in (10**9, 1)
    )
    assert small.keys() == large.keys() and len(small) > 3
    for key, row in small.items():
        for name, value in row.items():
            wanted = pytest.approx(value, rel=1e-9) if isinstance(value, float) else value
            assert large[key][name] == wanted, (key, name)


def test_largest_groups_of_several_grains(make_auctions):
    frame = make_auctions([{}, {"device_type": "ctv"}, {"placement_type": None}, {"timestamp": "2024-01-02 10:00:00"}])
    assert snapshots.largest_groups(frame, [["placement_type"], ["date", "device_type"]]) == [3, 2]
    assert snapshots.largest_groups(frame.where("false"), [["placement_type"], ["date"]]) == [0, 0]


def test_stored_snapshots_roll_up_without_the_facts(spark, auctions, tmp_path):
    snapshots.sketch_snapshot(auctions).write.parquet(str(tmp_path / "parts"))
    stored = spark.read.parquet(str(tmp_path / "parts"))
    for grain in (["placement_type"], ["date"], ["device_type", "ad_format"]):
        rolled = {tuple(r[k] for k in grain): r for r in rows(snapshots.roll_up(stored, grain))}
        exact = {tuple(r[k] for k in grain): r for r in rows(snapshots.kpi_snapshot(auctions, grain, quantiles={}))}
        assert rolled.keys() == exact.keys()
        for key, row in exact.items():
            for name, value in row.items():
                assert rolled[key][name] == (pytest.approx(value, rel=1e-9) if isinstance(value, float) else value), name
    # The rank of an estimate among the bids is off by a hundredth at most.
    bids = {key: part for key, part in auctions.select("placement_type", "winning_bid_usd").toPandas().groupby("placement_type")}
    for row in rows(snapshots.roll_up(stored, ["placement_type"])):
        x = bids[row["placement_type"]]["winning_bid_usd"].dropna()
        for name, p in snapshots.BID_QUANTILES.items():
            assert (x < row[name]).mean() - 0.01 <= p <= (x <= row[name]).mean() + 0.01


def test_rolling_up_groups_without_bids_and_weeks(make_auctions):
    data = [{"winning_bid_usd": None, "timestamp": f"2024-01-0{d} 10:00:00"} for d in (1, 7)] + [{"timestamp": "2024-01-08 00:00:00"}]
    weeks = {str(r["week_ending"]): r for r in rows(snapshots.weekly(snapshots.sketch_snapshot(make_auctions(data))))}
    assert weeks.keys() == {"2024-01-07", "2024-01-14"}
    assert weeks["2024-01-07"]["total_auctions"] == 2 and weeks["2024-01-07"]["p50_winning_bid"] is None
    assert weeks["2024-01-14"]["p50_winning_bid"] == 1.0


def test_spread_summary_of_ties_and_lone_rows(make_auctions):
    data = [{"placement_type": "lone", "clearing_price_usd": 0.8}] + [{"filled": 0}]
    data += [{"clearing_price_usd": 0.9} for _ in range(5)]
    result = {r["placement_type"]: r for r in rows(ops.bid_spread_summary(make_auctions(data)))}
    assert result["lone"]["std_spread"] is None and result["lone"]["n_auctions"] == 1
    assert result["top_of_search"]["median_spread"] == 0.1 and result["top_of_search"]["std_spread"] == 0.0


def test_higher_floors_fill_less(auctions):
    low, high = rows(ops.simulate_floor_change(auctions, [0.5, 2.0]))
    assert high["simulated_fill_rate"] <= low["simulated_fill_rate"] + 0.01
    assert low["n_auctions_affected"] == auctions.count()


def test_floor_change_without_revenue(make_auctions):
    row = rows(ops.simulate_floor_change(make_auctions([{"revenue_usd": 0.0}])))[0]
    assert row["revenue_delta_pct"] == 0.0


def test_first_price_pays_more(auctions):
    assert rows(ops.simulate_format_change(auctions))[0]["revenue_lift_pct"] > 0


def test_student_t():
    assert causal.student_t_two_sided(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert causal.student_t_two_sided(1.0, 1) == pytest.approx(0.5, abs=1e-6)
    assert causal.student_t_two_sided(0.0, 5) == pytest.approx(1.0, abs=1e-6)
    assert causal.student_t_two_sided(1.959964, 1e8) == pytest.approx(0.05, abs=1e-6)
    assert causal.student_t_two_sided(-3.0, 999_999) == pytest.approx(0.0026998, abs=1e-6)


def test_did_against_numpy(spark):
    auctions = registered.auctions(spark, CHECK_DIR)
    row = rows(causal.diff_in_diff(auctions, "ecpm"))[0]
    data = auctions.select("placement_type", "release_period", "ecpm").toPandas()
    treated = data["placement_type"].isin(["top_of_search", "rest_of_search"])
    cell = {
        (t, p): data.loc[(treated == t) & (data["release_period"] == p), "ecpm"].to_numpy()
        for t in (True, False)
        for p in ("pre", "post")
    }
    mean = {k: v.mean() for k, v in cell.items()}
    want = (mean[True, "post"] - mean[True, "pre"]) - (mean[False, "post"] - mean[False, "pre"])
    assert row["did_estimate"] == pytest.approx(want, abs=1e-3)
    a, b = cell[True, "post"], cell[True, "pre"]
    pooled = ((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2)
    t = (a.mean() - b.mean()) / np.sqrt(pooled * (1 / len(a) + 1 / len(b)))
    assert row["t_statistic"] == pytest.approx(t, abs=1e-3) and 0 <= row["p_value"] <= 1


def test_did_with_missing_cells(make_auctions):
    row = rows(causal.diff_in_diff(make_auctions([{}, {"treatment": 1}])))[0]
    assert row["post_treated"] == 0.0 and row["pre_control"] == 0.0
    assert row["t_statistic"] is None and row["p_value"] is None and row["significant_at_5pct"] is None


def test_did_on_a_column_of_its_own(auctions):
    assert rows(causal.diff_in_diff(auctions, "auction_depth"))[0]["metric"] == "auction_depth"


def test_supply_needs_auctions(supply):
    with pytest.raises(ValueError):
        supply_ops.supply_demand_balance(supply, None)
    with pytest.raises(ValueError):
        supply_ops.floor_sensitivity(None)


def test_balance_keeps_one_sided_days(supply, make_auctions):
    result = rows(supply_ops.supply_demand_balance(supply, make_auctions([{"timestamp": "2030-01-01 00:00:00"}])))
    alone = [r for r in result if r["supply_events"] is None]
    assert len(alone) == 1 and alone[0]["fill_rate"] == 1.0 and alone[0]["demand_supply_ratio"] is None


@pytest.mark.parametrize("placement", ["top_of_search", "off_amazon"])
def test_floor_curve_against_every_floor(auctions, placement):
    result = rows(supply_ops.floor_sensitivity(auctions, placement))
    data = auctions.where(F.col("placement_type") == placement).toPandas()
    floors = np.linspace(data["bid_floor_usd"].min(), data["bid_floor_usd"].quantile(0.95), 50)
    assert len(result) == 50 and sum(r["is_optimal_floor"] for r in result) == 1
    for row, floor in zip(result, floors):
        met = data["winning_bid_usd"] >= floor
        assert row["floor_usd"] == pytest.approx(floor, abs=1e-4)
        assert row["fill_rate"] == pytest.approx(met.mean(), abs=1e-4)
        revenue = data.loc[met, "clearing_price_usd"].mean() * met.mean()
        assert row["expected_rev_per_auction"] == pytest.approx(revenue, abs=1e-6)


def test_floor_curve_of_equal_floors_marks_the_first(make_auctions):
    result = rows(supply_ops.floor_sensitivity(make_auctions([{}, {"winning_bid_usd": 0.2}])))
    assert [r["is_optimal_floor"] for r in result] == [True] + [False] * 49
    assert {r["fill_rate"] for r in result} == {0.5}


def test_inventory_health_in_range(supply):
    assert all(0 <= r["avg_fill_rate"] <= 1 for r in rows(supply_ops.inventory_health(supply)))
