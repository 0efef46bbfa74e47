"""KPIs written in Python: merged states give what all rows would."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.functions.kpis import KPI
from bidscope.functions.measures import PythonMeasure
from bidscope.operators import kpi_reports, python_aggregate
from bidscope.plans import registered
from tests.conftest import rows


def spread_of(values):
    """Greatest less least."""
    return max(values) - min(values) if values else None


RANGE = PythonMeasure(
    start=lambda: [],
    update=lambda s, df: [v for v in [*s, df["bid_floor_usd"].min(), df["bid_floor_usd"].max()] if not math.isnan(v)],
    merge=lambda a, b: [min(a + b), max(a + b)] if a or b else [],
    finish=spread_of,
)
BID_RANGE = KPI(
    name="bid range", measure=RANGE, unit="USD", category="own", description="", inputs=("bid_floor_usd",),
    target=1.0, alert_threshold=5.0, higher_is_better=False,
)


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_states_merge_along_a_tree(spark, monkeypatch, fan):
    monkeypatch.setattr(python_aggregate, "HELD_GROUPS", 3)
    df = spark.range(0, 4000, 1, 37).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
        F.when(F.col("id") % 11 > 0, F.sin("id") * 10).alias("x"),
    ).withColumn("key", F.when(F.col("key") != "k2", F.col("key")))
    got = python_aggregate.aggregate(df, ["key"], {"skew": (registered.SKEWNESS, ["x"])}, fan).collect()
    wanted = {}
    for key, part in df.toPandas().groupby("key", dropna=False):
        x = part["x"].dropna().to_numpy()
        d = x - x.mean()
        wanted[key if isinstance(key, str) else None] = np.mean(d**3) / np.mean(d**2) ** 1.5
    assert len(got) == len(wanted) == 8
    assert all(abs(r["skew"] - wanted[r["key"]]) < 1e-9 for r in got)


def test_only_states_are_shuffled(spark):
    df = spark.range(0, 100_000, 1, 8).select(F.lit("hot").alias("key"), F.col("id").cast("double").alias("x"))
    out = python_aggregate.aggregate(df, ["key"], {"skew": (registered.SKEWNESS, ["x"])})
    assert abs(out.first()["skew"]) < 1e-9
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "id#" not in plan


def test_reports_take_kpis_in_python(make_auctions):
    data = [{"bid_floor_usd": b, "device_type": d, "timestamp": f"2024-01-0{day} 10:00:00"}
            for b, d, day in ((1.0, "mobile", 1), (9.0, "mobile", 1), (2.0, "ctv", 3), (None, "tablet", 3))]
    auctions = make_auctions(data)
    card = {r["kpi"]: r for r in rows(kpi_reports.scorecard(auctions, kpis=["fill_rate", BID_RANGE]))}
    assert (card["bid range"]["value"], card["bid range"]["status"], card["fill_rate"]["n_samples"]) == (8.0, "alert", 4)
    assert [r["kpi"] for r in rows(kpi_reports.alerts(auctions, kpis=[BID_RANGE]))] == ["bid range"]
    mobile = rows(kpi_reports.scorecard(auctions, {"device_type": "ctv"}, [BID_RANGE]))
    assert [(r["value"], r["status"]) for r in mobile] == [(0.0, "on_target")]
    parts = {(r["device_type"], r["kpi"]): r["value"] for r in rows(kpi_reports.by_segment(auctions, "device_type", [BID_RANGE, "ctr"]))}
    assert parts["mobile", "bid range"] == 8.0 and parts["tablet", "bid range"] is None and parts["ctv", "ctr"] == 0.0
    days = [r["value"] for r in rows(kpi_reports.trend(auctions, BID_RANGE).orderBy("timestamp"))]
    assert days == [8.0, None, 0.0]
    assert kpi_reports.scorecard(auctions.where("false"), kpis=[BID_RANGE]).count() == 0
    with pytest.raises(TypeError, match="Python"):
        BID_RANGE.value(auctions.columns)
    missing = rows(kpi_reports.scorecard(auctions.drop("bid_floor_usd"), kpis=[BID_RANGE]))
    assert missing[0]["value"] is None
