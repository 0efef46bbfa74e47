"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Every query runs to its end into a
sink that discards rows; the session is warmed up with one query that is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bidscope.plans.registered import queries  # noqa: E402
from bidscope.session import build_session  # noqa: E402

HEADLINE = [
    "kpi_scorecard", "kpi_by_segment", "kpi_trend_daily", "kpi_trend_weekly_grouped",
    "kpi_daily", "kpi_hourly", "kpi_by_category", "auctions_enriched", "supply_enriched",
    "bid_spread_summary", "bid_spread_over_time", "depth_by_bucket", "depth_summary",
    "fill_rate_analysis", "fill_rate_over_time", "ecpm_percentiles", "floor_change",
    "format_change", "did_fill_rate", "did_ecpm", "adoption_curve", "inventory_health",
    "supply_demand_balance", "floor_sensitivity", "supply_trend", "ad_load",
    "q_depth_distribution", "q_depth_buckets", "q_depth_trend", "q_depth_elasticity",
    "q_spread_summary", "q_spread_format_device", "q_spread_trend", "q_spread_deciles",
    "q_fill_heatmap", "q_unfilled", "q_fill_rolling", "q_floor_buckets", "q_hourly_imbalance",
    "q_scorecard_30d", "q_revenue_by_placement", "q_wow", "q_format_performance", "q_intraday",
    "star_by_tier", "detect_zscore", "detect_iqr", "scan_kpis", "bid_baselines",
    "bid_anomaly_scores", "top_bid_anomalies", "dash_score_histogram", "bid_rolling_baseline",
    "ranking_metrics", "kpi_5min", "kpi_alerts_consecutive", "dq_checks", "dq_primary_keys",
    "dq_orphans", "dim_placement", "iforest_scores", "iforest_summary", "anomaly_union",
    "kpi_snapshots", "etl_row_counts", "scan_csv", "upsert_partitioned", "bid_rolling_flags",
    "stream_kpi_5min", "stream_alerts_consecutive", "stream_bid_scores", "kpi_python_by_segment",
    "kpi_rollup_weekly", "stream_alerts_live", "stream_rolling_flags", "etl_incremental", "table_versions",
    "csv_quarantine", "star_by_campaign",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bidscope-bench",
        f"local[{cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    registered["kpi_scorecard"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
