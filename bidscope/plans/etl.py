"""Extract, enrich, aggregate and load in one run."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame

from bidscope.operators.enrich import enrich_auctions, enrich_supply
from bidscope.operators.snapshots import DAILY_GRAIN, HOURLY_GRAIN, kpi_snapshot, largest_groups
from bidscope.sources.csv_files import read_csv
from bidscope.sources.frames import frame
from bidscope.sources.warehouse import Warehouse


def extract(
    warehouse: Warehouse,
    datasets: Mapping[str, DataFrame] | None = None,
    csv_folder: str | None = None,
) -> dict[str, DataFrame]:
    """The raw tables: given frames, of which only supply may be absent, or four CSV tables."""
    if datasets is not None:
        raw = {name: frame(datasets, name) for name in ("auctions", "advertisers", "campaigns")}
        return {**raw, "supply": datasets["supply"]} if "supply" in datasets else raw
    if csv_folder is None:
        raise ValueError("Give datasets or a CSV folder.")
    names = ("auctions", "supply", "advertisers", "campaigns")
    return {name: read_csv(warehouse.spark, csv_folder, name) for name in names}


def run_etl(
    warehouse: Warehouse,
    datasets: Mapping[str, DataFrame] | None = None,
    csv_folder: str | None = None,
) -> dict[str, float]:
    """Load dimensions, facts and both snapshots; return duration and row counts.

    The enriched facts are written once, by date, and the snapshots read what was written. So
    the enrichment is not repeated, and a lost executor costs no more than its own tasks. Daily
    and hourly snapshots are two tables: one table with both would count every auction twice.
    """
    started = time.monotonic()
    raw = extract(warehouse, datasets, csv_folder)
    warehouse.load(raw["advertisers"], "dim_advertiser")
    warehouse.load(raw["campaigns"], "dim_campaign")
    auction_rows = warehouse.load(enrich_auctions(raw["auctions"]), "fact_auctions", partition_by=["date"])
    supply_rows = 0
    if "supply" in raw:
        supply_rows = warehouse.load(enrich_supply(raw["supply"]), "fact_supply", partition_by=["date"])
    facts = warehouse.table("fact_auctions")
    daily, hourly = largest_groups(facts, [DAILY_GRAIN, HOURLY_GRAIN])
    kpi_rows = warehouse.load(kpi_snapshot(facts, DAILY_GRAIN, largest=daily), "kpi_daily")
    kpi_rows += warehouse.load(kpi_snapshot(facts, HOURLY_GRAIN, largest=hourly), "kpi_hourly")
    return {
        "duration_sec": round(time.monotonic() - started, 2),
        "auction_rows": auction_rows,
        "supply_rows": supply_rows,
        "kpi_rows": kpi_rows,
    }
