"""Every operator as a query over the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.columns import put
from bidscope.functions.kpis import KPI, REGISTRY
from bidscope.functions.measures import PythonMeasure
from bidscope.operators import auctions as auction_ops
from bidscope.operators import causal, detect, key_filters, kpi_reports, quality, ranking, snapshots
from bidscope.operators import supply as supply_ops
from bidscope.operators import forest as forest_ops
from bidscope.operators.enrich import derive_auction_columns, enrich_auctions, enrich_supply
from bidscope.operators.merge import merge_rows
from bidscope.operators.models import EcpmModel, FillModel, hold_out
from bidscope.operators.tree_tables import NODES, ensemble_sum
from bidscope.plans import warehouse
from bidscope.plans.etl import run_etl
from bidscope.plans.incremental import enriched_facts, run_incremental
from bidscope.session import apply_runtime_conf, scratch_path, spread, stage_table
from bidscope.sources import star
from bidscope.sources.csv_files import RESCUED, read_csv, read_csv_rescued, write_csv
from bidscope.sources.versioned import VersionedStore
from bidscope.sources.warehouse import Warehouse
from bidscope.streaming import kpi_windows, live_alerts, rolling
from bidscope.streaming.runs import run_append, run_update, table_stream

Query = Callable[[SparkSession, str], DataFrame]


# Money of a single row has at most nine decimals.
ROW_DIGITS = 9
# Moves values off decimal ties, which engines break differently.
OFF_TIE = "1.234567e-9"


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles as reported: the order of summation must not show in the last digits."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    nudge = f" + {OFF_TIE}" if digits < ROW_DIGITS else ""
    rounded = {name: f"round(`{name}`{nudge}, {digits})" for name in doubles}
    return put(df, rounded).select(df.columns) if doubles else df


def raw_auctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_auctions(apply_runtime_conf(spark), sf_dir)


def auctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with row-level columns; the placement statistics only where a query reads them."""
    return derive_auction_columns(raw_auctions(spark, sf_dir))


def spread_auctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows for Python scoring: line items read from too few splits go to all cores."""
    lines = spread(star.read_table(apply_runtime_conf(spark), sf_dir, "lineitem"))
    return derive_auction_columns(star.auctions_from(lines, star.read_table(spark, sf_dir, "part")))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_auctions(raw_auctions(spark, sf_dir))


def raw_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_supply(apply_runtime_conf(spark), sf_dir)


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_supply(raw_supply(spark, sf_dir))


def kpi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.kpi_snapshot(auctions(spark, sf_dir), snapshots.DAILY_GRAIN, quantiles={})


def kpi_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.kpi_snapshot(auctions(spark, sf_dir), snapshots.HOURLY_GRAIN, quantiles={})


def kpi_rollup_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks per placement from daily snapshots that were stored; the quantiles, which are estimates, are left to the tests."""
    store = own_database(apply_runtime_conf(spark))
    store.load(snapshots.sketch_snapshot(auctions(spark, sf_dir)), "kpi_daily_parts", partition_by=["date"])
    return shown(snapshots.weekly(store.table("kpi_daily_parts"), quantiles={}))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = auctions(spark, sf_dir)
    return detect.score_bids(rows, stage_table(detect.bid_baselines(rows, quantiles=False), "baselines"))


def _on(source: Query, operator: Callable[[DataFrame], DataFrame], digits: int | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = operator(source(spark, sf_dir))
        return result if digits is None else shown(result, digits)

    return query


ENRICHED_COLUMNS = [
    "auction_id", "timestamp", "date", "hour", "day_of_week", "week", "month", "is_weekend",
    "placement_type", "device_type", "ad_format", "category", "campaign_id", "advertiser_id",
    "auction_depth", "bid_floor_usd", "winning_bid_usd", "clearing_price_usd", "bid_spread",
    "margin_usd", "ecpm", "filled", "clicked", "converted", "revenue_usd", "has_click",
    "has_conversion", "ctr", "cvr", "bid_z_score", "is_bid_anomaly", "below_floor",
]


def release_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("release_period", "treatment", "feature_version", "placement_type").agg(
        F.count(F.lit(1)).alias("n_auctions"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
    )


def dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_tables(
        {
            "dim_advertiser": star.dim_advertiser(spark, sf_dir),
            "dim_campaign": star.dim_campaign(spark, sf_dir),
            "fact_auctions": raw_auctions(spark, sf_dir),
            "fact_supply": supply(spark, sf_dir),
            "dim_date": quality.dim_date(raw_auctions(spark, sf_dir)),
            "dim_placement": quality.dim_placement(raw_auctions(spark, sf_dir)),
            "kpi_daily": kpi_daily(spark, sf_dir),
            "kpi_hourly": kpi_hourly(spark, sf_dir),
        }
    )


#: Days before this one are appended a second time.
APPENDED_BEFORE = "2024-01-08"


def dq_keys_after_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the stored daily snapshot after its first days were appended again by mistake."""
    store = own_database(spark)
    store.load(kpi_daily(spark, sf_dir), "kpi_daily")
    again = kpi_daily(spark, sf_dir).where(F.col("date") < F.lit(APPENDED_BEFORE).cast("date"))
    store.load(again, "kpi_daily", "append")
    return quality.check_primary_key(store.table("kpi_daily"), "kpi_daily")


def _filtered_append(
    stored: DataFrame, new: DataFrame, table: str, key: list[str], by: list[str]
) -> DataFrame:
    """The report on an append by filters that are built from ``stored`` and kept as a table of their own."""
    fullest = stored.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    blocks = key_filters.blocks_for(fullest)
    filters = stage_table(key_filters.build_filters(stored, key, by, blocks), "key-filters")
    found = key_filters.check_append(new, stored, filters, table, key, by, blocks)
    return found.drop("partitions_read", "partitions_stored")


def dq_append_by_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``dq_keys_after_append`` finds, told before the append from the filters of the days."""
    store = own_database(spark)
    store.load(kpi_daily(spark, sf_dir), "kpi_daily", partition_by=["date"])
    stored = store.table("kpi_daily")
    again = stored.where(F.col("date") < F.lit(APPENDED_BEFORE).cast("date"))
    return _filtered_append(stored, again, "kpi_daily", quality.PRIMARY_KEYS["kpi_daily"], ["date"])


def dq_fact_append_by_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append to the facts: their first days again, and the others under new ids, which midnight's rows lack."""
    store = own_database(spark)
    store.load(raw_auctions(spark, sf_dir).select("auction_id", "hour", "date"), "facts", partition_by=["date"])
    stored = store.table("facts")
    fresh = F.when(F.col("hour") > 0, F.concat(F.lit("new-"), F.col("auction_id")))
    again = F.col("date") < F.lit(APPENDED_BEFORE).cast("date")
    new = stored.withColumn("auction_id", F.when(again, F.col("auction_id")).otherwise(fresh))
    return _filtered_append(stored, new, "fact_auctions", ["auction_id"], ["date"])


def dq_primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = raw_auctions(spark, sf_dir)
    store = own_database(spark)
    store.load_many({"kpi_daily": kpi_daily(spark, sf_dir), "kpi_hourly": kpi_hourly(spark, sf_dir)})
    tables = {
        "dim_advertiser": star.dim_advertiser(spark, sf_dir),
        "dim_campaign": star.dim_campaign(spark, sf_dir),
        "fact_auctions": facts,
        "fact_supply": raw_supply(spark, sf_dir),
        "dim_date": quality.dim_date(facts),
        "dim_placement": quality.dim_placement(facts),
        "kpi_daily": store.table("kpi_daily"),
        "kpi_hourly": store.table("kpi_hourly"),
    }
    reports = [quality.check_primary_key(df, name) for name, df in tables.items()]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "dim_advertiser": star.dim_advertiser(spark, sf_dir),
        "dim_campaign": star.dim_campaign(spark, sf_dir),
        "fact_auctions": raw_auctions(spark, sf_dir),
    }
    reports = [
        quality.check_foreign_key(tables[child], tables[parent], column, (child, parent))
        for child, column, parent in quality.FOREIGN_KEYS
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def supply_demand_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(supply_ops.supply_demand_balance(supply(spark, sf_dir), auctions(spark, sf_dir)))


def star_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.star_by_tier(auctions(spark, sf_dir), star.dim_advertiser(spark, sf_dir))


def own_database(spark: SparkSession) -> Warehouse:
    """A database of its own in the shared folder."""
    location = scratch_path(spark, "database")
    return Warehouse(spark, f"bidscope_{location.rsplit('-', 1)[1]}", location)


#: Buckets of the tables that are joined by campaign.
BUCKETS = 16


def campaign_store(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Campaigns and their days in buckets by campaign."""
    store = own_database(apply_runtime_conf(spark))
    bucketed = {"bucket_by": ["campaign_id"], "buckets": BUCKETS}
    store.load(warehouse.campaign_days(auctions(spark, sf_dir)), "campaign_days", **bucketed)
    store.load(star.dim_campaign(spark, sf_dir), "dim_campaign", **bucketed)
    return store


def star_by_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = campaign_store(spark, sf_dir)
    advertisers = star.dim_advertiser(spark, sf_dir)
    return warehouse.star_by_campaign(store.table("campaign_days"), store.table("dim_campaign"), advertisers)


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supply events as CSV with faults in some lines; how many are accepted, and the others by what is wrong with them."""
    folder, key = scratch_path(spark, "csv"), "CAST(supply_event_id AS BIGINT) % 50"
    faulty = put(
        raw_supply(spark, sf_dir),
        {
            "available_slots": f"CASE WHEN {key} IN (1, 4) THEN 'n/a' WHEN {key} = 2 THEN '2.5' ELSE CAST(available_slots AS STRING) END",
            "fill_rate": f"CASE WHEN {key} IN (3, 4) THEN 7e0 ELSE fill_rate END",
            "placement_type": f"CASE WHEN {key} = 5 THEN NULL ELSE placement_type END",
        },
    )
    write_csv({"supply": faulty}, folder)
    rows = read_csv_rescued(spark, folder, "supply")
    accepted, rejected = quality.quarantine(rows, "fact_supply", rescued=RESCUED)
    good = accepted.agg(
        F.lit("accepted").alias("outcome"), F.count(F.lit(1)).alias("n_rows"), F.sum("available_slots").alias("available_slots")
    )
    return good.unionByName(
        rejected.groupBy(F.concat_ws(", ", "failed").alias("outcome")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("available_slots").alias("available_slots")
        )
    )


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw facts through a folder of CSV files and back."""
    folder = scratch_path(spark, "csv")
    write_csv({"auctions": raw_auctions(spark, sf_dir)}, folder)
    return shown(read_csv(spark, folder, "auctions"), ROW_DIGITS)


def sql_param_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    auctions(spark, sf_dir).createOrReplaceTempView("bidscope_auctions")
    sql = (
        "SELECT auction_id, placement_type, `date`, round(winning_bid_usd, 9) AS winning_bid_usd "
        "FROM bidscope_auctions WHERE placement_type = ? AND auction_depth >= ? AND `date` >= CAST(? AS DATE)"
    )
    found = Warehouse(spark).query(sql, ["off_amazon", 8, "2024-02-01"])
    spark.catalog.dropTempView("bidscope_auctions")  # the query is resolved by now
    return found


def sink_append_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace, then append the same rows: what the sink counted and what the table holds."""
    store = own_database(spark)
    rows = raw_supply(spark, sf_dir)
    replaced = store.load(rows, "fact_supply", "replace")
    appended = store.load(rows, "fact_supply", "append")
    return store.table("fact_supply").agg(
        F.lit(replaced).cast("long").alias("rows_replaced"),
        F.lit(appended).cast("long").alias("rows_appended"),
        F.count(F.lit(1)).alias("rows_in_table"),
        F.sum("available_slots").alias("available_slots"),
    )


def loaded_tables(spark: SparkSession, sf_dir: str) -> Warehouse:
    store = own_database(spark)
    store.load_many(
        {
            "dim_advertiser": star.dim_advertiser(apply_runtime_conf(spark), sf_dir),
            "dim_campaign": star.dim_campaign(spark, sf_dir),
            "fact_supply": raw_supply(spark, sf_dir),
        }
    )
    return store


def etl_run(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The whole run from raw frames to loaded tables."""
    store = own_database(apply_runtime_conf(spark))
    run_etl(
        store,
        {
            "auctions": raw_auctions(spark, sf_dir),
            "supply": raw_supply(spark, sf_dir),
            "advertisers": star.dim_advertiser(spark, sf_dir),
            "campaigns": star.dim_campaign(spark, sf_dir),
        },
    )
    return store


def etl_kpi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily snapshot as the run stored it."""
    return shown(etl_run(spark, sf_dir).table("kpi_daily"))


#: The second load begins two days before the first one ends, so both have the rows of these days.
FIRST_LOAD_UNTIL, SECOND_LOAD_FROM = "2024-02-15", "2024-02-13"


def incremental_store(spark: SparkSession, sf_dir: str) -> VersionedStore:
    """All facts in two loads, of which the second is delivered twice."""
    store = VersionedStore(apply_runtime_conf(spark), scratch_path(spark, "versions"))
    rows = raw_auctions(spark, sf_dir)
    date = F.to_date("timestamp")
    later = rows.where(date >= F.lit(SECOND_LOAD_FROM).cast("date"))
    run_incremental(store, "first", rows.where(date < F.lit(FIRST_LOAD_UNTIL).cast("date")))
    run_incremental(store, "second", later)
    run_incremental(store, "second", later)
    return store


def etl_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily snapshot that the increments leave."""
    return shown(incremental_store(spark, sf_dir).table("kpi_daily"))


def etl_incremental_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts that the increments leave, enriched from the moments of their dates."""
    return shown(enriched_facts(incremental_store(spark, sf_dir)).select(ENRICHED_COLUMNS), ROW_DIGITS)


def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supply stored by date, appended to, merged into and replaced; what each version of the table holds."""
    store = VersionedStore(apply_runtime_conf(spark), scratch_path(spark, "versions"))
    rows = raw_supply(spark, sf_dir).select("supply_event_id", "placement_type", "available_slots", "date")
    ctv = rows.where("placement_type = 'off_amazon'")
    store.load(rows.where("placement_type <> 'off_amazon'"), "fact_supply", partition_by=["date"])
    store.load(ctv, "fact_supply", "append")
    store.merge(put(ctv, {"available_slots": "available_slots + 1"}).select(rows.columns), "fact_supply", ["supply_event_id"])
    store.load(ctv, "fact_supply", partition_by=["date"])
    versions = [
        store.table("fact_supply", as_of=number).agg(
            F.lit(number).cast("long").alias("version"),
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("available_slots").alias("available_slots"),
            F.countDistinct("date").alias("n_dates"),
        )
        for number in store.versions("fact_supply")
    ]
    return functools.reduce(DataFrame.unionByName, versions)


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertisers with raised budgets of the small tier and a copy of each enterprise account."""
    old = star.dim_advertiser(apply_runtime_conf(spark), sf_dir)
    raised = put(old.where("tier = 'small'"), {"daily_budget_usd": "daily_budget_usd * 2"})
    copies = put(old.where("tier = 'enterprise'"), {"advertiser_id": "concat(advertiser_id, '-2')"})
    new = raised.unionByName(copies.select(raised.columns)).select(old.columns)
    return shown(merge_rows(old, new, ["advertiser_id"]), ROW_DIGITS)


def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supply stored by date; events of the first day with one more slot, and copies of them, are merged in."""
    store = own_database(spark)
    rows = raw_supply(spark, sf_dir).select("supply_event_id", "placement_type", "available_slots", "date")
    store.load(rows, "fact_supply", partition_by=["date"])
    first = rows.agg(F.min("date")).first()[0]
    raised = put(rows.where(F.col("date") == F.lit(first)), {"available_slots": "available_slots + 1"}).select(rows.columns)
    copies = put(raised, {"supply_event_id": "concat(supply_event_id, '-2')"}).select(rows.columns)
    store.merge(raised.unionByName(copies), "fact_supply", ["supply_event_id"])
    return store.table("fact_supply")


def own_kpi(auctions_: DataFrame) -> DataFrame:
    """A KPI of one's own, given as a Column, per placement."""
    margin = KPI(
        name="win margin",
        measure=F.avg(F.col("winning_bid_usd") - F.col("clearing_price_usd")),
        unit="USD",
        category="efficiency",
        description="Mean of what the winner bid above the clearing price.",
        inputs=("winning_bid_usd", "clearing_price_usd"),
    )
    return kpi_reports.by_segment(auctions_, "placement_type", [margin])


def _add_moments(a: tuple, b: tuple) -> tuple:
    """Count, mean and central sums of the second and third power of two sets of numbers as one."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, d = a[0] + b[0], b[1] - a[1]
    second = a[2] + b[2] + d * d * a[0] * b[0] / n
    third = a[3] + b[3] + d**3 * a[0] * b[0] * (a[0] - b[0]) / n**2 + 3 * d * (a[0] * b[2] - b[0] * a[2]) / n
    return n, a[1] + d * b[0] / n, second, third


def _moments(rows: pd.DataFrame) -> tuple:
    x = rows.iloc[:, 0].dropna().to_numpy(dtype=float)
    if not len(x):
        return 0, 0.0, 0.0, 0.0
    d = x - x.mean()
    return len(x), float(x.mean()), float((d * d).sum()), float((d**3).sum())


#: Skewness of a column: the third central moment over the third power of the standard deviation.
SKEWNESS = PythonMeasure(
    start=lambda: (0, 0.0, 0.0, 0.0),
    update=lambda state, rows: _add_moments(state, _moments(rows)),
    merge=_add_moments,
    finish=lambda s: None if not s[2] else (s[3] / s[0]) / (s[2] / s[0]) ** 1.5,
)
BID_SKEW = KPI(
    name="bid skew",
    measure=SKEWNESS,
    unit="ratio",
    category="efficiency",
    description="Skewness of the winning bids.",
    inputs=("winning_bid_usd",),
)


def python_kpi(auctions_: DataFrame) -> DataFrame:
    """A KPI computed in Python beside a registered one, per device and day of the week."""
    days = auctions_.withColumn("segment", F.concat_ws(" ", "device_type", "day_of_week"))
    return kpi_reports.by_segment(days, "segment", [BID_SKEW, "fill_rate"])


#: Files of the facts in one micro-batch; all files are read, in as many triggers as that takes.
FILES_PER_TRIGGER = 1_000


def auction_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """The facts from a stream of line items and the static parts."""
    apply_runtime_conf(spark)
    parts = star.read_table(spark, sf_dir, "part")
    return derive_auction_columns(star.auctions_from(table_stream(spark, sf_dir, "lineitem", files_per_trigger), parts))


WINDOW_COLUMNS = ["window_start", "window_end", "n_samples", *[kpi.name for kpi in REGISTRY]]


def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest version of each window; event times come in no order, so there is no watermark."""
    windows = kpi_windows.windowed_kpis(auction_stream(spark, sf_dir)).drop("window")
    return kpi_windows.without_zone(run_update(windows, "window_start", "kpi-windows"))


def stream_kpi_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(streamed_windows(spark, sf_dir).select(WINDOW_COLUMNS))


def kpi_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = kpi_windows.without_zone(kpi_windows.windowed_kpis(auctions(spark, sf_dir)))
    return shown(windows.select(WINDOW_COLUMNS))


def kpi_alerts_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = kpi_windows.without_zone(kpi_windows.windowed_kpis(auctions(spark, sf_dir)))
    return shown(kpi_windows.consecutive_alerts(kpi_windows.window_status(windows)))


def stream_alerts_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = stage_table(streamed_windows(spark, sf_dir), "latest-windows")
    return shown(kpi_windows.consecutive_alerts(kpi_windows.window_status(latest)))


def stream_alerts_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts that the running stream has raised and not withdrawn by its present end."""
    windows = kpi_windows.windowed_kpis(auction_stream(spark, sf_dir)).drop("window")
    return shown(live_alerts.run_live_alerts(windows, scratch_path(spark, "live-alerts")))


def stream_bid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    baselines = stage_table(detect.bid_baselines(auctions(spark, sf_dir), quantiles=False), "baselines")
    # No state and no shuffle of the stream: the staged baselines are as small as there are placements.
    scored_bids = detect.score_bids(auction_stream(spark, sf_dir), baselines).select(
        "auction_id", "placement_type", "winning_bid_usd", "bid_z_score", "bid_is_anomaly"
    )
    return shown(run_append(scored_bids, "bid-scores"), ROW_DIGITS)


#: Landings, one after the other in time, that the rolling stream is run over.
LANDINGS = 4


def stream_rolling_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bids that land in order of time, slice by slice, each followed by a run of the stream."""
    bids = auctions(spark, sf_dir).select("auction_id", "placement_type", "timestamp", "winning_bid_usd")
    # A slice is read from all of its files; to order them first would send every bid once more.
    bids = stage_table(bids, "bids")
    seconds = F.unix_seconds(F.col("timestamp").cast("timestamp"))
    first, last = bids.agg(F.min(seconds), F.max(seconds)).first()
    landing, location = scratch_path(spark, "landing"), scratch_path(spark, "rolling")
    slice_of = F.floor((seconds - F.lit(first)) * LANDINGS / F.lit((last or 0) - (first or 0) + 1))
    for number in range(LANDINGS):
        bids.where(slice_of == number).write.mode("append").parquet(landing)
        rolling.roll_stream(spark.readStream.schema(bids.schema).parquet(landing), location)
    flags = rolling.rolled_flags(spark, location).select("auction_id", "rolling_limit", "is_rolling_anomaly")
    return shown(flags, 6)


# Boosted models of this process by the rows they were fitted on, so that the queries about one model fit it once.
_FITTED: dict[tuple, object] = {}


def _fingerprint(rows: DataFrame) -> tuple:
    """Number and summed hash of the rows: another one as soon as the data differ."""
    digest = F.xxhash64(*rows.columns).cast("decimal(38,0)")
    return tuple(rows.agg(F.count(F.lit(1)), F.sum(digest)).first())


def _fitted(kind: type, spark: SparkSession, sf_dir: str, source: Query):
    at = (kind, spark.sparkContext.applicationId, *_fingerprint(source(spark, sf_dir)))
    if at not in _FITTED:
        _FITTED[at] = kind().fit(source(spark, sf_dir))
    return _FITTED[at]


def fill_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _fitted(FillModel, spark, sf_dir, auctions).metrics
    return spark.createDataFrame([metrics], "roc_auc double, avg_precision double, test_samples long, positive_rate double")


def fill_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _fitted(FillModel, spark, sf_dir, auctions)
    return model.predict(auctions(spark, sf_dir)).select("auction_id", "filled", "fill_probability", "predicted_fill")


def fill_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(FillModel, spark, sf_dir, auctions).feature_importance()


def ecpm_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _fitted(EcpmModel, spark, sf_dir, auctions).metrics
    return spark.createDataFrame([metrics], "mae_log double, r2 double, mae_ecpm double, test_samples long")


def ecpm_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _fitted(EcpmModel, spark, sf_dir, auctions)
    return model.predict(auctions(spark, sf_dir)).select("auction_id", "ecpm", "predicted_ecpm")


def iforest_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = forest_ops.AnomalyForest().fit(spread_auctions(spark, sf_dir))
    return shown(forest.training_statistics(spark))


def fill_hold_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and test rows per class of the fill model's split."""
    marked = hold_out(auctions(spark, sf_dir).select("auction_id", "filled"), "auction_id", ["filled"])
    return marked.groupBy("filled").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("_test").alias("n_test"))


def forest_scored(spark: SparkSession, sf_dir: str, native: bool = False) -> DataFrame:
    columns = dict.fromkeys(["auction_id", "placement_type", "device_type", *forest_ops.FEATURES])
    return forest_ops.AnomalyForest(native=native).fit_predict(spread_auctions(spark, sf_dir).select(*columns))


def iforest_scores_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest's scores by its node table and Spark's expressions."""
    return forest_scored(spark, sf_dir, native=True).select("auction_id", "anomaly_score", "is_anomaly")


#: Three trees over bid, floor and depth: a stump, one cut twice, a leaf alone.
LITERAL_TREES = [
    (0, 0, 0, 1.25, 1, 2, None),
    (0, 1, -1, None, None, None, 0.5),
    (0, 2, -1, None, None, None, -0.25),
    (1, 0, 2, 4.0, 1, 2, None),
    (1, 1, 1, 0.4, 3, 4, None),
    (1, 2, 0, 2.0, 5, 6, None),
    (1, 3, -1, None, None, None, 1.0),
    (1, 4, -1, None, None, None, 2.0),
    (1, 5, -1, None, None, None, 4.0),
    (1, 6, -1, None, None, None, 8.0),
    (2, 7, -1, None, None, None, 16.0),
]


def tree_table_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three given trees add up to for each auction; a missing bid, floor or depth goes to the right."""
    nodes = spark.createDataFrame(LITERAL_TREES, NODES)
    features = [F.col("winning_bid_usd"), F.col("bid_floor_usd"), F.col("auction_depth")]
    return raw_auctions(spark, sf_dir).select("auction_id", ensemble_sum(nodes, features).alias("tree_sum"))


def anomaly_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_ops.either_detector(forest_scored(spark, sf_dir), scored(spark, sf_dir))


def queries() -> dict[str, Query]:
    a = auctions
    return {
        "auctions_enriched": _on(enriched, lambda df: df.select(ENRICHED_COLUMNS), ROW_DIGITS),
        "supply_enriched": _on(supply, lambda df: df, ROW_DIGITS),
        "release_labels": _on(a, release_summary),
        "release_label_rows": _on(
            a, lambda df: df.select("auction_id", "release_period", "treatment", "feature_version")
        ),
        "kpi_scorecard": _on(a, kpi_reports.scorecard),
        "kpi_scorecard_segment": _on(
            a,
            lambda df: kpi_reports.scorecard(
                df, {"placement_type": "top_of_search", "device_type": "mobile"}
            ),
        ),
        "kpi_scorecard_core": _on(a, kpi_reports.core_scorecard),
        "kpi_alerts": _on(a, kpi_reports.alerts),
        "kpi_by_segment": _on(a, lambda df: kpi_reports.by_segment(df, "placement_type")),
        "kpi_by_segment_subset": _on(
            a, lambda df: kpi_reports.by_segment(df, "device_type", ["fill_rate", "ecpm"])
        ),
        "kpi_own_by_segment": _on(a, own_kpi),
        "kpi_python_by_segment": _on(a, python_kpi),
        "kpi_trend_daily": _on(a, lambda df: kpi_reports.trend(df, "fill_rate"), 6),
        "kpi_trend_weekly_grouped": _on(
            a, lambda df: kpi_reports.trend(df, "ecpm", "W", "placement_type"), 6
        ),
        "kpi_series_daily": _on(a, kpi_reports.kpi_series, 6),
        "kpi_daily": _on(a, snapshots.kpi_snapshot, 6),
        "kpi_hourly": _on(a, lambda df: snapshots.kpi_snapshot(df, snapshots.HOURLY_GRAIN), 6),
        "kpi_by_category": _on(a, lambda df: snapshots.kpi_snapshot(df, ["category"]), 6),
        "kpi_rollup_weekly": kpi_rollup_weekly,
        "kpi_snapshots": _on(a, snapshots.all_snapshots, 6),
        "dash_daily_revenue": _on(kpi_daily, snapshots.daily_revenue, 6),
        "dash_fill_by_placement": _on(kpi_daily, snapshots.fill_by_placement, 6),
        "bid_spread_summary": _on(a, auction_ops.bid_spread_summary),
        "bid_spread_over_time": _on(a, auction_ops.bid_spread_over_time),
        "depth_by_bucket": _on(a, auction_ops.depth_by_bucket),
        "depth_summary": _on(a, auction_ops.depth_summary, 6),
        "depth_distribution": _on(a, auction_ops.depth_distribution),
        "fill_rate_analysis": _on(a, auction_ops.fill_rate_analysis),
        "fill_rate_over_time": _on(a, auction_ops.fill_rate_over_time),
        "fill_rate_over_time_weekly": _on(a, lambda df: auction_ops.fill_rate_over_time(df, "W")),
        "ecpm_percentiles": _on(a, auction_ops.ecpm_percentiles),
        "floor_change": _on(a, lambda df: auction_ops.simulate_floor_change(df, [0.8, 0.9, 1.0, 1.1, 1.25])),
        "floor_change_placement": _on(
            a, lambda df: auction_ops.simulate_floor_change(df, placement="top_of_search")
        ),
        "format_change": _on(a, auction_ops.simulate_format_change),
        "did_fill_rate": _on(a, causal.diff_in_diff),
        "did_ecpm": _on(a, lambda df: causal.diff_in_diff(df, "ecpm")),
        "did_revenue": _on(a, lambda df: causal.diff_in_diff(df, "revenue")),
        "dash_did_cells": _on(a, lambda df: causal.did_cells(causal.diff_in_diff(df, "ecpm"))),
        "adoption_curve": _on(a, causal.adoption_curve),
        "inventory_health": _on(supply, supply_ops.inventory_health),
        "supply_demand_balance": supply_demand_balance,
        "floor_sensitivity": _on(a, supply_ops.floor_sensitivity),
        "supply_trend": _on(supply, supply_ops.supply_trend),
        "ad_load": _on(supply, supply_ops.ad_load),
        "ad_load_overall": _on(supply, supply_ops.ad_load_overall),
        "q_depth_distribution": _on(a, warehouse.depth_distribution),
        "q_depth_buckets": _on(a, warehouse.depth_buckets),
        "q_depth_trend": _on(a, warehouse.depth_trend),
        "q_depth_elasticity": _on(a, warehouse.depth_elasticity),
        "q_spread_summary": _on(a, warehouse.spread_summary),
        "q_spread_format_device": _on(a, warehouse.spread_by_format_device),
        "q_spread_trend": _on(a, warehouse.spread_trend),
        "q_spread_deciles": _on(a, warehouse.spread_deciles),
        "q_fill_heatmap": _on(a, warehouse.fill_heatmap),
        "q_unfilled": _on(a, warehouse.unfilled_diagnosis),
        "q_fill_rolling": _on(a, warehouse.fill_rolling),
        "q_floor_buckets": _on(a, warehouse.floor_buckets),
        "q_hourly_imbalance": _on(a, warehouse.hourly_imbalance),
        "q_scorecard_30d": _on(kpi_daily, warehouse.scorecard_30d),
        "q_revenue_by_placement": _on(kpi_daily, warehouse.revenue_by_placement),
        "q_wow": _on(kpi_daily, warehouse.week_over_week),
        "q_format_performance": _on(kpi_daily, warehouse.format_performance),
        "q_intraday": _on(kpi_hourly, warehouse.intraday),
        "star_by_tier": star_by_tier,
        "star_by_campaign": star_by_campaign,
        "detect_zscore": _on(
            a,
            lambda df: detect.detect(df, "winning_bid_usd").select("auction_id", "winning_bid_usd", "is_anomaly"),
            ROW_DIGITS,
        ),
        "detect_iqr": _on(
            a, lambda df: detect.detect(df, "ecpm", "iqr").select("auction_id", "ecpm", "is_anomaly"), ROW_DIGITS
        ),
        "detect_zscore_keyed": _on(
            a,
            lambda df: detect.detect(df, "winning_bid_usd", keys=["placement_type"]).select(
                "auction_id", "placement_type", "is_anomaly"
            ),
        ),
        "scan_kpis": _on(a, lambda df: detect.scan_kpis(kpi_reports.kpi_series(df)), 6),
        "scan_kpis_iqr": _on(a, lambda df: detect.scan_kpis(kpi_reports.kpi_series(df), method="iqr"), 6),
        "bid_baselines": _on(a, detect.bid_baselines, 6),
        "bid_anomaly_scores": _on(
            scored,
            lambda df: df.select(
                "auction_id", "placement_type", "winning_bid_usd", "bid_z_score", "bid_is_anomaly"
            ),
            ROW_DIGITS,
        ),
        "top_bid_anomalies": _on(scored, detect.top_bid_anomalies, ROW_DIGITS),
        "dash_bid_anomaly_share": _on(scored, detect.anomaly_share),
        "dash_score_histogram": _on(enriched, lambda df: detect.score_histogram(df, "bid_z_score")),
        "bid_rolling_baseline": _on(
            a,
            lambda df: detect.rolling_baseline(df).select(
                "auction_id", "placement_type", "rolling_mean", "rolling_std"
            ),
            6,
        ),
        "bid_rolling_flags": _on(
            a,
            lambda df: detect.rolling_baseline(df).select("auction_id", "rolling_limit", "is_rolling_anomaly"),
            6,
        ),
        "ranking_metrics": _on(
            a,
            lambda df: ranking.ranking_metrics(
                df.withColumn("score", F.round("winning_bid_usd", 3)), "score", "filled"
            ),
        ),
        "scan_csv": scan_csv,
        "csv_quarantine": csv_quarantine,
        "sql_param_scan": sql_param_scan,
        "sink_append_counts": sink_append_counts,
        "table_info": lambda spark, sf_dir: loaded_tables(spark, sf_dir).table_info(),
        "warehouse_summary": lambda spark, sf_dir: loaded_tables(spark, sf_dir).summary(),
        "etl_row_counts": lambda spark, sf_dir: etl_run(spark, sf_dir).table_info(),
        "etl_kpi_daily": etl_kpi_daily,
        "etl_incremental": etl_incremental,
        "etl_incremental_facts": etl_incremental_facts,
        "table_versions": table_versions,
        "upsert_merge": upsert_merge,
        "upsert_partitioned": upsert_partitioned,
        "kpi_5min": kpi_5min,
        "stream_kpi_5min": stream_kpi_5min,
        "kpi_alerts_consecutive": kpi_alerts_consecutive,
        "stream_alerts_consecutive": stream_alerts_consecutive,
        "stream_alerts_live": stream_alerts_live,
        "stream_rolling_flags": stream_rolling_flags,
        "stream_bid_scores": stream_bid_scores,
        "iforest_scores": _on(
            forest_scored, lambda df: df.select("auction_id", "anomaly_score", "is_anomaly")
        ),
        "iforest_scores_native": iforest_scores_native,
        "tree_table_scores": tree_table_scores,
        "iforest_summary": _on(forest_scored, forest_ops.summarise),
        "iforest_training": iforest_training,
        "iforest_flag_rate": _on(forest_scored, forest_ops.flag_rate),
        "top_anomalies": _on(forest_scored, forest_ops.top_anomalies),
        "anomaly_union": anomaly_union,
        "fill_hold_out": fill_hold_out,
        "fill_model_metrics": fill_model_metrics,
        "fill_predictions": fill_predictions,
        "fill_importance": fill_importance,
        "ecpm_model_metrics": ecpm_model_metrics,
        "ecpm_predictions": ecpm_predictions,
        "dq_checks": dq_checks,
        "dq_primary_keys": dq_primary_keys,
        "dq_keys_after_append": dq_keys_after_append,
        "dq_append_by_filters": dq_append_by_filters,
        "dq_fact_append_by_filters": dq_fact_append_by_filters,
        "dq_orphans": dq_orphans,
        "dim_date": _on(raw_auctions, quality.dim_date),
        "dim_placement": _on(raw_auctions, quality.dim_placement),
        "dim_advertiser": lambda spark, sf_dir: shown(star.dim_advertiser(apply_runtime_conf(spark), sf_dir), ROW_DIGITS),
        "dim_campaign": lambda spark, sf_dir: shown(star.dim_campaign(apply_runtime_conf(spark), sf_dir), ROW_DIGITS),
    }
