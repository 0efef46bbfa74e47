"""Daily, hourly and free-grain KPI snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.functions.numbers import ratio, round_mean
from bidscope.functions.timebins import time_bin
from bidscope.operators.quantiles import count_buckets, grouped_quantiles
from bidscope.session import stage_table

DAILY_GRAIN = ["date", "placement_type", "device_type", "ad_format"]
HOURLY_GRAIN = ["date", "hour", "placement_type"]
BID_QUANTILES = {"p50_winning_bid": 0.5, "p90_winning_bid": 0.9, "p99_winning_bid": 0.99}

_SUMS = {
    "filled_auctions": "filled",
    "total_clicks": "clicked",
    "total_conversions": "converted",
    "total_revenue_usd": "revenue_usd",
}
_MEANS = {
    "avg_winning_bid": "winning_bid_usd",
    "avg_clearing_price": "clearing_price_usd",
    "avg_bid_spread": "bid_spread",
    "avg_ecpm": "ecpm",
    "avg_auction_depth": "auction_depth",
}


#: Rows of a group up to which its quantiles come from the snapshot's own aggregate, which holds the group's distinct
#: bids; larger groups take histograms. It decides the plan only.
GATHERED_ROWS = 500_000
#: Accuracy of the stored quantile sketches: about 1 % of the rank at 200, a tenth of that at 2000.
SKETCH_K = 800


def _parts() -> list[Column]:
    """What adds up over rows: counts, sums, and sums and counts of the means."""
    return [
        F.count("auction_id").alias("total_auctions"),
        *[F.sum(column).alias(name) for name, column in _SUMS.items()],
        *[part(column).alias(f"{name}_{part.__name__}") for name, column in _MEANS.items() for part in (F.sum, F.count)],
    ]


def _totals() -> list[Column]:
    """The snapshot's counts, sums and means from parts."""
    return [
        *[F.sum(name).alias(name) for name in ["total_auctions", *_SUMS]],
        *[ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_count")).alias(name) for name in _MEANS],
    ]


def _with_ratios(snapshot: DataFrame) -> DataFrame:
    return snapshot.withColumns(
        {
            "fill_rate": round_mean(ratio(F.col("filled_auctions"), F.col("total_auctions")), 4),
            "ctr": round_mean(ratio(F.col("total_clicks"), F.col("filled_auctions")), 4),
            "cvr": round_mean(ratio(F.col("total_conversions"), F.col("total_clicks")), 4),
            "cpc_usd": round_mean(ratio(F.col("total_revenue_usd"), F.col("total_clicks")), 4),
            "rpm_usd": round_mean(ratio(F.col("total_revenue_usd"), F.col("total_auctions")) * 1000, 4),
        }
    )


def largest_groups(auctions: DataFrame, grains: Sequence[Sequence[str]]) -> list[int]:
    """Rows of the largest group of each grain: one pass over the columns of all grains."""
    union = list(dict.fromkeys(column for grain in grains for column in grain))
    cells = auctions.groupBy(*union).agg(F.count(F.lit(1)).alias("_rows"))
    cells = stage_table(cells, "cells") if len(grains) > 1 else cells
    most = []
    for grain in grains:
        groups = cells.dropna(subset=list(grain)).groupBy(*grain).agg(F.sum("_rows").alias("_rows"))
        most.append(groups.agg(F.max("_rows")).first()[0] or 0)
    return most


def kpi_snapshot(
    auctions: DataFrame,
    grain: Sequence[str] = tuple(DAILY_GRAIN),
    quantiles: Mapping[str, float] = BID_QUANTILES,
    approximate: bool = False,
    gathered_rows: int = GATHERED_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Counts, sums, means, bid quantiles and ratios per grain.

    Where no group has over ``gathered_rows`` rows, everything is one aggregate, after a pass over the grain's columns that
    tells so (``largest`` saves it). Else the first pass counts and sums per grain and bucket of bids, and a second one looks
    only at the buckets that hold a quantile. Pass no ``quantiles`` where they are not read, or ``approximate`` for
    sketches in a single pass.
    """
    grain = list(grain)
    rows = auctions.dropna(subset=grain)
    if quantiles and not approximate and largest is None:
        (largest,) = largest_groups(auctions, [grain])
    if quantiles and not approximate and largest > gathered_rows:
        cells = stage_table(count_buckets(rows, grain, "winning_bid_usd", _parts()), "cells")
        exact = grouped_quantiles(rows, grain, "winning_bid_usd", dict(quantiles), counted=cells)
        return _with_ratios(cells.groupBy(*grain).agg(*_totals()).join(exact, grain, "left"))
    columns = [
        F.count("auction_id").alias("total_auctions"),
        *[F.sum(column).alias(name) for name, column in _SUMS.items()],
        *[F.avg(column).alias(name) for name, column in _MEANS.items()],
    ]
    if quantiles:
        shares = list(quantiles.values())
        bid = F.col("winning_bid_usd").cast("double")
        several = F.percentile_approx(bid, shares, 10000) if approximate else F.percentile(bid, shares)
        columns.append(several.alias("_quantiles"))
    snapshot = rows.groupBy(*grain).agg(*columns)
    kept = [c for c in snapshot.columns if c != "_quantiles"]
    return _with_ratios(
        snapshot.select(*kept, *[F.get("_quantiles", F.lit(i)).alias(name) for i, name in enumerate(quantiles)])
    )


def all_snapshots(auctions: DataFrame, quantiles: Mapping[str, float] = BID_QUANTILES) -> DataFrame:
    """Daily and hourly rows in one frame, told apart by ``grain`` so that nobody sums both.

    Three scans: one tells the largest group of either grain, and each grain is one aggregate.
    """
    grains = {"daily": DAILY_GRAIN, "hourly": HOURLY_GRAIN}
    most = largest_groups(auctions, list(grains.values())) if quantiles else [0, 0]
    daily, hourly = (
        kpi_snapshot(auctions, grain, quantiles, largest=rows).withColumn("grain", F.lit(name))
        for (name, grain), rows in zip(grains.items(), most)
    )
    return daily.unionByName(hourly, allowMissingColumns=True)


def sketch_snapshot(auctions: DataFrame, grain: Sequence[str] = tuple(DAILY_GRAIN), accuracy: int = SKETCH_K) -> DataFrame:
    """A snapshot to be stored and rolled up: parts that add up, and a sketch of the bids that merges.

    One pass; the rows of a group never meet, only its parts and sketches do.
    """
    grain = list(grain)
    return auctions.dropna(subset=grain).groupBy(*grain).agg(
        *_parts(), F.kll_sketch_agg_double(F.col("winning_bid_usd").cast("double"), accuracy).alias("bid_sketch")
    )


def roll_up(
    stored: DataFrame,
    grain: Sequence[str],
    quantiles: Mapping[str, float] = BID_QUANTILES,
    accuracy: int = SKETCH_K,
) -> DataFrame:
    """The snapshot of a coarser grain, or over a longer time, from stored ones; no fact is read.

    Counts, sums, means and ratios are exact, quantiles are as near as the merged sketches.
    """
    merged = [F.kll_merge_agg_double("bid_sketch", accuracy).alias("_sketch")] if quantiles else []
    rolled = stored.dropna(subset=list(grain)).groupBy(*grain).agg(*_totals(), *merged)
    for name, p in quantiles.items():
        known = F.coalesce(F.kll_sketch_get_n_double("_sketch"), F.lit(0)) > 0
        rolled = rolled.withColumn(name, F.when(known, F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p)))))
    return _with_ratios(rolled.drop("_sketch"))


def weekly(stored: DataFrame, keys: Sequence[str] = ("placement_type",), quantiles: Mapping[str, float] = BID_QUANTILES) -> DataFrame:
    """Stored daily snapshots per week, named by its Sunday, and ``keys``."""
    weeks = stored.withColumn("week_ending", F.to_date(time_bin(F.col("date"), "W")))
    return roll_up(weeks, ["week_ending", *keys], quantiles)


def daily_revenue(kpi_daily: DataFrame) -> DataFrame:
    return kpi_daily.groupBy("date").agg(F.sum("total_revenue_usd").alias("total_revenue_usd")).orderBy("date")


def fill_by_placement(kpi_daily: DataFrame) -> DataFrame:
    """Mean of the snapshot fill rates, each snapshot row counting once."""
    return (
        kpi_daily.groupBy("placement_type").agg(F.avg("fill_rate").alias("fill_rate")).orderBy("fill_rate")
    )
