"""Spread, depth, fill and eCPM analyses, and the two counterfactuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.labels import DEPTH_BINS, depth_bin
from bidscope.functions.numbers import ratio, round_mean
from bidscope.functions.timebins import fill_empty_bins, time_bin
from bidscope.operators.quantiles import grouped_quantiles
from bidscope.session import one_row

# Fixed text of the format report.
FORMAT_NOTE = (
    "First-price auctions incentivize bid-shading; actual lift will be lower as advertisers adjust bids."
)


def filled_only(auctions: DataFrame) -> DataFrame:
    return auctions.where("filled = 1")


def _rounded(df: DataFrame, names: Sequence[str], digits: int) -> DataFrame:
    return df.withColumns({name: round_mean(F.col(name), digits) for name in names})


def bid_spread_summary(auctions: DataFrame, by: Sequence[str] = ("placement_type",)) -> DataFrame:
    """Spread of filled auctions per segment."""
    by = list(by)
    rows = filled_only(auctions).dropna(subset=by)
    moments = rows.groupBy(*by).agg(
        F.avg("bid_spread").alias("mean_spread"),
        F.stddev_samp("bid_spread").alias("std_spread"),
        F.count("bid_spread").alias("n_auctions"),
    )
    quantiles = grouped_quantiles(
        rows, by, "bid_spread", {"median_spread": 0.5, "p10_spread": 0.1, "p90_spread": 0.9}
    )
    columns = ["mean_spread", "median_spread", "p10_spread", "p90_spread", "std_spread"]
    return _rounded(moments.join(quantiles, by, "left"), columns, 4).select(*by, *columns, "n_auctions")


def bid_spread_over_time(auctions: DataFrame, freq: str = "D") -> DataFrame:
    rows = filled_only(auctions).withColumn("_bin", time_bin(F.col("timestamp"), freq))
    moments = rows.groupBy("_bin").agg(
        F.avg("bid_spread").alias("avg_spread"),
        F.stddev_samp("bid_spread").alias("std_spread"),
        F.count("bid_spread").alias("n_auctions"),
    )
    medians = grouped_quantiles(rows, ["_bin"], "bid_spread", {"p50_spread": 0.5})
    binned = moments.join(medians, "_bin", "left")
    columns = ["avg_spread", "p50_spread", "std_spread"]
    return (
        _rounded(fill_empty_bins(binned, "_bin", freq, zero=["n_auctions"]), columns, 4)
        .select(F.col("_bin").alias("timestamp"), *columns, "n_auctions")
        .orderBy("timestamp")
    )


def depth_by_bucket(auctions: DataFrame) -> DataFrame:
    rows = auctions.withColumn("depth_bucket", depth_bin("auction_depth"))
    order = F.array_position(F.array(*[F.lit(label) for _, label in DEPTH_BINS]), F.col("depth_bucket"))
    return (
        rows.where(F.col("depth_bucket").isNotNull())
        .groupBy("depth_bucket")
        .agg(
            F.count("auction_id").alias("n_auctions"),
            round_mean(F.avg("filled"), 4).alias("fill_rate"),
            F.round(F.avg("ecpm"), 4).alias("avg_ecpm"),
            F.round(F.avg("winning_bid_usd"), 4).alias("avg_winning_bid"),
            round_mean(F.avg("bid_spread"), 4).alias("avg_bid_spread"),
        )
        .orderBy(order)
    )


def depth_summary(auctions: DataFrame) -> DataFrame:
    """Mean, median and quartiles of the depth, one row."""
    mean = one_row(auctions.agg(F.avg("auction_depth").alias("mean"))).getField("mean")
    quantiles = {"median_depth": 0.5, "p25_depth": 0.25, "p75_depth": 0.75}
    return grouped_quantiles(auctions, [], "auction_depth", quantiles).select(
        mean.alias("mean_depth"), *quantiles
    )


def depth_distribution(auctions: DataFrame) -> DataFrame:
    return (
        auctions.dropna(subset=["auction_depth"])
        .groupBy("auction_depth")
        .agg(F.count(F.lit(1)).alias("n_auctions"))
        .orderBy("auction_depth")
    )


def fill_rate_analysis(
    auctions: DataFrame, by: Sequence[str] = ("placement_type", "device_type", "ad_format")
) -> DataFrame:
    by = list(by)
    return (
        auctions.dropna(subset=by)
        .groupBy(*by)
        .agg(
            F.count("auction_id").alias("n_auctions"),
            round_mean(F.avg("filled"), 4).alias("fill_rate"),
            F.round(F.avg("bid_floor_usd"), 4).alias("avg_floor_usd"),
            F.round(F.avg("winning_bid_usd"), 4).alias("avg_winning_bid"),
            F.round(F.sum("revenue_usd"), 4).alias("revenue_usd"),
        )
        .orderBy(F.desc("fill_rate"), *by)
    )


def fill_rate_over_time(auctions: DataFrame, freq: str = "D") -> DataFrame:
    binned = (
        auctions.withColumn("_bin", time_bin(F.col("timestamp"), freq))
        .groupBy("_bin")
        .agg(round_mean(F.avg("filled"), 4).alias("fill_rate"), F.count("filled").alias("n_auctions"))
    )
    return (
        fill_empty_bins(binned, "_bin", freq, zero=["n_auctions"])
        .withColumnRenamed("_bin", "timestamp")
        .orderBy("timestamp")
    )


def ecpm_percentiles(auctions: DataFrame, by: Sequence[str] = ("placement_type", "ad_format")) -> DataFrame:
    by = list(by)
    rows = filled_only(auctions).dropna(subset=by)
    means = rows.groupBy(*by).agg(F.avg("ecpm").alias("mean"), F.count("ecpm").alias("n"))
    quantiles = grouped_quantiles(rows, by, "ecpm", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95})
    columns = ["p25", "p50", "p75", "p95", "mean"]
    return _rounded(means.join(quantiles, by, "left"), columns, 2).select(*by, *columns, "n")


def simulate_floor_change(
    auctions: DataFrame,
    multipliers: Sequence[float] = (1.10,),
    placement: str | None = None,
) -> DataFrame:
    """Which past bids would still meet a changed floor, and what they paid.

    Bids and clearing prices stay as they were. All multipliers share one scan: each is a pair of
    conditional aggregates, so rows are not multiplied.
    """
    rows = auctions.where(F.col("placement_type") == placement) if placement else auctions
    aggregates = [
        F.count(F.lit(1)).alias("n"),
        F.avg("filled").alias("fill"),
        F.coalesce(F.sum("revenue_usd"), F.lit(0.0)).alias("revenue"),
    ]
    for i, multiplier in enumerate(multipliers):
        meets = F.coalesce(
            F.col("winning_bid_usd") >= F.col("bid_floor_usd") * F.lit(float(multiplier)), F.lit(False)
        )
        aggregates += [
            F.avg(meets.cast("int")).alias(f"fill_{i}"),
            F.coalesce(F.sum(F.when(meets, F.col("revenue_usd"))), F.lit(0.0)).alias(f"revenue_{i}"),
        ]
    reports = [
        F.struct(
            F.lit(float(multiplier)).alias("floor_multiplier"),
            F.lit(placement or "all").alias("placement"),
            round_mean(F.col("fill"), 4).alias("baseline_fill_rate"),
            round_mean(F.col(f"fill_{i}"), 4).alias("simulated_fill_rate"),
            round_mean(F.col(f"fill_{i}") - F.col("fill"), 4).alias("fill_rate_delta"),
            F.round("revenue", 2).alias("baseline_revenue_usd"),
            F.round(f"revenue_{i}", 2).alias("simulated_revenue_usd"),
            F.coalesce(
                F.round((ratio(F.col(f"revenue_{i}"), F.col("revenue")) - 1) * 100, 2), F.lit(0.0)
            ).alias("revenue_delta_pct"),
            F.col("n").alias("n_auctions_affected"),
        )
        for i, multiplier in enumerate(multipliers)
    ]
    return rows.agg(*aggregates).select(F.inline(F.array(*reports)))


def simulate_format_change(
    auctions: DataFrame, from_format: str = "second_price", to_format: str = "first_price"
) -> DataFrame:
    """Revenue if every winner had paid the own bid; the formats are labels of the report."""
    paid, bid = F.sum("clearing_price_usd"), F.sum("winning_bid_usd")
    return filled_only(auctions).agg(
        F.lit(from_format).alias("from_format"),
        F.lit(to_format).alias("to_format"),
        F.round(paid, 2).alias("baseline_revenue_usd"),
        F.round(bid, 2).alias("simulated_revenue_usd"),
        F.round((ratio(bid, paid) - 1) * 100, 2).alias("revenue_lift_pct"),
        round_mean(F.avg("bid_spread"), 4).alias("avg_bid_spread"),
        F.lit(FORMAT_NOTE).alias("note"),
    )
