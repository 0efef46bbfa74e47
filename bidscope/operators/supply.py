"""Inventory health, supply and demand, floor sensitivity, ad load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.functions.numbers import ratio, round_mean
from bidscope.functions.timebins import fill_empty_bins, time_bin
from bidscope.operators.quantiles import grouped_quantiles
from bidscope.session import one_row, stage_table

FLOOR_STEPS = 50


def inventory_health(supply: DataFrame) -> DataFrame:
    by = ["placement_type", "device_type"]
    rows = supply.dropna(subset=by)
    means = rows.groupBy(*by).agg(
        F.count("supply_event_id").alias("total_supply_events"),
        F.avg("fill_rate").alias("avg_fill_rate"),
        F.avg("available_slots").alias("avg_available_slots"),
        F.avg("monetized_slots").alias("avg_monetized_slots"),
        F.avg("floor_price_usd").alias("avg_floor_price"),
        F.avg("supply_health").alias("avg_supply_health"),
    )
    quantiles = grouped_quantiles(rows, by, "fill_rate", {"p50_fill_rate": 0.5, "p10_fill_rate": 0.1})
    rounded = {
        name: round_mean(F.col(name), 4)
        for name in [
            "avg_fill_rate",
            "avg_available_slots",
            "avg_monetized_slots",
            "avg_floor_price",
            "avg_supply_health",
            "p50_fill_rate",
            "p10_fill_rate",
        ]
    }
    return means.join(quantiles, by, "left").withColumns(rounded).orderBy(F.desc("avg_supply_health"), *by)


def supply_demand_balance(supply: DataFrame, auctions: DataFrame | None) -> DataFrame:
    """Daily supply next to daily demand; a day with only one of them keeps its row."""
    if auctions is None:
        raise ValueError("Supply-demand balance needs the auctions.")
    by = ["date", "placement_type"]
    offered = (
        supply.dropna(subset=by)
        .groupBy(*by)
        .agg(
            F.count("supply_event_id").alias("supply_events"),
            F.sum("available_slots").alias("available_slots"),
            F.sum("monetized_slots").alias("monetized_slots"),
        )
    )
    requested = (
        auctions.dropna(subset=by)
        .groupBy(*by)
        .agg(
            F.count("auction_id").alias("auction_requests"),
            F.sum("filled").alias("filled_requests"),
            F.sum("revenue_usd").alias("revenue_usd"),
        )
    )
    return (
        offered.join(requested, by, "full")
        .withColumns(
            {
                "fill_rate": round_mean(ratio(F.col("filled_requests"), F.col("auction_requests")), 4),
                "monetization_rate": round_mean(ratio(F.col("revenue_usd"), F.col("available_slots")), 4),
                "demand_supply_ratio": round_mean(ratio(F.col("auction_requests"), F.col("supply_events")), 2),
            }
        )
        .orderBy(*by)
    )


def _floor_at(index: Column) -> Column:
    evenly = F.col("_low") + index * F.col("_step")
    return F.when(index == FLOOR_STEPS - 1, F.col("_high")).otherwise(evenly)


def _floors_met() -> Column:
    """How many of the floors the bid meets: an arithmetic guess, set right by its neighbours."""
    bid, last = F.col("winning_bid_usd"), F.lit(FLOOR_STEPS - 1)
    guess = F.floor(ratio(bid - F.col("_low"), F.col("_step")))
    top = F.least(F.greatest(guess, F.lit(-1)), last)
    next_met = (top < last) & (_floor_at(top + 1) <= bid)
    not_met = (top >= 0) & (_floor_at(top) > bid)
    met = top + 1 + F.when(next_met, 1).otherwise(0) - F.when(not_met, 1).otherwise(0)
    one_floor = F.when(bid >= F.col("_low"), F.lit(FLOOR_STEPS)).otherwise(F.lit(0))
    return F.coalesce(F.when(F.col("_step") == 0, one_floor).otherwise(met), F.lit(0)).cast("int")


def floor_sensitivity(auctions: DataFrame | None, placement: str = "top_of_search") -> DataFrame:
    """Fill rate and expected revenue of 50 floors between the lowest and the 95th percentile.

    Rows are not repeated per floor. Each bid is counted under the number of floors it meets, and
    the curve is a running sum over those 51 counts. The first best floor is marked, once.
    """
    if auctions is None:
        raise ValueError("Floor sensitivity needs the auctions.")
    rows = auctions.where(F.col("placement_type") == placement)
    span = stage_table(grouped_quantiles(rows, [], "bid_floor_usd", {"_low": 0.0, "_high": 0.95}), "floors")
    bounds = one_row(span)
    ends = {name: bounds.getField(name) for name in span.columns}
    step = {"_step": (F.col("_high") - F.col("_low")) / (FLOOR_STEPS - 1)}
    counted = stage_table(
        rows.withColumns(ends)
        .withColumns(step)
        .withColumn("_met", _floors_met())
        .groupBy("_met")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("clearing_price_usd").alias("_paid"),
            F.count("clearing_price_usd").alias("_priced"),
        ),
        "floors",
    )
    met_at_least = Window.partitionBy(F.lit(0)).orderBy(F.desc("_met")).rowsBetween(Window.unboundedPreceding, 0)
    total = one_row(counted.agg(F.sum("_n").alias("n"))).getField("n")
    spine = span.select(
        *span.columns,
        F.explode(F.sequence(F.lit(1), F.lit(FLOOR_STEPS))).alias("_met"),
    )
    curve = (
        spine.join(counted, "_met", "left")
        .withColumns(step)
        .withColumns({name: F.sum(name).over(met_at_least) for name in ["_n", "_paid", "_priced"]})
        .withColumn("_fill", ratio(F.coalesce(F.col("_n"), F.lit(0)), total))
        .select(
            F.col("_met").alias("_index"),
            F.round(_floor_at(F.col("_met") - 1), 4).alias("floor_usd"),
            round_mean(F.col("_fill"), 4).alias("fill_rate"),
            F.round(ratio(F.col("_paid"), F.col("_priced")) * F.col("_fill"), 6).alias("expected_rev_per_auction"),
        )
    )
    best = Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last("expected_rev_per_auction"), "_index")
    return (
        curve.where(F.col("floor_usd").isNotNull())
        .withColumn("is_optimal_floor", F.row_number().over(best) == 1)
        .withColumn("placement_type", F.lit(placement))
        .orderBy("_index")
        .drop("_index")
    )


def supply_trend(supply: DataFrame, freq: str = "W") -> DataFrame:
    binned = (
        supply.withColumn("_bin", time_bin(F.col("timestamp"), freq))
        .groupBy("_bin")
        .agg(
            F.count("supply_event_id").alias("supply_events"),
            round_mean(F.avg("fill_rate"), 4).alias("avg_fill_rate"),
            round_mean(F.avg("available_slots"), 4).alias("avg_available_slots"),
            round_mean(F.avg("floor_price_usd"), 4).alias("avg_floor_price"),
        )
    )
    last_four = Window.partitionBy(F.lit(0)).orderBy("timestamp").rowsBetween(-3, 0)
    return (
        fill_empty_bins(binned, "_bin", freq, zero=["supply_events"])
        .withColumnRenamed("_bin", "timestamp")
        .withColumn("fill_rate_rolling", round_mean(F.avg("avg_fill_rate").over(last_four), 4))
        .orderBy("timestamp")
    )


def ad_load(supply: DataFrame) -> DataFrame:
    rows = supply.dropna(subset=["placement_type"])
    loads = rows.groupBy("placement_type").agg(
        round_mean(F.avg("available_slots"), 2).alias("avg_ad_load"),
        F.max("available_slots").alias("max_ad_load"),
        F.round(F.stddev_samp("available_slots"), 2).alias("std_ad_load"),
    )
    medians = grouped_quantiles(rows, ["placement_type"], "available_slots", {"median_ad_load": 0.5})
    return loads.join(medians, "placement_type", "left").select(
        "placement_type",
        "avg_ad_load",
        F.round("median_ad_load", 2).alias("median_ad_load"),
        "max_ad_load",
        "std_ad_load",
    )


def ad_load_overall(supply: DataFrame) -> DataFrame:
    mean = one_row(supply.agg(F.avg("available_slots").alias("mean"))).getField("mean")
    quantiles = grouped_quantiles(supply, [], "page_load_ms", {"p50": 0.5, "p95": 0.95})
    return quantiles.select(
        round_mean(mean, 2).alias("overall_avg_load"),
        F.col("p50").cast("int").alias("page_load_p50_ms"),
        F.col("p95").cast("int").alias("page_load_p95_ms"),
    )
