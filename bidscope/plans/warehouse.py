"""The warehouse query set over the auction facts and the KPI snapshots.

``as_of`` takes the place of the current date, so that a result can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.functions.labels import depth_level, floor_step
from bidscope.functions.numbers import ratio, round_mean
from bidscope.operators.quantiles import grouped_quantiles
from bidscope.operators.ranking import tile_totals

AS_OF = "2024-03-31"


def _count() -> Column:
    return F.count(F.lit(1)).alias("n_auctions")


def _mean(column: str, digits: int) -> Column:
    return round_mean(F.avg(column), digits)


def _sum(column: str | Column, digits: int = 2) -> Column:
    return F.round(F.sum(column), digits)


def _share(part: Column, partition: list[str]) -> Column:
    """Percent of the total of a partition, over rows that are already aggregated."""
    whole = F.sum(part).over(Window.partitionBy(*(partition or [F.lit(0)])))
    return F.round(100.0 * ratio(part, whole), 2)


# Auction depth


def depth_distribution(auctions: DataFrame) -> DataFrame:
    by = ["placement_type", "auction_depth"]
    return (
        auctions.groupBy(*by)
        .agg(
            _count(),
            _mean("filled", 4).alias("fill_rate"),
            _mean("ecpm", 2).alias("avg_ecpm"),
            _mean("winning_bid_usd", 4).alias("avg_winning_bid"),
            _mean("clearing_price_usd", 4).alias("avg_clearing_price"),
            _mean("bid_spread", 4).alias("avg_bid_spread"),
            _sum("revenue_usd").alias("total_revenue"),
        )
        .withColumn("pct_of_placement", _share(F.col("n_auctions"), ["placement_type"]))
        .orderBy(*by)
    )


def depth_buckets(auctions: DataFrame) -> DataFrame:
    """Depth levels with the fill rate of their days.

    The fill rate of a day and placement is the same on all its rows. So rows are counted per
    day, placement and level first, and the join and the average run over those counts.
    """
    by = ["placement_type", "depth_bucket"]
    day = ["date", "placement_type"]
    parts = (
        auctions.withColumn("depth_bucket", depth_level("auction_depth"))
        .groupBy("date", *by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("filled").alias("fills"),
            F.count("filled").alias("known"),
            F.sum("ecpm").alias("ecpm"),
            F.count("ecpm").alias("n_ecpm"),
            F.sum("bid_spread").alias("spread"),
            F.count("bid_spread").alias("n_spread"),
            F.min("auction_depth").alias("depth"),
        )
    )
    of_day = Window.partitionBy(*day)
    daily_fill = F.round(ratio(F.sum("fills").over(of_day), F.sum("known").over(of_day)), 4)
    joined = F.when(F.col("date").isNotNull() & F.col("placement_type").isNotNull(), daily_fill)
    weight = F.when(F.col("fill").isNotNull(), F.col("n"))
    return (
        parts.withColumn("fill", joined)
        .groupBy(*by)
        .agg(
            F.sum("n").alias("n_auctions"),
            round_mean(ratio(F.sum(F.col("fill") * F.col("n")), F.sum(weight)), 4).alias("avg_fill_rate"),
            round_mean(ratio(F.sum("ecpm"), F.sum("n_ecpm")), 2).alias("avg_ecpm"),
            round_mean(ratio(F.sum("spread"), F.sum("n_spread")), 4).alias("avg_bid_spread"),
            F.min("depth").alias("_depth"),
        )
        .orderBy("placement_type", "_depth")
        .drop("_depth")
    )


def depth_trend(auctions: DataFrame) -> DataFrame:
    by = ["date", "placement_type"]
    return (
        auctions.groupBy(*by)
        .agg(
            _mean("auction_depth", 2).alias("avg_depth"),
            _mean("filled", 4).alias("fill_rate"),
            _mean("ecpm", 2).alias("avg_ecpm"),
            _count(),
        )
        .orderBy(*by)
    )


def depth_elasticity(auctions: DataFrame, min_rows: int = 50) -> DataFrame:
    """What one more bidder adds to the mean eCPM of filled auctions."""
    by_depth = Window.partitionBy(F.lit(0)).orderBy("auction_depth")
    return (
        auctions.where("filled = 1")
        .groupBy("auction_depth")
        .agg(_mean("ecpm", 4).alias("avg_ecpm"), _count())
        .where(F.col("n_auctions") >= min_rows)
        .withColumn("ecpm_marginal_gain", F.round(F.col("avg_ecpm") - F.lag("avg_ecpm").over(by_depth), 4))
        .orderBy("auction_depth")
    )


# Bid spreads


def spread_summary(auctions: DataFrame) -> DataFrame:
    margin = F.col("winning_bid_usd") - F.col("clearing_price_usd")
    rows = auctions.where("filled = 1")
    sums = rows.groupBy("placement_type").agg(
        _count(),
        _mean("bid_spread", 4).alias("mean_spread"),
        F.round(F.min("bid_spread"), 4).alias("min_spread"),
        F.round(F.max("bid_spread"), 4).alias("max_spread"),
        F.round(F.avg(margin), 4).alias("avg_margin_usd"),
        _sum(margin).alias("total_advertiser_surplus"),
    )
    medians = grouped_quantiles(
        rows, ["placement_type"], "bid_spread", {"median_spread": 0.5}, keep_null_keys=True
    ).withColumn("median_spread", round_mean(F.col("median_spread"), 4))
    same = sums["placement_type"].eqNullSafe(medians["placement_type"])
    return (
        sums.join(medians, same, "left")
        .select(
            sums["placement_type"],
            "n_auctions",
            "mean_spread",
            "median_spread",
            "min_spread",
            "max_spread",
            "avg_margin_usd",
            "total_advertiser_surplus",
        )
        .orderBy(F.desc("mean_spread"), "placement_type")
    )


def spread_by_format_device(auctions: DataFrame) -> DataFrame:
    by = ["ad_format", "device_type"]
    margin = F.col("winning_bid_usd") - F.col("clearing_price_usd")
    return (
        auctions.where("filled = 1")
        .groupBy(*by)
        .agg(
            _count(),
            _mean("bid_spread", 4).alias("avg_spread"),
            _mean("ecpm", 2).alias("avg_ecpm"),
            _mean("auction_depth", 2).alias("avg_depth"),
            _sum(margin).alias("total_advertiser_surplus_usd"),
        )
        .orderBy(F.desc("avg_spread"), *by)
    )


def spread_trend(auctions: DataFrame) -> DataFrame:
    return (
        auctions.where("filled = 1")
        .groupBy("date")
        .agg(
            _mean("bid_spread", 4).alias("avg_spread"),
            _mean("winning_bid_usd", 4).alias("avg_winning_bid"),
            _mean("clearing_price_usd", 4).alias("avg_clearing_price"),
            F.count(F.lit(1)).alias("n_filled_auctions"),
        )
        .orderBy("date")
    )


def spread_deciles(auctions: DataFrame, tiles: int = 10) -> DataFrame:
    """Share of the surplus per decile of the spread; equal spreads are ordered by auction id."""
    rows = auctions.where("filled = 1").selectExpr(
        "auction_id",
        "bid_spread",
        "bid_spread AS spread",
        "winning_bid_usd - clearing_price_usd AS margin_usd",
    )
    return (
        tile_totals(rows, tiles, "bid_spread", "auction_id", ["spread", "margin_usd"], "spread_decile")
        .withColumn("pct_total_surplus", _share(F.col("margin_usd"), []))
        .select(
            "spread_decile",
            F.col("n_rows").alias("n_auctions"),
            round_mean(ratio(F.col("spread"), F.col("n_rows")), 4).alias("avg_spread"),
            F.round("margin_usd", 2).alias("total_surplus_usd"),
            "pct_total_surplus",
        )
        .orderBy("spread_decile")
    )


# Fill rate


def fill_heatmap(auctions: DataFrame) -> DataFrame:
    by = ["placement_type", "device_type"]
    return (
        auctions.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            F.sum("filled").alias("filled_requests"),
            round_mean(100.0 * F.avg("filled"), 2).alias("fill_rate_pct"),
            _mean("bid_floor_usd", 4).alias("avg_floor_usd"),
            _mean("winning_bid_usd", 4).alias("avg_winning_bid"),
            round_mean(F.avg(F.when(F.col("filled") == 1, F.col("ecpm"))), 2).alias("avg_filled_ecpm"),
            _sum("revenue_usd").alias("total_revenue_usd"),
        )
        .orderBy(F.desc("fill_rate_pct"), *by)
    )


def unfilled_diagnosis(auctions: DataFrame) -> DataFrame:
    bid, floor = F.col("winning_bid_usd"), F.col("bid_floor_usd")
    below = F.sum(F.when(bid < floor, 1).otherwise(0))
    return (
        auctions.where("filled = 0")
        .groupBy("placement_type")
        .agg(
            F.count(F.lit(1)).alias("unfilled_auctions"),
            _mean("bid_floor_usd", 4).alias("avg_floor_usd"),
            _mean("winning_bid_usd", 4).alias("avg_bid_below_floor"),
            round_mean(F.avg(floor - bid), 4).alias("avg_shortfall_usd"),
            F.round(100.0 * below / F.count(F.lit(1)), 2).alias("pct_below_floor"),
        )
        .orderBy(F.desc("unfilled_auctions"), "placement_type")
    )


def fill_rolling(auctions: DataFrame) -> DataFrame:
    last_seven = Window.partitionBy(F.lit(0)).orderBy("date").rowsBetween(-6, 0)
    return (
        auctions.groupBy("date")
        .agg(_mean("filled", 4).alias("fill_rate"), _count())
        .withColumn("rolling_7d_fill_rate", round_mean(F.avg("fill_rate").over(last_seven), 4))
        .orderBy("date")
    )


def floor_buckets(auctions: DataFrame, min_rows: int = 100) -> DataFrame:
    by = ["placement_type", "floor_bucket"]
    return (
        auctions.withColumn("floor_bucket", floor_step("bid_floor_usd"))
        .groupBy(*by)
        .agg(_count(), _mean("filled", 4).alias("fill_rate"), _sum("revenue_usd").alias("revenue_usd"))
        .where(F.col("n_auctions") >= min_rows)
        .withColumn("rev_per_request", round_mean(F.col("revenue_usd") / F.col("n_auctions"), 4))
        .orderBy(*by)
    )


def hourly_imbalance(auctions: DataFrame) -> DataFrame:
    return (
        auctions.groupBy("hour")
        .agg(
            F.count(F.lit(1)).alias("n_requests"),
            _mean("filled", 4).alias("fill_rate"),
            _mean("auction_depth", 2).alias("avg_depth"),
            _mean("ecpm", 2).alias("avg_ecpm"),
            _sum("revenue_usd").alias("hourly_revenue"),
        )
        .orderBy("hour")
    )


# KPI snapshots


def _days_back(as_of: str, days: int) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), days)


def scorecard_30d(kpi_daily: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Five KPIs of the last 30 days next to those of the 30 days before, from one pass.

    Each period is aggregated on its own; multiplying their rows would inflate the sums.
    """
    recent = F.col("date") >= _days_back(as_of, 30)
    prior = (F.col("date") >= _days_back(as_of, 60)) & ~recent
    # Reported KPIs, their aggregate and their digits.
    reported = [
        ("fill_rate", F.avg, 4),
        ("avg_ecpm", F.avg, 2),
        ("avg_bid_spread", F.avg, 4),
        ("ctr", F.avg, 4),
        ("total_revenue_usd", F.sum, 2),
    ]
    totals = kpi_daily.where(F.col("date") >= _days_back(as_of, 60)).agg(
        *[agg(F.when(recent, F.col(name))).alias(f"now_{name}") for name, agg, _ in reported],
        *[agg(F.when(prior, F.col(name))).alias(f"then_{name}") for name, agg, _ in reported],
    )

    def line(name: str, digits: int) -> Column:
        now, then = F.col(f"now_{name}"), F.col(f"then_{name}")
        return F.struct(
            F.lit(name).alias("kpi"),
            round_mean(now, digits).alias("current_value"),
            round_mean(then, digits).alias("prior_value"),
            F.round(100.0 * ratio(now - then, then), 2).alias("pct_change"),
        )

    return totals.select(F.inline(F.array(*[line(name, digits) for name, _, digits in reported])))


def revenue_by_placement(kpi_daily: DataFrame, as_of: str = AS_OF) -> DataFrame:
    return (
        kpi_daily.where(F.col("date") >= _days_back(as_of, 30))
        .groupBy("placement_type")
        .agg(
            F.sum("total_revenue_usd").alias("_revenue"),
            _mean("fill_rate", 4).alias("avg_fill_rate"),
            _mean("avg_ecpm", 2).alias("avg_ecpm"),
            F.sum("total_auctions").alias("total_auctions"),
            _mean("avg_bid_spread", 4).alias("avg_bid_spread"),
        )
        .withColumn("revenue_share_pct", _share(F.col("_revenue"), []))
        .withColumn("revenue_usd", F.round("_revenue", 2))
        .drop("_revenue")
        .orderBy(F.desc("revenue_usd"), "placement_type")
    )


def week_over_week(kpi_daily: DataFrame) -> DataFrame:
    """Each day next to the same cell seven days before.

    The snapshot is joined with itself on the date shifted by a week: an equi-join on four keys.
    """
    cell = ["placement_type", "device_type", "ad_format"]
    week_before = kpi_daily.select(
        F.date_add("date", 7).alias("date"), *cell, F.col("total_revenue_usd").alias("_before")
    )
    now, before = F.sum("total_revenue_usd"), F.sum("_before")
    by = ["date", "placement_type"]
    return (
        kpi_daily.join(week_before, ["date", *cell], "left")
        .groupBy(*by)
        .agg(
            F.round(now, 2).alias("revenue_usd"),
            _mean("fill_rate", 4).alias("fill_rate"),
            _mean("avg_ecpm", 2).alias("avg_ecpm"),
            F.round(before, 2).alias("revenue_usd_wow"),
            F.round(100.0 * ratio(now - before, before), 2).alias("wow_pct_change"),
        )
        .orderBy(*by)
    )


def format_performance(kpi_daily: DataFrame) -> DataFrame:
    by = ["ad_format", "device_type"]
    return (
        kpi_daily.groupBy(*by)
        .agg(
            _mean("fill_rate", 4).alias("avg_fill_rate"),
            _mean("avg_ecpm", 2).alias("avg_ecpm"),
            _mean("ctr", 4).alias("avg_ctr"),
            _mean("cvr", 4).alias("avg_cvr"),
            _mean("avg_bid_spread", 4).alias("avg_bid_spread"),
            F.sum("total_auctions").alias("total_auctions"),
            _sum("total_revenue_usd").alias("total_revenue"),
        )
        .orderBy(F.desc("avg_ecpm"), *by)
    )


def intraday(kpi_hourly: DataFrame, as_of: str = AS_OF) -> DataFrame:
    by = ["hour", "placement_type"]
    return (
        kpi_hourly.where(F.col("date") >= _days_back(as_of, 7))
        .groupBy(*by)
        .agg(
            _mean("total_revenue_usd", 2).alias("avg_hourly_revenue"),
            _mean("fill_rate", 4).alias("avg_fill_rate"),
            _mean("avg_ecpm", 2).alias("avg_ecpm"),
            F.sum("total_auctions").alias("total_auctions"),
        )
        .orderBy(*by)
    )


# Star join


def star_by_tier(auctions: DataFrame, advertisers: DataFrame) -> DataFrame:
    """Auction totals per advertiser tier and strategy.

    Facts are summed per advertiser before the join, so an advertiser with a third of all
    auctions is one row when it meets its dimension row. Auctions of no or an unknown advertiser
    are the line without a tier, so the lines add up to the facts.
    """
    per_advertiser = auctions.groupBy("advertiser_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("filled").alias("fills"),
        F.sum("revenue_usd").alias("revenue"),
        F.sum("winning_bid_usd").alias("bids"),
    )
    return (
        per_advertiser.join(advertisers, "advertiser_id", "left")
        .groupBy("tier", "bidding_strategy")
        .agg(
            F.count("advertiser_id").alias("n_advertisers"),
            F.sum("n").alias("n_auctions"),
            round_mean(ratio(F.sum("fills"), F.sum("n")), 4).alias("fill_rate"),
            round_mean(ratio(F.sum("bids"), F.sum("n")), 4).alias("avg_winning_bid"),
            F.round(F.sum("revenue"), 2).alias("revenue_usd"),
        )
        .orderBy("tier", "bidding_strategy")
    )


#: Measures of a campaign's day that add up.
_DAY_SUMS = {"fills": "filled", "clicks": "clicked", "conversions": "converted", "revenue": "revenue_usd"}


def campaign_days(auctions: DataFrame) -> DataFrame:
    """Totals per campaign and day: partial sums, so a campaign with a third of all auctions is a row a day."""
    return auctions.groupBy("campaign_id", "date").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(column).alias(name) for name, column in _DAY_SUMS.items()]
    )


def star_by_campaign(days: DataFrame, campaigns: DataFrame, advertisers: DataFrame) -> DataFrame:
    """Auction totals per tier of the campaign's advertiser and format of the campaign.

    ``days`` are ``campaign_days``. Where they and the campaigns are stored in as many buckets by campaign, days are summed
    and meet their campaign without a shuffle; only totals per advertiser travel on. Days without a campaign and campaigns
    without an advertiser are lines without a format or tier, so the lines add up to the facts. ``budget_use`` is the
    revenue as a share of the daily budgets of the days with auctions.
    """
    per_campaign = days.groupBy("campaign_id").agg(
        F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in _DAY_SUMS], F.count("date").alias("active_days")
    )
    named = campaigns.select("campaign_id", "advertiser_id", F.col("ad_format").alias("campaign_format"), "daily_budget_usd")
    met = per_campaign.join(named.hint("merge"), "campaign_id", "left")
    totals = ["n", *_DAY_SUMS, "budget", "n_campaigns"]
    per_owner = met.groupBy("advertiser_id", "campaign_format").agg(
        *[F.sum(name).alias(name) for name in ["n", *_DAY_SUMS]],
        F.sum(F.col("daily_budget_usd") * F.col("active_days")).alias("budget"),
        F.count("campaign_id").alias("n_campaigns"),
    )
    return (
        per_owner.join(advertisers.select("advertiser_id", "tier"), "advertiser_id", "left")
        .groupBy("tier", "campaign_format")
        .agg(*[F.sum(name).alias(name) for name in totals])
        .select(
            "tier",
            "campaign_format",
            "n_campaigns",
            F.col("n").alias("n_auctions"),
            round_mean(ratio(F.col("fills"), F.col("n")), 4).alias("fill_rate"),
            round_mean(ratio(F.col("clicks"), F.col("fills")), 4).alias("ctr"),
            F.round("revenue", 2).alias("revenue_usd"),
            round_mean(ratio(F.col("revenue"), F.col("budget")), 6).alias("budget_use"),
        )
        .orderBy("tier", "campaign_format")
    )
