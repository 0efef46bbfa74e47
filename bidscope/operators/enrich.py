"""Row-level enrichment of auctions and supply events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.columns import put
from bidscope.functions.numbers import rounded
from bidscope.schemas import REQUIRED_AUCTION_COLUMNS, require_columns
from bidscope.session import one_row, stage_table

Z_LIMIT = 3.0


def derive_auction_columns(raw: DataFrame) -> DataFrame:
    """The columns that need nothing but their own row: projections only, no shuffle."""
    require_columns(raw, REQUIRED_AUCTION_COLUMNS)

    def flag(name: str) -> str:
        return f"coalesce({name} <> 0, false)" if name in raw.columns else "false"

    margin = "winning_bid_usd - clearing_price_usd"
    derived = {
        "date": "to_date(`timestamp`)",
        "hour": "hour(`timestamp`)",
        "day_of_week": "date_format(`timestamp`, 'EEEE')",
        "week": "weekofyear(`timestamp`)",
        "month": "month(`timestamp`)",
        "is_weekend": "weekday(`timestamp`) >= 5",
        "bid_spread": rounded(f"coalesce(({margin}) / nullif(winning_bid_usd, 0), 0)", 4),
        "margin_usd": rounded(margin, 4),
        "has_click": flag("clicked"),
        "has_conversion": flag("converted"),
    }
    if "bid_floor_usd" in raw.columns:
        derived["below_floor"] = "coalesce(winning_bid_usd < bid_floor_usd, false)"
    rates = {
        "ctr": "CASE WHEN filled = 1 THEN CAST(has_click AS DOUBLE) END",
        "cvr": "CASE WHEN has_click THEN CAST(has_conversion AS DOUBLE) END",
    }
    timed = put(raw, {"timestamp": "CAST(`timestamp` AS timestamp_ntz)"})
    return put(put(timed, derived), rates)


def add_bid_zscore(df: DataFrame) -> DataFrame:
    """Distance of each bid from the mean of its placement, in standard deviations.

    The statistics are aggregated first and joined back: a window per placement would put a hot
    placement in one task. They are staged, so a small set is broadcast and the fact table is
    neither shuffled nor aggregated again by later passes.
    """
    stats = stage_table(
        df.dropna(subset=["placement_type"])
        .groupBy("placement_type")
        .agg(
            F.avg("winning_bid_usd").alias("_mean"),
            F.stddev_samp("winning_bid_usd").alias("_std"),
        ),
        "placement-bids",
    )
    return scored_against(df, stats)


def scored_against(df: DataFrame, statistics: DataFrame) -> DataFrame:
    """``bid_z_score`` and its flag from ``placement_type, _mean, _std``, which are staged."""
    scored = put(
        df.join(statistics, "placement_type", "left"),
        {"bid_z_score": rounded("(winning_bid_usd - _mean) / nullif(_std, 0)", 3)},
    )
    flagged = put(scored, {"is_bid_anomaly": f"coalesce(abs(bid_z_score) > {Z_LIMIT}, false)"})
    return flagged.drop("_mean", "_std")


def enrich_auctions(raw: DataFrame) -> DataFrame:
    return add_bid_zscore(derive_auction_columns(raw))


def enrich_supply(raw: DataFrame) -> DataFrame:
    top_floor = one_row(raw.agg(F.max("floor_price_usd").alias("floor"))).getField("floor")
    timed = put(raw, {"timestamp": "CAST(`timestamp` AS timestamp_ntz)"}).withColumn("_top_floor", top_floor)
    return put(
        timed,
        {
            "date": "to_date(`timestamp`)",
            "hour": "hour(`timestamp`)",
            "day_of_week": "date_format(`timestamp`, 'EEEE')",
            "monetized_slots": rounded("available_slots * fill_rate", 2),
            "supply_health": rounded(
                "fill_rate * 7e-1 + (1 - floor_price_usd / nullif(_top_floor, 0)) * 3e-1", 4
            ),
        },
    ).drop("_top_floor")
