"""Auction facts and dimensions as views over the order tables.

The order tables hold no auction log, so every fact column is a fixed expression over a line
item, its part, an event or a supplier. ``checks/oracles.py`` states the same expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bidscope.functions.columns import one_of, put
from bidscope.functions.labels import release_labels
from bidscope.schemas import AD_FORMATS, ADVERTISER_TIERS, BIDDING_STRATEGIES, DEVICE_TYPES, PLACEMENT_TYPES


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def auctions_from(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One auction per line item, over 90 days; the bid is five times higher on every 97th order."""
    spike = "CASE WHEN l_orderkey % 97 = 0 THEN 5e0 ELSE 1e0 END"
    seconds = "(l_orderkey * 1103 + l_linenumber * 7919 + l_partkey * 31) % 7776000"
    bids = lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"]).selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS auction_id",
        f"timestampadd(SECOND, CAST({seconds} AS INT), timestamp_ntz '2024-01-01 00:00:00') AS `timestamp`",
        f"{one_of(PLACEMENT_TYPES, 'l_partkey')} AS placement_type",
        f"{one_of(DEVICE_TYPES, 'l_suppkey')} AS device_type",
        f"{one_of(AD_FORMATS, 'l_linenumber')} AS ad_format",
        "p_brand AS category",
        "CAST(l_partkey AS STRING) AS campaign_id",
        "CAST(l_suppkey AS STRING) AS advertiser_id",
        "CAST(2 + l_orderkey % 11 AS INT) AS auction_depth",
        "5e-2 + l_quantity * 12e-3 AS bid_floor_usd",
        f"l_extendedprice / 100000e0 * ({spike}) AS winning_bid_usd",
        "97e-2 - l_discount AS _price_share",
        f"l_extendedprice / 100e0 * (p_size / 50e0) * ({spike}) AS ecpm",
        "CAST(l_orderkey % 20 = 0 AS INT) AS clicked",
        "CAST(l_orderkey % 60 = 0 AS INT) AS converted",
    )
    price = "CASE WHEN winning_bid_usd >= bid_floor_usd THEN winning_bid_usd * _price_share ELSE 0e0 END"
    priced = put(
        bids,
        {
            "date": "to_date(`timestamp`)",
            "hour": "hour(`timestamp`)",
            "filled": "CAST(winning_bid_usd >= bid_floor_usd AS INT)",
            "clearing_price_usd": price,
            "revenue_usd": price,
        },
    ).drop("_price_share")
    return release_labels(priced)


def supply_from(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "CAST(event_id AS STRING) AS supply_event_id",
        "ts AS `timestamp`",
        "to_date(ts) AS `date`",
        f"{one_of(PLACEMENT_TYPES, 'user_id')} AS placement_type",
        f"{one_of(DEVICE_TYPES, 'event_id')} AS device_type",
        "CAST(1 + event_id % 5 AS INT) AS available_slots",
        "value / (value + 10e0) AS fill_rate",
        "5e-2 + (event_id % 80) * 1e-2 AS floor_price_usd",
        "CAST(50 + (event_id * 37) % 2950 AS INT) AS page_load_ms",
    )


def advertisers_from(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    small, mid, large, enterprise = ADVERTISER_TIERS
    return supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).selectExpr(
        "CAST(s_suppkey AS STRING) AS advertiser_id",
        f"CASE WHEN s_acctbal < 2000 THEN '{small}' WHEN s_acctbal < 5000 THEN '{mid}' "
        f"WHEN s_acctbal < 8000 THEN '{large}' ELSE '{enterprise}' END AS tier",
        "n_name AS category",
        "s_acctbal + 1000e0 AS daily_budget_usd",
        f"{one_of(BIDDING_STRATEGIES, 's_suppkey')} AS bidding_strategy",
        "1e-1 + (s_suppkey % 50) * 1e-2 AS target_cpc_usd",
        "3e0 + (s_suppkey % 70) * 1e-1 AS quality_score",
        "(s_suppkey % 100) * 1e-2 AS identity_match_rate",
    )


def campaigns_from(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    owners = lineitem.groupBy("l_partkey").agg({"l_suppkey": "min"})
    return part.join(owners, part["p_partkey"] == owners["l_partkey"]).selectExpr(
        "CAST(p_partkey AS STRING) AS campaign_id",
        "CAST(`min(l_suppkey)` AS STRING) AS advertiser_id",
        f"{one_of(AD_FORMATS, 'p_partkey')} AS ad_format",
        "p_brand AS category",
        "p_retailprice AS daily_budget_usd",
        "p_retailprice / 1000e0 AS target_bid_usd",
        "p_size / 5e0 AS quality_score",
        "(p_partkey % 100) * 1e-2 AS relevance_score",
    )


def fact_auctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return auctions_from(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part"))


def fact_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supply_from(read_table(spark, sf_dir, "events"))


def dim_advertiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advertisers_from(read_table(spark, sf_dir, "supplier"), read_table(spark, sf_dir, "nation"))


def dim_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns_from(read_table(spark, sf_dir, "part"), read_table(spark, sf_dir, "lineitem"))
