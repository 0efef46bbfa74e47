"""Data-quality checks, and the date and placement dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A condition every row must meet; as in SQL, an unknown condition is no violation."""

    name: str
    condition: str


def _one_of(column: str, values: Sequence[str]) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"{column}_not_null", f"{column} is not null") for column in columns]


# Allowed values and ranges of the warehouse tables.
RULES: dict[str, list[Rule]] = {
    "dim_advertiser": [
        Rule("tier_known", _one_of("tier", ["small", "mid", "large", "enterprise"])),
        Rule("quality_score_0_10", "quality_score between 0 and 10"),
        Rule("identity_match_rate_0_1", "identity_match_rate between 0 and 1"),
        *not_null("tier", "category", "daily_budget_usd", "bidding_strategy"),
    ],
    "dim_campaign": [
        Rule("quality_score_0_10", "quality_score between 0 and 10"),
        Rule("relevance_score_0_1", "relevance_score between 0 and 1"),
        *not_null("advertiser_id", "ad_format", "category", "daily_budget_usd"),
    ],
    "fact_auctions": [
        Rule("hour_0_23", "hour between 0 and 23"),
        Rule("auction_depth_positive", "auction_depth >= 1"),
        Rule("filled_0_1", "filled in (0, 1)"),
        Rule("clicked_0_1", "clicked in (0, 1)"),
        Rule("converted_0_1", "converted in (0, 1)"),
        Rule("release_period_known", _one_of("release_period", ["pre", "post"])),
        Rule("treatment_0_1", "treatment in (0, 1)"),
        Rule("click_needs_fill", "not (clicked = 1 and filled = 0)"),
        *not_null(
            "timestamp",
            "date",
            "hour",
            "placement_type",
            "device_type",
            "ad_format",
            "category",
            "auction_depth",
            "bid_floor_usd",
            "winning_bid_usd",
            "clearing_price_usd",
            "filled",
            "clicked",
            "converted",
            "revenue_usd",
        ),
    ],
    "fact_supply": [
        Rule("available_slots_not_negative", "available_slots >= 0"),
        Rule("fill_rate_0_1", "fill_rate between 0 and 1"),
        *not_null(
            "timestamp",
            "date",
            "hour",
            "placement_type",
            "device_type",
            "available_slots",
            "fill_rate",
            "floor_price_usd",
        ),
    ],
    "dim_date": [
        Rule("quarter_1_4", "quarter between 1 and 4"),
        Rule("month_1_12", "month between 1 and 12"),
        Rule("is_weekend_0_1", "is_weekend in (0, 1)"),
        *not_null("year", "quarter", "month", "week", "day_of_week", "is_weekend", "is_holiday"),
    ],
    "dim_placement": not_null("placement_type", "device_type"),
    "kpi_daily": not_null("date", "placement_type", "device_type", "ad_format"),
    "kpi_hourly": not_null("date", "hour", "placement_type"),
}

# The keys of the warehouse tables.
PRIMARY_KEYS: dict[str, list[str]] = {
    "dim_advertiser": ["advertiser_id"],
    "dim_campaign": ["campaign_id"],
    "dim_date": ["date_key"],
    "dim_placement": ["placement_key"],
    "fact_auctions": ["auction_id"],
    "fact_supply": ["supply_event_id"],
    "kpi_daily": ["date", "placement_type", "device_type", "ad_format"],
    "kpi_hourly": ["date", "hour", "placement_type"],
}
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    ("dim_campaign", "advertiser_id", "dim_advertiser"),
    ("fact_auctions", "campaign_id", "dim_campaign"),
    ("fact_auctions", "advertiser_id", "dim_advertiser"),
]

# Informational: clicks are recorded without regard to fill, so this rule may count rows.
INFORMATIONAL = {"click_needs_fill"}


def _applies(df: DataFrame, rule: Rule) -> bool:
    try:
        return bool(df.select(F.expr(rule.condition)).schema)
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise


def _severity(rule: Rule, skipped: set[str]) -> str:
    if rule.name in skipped:
        return "skipped"
    return "info" if rule.name in INFORMATIONAL else "error"


def check_rules(df: DataFrame, table: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Violations per rule, all rules in one pass.

    A rule on a column the table lacks has the severity ``skipped`` and no count.
    """
    chosen = list(RULES[table] if rules is None else rules)
    skipped = {rule.name for rule in chosen if not _applies(df, rule)}
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            (F.lit(None).cast("long") if rule.name in skipped else F.count_if(~F.expr(rule.condition))).alias(f"_rule_{i}")
            for i, rule in enumerate(chosen)
        ],
    )
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule.name).alias("rule"),
            F.lit(_severity(rule, skipped)).alias("severity"),
            F.col(f"_rule_{i}").alias("violations"),
            F.col("_rows").alias("n_rows"),
        )
        for i, rule in enumerate(chosen)
    ]
    return totals.select(F.inline(F.array(*lines)))


def failures(df: DataFrame, table: str, rules: Sequence[Rule] | None = None, rescued: str | None = None) -> Column:
    """The sorted names of what is wrong with a row, as an array column.

    That are the rules it breaks, but for informational ones and those on columns the table lacks, and ``unreadable
    <column>`` for each entry ``column=text`` of the array column ``rescued``. A rule on a cell that could not be read is not
    counted again.
    """
    chosen = [rule for rule in (RULES[table] if rules is None else rules) if rule.name not in INFORMATIONAL and _applies(df, rule)]
    broken = F.array_compact(F.array(*[F.when(~F.expr(rule.condition), rule.name) for rule in chosen], F.lit(None).cast("string")))
    if rescued is None:
        return F.array_sort(broken)
    lost = F.transform(rescued, lambda entry: F.substring_index(entry, "=", 1))
    own = F.filter(broken, lambda name: ~F.exists(lost, lambda column: name == F.concat(column, F.lit("_not_null"))))
    return F.array_sort(F.concat(F.transform(lost, lambda column: F.concat(F.lit("unreadable "), column)), own))


def quarantine(
    df: DataFrame, table: str, rules: Sequence[Rule] | None = None, rescued: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows that break no rule, and the others with ``failed``, an array of what is wrong with them.

    Both are written in one pass over ``df``, which is read once, and add up to its rows.
    """
    path = scratch_path(df.sparkSession, f"quarantine-{table}")
    marked = df.withColumn("failed", failures(df, table, rules, rescued))
    marked.withColumn("accepted", F.size("failed") == 0).write.partitionBy("accepted").parquet(path)
    back = df.sparkSession.read.schema(marked.schema.add("accepted", "boolean")).parquet(path)
    kept = [name for name in df.columns if name != rescued]
    return back.where("accepted").select(*kept), back.where("NOT accepted").drop("accepted")


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    reports = [check_rules(df, name) for name, df in tables.items() if name in RULES]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def check_primary_key(df: DataFrame, table: str, key: Sequence[str] | None = None) -> DataFrame:
    """How many key values occur more than once, on how many rows, and how many rows lack a key."""
    key = list(key or PRIMARY_KEYS[table])
    missing = F.lit(False)
    for column in key:
        missing = missing | F.col(column).isNull()
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).withColumn("_missing", missing)
    repeated = (F.col("_n") > 1) & ~F.col("_missing")
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(", ".join(key)).alias("key_columns"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("rows_with_repeated_key"),
        F.coalesce(F.sum(F.when(F.col("_missing"), F.col("_n"))), F.lit(0)).alias("rows_without_key"),
    )


def check_foreign_key(child: DataFrame, parent: DataFrame, column: str, names: tuple[str, str]) -> DataFrame:
    """Child rows whose key the parent lacks.

    Rows are counted per key before the join, so a hot key is one row when it is shuffled.
    """
    per_key = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    lost = per_key.join(parent.select(column), column, "left_anti")
    return lost.agg(
        F.lit(names[0]).alias("table_name"),
        F.lit(column).alias("key_column"),
        F.lit(names[1]).alias("parent_table"),
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"),
    )


def dim_date(auctions: DataFrame) -> DataFrame:
    """The calendar from the first to the last auction day; no source names holidays."""
    day = F.col("date_key")
    return (
        auctions.agg(F.min("date").alias("first"), F.max("date").alias("last"))
        .where(F.col("first").isNotNull())
        .select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_key"))
        .select(
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.weekofyear(day).alias("week"),
            F.date_format(day, "EEEE").alias("day_of_week"),
            (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
            F.lit(0).alias("is_holiday"),
        )
    )


def dim_placement(auctions: DataFrame) -> DataFrame:
    """One row per placement and device with its average floor and the formats seen on it.

    Formats are made distinct before they are listed, so the list is as short as there are formats.
    """
    by = ["placement_type", "device_type"]
    rows = auctions.dropna(subset=by)
    floors = rows.groupBy(*by).agg(F.round(F.avg("bid_floor_usd"), 4).alias("floor_price_usd"))
    formats = (
        rows.select(*by, "ad_format")
        .distinct()
        .groupBy(*by)
        .agg(F.to_json(F.array_sort(F.collect_list("ad_format"))).alias("ad_formats_allowed"))
    )
    return floors.join(formats, by).select(
        F.concat_ws("|", *by).alias("placement_key"), *by, "floor_price_usd", "ad_formats_allowed"
    )
