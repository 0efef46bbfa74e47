"""Bucket and release labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.functions.columns import listed, put
from bidscope.schemas import RELEASE_DATE, RELEASE_PLACEMENTS

# Upper depth bounds with the labels of the analysis and of the warehouse query.
DEPTH_BINS = [(2, "2"), (4, "3-4"), (6, "5-6"), (8, "7-8"), (100, "9+")]
DEPTH_LEVELS = [
    (2, "low (1-2)"),
    (4, "medium (3-4)"),
    (6, "high (5-6)"),
    (8, "very_high (7-8)"),
    (None, "extreme (9+)"),
]


def depth_bin(depth: str) -> Column:
    """Half-open bins from 0 to 100; a depth outside them has no bin."""
    bins = " ".join(f"WHEN {depth} <= {upper} THEN '{name}'" for upper, name in DEPTH_BINS)
    return F.expr(f"CASE WHEN {depth} <= 0 THEN NULL {bins} END")


def depth_level(depth: str) -> Column:
    """Five levels without an upper end; an unknown depth falls in the last, as in SQL."""
    *bounded, (_, last) = DEPTH_LEVELS
    levels = " ".join(f"WHEN {depth} <= {upper} THEN '{name}'" for upper, name in bounded)
    return F.expr(f"CASE {levels} ELSE '{last}' END")


def floor_step(floor_usd: str) -> Column:
    """Nearest step of five cents."""
    return F.expr(f"round({floor_usd} * 20) / 20")


def release_labels(
    df: DataFrame,
    release_date: str = RELEASE_DATE,
    placements: list[str] | None = None,
) -> DataFrame:
    """Period before or after a release, whether the row got the feature, and its version."""
    after = f"`timestamp` >= timestamp_ntz '{release_date} 00:00:00'"
    treated = f"{after} AND placement_type IN ({listed(placements or RELEASE_PLACEMENTS)})"
    return put(
        df,
        {
            "release_period": f"CASE WHEN {after} THEN 'post' ELSE 'pre' END",
            "treatment": f"CASE WHEN {treated} THEN 1 ELSE 0 END",
            "feature_version": f"CASE WHEN {treated} THEN 'v2.0' ELSE 'v1.0' END",
        },
    )
