"""Difference-in-differences and adoption of a release."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.numbers import ratio, round_mean
from bidscope.functions.timebins import fill_empty_bins, time_bin

# Names of the metrics and the columns behind them.
METRIC_COLUMNS = {"fill_rate": "filled", "ecpm": "ecpm", "revenue": "revenue_usd"}


def metric_column(metric: str) -> str:
    return METRIC_COLUMNS.get(metric, metric)


def student_t_two_sided(t: float, freedom: float) -> float:
    """Probability of a value at least as far from zero as ``t``.

    The density is integrated over the tail, mapped to the unit interval, and divided by its integral
    from zero on: its constant factor, which cancels digits at many degrees of freedom, is not needed.
    """
    nodes, weights = np.polynomial.legendre.leggauss(400)
    u = (nodes + 1) / 2

    def beyond(start: float) -> float:
        x = start + u / (1 - u)
        return float(np.sum(weights * np.exp(-(freedom + 1) / 2 * np.log1p(x * x / freedom)) / (1 - u) ** 2))

    return min(1.0, beyond(abs(t)) / beyond(0.0))


@F.pandas_udf(T.DoubleType())
def _p_value(t: pd.Series, freedom: pd.Series) -> pd.Series:
    pairs = zip(t.astype("float64"), freedom.astype("float64"))
    return pd.Series([None if pd.isna(a) or pd.isna(b) else student_t_two_sided(a, b) for a, b in pairs])


def _cells(auctions: DataFrame, value: str, treatment: str, period: str) -> DataFrame:
    """Rows, values, mean and squared deviations of the four group-by-period cells.

    The fact table is read once and reduced to one row per placement and period. Whether a
    placement was ever treated is decided on those few rows, and their moments are merged there.
    """
    metric = F.col(value).cast("double")
    parts = auctions.groupBy("placement_type", F.col(period).alias("period")).agg(
        F.max(F.col(treatment)).alias("_treated"),
        F.count(F.lit(1)).alias("_rows"),
        F.count(metric).alias("_n"),
        F.avg(metric).alias("_mean"),
        (F.var_pop(metric) * F.count(metric)).alias("_dev"),
    )
    ever = F.max("_treated").over(Window.partitionBy("placement_type"))
    grouped = parts.withColumn("treated", F.coalesce(ever == 1, F.lit(False)).cast("int"))
    cell = Window.partitionBy("treated", "period")
    center = F.sum(F.col("_mean") * F.col("_n")).over(cell) / F.nullif(F.sum("_n").over(cell), F.lit(0))
    return (
        grouped.withColumn("_center", center)
        .groupBy("treated", "period")
        .agg(
            F.sum("_rows").alias("rows"),
            F.sum("_n").alias("n"),
            F.max("_center").alias("mean"),
            F.sum(F.col("_dev") + F.col("_n") * (F.col("_mean") - F.col("_center")) ** 2).alias("dev"),
        )
    )


def diff_in_diff(
    auctions: DataFrame,
    metric: str = "fill_rate",
    treatment_col: str = "treatment",
    period_col: str = "release_period",
) -> DataFrame:
    """One row: the cell means, the estimate, and a pooled t-test of treated post against pre.

    A missing cell counts as 0. Fewer than two treated rows on either side give no test.
    """
    cells = _cells(auctions, metric_column(metric), treatment_col, period_col)

    def cell(treated: int, period: str, column: str) -> Column:
        here = (F.col("treated") == treated) & (F.col("period") == period)
        return F.max(F.when(here, F.col(column)))

    wide = cells.agg(
        F.coalesce(cell(0, "pre", "mean"), F.lit(0.0)).alias("pre_control"),
        F.coalesce(cell(0, "post", "mean"), F.lit(0.0)).alias("post_control"),
        F.coalesce(cell(1, "pre", "mean"), F.lit(0.0)).alias("pre_treated"),
        F.coalesce(cell(1, "post", "mean"), F.lit(0.0)).alias("post_treated"),
        *[
            cell(1, period, column).alias(f"_{column}_{period}")
            for period in ("pre", "post")
            for column in ("rows", "n", "mean", "dev")
        ],
    )
    estimate = (F.col("post_treated") - F.col("pre_treated")) - (F.col("post_control") - F.col("pre_control"))
    freedom = F.col("_n_post") + F.col("_n_pre") - 2
    spread = ratio(F.col("_dev_post") + F.col("_dev_pre"), freedom) * (
        ratio(F.lit(1.0), F.col("_n_post")) + ratio(F.lit(1.0), F.col("_n_pre"))
    )
    enough = (F.col("_rows_pre") >= 2) & (F.col("_rows_post") >= 2)
    tested = (
        wide.withColumn("_did", estimate)
        .withColumn("_freedom", freedom)
        .withColumn("_t", F.when(enough, ratio(F.col("_mean_post") - F.col("_mean_pre"), F.sqrt(spread))))
        .withColumn("_p", _p_value(F.col("_t"), F.col("_freedom").cast("double")))
    )
    return tested.select(
        F.lit(metric).alias("metric"),
        *[round_mean(F.col(name), 4).alias(name) for name in ("pre_control", "post_control", "pre_treated", "post_treated")],
        round_mean(F.col("_did"), 4).alias("did_estimate"),
        F.coalesce(F.round(ratio(F.col("_did"), F.col("pre_treated")) * 100, 2), F.lit(0.0)).alias(
            "relative_lift_pct"
        ),
        F.round("_t", 3).alias("t_statistic"),
        F.round("_p", 4).alias("p_value"),
        (F.col("_p") < 0.05).alias("significant_at_5pct"),
    )


def did_cells(report: DataFrame) -> DataFrame:
    """The four cell means of a report as rows for a chart."""
    # Chart labels.
    labels = {
        "pre_control": "Control (pre)",
        "post_control": "Control (post)",
        "pre_treated": "Treated (pre)",
        "post_treated": "Treated (post)",
    }
    cells = [F.struct(F.lit(label).alias("group"), F.col(name).alias("value")) for name, label in labels.items()]
    return report.select(F.inline(F.array(*cells)))


def adoption_curve(auctions: DataFrame, freq: str = "D") -> DataFrame:
    """Share of treated auctions per bin after the release."""
    binned = (
        auctions.where("release_period = 'post'")
        .withColumn("period", time_bin(F.col("timestamp"), freq))
        .groupBy("period")
        .agg(round_mean(F.avg("treatment"), 4).alias("adoption_rate"), F.count("treatment").alias("n_events"))
    )
    return fill_empty_bins(binned, "period", freq, zero=["n_events"]).orderBy("period")
