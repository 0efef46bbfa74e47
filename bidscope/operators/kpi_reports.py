"""Scorecards, segments, trends and alerts over the KPI registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.functions.columns import quoted
from bidscope.functions.kpis import CORE_KPIS, KPI, REGISTRY, pick_kpis, sql_number, status_of
from bidscope.functions.timebins import fill_empty_bins, time_bin
from bidscope.operators.python_aggregate import aggregate


def measures(kpis: Sequence[KPI], columns: Sequence[str]) -> list[Column]:
    return [kpi.value(columns) for kpi in kpis]


def totals_of(rows: DataFrame, keys: Sequence[str], kpis: Sequence[KPI]) -> DataFrame:
    """``n_samples`` and the KPIs per ``keys``, which are not null: one aggregate, and one more for KPIs in Python."""
    own = [kpi for kpi in kpis if kpi.in_python(rows.columns)]
    native = [kpi for kpi in kpis if kpi not in own]
    totals = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_samples"), *measures(native, rows.columns))
    if own:
        states = aggregate(rows, keys, {kpi.name: (kpi.measure, kpi.inputs) for kpi in own})
        if keys:
            totals = totals.join(states, list(keys), "left")
        else:
            # One row beside one row.
            totals = totals.withColumn("_one", F.lit(1)).join(states.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")
    return totals.select(*keys, "n_samples", *[quoted(kpi.name) for kpi in kpis])


def text(value: str) -> str:
    """An SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def in_segment(df: DataFrame, segment: Mapping[str, object] | None) -> DataFrame:
    for column, wanted in (segment or {}).items():
        df = df.where(F.col(column) == F.lit(wanted))
    return df


def scorecard(
    auctions: DataFrame,
    segment: Mapping[str, object] | None = None,
    kpis: Sequence[str | KPI] | None = None,
) -> DataFrame:
    """All KPIs of the data or a segment with their status: one scan, one aggregate.

    No rows in, no rows out.
    """
    kpis = pick_kpis(kpis)
    totals = totals_of(in_segment(auctions, segment), [], kpis)
    cards = [
        f"named_struct('kpi', {text(kpi.name)}, 'value', round({quoted(kpi.name)}, 6), 'unit', {text(kpi.unit)}, "
        f"'target', {sql_number(kpi.target)}, 'alert_threshold', {sql_number(kpi.alert_threshold)}, "
        f"'status', {status_of(kpi, quoted(kpi.name))}, 'category', {text(kpi.category)}, "
        f"'higher_is_better', {str(kpi.higher_is_better).lower()}, 'description', {text(kpi.description)}, "
        "'n_samples', n_samples)"
        for kpi in kpis
    ]
    return totals.where("n_samples > 0").selectExpr(f"inline(array({', '.join(cards)}))")


def core_scorecard(auctions: DataFrame) -> DataFrame:
    return scorecard(auctions, kpis=CORE_KPIS)


def alerts(
    auctions: DataFrame,
    segment: Mapping[str, object] | None = None,
    kpis: Sequence[str | KPI] | None = None,
) -> DataFrame:
    return scorecard(auctions, segment, kpis).where(F.col("status") == "alert")


def by_segment(auctions: DataFrame, column: str, kpis: Sequence[str | KPI] | None = None) -> DataFrame:
    """KPIs per value of a column, one row per value and KPI."""
    kpis = pick_kpis(kpis)
    grouped = totals_of(auctions.dropna(subset=[column]), [column], kpis)
    cells = [
        f"named_struct('kpi', {text(kpi.name)}, 'value', round({quoted(kpi.name)}, 6), 'unit', {text(kpi.unit)})"
        for kpi in kpis
    ]
    return grouped.selectExpr(quoted(column), "n_samples", f"inline(array({', '.join(cells)}))").select(
        column, "kpi", "value", "unit", "n_samples"
    )


def binned_kpis(
    auctions: DataFrame,
    freq: str = "D",
    group: str | None = None,
    kpis: Sequence[KPI] = REGISTRY,
) -> DataFrame:
    """KPIs per time bin (and group); bins without rows have null values."""
    keys = [group] if group else []
    rows = auctions.dropna(subset=["timestamp", *keys])
    binned = totals_of(rows.withColumn("_bin", time_bin(F.col("timestamp"), freq)), [*keys, "_bin"], kpis).drop("n_samples")
    return fill_empty_bins(binned, "_bin", freq, keys).withColumnRenamed("_bin", "timestamp")


def trend(auctions: DataFrame, kpi: str | KPI, freq: str = "D", group: str | None = None) -> DataFrame:
    """One KPI, by its registered name or one's own, over time with the mean of its last seven bins.

    The window runs over bins, of which a group has as many as the calendar, not over events.
    """
    (wanted,) = pick_kpis([kpi])
    binned = binned_kpis(auctions, freq, group, [wanted]).withColumnRenamed(wanted.name, "value")
    last_seven = Window.partitionBy(group or F.lit(0)).orderBy("timestamp").rowsBetween(-6, 0)
    return binned.withColumns(
        {
            "rolling_avg": F.round(F.avg("value").over(last_seven), 6),
            "kpi": F.lit(wanted.name),
        }
    ).orderBy(*([group] if group else []), "timestamp")


def kpi_series(auctions: DataFrame, freq: str = "D", kpis: Sequence[KPI] = REGISTRY) -> DataFrame:
    """All KPIs over time in long form: ``timestamp``, ``kpi``, ``value``."""
    names = [kpi.name for kpi in kpis]
    return binned_kpis(auctions, freq, kpis=kpis).unpivot(["timestamp"], names, "kpi", "value")
