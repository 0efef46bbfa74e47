"""KPIs in event-time windows, and alerts on two breached windows in a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.kpis import KPI, REGISTRY, status_of
from bidscope.functions.columns import listed, quoted
from bidscope.operators.kpi_reports import measures

WINDOW = "5 minutes"


def windowed_kpis(
    auctions: DataFrame,
    window: str = WINDOW,
    watermark: str | None = None,
    kpis: Sequence[KPI] = REGISTRY,
) -> DataFrame:
    """The registered KPIs per window, of a stream or a batch.

    Event time is cast to a timestamp with the session's zone, as watermarks need one. Without a
    watermark a stream keeps one row of state per window and every row counts, however late. A
    watermark frees that state and drops the rows that are later: only for sources that come in
    order but for that delay.
    """
    timed = auctions.withColumn("_event_time", F.col("timestamp").cast("timestamp"))
    if auctions.isStreaming and watermark:
        timed = timed.withWatermark("_event_time", watermark)
    return (
        timed.groupBy(F.window("_event_time", window).alias("window"))
        .agg(F.count(F.lit(1)).alias("n_samples"), *measures(kpis, auctions.columns))
        .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
    )


def without_zone(windows: DataFrame) -> DataFrame:
    """Window bounds as plain timestamps, once nothing needs the watermark any more."""
    ntz = {name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")}
    return windows.drop("window").withColumns(ntz)


def window_status(windows: DataFrame, kpis: Sequence[KPI] = REGISTRY) -> DataFrame:
    """One row per window and KPI with its status; KPIs that cannot alert are left out."""
    able = [kpi for kpi in kpis if kpi.alert_threshold is not None]
    cells = ", ".join(
        f"named_struct('kpi', {listed([kpi.name])}, 'value', {quoted(kpi.name)}, 'status', {status_of(kpi, quoted(kpi.name))})"
        for kpi in able
    )
    return windows.selectExpr("window_start", "window_end", f"inline(array({cells}))")


def consecutive_alerts(status: DataFrame) -> DataFrame:
    """Breaches whose KPI was also breached in the window that ends where this one starts.

    A window without events breaks the run. Windows are joined on KPI and time, so neither side has
    a hot key. For a stream, ``status`` is that of the latest version of each window
    (``runs.run_update``), and late rows that change a window change its alerts.
    """
    breached = status.where("status = 'alert'")
    ended = breached.select(F.col("kpi").alias("_kpi"), F.col("window_end").alias("_end"))
    follows = (F.col("kpi") == F.col("_kpi")) & (F.col("window_start") == F.col("_end"))
    return breached.join(ended, follows, "left_semi").select("kpi", "window_start", "value")
