"""Alerts on two breached windows in a row, raised and withdrawn while the stream runs.

Two queries, as Spark has no keyed state after an aggregation: the first writes each trigger's versions of the windows'
statuses, the second keeps them in state and writes what changes about the alerts. The state is keyed by KPI and block of
time, so a KPI is spread over many tasks; the last window of a block is handed to the next block as well, where the first
window needs it. Rows may come in any order and windows may change: an alert whose window recovers is withdrawn.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from bidscope.functions.kpis import KPI, REGISTRY
from bidscope.streaming.kpi_windows import window_status

#: Microseconds of a block: a day has 288 windows of five minutes.
BLOCK = 86_400_000_000

_STATUS = "kpi string, start long, length long, breached boolean, value double"
_CHANGES = "kpi string, start long, value double, raised boolean, revision long"
_STATE = (
    "starts array<long>, versions array<long>, breached array<boolean>, values array<double>, "
    "raised array<boolean>, revisions array<long>"
)


def write_statuses(windows: DataFrame, location: str, kpis: Sequence[KPI] = REGISTRY) -> None:
    """Run the stream of windows over all there is, from where the last run ended.

    Each trigger writes the statuses it changed below its own number, so that a trigger that is repeated after a failure
    writes the same again.
    """

    def write(batch: DataFrame, number: int) -> None:
        statuses = window_status(batch, kpis).select(
            "kpi",
            F.unix_micros(F.col("window_start").cast("timestamp")).alias("start"),
            (F.unix_micros(F.col("window_end").cast("timestamp")) - F.unix_micros(F.col("window_start").cast("timestamp"))).alias("length"),
            (F.col("status") == "alert").alias("breached"),
            "value",
        )
        statuses.write.mode("overwrite").parquet(f"{location}/statuses/version={number}")

    _run(windows, write, f"{location}/statuses-state")


def _run(stream: DataFrame, write, checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, timed: bool) -> Iterator[pd.DataFrame]:
    """Update a block's windows and report the alerts that this changes; ``timed`` blocks end with the watermark."""
    if state.hasTimedOut:
        state.remove()
        return
    kpi, block = key[0], int(key[1])
    # start: [version, breached, value, raised, revision]
    known = {s: list(rest) for s, *rest in zip(*state.get)} if state.exists else {}
    touched, changed, length = set(), set(), 0
    for batch in batches:
        for start, step, breached, value, version in batch[["start", "length", "breached", "value", "version"]].itertuples(
            index=False, name=None
        ):
            length = int(step)
            window = known.setdefault(int(start), [-1, False, None, False, 0])
            if version >= window[0]:
                news = [int(version), bool(breached), None if pd.isna(value) else float(value)]
                changed |= {int(start)} if news[2] != window[2] else set()
                window[:3] = news
                touched |= {int(start), int(start) + length}
    ends = (block + 1) * BLOCK // 1000
    watermark = state.getCurrentWatermarkMs() if timed else 0
    if timed and ends + length // 1000 <= watermark and not state.exists:
        return  # a block that was let go
    out = []
    for start in sorted(touched):
        if start not in known or start // BLOCK != block:
            continue
        window, before = known[start], known.get(start - length)
        alert = window[1] and before is not None and before[1]
        if alert != window[3] or (alert and start in changed):
            window[4] += 1
            out.append((kpi, start, window[2], alert, window[4]))
        window[3] = alert
    columns = list(zip(*([s, *w[:5]] for s, w in sorted(known.items()))))
    state.update(tuple(list(c) for c in columns))
    if timed:
        state.setTimeoutTimestamp(max(ends + length // 1000, watermark + 1))
    yield pd.DataFrame(out, columns=["kpi", "start", "value", "raised", "revision"])


def alert_changes(statuses: DataFrame, watermark: str | None = None) -> DataFrame:
    """A row for each alert that a trigger raises, changes or withdraws, of a stream of statuses and their versions.

    With a watermark the state of a block ends with it, and statuses for a block that has ended are ignored.
    """
    rows = statuses.withColumn("event_time", F.timestamp_micros("start"))
    if watermark:
        rows = rows.withWatermark("event_time", watermark)
    blocks = F.array_distinct(F.array(F.expr(f"start div {BLOCK}"), F.expr(f"(start + length) div {BLOCK}")))
    timeout = GroupStateTimeout.EventTimeTimeout if watermark else GroupStateTimeout.NoTimeout
    return (
        rows.withColumn("block", F.explode(blocks))
        .groupBy("kpi", "block")
        .applyInPandasWithState(lambda k, b, s: _follow(k, b, s, bool(watermark)), _CHANGES, _STATE, "update", timeout)
    )


def follow_alerts(spark: SparkSession, location: str, watermark: str | None = None, files_per_trigger: int | None = None) -> None:
    """Run the stream of alerts over the statuses that were written since its last run."""
    reader = spark.readStream.schema(f"{_STATUS}, version long")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{location}/alerts/batch={number}")

    _run(alert_changes(reader.parquet(f"{location}/statuses"), watermark), write, f"{location}/alerts-state")


def open_alerts(spark: SparkSession, location: str) -> DataFrame:
    """``kpi, window_start, value`` of the alerts that are raised now."""
    try:
        changes = spark.read.schema(f"{_CHANGES}, batch long").parquet(f"{location}/alerts")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # Nothing was written yet.
        changes = spark.createDataFrame([], _CHANGES)
    latest = changes.groupBy("kpi", "start").agg(F.max_by(F.struct("value", "raised"), "revision").alias("last"))
    return latest.where("last.raised").select(
        "kpi", F.timestamp_micros("start").cast("timestamp_ntz").alias("window_start"), F.col("last.value").alias("value")
    )


def run_live_alerts(
    windows: DataFrame, location: str, kpis: Sequence[KPI] = REGISTRY, watermark: str | None = None
) -> DataFrame:
    """Bring statuses and alerts up to the stream's present end; the alerts that are then raised.

    Called again with the same ``location`` it goes on where it ended.
    """
    write_statuses(windows, location, kpis)
    follow_alerts(windows.sparkSession, location, watermark)
    return open_alerts(windows.sparkSession, location)
