"""Statistical anomaly detection on series and on single bids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.functions.numbers import ratio, rounded
from bidscope.operators.quantiles import grouped_quantiles
from bidscope.operators.ranking import with_position
from bidscope.session import one_row, stage_table

Z_THRESHOLD = 2.5
IQR_MULTIPLIER = 2.0
BID_Z_THRESHOLD = 3.0
MIN_STD = 1e-9
ROLLING_ROWS = 1000
CHUNK_ROWS = 20_000


def _attach(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Put statistics next to the rows of their key, or next to every row where there is no key."""
    if keys:
        return df.join(stage_table(stats, "statistics"), keys, "left")
    row = one_row(stats)
    return df.withColumns({name: row.getField(name) for name in stats.columns})


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def detect(
    df: DataFrame,
    value: str,
    method: str = "zscore",
    keys: Sequence[str] = (),
    z_threshold: float = Z_THRESHOLD,
    iqr_multiplier: float = IQR_MULTIPLIER,
    flag: str = "is_anomaly",
) -> DataFrame:
    """Mark the values far from the mean, or far outside the quartiles, of all rows or of their key."""
    keys = list(keys)
    x = F.col(value)
    if method == "zscore":
        stats = df.groupBy(*keys).agg(F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_std"))
        marked = F.abs(ratio(x - F.col("_mean"), F.col("_std"))) > z_threshold
        return _attach(df, stats, keys).withColumn(flag, _flag(marked)).drop("_mean", "_std")
    if method == "iqr":
        stats = grouped_quantiles(df, keys, value, {"_q1": 0.25, "_q3": 0.75})
        reach = (F.col("_q3") - F.col("_q1")) * iqr_multiplier
        marked = (x < F.col("_q1") - reach) | (x > F.col("_q3") + reach)
        return _attach(df, stats, keys).withColumn(flag, _flag(marked)).drop("_q1", "_q3")
    raise ValueError(f"A method is 'zscore' or 'iqr', not {method!r}")


def scan_kpis(series: DataFrame, value: str = "value", method: str = "zscore") -> DataFrame:
    """Scan ``timestamp``, ``kpi``, ``value`` rows per KPI.

    Missing values stand in as the median of their KPI for the flag; the score is taken over the
    values that are there.
    """
    if method not in ("zscore", "iqr"):
        raise ValueError(f"A method is 'zscore' or 'iqr', not {method!r}")
    # Several statistics read the series, so it is computed once.
    series = stage_table(series, "series")
    medians = grouped_quantiles(series, ["kpi"], value, {"_median": 0.5})
    moments = series.groupBy("kpi").agg(F.avg(value).alias("_mean0"), F.stddev_samp(value).alias("_std0"))
    known = _attach(series, moments.join(medians, "kpi", "left"), ["kpi"]).withColumn(
        "_filled", F.coalesce(F.col(value), F.col("_median"))
    )
    score = F.round(F.abs(ratio(F.col(value) - F.col("_mean0"), F.col("_std0"))), 3)
    return (
        detect(known, "_filled", method, ["kpi"])
        .withColumn("anomaly_score", score)
        .drop("_filled", "_median", "_mean0", "_std0")
    )


def bid_baselines(auctions: DataFrame, quantiles: bool = True) -> DataFrame:
    """Mean, standard deviation and 99th percentile of the bids of each placement."""
    rows = auctions.dropna(subset=["placement_type"])
    moments = rows.groupBy("placement_type").agg(
        F.avg("winning_bid_usd").alias("mean"), F.stddev_samp("winning_bid_usd").alias("std")
    )
    if not quantiles:
        return moments
    top = grouped_quantiles(rows, ["placement_type"], "winning_bid_usd", {"p99": 0.99})
    return moments.join(top, "placement_type", "left")


def score_bids(auctions: DataFrame, baselines: DataFrame, z_threshold: float = BID_Z_THRESHOLD) -> DataFrame:
    """Score bids, batch or stream, against fitted baselines.

    A placement without a baseline has no score and no flag. The flag uses the score before
    rounding. Pass staged baselines (``session.stage_table``), so that a small set is broadcast.
    """
    fitted = baselines.select("placement_type", F.col("mean").alias("_mean"), F.col("std").alias("_std"))
    floor = F.when(F.col("_std").isNotNull(), F.greatest(F.col("_std"), F.lit(MIN_STD)))
    return (
        auctions.join(fitted, "placement_type", "left")
        .withColumn("_z", (F.col("winning_bid_usd") - F.col("_mean")) / floor)
        .withColumn("bid_z_score", F.expr(rounded("_z", 3)))
        .withColumn("bid_is_anomaly", _flag(F.abs("_z") > z_threshold))
        .drop("_mean", "_std", "_z")
    )


def top_bid_anomalies(scored: DataFrame, k: int = 15) -> DataFrame:
    return (
        scored.where("bid_is_anomaly")
        .select(
            "auction_id", "placement_type", "device_type", "winning_bid_usd", "bid_floor_usd", "bid_z_score"
        )
        .orderBy(F.desc("bid_z_score"), "auction_id")
        .limit(k)
    )


def anomaly_share(scored: DataFrame, flag: str = "bid_is_anomaly") -> DataFrame:
    marked = F.coalesce(F.sum(F.col(flag).cast("int")), F.lit(0))
    return scored.agg(
        marked.alias("n_anomalies"),
        F.count(F.lit(1)).alias("n_auctions"),
        F.round(ratio(marked, F.count(F.lit(1))), 6).alias("anomaly_share"),
    )


def score_histogram(scored: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Row counts in equal steps between the least and the greatest score; empty bins included."""
    x = F.col(column)
    rows = scored.where(x.isNotNull()).select(x.cast("double").alias("_x"))
    span = one_row(rows.agg(F.min("_x").alias("low"), F.max("_x").alias("high")))
    low, width = span.getField("low"), (span.getField("high") - span.getField("low")) / bins
    step = F.coalesce(F.floor(ratio(F.col("_x") - F.col("_low"), F.col("_width"))), F.lit(0))
    counts = (
        rows.withColumns({"_low": low, "_width": width})
        .groupBy((F.least(step, F.lit(bins - 1)) + 1).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    spine = scored.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (
        spine.join(counts, "bin", "left")
        .fillna(0, subset=["n_rows"])
        .withColumns({"_low": low, "_width": width})
        .select(
            "bin",
            F.round(F.col("_low") + (F.col("bin") - 1) * F.col("_width"), 6).alias("from_score"),
            F.round(F.col("_low") + F.col("bin") * F.col("_width"), 6).alias("to_score"),
            "n_rows",
        )
        .orderBy("bin")
    )


def rolling_baseline(
    auctions: DataFrame,
    rows_back: int = ROLLING_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    z_threshold: float = BID_Z_THRESHOLD,
) -> DataFrame:
    """Mean and deviation of the bids before each one, the limit they set, and whether the bid is beyond it.

    A window per placement would put a whole placement in one task. The rows are numbered in the
    order of placement and time and cut into chunks; the last ``rows_back`` rows of a chunk are
    also given to the next one, so every row finds all its predecessors in its own chunk. Within
    a chunk a row costs the same whatever its look-back: the sums over the rows before it are
    differences of running totals, taken around the chunk's mean to keep their digits.
    """
    return rolled(in_bid_order(auctions), rows_back, chunk_rows, z_threshold)


def in_bid_order(auctions: DataFrame, others: Sequence[str] = ()) -> DataFrame:
    """Bids with their ``_position`` in the order of placement, time and id; written down once."""
    return with_position(
        auctions.dropna(subset=["placement_type"]).select(
            "auction_id", "placement_type", "timestamp", "winning_bid_usd", *others
        ),
        [F.col("placement_type"), F.col("timestamp"), F.col("auction_id")],
        "_position",
    )


def rolled(
    placed: DataFrame,
    rows_back: int = ROLLING_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    z_threshold: float = BID_Z_THRESHOLD,
    others: Sequence[str] = (),
) -> DataFrame:
    """``rolling_baseline`` of bids from ``in_bid_order``; ``others`` are columns to keep."""
    if rows_back > chunk_rows:
        raise ValueError("A chunk must be at least as long as the rows looked back.")
    chunks = placed.selectExpr("*", f"_position div {chunk_rows} AS _home").selectExpr(
        "*",
        f"explode(CASE WHEN _position % {chunk_rows} >= {chunk_rows - rows_back} "
        "THEN array(_home, _home + 1) ELSE array(_home) END) AS _chunk",
    )
    group = "PARTITION BY _chunk, placement_type"
    ordered = f"({group} ORDER BY _position)"
    so_far = f"OVER ({group} ORDER BY _position ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def before(total: str) -> str:
        """What a running total grew by over the rows looked back on."""
        return f"lag({total}, 1, 0) OVER {ordered} - lag({total}, {rows_back + 1}, 0) OVER {ordered}"

    centered = chunks.selectExpr(
        "*",
        f"avg(winning_bid_usd) OVER ({group}) AS _center",
        f"CAST(NOT winning_bid_usd <=> lag(winning_bid_usd) OVER {ordered} AS INT) AS _change",
    ).selectExpr("*", "winning_bid_usd - _center AS _x")
    totals = centered.selectExpr(
        "*",
        f"count(_x) {so_far} AS _n",
        f"CAST(coalesce(sum(_x) {so_far}, 0) AS DOUBLE) AS _s",
        f"CAST(coalesce(sum(_x * _x) {so_far}, 0) AS DOUBLE) AS _ss",
        f"sum(_change) {so_far} AS _changes",
    )
    sums = totals.selectExpr(
        "*",
        f"{before('_n')} AS _rows",
        f"{before('_s')} AS _sum",
        f"{before('_ss')} AS _squares",
        f"lag(_changes, 1) OVER {ordered} - coalesce(lag(_changes, {rows_back}) OVER {ordered}, "
        f"first(_changes) {so_far}) AS _varied",
    )
    variance = "(_squares - _sum * _sum / _rows) / nullif(_rows - 1, 0)"
    spread = f"CASE WHEN _rows < 2 THEN NULL WHEN _varied = 0 THEN 0D ELSE sqrt(greatest({variance}, 0D)) END"
    return (
        sums.where("_chunk = _home")
        .selectExpr(
            "auction_id",
            "placement_type",
            "`timestamp`",
            "winning_bid_usd",
            *others,
            "_center + _sum / nullif(_rows, 0) AS rolling_mean",
            f"{spread} AS rolling_std",
        )
        .selectExpr(
            "*",
            "(winning_bid_usd - rolling_mean) / nullif(rolling_std, 0) AS rolling_z",
            f"rolling_mean + {z_threshold!r}D * rolling_std AS rolling_limit",
        )
        .withColumn("is_rolling_anomaly", _flag(F.abs("rolling_z") > z_threshold))
    )
