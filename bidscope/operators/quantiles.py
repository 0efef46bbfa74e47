"""Exact quantiles that never gather a group in one task.

The built-in exact ``percentile`` keeps the distinct values of a group in the memory of one task,
which a group with a third of all rows does not fit. Here a group is narrowed down by histograms
instead: every pass counts the values per bucket (partial sums, so little is shuffled), finds the
bucket that holds the wanted rank and looks only at that bucket next. A bucket that is small
enough is ranked row by row. The result is the linearly interpolated quantile, as ``percentile``
and ``percentile_cont`` define it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from bidscope.functions.columns import quoted
from bidscope.session import stage_table

BUCKETS_PER_E_FOLD = 16
SUB_BUCKETS = 4096
# Decides the plan only: a fuller bucket is narrowed down by another pass, with the same result.
RANKED_ROWS = 2_000_000

# A bucket number that never falls as the value rises, for either sign and any magnitude.
_LOG_BUCKET = (
    f"CASE WHEN _value < 0 THEN -floor(ln(1 - _value * 1e4) * {BUCKETS_PER_E_FOLD}) "
    f"ELSE floor(ln(1 + _value * 1e4) * {BUCKETS_PER_E_FOLD}) END"
)
# Equal steps between two distinct bounds.
_EVEN_BUCKET = f"least(floor((_value - _low) / (_high - _low) * {SUB_BUCKETS}), {SUB_BUCKETS - 1})"


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    keep_null_keys: bool = False,
    ranked_rows: int = RANKED_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """One row per key with one exact quantile of ``value`` per entry of ``probabilities``.

    With no keys the result is the single row of the whole frame. Null values are left out. A
    bucket of up to ``ranked_rows`` rows is ranked directly, a larger one is narrowed further.
    ``counted`` is the first histogram where the caller has it already, from ``count_buckets``.
    """
    groups = [quoted(key) for key in keys] or ["_all"]
    rows = df.selectExpr(*(groups if keys else ["0 AS _all"]), f"CAST({quoted(value)} AS DOUBLE) AS _value")
    rows = rows.where("_value IS NOT NULL")
    if keys and not keep_null_keys:
        rows = rows.dropna(subset=list(keys))

    targets, largest = _stage(_first_targets(rows, groups, probabilities, counted))
    while largest is not None and largest > ranked_rows:
        targets, largest = _stage(_narrow(rows, groups, targets, ranked_rows))
    if largest is None:
        found = targets.withColumnRenamed("_low", "_found")
    else:
        found = _rank(rows, groups, targets)

    def read(name: str, upper: bool, column: str = "_found") -> str:
        return f"max(CASE WHEN _name = '{name}' AND _upper = {str(upper).lower()} THEN {column} END)"

    result = found.groupBy(*[F.col(g) for g in groups]).agg(
        *[
            F.expr(
                f"{read(name, False)} + ({read(name, True)} - {read(name, False)}) "
                f"* {read(name, False, '_fraction')} AS {quoted(name)}"
            )
            for name in probabilities
        ]
    )
    return result if keys else result.drop("_all")


def count_buckets(df: DataFrame, keys: Sequence[str], value: str, others: Sequence[Column] = ()) -> DataFrame:
    """Rows, least and greatest ``value`` per key and bucket, with ``others`` aggregated in the same pass.

    Rows without a value have the bucket null.
    """
    groups = [quoted(key) for key in keys]
    rows = df.withColumn("_value", F.col(value).cast("double"))
    return _counted(rows, groups, _LOG_BUCKET, "0 * count(*)", others)


def _stage(targets: DataFrame) -> tuple[DataFrame, int | None]:
    """Write the targets down, and learn how many rows the largest unresolved bucket has."""
    seen = Observation()
    largest = F.expr("max(CASE WHEN _low < _high THEN _n END) AS n")
    staged = stage_table(targets.observe(seen, largest), "quantiles")
    return staged, seen.get["n"]


def _histogram(rows: DataFrame, groups: list[str], bucket: str, base: str) -> DataFrame:
    """Rows, least and greatest value per bucket, and the rows of the key in front of the bucket.

    ``base`` is an aggregate: the rows of the key in front of the first bucket.
    """
    return _with_ahead(_counted(rows, groups, bucket, base), groups)


def _counted(rows: DataFrame, groups: list[str], bucket: str, base: str, others: Sequence[Column] = ()) -> DataFrame:
    return (
        rows.selectExpr("*", f"{bucket} AS _bucket")
        .groupBy(*[F.col(g) for g in groups], "_bucket")
        .agg(
            F.expr("count(*) AS _n"),
            F.expr("min(_value) AS _min"),
            F.expr("max(_value) AS _max"),
            F.expr(f"{base} AS _base"),
            *others,
        )
    )


def _with_ahead(counted: DataFrame, groups: list[str]) -> DataFrame:
    ordered = f"PARTITION BY {', '.join(groups)} ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return counted.selectExpr("*", f"_base + coalesce(sum(_n) OVER ({ordered}), 0) AS _ahead")


def _first_targets(
    rows: DataFrame, groups: list[str], probabilities: Mapping[str, float], counted: DataFrame | None = None
) -> DataFrame:
    """Every wanted rank with the bucket that holds it."""
    wanted = ", ".join(
        f"named_struct('_name', '{name}', '_p', {float(p)!r}D, '_upper', {upper})"
        for name, p in probabilities.items()
        for upper in ("false", "true")
    )
    total = f"sum(_n) OVER (PARTITION BY {', '.join(groups)}) AS _total"
    # A bucket is of use if it holds one of the ranks next to a wanted position.
    useful = " OR ".join(
        f"({p!r}D * (_total - 1) < _ahead + _n AND {p!r}D * (_total - 1) >= _ahead - 1)"
        for p in {float(p) for p in probabilities.values()}
    )
    kept = [*groups, "_ahead", "_n", "_min AS _low", "_max AS _high"]
    counted = _counted(rows, groups, _LOG_BUCKET, "0 * count(*)") if counted is None else counted
    return (
        _with_ahead(counted.where("_bucket IS NOT NULL"), groups)
        .selectExpr("*", total)
        .where(useful)
        .selectExpr(*kept, "_total", f"inline(array({wanted}))")
        .selectExpr("*", "floor(_p * (_total - 1)) AS _floor")
        .selectExpr(
            *[column.split(" AS ")[-1] for column in kept],
            "_name",
            "_upper",
            "_p * (_total - 1) - _floor AS _fraction",
            "CASE WHEN _upper THEN least(_floor + 1, _total - 1) ELSE _floor END AS _rank",
        )
        .where("_rank >= _ahead AND _rank < _ahead + _n")
    )


def _same(left: str, right: str, columns: Sequence[str]) -> str:
    return " AND ".join(f"{left}.{column} <=> {right}.{column}" for column in columns)


def _rows_within(rows: DataFrame, groups: list[str], targets: DataFrame) -> DataFrame:
    """The rows inside the target intervals of their key; an interval set this small is broadcast."""
    intervals = targets.selectExpr(*groups, "_low", "_high", "_ahead").distinct()
    inside = f"{_same('r', 'i', groups)} AND r._value BETWEEN i._low AND i._high"
    return (
        rows.alias("r")
        .join(intervals.alias("i"), F.expr(inside))
        .selectExpr(*[f"i.{g}" for g in groups], "i._low", "i._high", "i._ahead", "r._value")
    )


def _meet(targets: DataFrame, groups: list[str], buckets: DataFrame) -> DataFrame:
    """Join targets with the buckets of their interval that hold their rank."""
    holds = (
        f"{_same('t', 'b', groups)} AND t._low = b._low AND t._high = b._high "
        "AND t._rank >= b._ahead AND t._rank < b._ahead + b._n"
    )
    return targets.alias("t").join(buckets.alias("b"), F.expr(holds))


def _narrow(rows: DataFrame, groups: list[str], targets: DataFrame, ranked_rows: int) -> DataFrame:
    """Replace every too large bucket by the part of it that holds the wanted rank."""
    large = f"_n > {ranked_rows} AND _low < _high"
    open_targets = targets.where(large)
    inside = _rows_within(rows, groups, open_targets)
    buckets = _histogram(inside, [*groups, "_low", "_high"], _EVEN_BUCKET, "min(_ahead)")
    narrowed = _meet(open_targets, groups, buckets).selectExpr(
        *[f"t.{c}" for c in [*groups, "_name", "_upper", "_fraction", "_rank"]],
        "b._ahead",
        "b._n",
        "b._min AS _low",
        "b._max AS _high",
    )
    return targets.where(f"NOT ({large})").unionByName(narrowed)


def _rank(rows: DataFrame, groups: list[str], targets: DataFrame) -> DataFrame:
    """Read the wanted values off the distinct values of the remaining, bounded buckets."""
    open_targets = targets.where("_low < _high")
    interval = [*groups, "_low", "_high"]
    counted = (
        _rows_within(rows, groups, open_targets)
        .groupBy(*[F.col(c) for c in interval], "_ahead", "_value")
        .agg(F.expr("count(*) AS _n"))
    )
    ordered = f"PARTITION BY {', '.join(interval)} ORDER BY _value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    ranked = counted.selectExpr(
        *interval, "_value", "_n", f"_ahead + coalesce(sum(_n) OVER ({ordered}), 0) AS _ahead"
    )
    kept = [*groups, "_name", "_upper", "_fraction"]
    read_off = _meet(open_targets, groups, ranked).selectExpr(*[f"t.{c}" for c in kept], "b._value AS _found")
    known = targets.where("_low = _high").selectExpr(*kept, "_low AS _found")
    return known.unionByName(read_off)
