"""Positions, tiles and running totals over a total order of all rows.

A window without partitions would send every row to one task. Here Spark range-partitions the
rows, each partition is sorted on its own, and the totals of the partitions in front are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.functions.columns import put
from bidscope.functions.numbers import ratio
from bidscope.session import one_row, stage_table

# monotonically_increasing_id: the partition number above 33 bits of position.
_POSITION_BITS = 33


def _pin_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """Sorted rows with their partition and place, written down so that both stay as they are."""
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    pinned = stage_table(numbered, "ordered")
    return pinned.withColumns(
        {
            "_part": F.shiftright("_id", _POSITION_BITS),
            "_place": F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    ).drop("_id")


def _in_front(parts: DataFrame, amounts: list[str]) -> DataFrame:
    """Totals of the partitions in front of each one; as many rows as there are partitions."""
    ahead = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "_part", *[F.coalesce(F.sum(name).over(ahead), F.lit(0)).alias(f"_before_{name}") for name in amounts]
    )


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """The place of each row, from 0, in an order without ties."""
    pinned = _pin_order(df, order)
    parts = _in_front(pinned.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")), ["_rows"])
    return (
        pinned.join(F.broadcast(parts), "_part")
        .withColumn(name, F.col("_before__rows") + F.col("_place"))
        .drop("_part", "_place", "_before__rows")
    )


def _tile_of(place: str, total: str, tiles: int) -> str:
    """The tile of a place: the first ``total % tiles`` tiles have one row more than the others."""
    size, extra = f"({total} div {tiles})", f"({total} % {tiles})"
    return (
        f"CAST(CASE WHEN {place} < {extra} * ({size} + 1) THEN {place} div ({size} + 1) "
        f"ELSE {extra} + ({place} - {extra} * ({size} + 1)) div nullif({size}, 0) END + 1 AS INT)"
    )


def with_tile(df: DataFrame, tiles: int, order: list[Column], name: str = "tile") -> DataFrame:
    """``ntile`` of every row over an order without ties."""
    placed = with_position(df, order, "_position")
    total = one_row(placed.agg(F.count(F.lit(1)).alias("n"))).getField("n")
    return put(placed.withColumn("_total", total), {name: _tile_of("_position", "_total", tiles)}).drop(
        "_total", "_position"
    )


def tile_totals(
    df: DataFrame, tiles: int, value: str, tie_break: str, sums: Sequence[str], name: str = "tile"
) -> DataFrame:
    """Row count and sums per ``ntile`` of the descending value, ties in the order of ``tie_break``.

    Rows are summed per distinct value first. A value whose rows all fall in one tile needs
    nothing more; only rows of the at most ``tiles - 1`` values that straddle a boundary are sorted.
    Rows without a value come last.
    """
    totals = [F.sum(column).alias(column) for column in sums]
    per_value = df.groupBy(F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"), *totals)
    ranked = stage_table(running_totals(per_value, [F.desc_nulls_last("_value")], {"_to": F.col("_n")}), "tiles")
    total = one_row(ranked.agg(F.sum("_n").alias("n"))).getField("n")
    placed = put(
        ranked.withColumn("_total", total),
        {
            "_first": _tile_of("(_to - _n)", "_total", tiles),
            "_last": _tile_of("(_to - 1)", "_total", tiles),
        },
    )
    whole = placed.where("_first = _last").select(F.col("_first").alias(name), "_n", *sums)
    split = stage_table(placed.where("_first < _last").selectExpr("_value AS _split", "_to - _n AS _before", "_total"), "split")
    rows = df.select(F.col(value).alias("_value"), tie_break, *sums).join(
        split, F.col("_value").eqNullSafe(F.col("_split"))
    )
    # Places among the sorted rows of the split values, moved to where each value begins.
    sorted_rows = with_position(rows, [F.desc_nulls_last("_value"), F.asc(tie_break)], "_position")
    starts = sorted_rows.groupBy(F.col("_value").alias("_of")).agg(F.min("_position").alias("_start"))
    starts = stage_table(starts, "tile-starts")
    tiled = put(
        sorted_rows.join(starts, F.col("_value").eqNullSafe(F.col("_of"))),
        {name: _tile_of("(_before + _position - _start)", "_total", tiles)},
    ).select(name, F.lit(1).cast("long").alias("_n"), *sums)
    return whole.unionByName(tiled).groupBy(name).agg(F.sum("_n").alias("n_rows"), *totals)


def running_totals(df: DataFrame, order: list[Column], amounts: dict[str, Column]) -> DataFrame:
    """Add the running total of each amount, the row's own included."""
    names = list(amounts)
    pinned = _pin_order(df.withColumns({f"_add_{n}": c for n, c in amounts.items()}), order)
    parts = _in_front(
        pinned.groupBy("_part").agg(*[F.sum(f"_add_{n}").alias(n) for n in names]),
        names,
    )
    up_to = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return (
        pinned.join(F.broadcast(parts), "_part")
        .withColumns({n: F.col(f"_before_{n}") + F.sum(f"_add_{n}").over(up_to) for n in names})
        .drop("_part", "_place", *[f"_add_{n}" for n in names], *[f"_before_{n}" for n in names])
    )


def ranking_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve and average precision, ties counted as one threshold."""
    per_score = df.groupBy(F.col(score).alias("_score")).agg(
        F.sum(F.col(label).cast("long")).alias("_hits"), F.count(F.lit(1)).alias("_rows")
    )
    curve = running_totals(
        per_score,
        [F.col("_score").desc()],
        {"_hits_above": F.col("_hits"), "_rows_above": F.col("_rows")},
    )
    misses = F.col("_rows") - F.col("_hits")
    better = F.col("_hits_above") - F.col("_hits") + F.col("_hits") / 2
    sums = curve.agg(
        F.sum("_hits").alias("hits"),
        F.sum("_rows").alias("rows"),
        F.sum(misses * better).alias("won"),
        F.sum(F.col("_hits") * F.col("_hits_above") / F.col("_rows_above")).alias("precision"),
    )
    return sums.select(
        F.round(ratio(F.col("won"), F.col("hits").cast("double") * (F.col("rows") - F.col("hits"))), 4).alias(
            "roc_auc"
        ),
        F.round(ratio(F.col("precision"), F.col("hits")), 4).alias("avg_precision"),
        F.col("rows").alias("test_samples"),
        F.round(ratio(F.col("hits"), F.col("rows")), 4).alias("positive_rate"),
    )
