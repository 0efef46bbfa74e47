"""Calendar bins and the spine that keeps empty bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.functions.columns import quoted

STEPS = {"h": "interval 1 hour", "D": "interval 1 day", "W": "interval 7 days"}


def time_bin(timestamp: Column, freq: str) -> Column:
    """Start of the hour or day; a week runs Monday to Sunday and is named by its Sunday."""
    if freq == "h":
        return F.timestamp_add("HOUR", F.hour(timestamp), F.to_date(timestamp).cast("timestamp_ntz"))
    if freq == "D":
        return F.to_date(timestamp).cast("timestamp_ntz")
    if freq == "W":
        return F.date_add(F.trunc(F.to_date(timestamp), "week"), 6).cast("timestamp_ntz")
    raise ValueError(f"Unknown frequency: {freq}. Use one of {sorted(STEPS)}.")


def fill_empty_bins(
    binned: DataFrame,
    bin_col: str,
    freq: str,
    keys: list[str] | None = None,
    zero: list[str] | None = None,
) -> DataFrame:
    """Add the bins without rows between the first and last bin (of each key).

    ``binned`` is an aggregate with one row per bin, as long as the calendar is whatever the number
    of events. Each bin brings the empty bins that follow it, so nothing is joined and the events
    are read once. Counts named in ``zero`` become 0.
    """
    group = ", ".join(quoted(key) for key in keys or []) or "0"
    step, here = STEPS[freq], quoted(bin_col)
    following = f"lead({here}) OVER (PARTITION BY {group} ORDER BY {here})"
    spread = (
        binned.where(f"{here} IS NOT NULL")
        .selectExpr("*", f"coalesce({following} - {step}, {here}) AS _last")
        .selectExpr("*", f"explode(sequence({here}, _last, {step})) AS _each")
    )
    values = [name for name in binned.columns if name not in {bin_col, *(keys or [])}]
    return spread.selectExpr(
        *[quoted(key) for key in keys or []],
        f"_each AS {here}",
        *[
            f"CASE WHEN _each = {here} THEN {quoted(name)}{' ELSE 0' if name in (zero or []) else ''} END "
            f"AS {quoted(name)}"
            for name in values
        ],
    )
