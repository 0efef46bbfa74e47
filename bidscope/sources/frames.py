"""Tables that are DataFrames already."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def frame(datasets: Mapping[str, DataFrame], table: str) -> DataFrame:
    if table not in datasets:
        raise KeyError(f"{table} is not among the given tables: {', '.join(sorted(datasets))}")
    return datasets[table]
