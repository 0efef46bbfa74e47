"""Columns given as SQL expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def quoted(name: str) -> str:
    return f"`{name}`"


def put(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Add or replace columns, each an SQL expression over the columns of ``df``.

    One projection, however many columns there are.
    """
    kept = [quoted(name) for name in df.columns if name not in expressions]
    return df.selectExpr(*kept, *[f"{sql} AS {quoted(name)}" for name, sql in expressions.items()])


def one_of(names: list[str], index: str) -> str:
    """The SQL that picks ``names[index % len(names)]``."""
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE {index} % {len(names)} {cases} END"


def listed(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)
