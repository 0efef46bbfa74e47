"""Upsert of one frame into another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def merge_rows(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of ``new``, and those of ``old`` whose key ``new`` lacks; keys are unique in each."""
    return old.join(new.select(*key), list(key), "left_anti").select(old.columns).unionByName(new)
