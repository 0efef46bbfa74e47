"""Aggregates of one's own, written in Python."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import pandas as pd


@dataclass(frozen=True)
class PythonMeasure:
    """An aggregate as four functions over a state that can be pickled.

    ``update`` folds rows, a pandas frame of the inputs, into a state, ``merge`` joins two states of disjoint rows, and
    ``finish`` turns a state into the value or None. The result must not depend on how rows are dealt out; states may be
    changed in place.
    """

    start: Callable[[], Any]
    update: Callable[[Any, pd.DataFrame], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], float | None]
