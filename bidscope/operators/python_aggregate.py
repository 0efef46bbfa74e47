"""Aggregates written in Python, with states that merge.

The built-in grouped pandas functions gather a group in one task. Here the tasks that read the rows fold each Arrow
batch into one small state per group, and only states are shuffled. States of a group merge along a tree: a task
merges at most ``FAN`` of them, so neither a hot group nor a great number of tasks makes one task large.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.measures import PythonMeasure
from bidscope.session import stage_table

#: States of one group that a task merges.
FAN = 64
#: Groups whose states a task holds before it hands them on.
HELD_GROUPS = 20_000


def _folded(
    batches: Iterator[pd.DataFrame], keys: list[str], columns: list[str], measures: list[PythonMeasure]
) -> Iterator[pd.DataFrame]:
    """One row per group and task: the pickled states of all measures."""
    held: dict[tuple, list] = {}
    for batch in batches:
        for key, rows in batch.groupby(keys, sort=False, dropna=False):
            states = held.get(key)
            if states is None:
                held[key] = states = [m.start() for m in measures]
            inputs = rows[columns]
            for i, measure in enumerate(measures):
                states[i] = measure.update(states[i], inputs)
        if len(held) > HELD_GROUPS:
            yield _framed(held, keys)
            held = {}
    if held:
        yield _framed(held, keys)


def _framed(held: dict[tuple, list], keys: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame.from_records(list(held), columns=keys)
    return frame.assign(_state=[pickle.dumps(states) for states in held.values()])


def _merged(
    batches: Iterator[pd.DataFrame], keys: list[str], measures: list[PythonMeasure], last: bool
) -> Iterator[pd.DataFrame]:
    """States that come sorted by group and node; one merged row of each group is open at a time."""
    group = [*keys, "_node"]
    now, states = None, None

    def closed(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame.from_records([key for key, _ in rows], columns=group)
        if not last:
            return frame.assign(_state=[pickle.dumps(s) for _, s in rows])
        values = [[None if (v := m.finish(s)) is None else float(v) for m, s in zip(measures, ss)] for _, ss in rows]
        found = pd.DataFrame(values, columns=[f"_v{i}" for i in range(len(measures))], dtype=object)
        return pd.concat([frame.drop(columns="_node"), found], axis=1)

    for batch in batches:
        out = []
        # A null of a key is not equal to itself; by its text it is.
        marks = batch[group].astype(str).apply(tuple, axis=1) if len(batch) else []
        for mark, key, state in zip(marks, batch[group].itertuples(index=False, name=None), batch["_state"]):
            loaded = pickle.loads(state)
            if now is not None and now[0] == mark:
                states = [m.merge(a, b) for m, a, b in zip(measures, states, loaded)]
            else:
                if now is not None:
                    out.append((now[1], states))
                now, states = (mark, key), loaded
        if out:
            yield closed(out)
    if now is not None:
        yield closed([(now[1], states)])


def aggregate(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[PythonMeasure, Sequence[str]]], fan: int = FAN
) -> DataFrame:
    """``keys`` and a double for each of ``measures``: its function and the columns it reads.

    A null is a key like any other. Without rows there are no groups; without keys all rows are one group.
    """
    keys = list(keys)
    names = list(measures)
    functions = [measures[name][0] for name in names]
    inputs = list(dict.fromkeys(c for name in names for c in measures[name][1]))
    rows = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *inputs)
    group = [f"_k{i}" for i in range(len(keys))]
    if not keys:
        rows, group = rows.withColumn("_k0", F.lit(0)), ["_k0"]
    key_ddl = ", ".join(f"{g} {rows.schema[g].dataType.simpleString()}" for g in group)

    states = rows.mapInPandas(lambda it: _folded(it, group, inputs, functions), f"{key_ddl}, _state binary")
    # Written down, so that no state is made twice; a state's leaf is the task that made it.
    states = stage_table(states.withColumn("_node", F.spark_partition_id().cast("long")), "aggregate_states")
    nodes = (states.agg(F.max("_node")).first()[0] or 0) + 1
    while nodes > fan:
        states = _arranged(states.withColumn("_node", F.expr(f"_node div {fan}")), group).mapInPandas(
            lambda it: _merged(it, group, functions, False), f"{key_ddl}, _node long, _state binary"
        )
        nodes = -(-nodes // fan)
    values = ", ".join(f"_v{i} double" for i in range(len(names)))
    done = _arranged(states.withColumn("_node", F.lit(0).cast("long")), group).mapInPandas(
        lambda it: _merged(it, group, functions, True), f"{key_ddl}, {values}"
    )
    return done.select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], *[F.col(f"_v{i}").alias(n) for i, n in enumerate(names)]
    )


def _arranged(states: DataFrame, group: list[str]) -> DataFrame:
    """States of a group and node in one task, one after the other."""
    return states.select(*group, "_node", "_state").repartition(*group, "_node").sortWithinPartitions(*group, "_node")
