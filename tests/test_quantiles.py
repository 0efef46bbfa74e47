import random

import pytest
from pyspark.sql import functions as F

from bidscope.operators.quantiles import grouped_quantiles

PROBABILITIES = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def values():
    """A key with a third of all rows, ties, both signs, nulls, one-row and constant groups."""
    rng = random.Random(7)
    out = [("hot", rng.choice([rng.lognormvariate(0, 2), -rng.random(), 0.25])) for _ in range(1500)]
    out += [(f"k{i % 40}", rng.uniform(-1e6, 1e6)) for i in range(2500)]
    out += [("one", 3.5), ("constant", 7.0), ("constant", 7.0), ("empty", None), ("hot", None)]
    out += [(None, 1.0), (None, 5.0)]
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(values(), "k string, x double").persist()


def expected(frame, keys):
    exact = [F.percentile("x", p).alias(n) for n, p in PROBABILITIES.items()]
    grouped = frame.where("x IS NOT NULL").groupBy(*keys).agg(*exact)
    return {tuple(r[k] for k in keys): [r[n] for n in PROBABILITIES] for r in grouped.collect()}


def got(df, keys):
    return {tuple(r[k] for k in keys): [r[n] for n in PROBABILITIES] for r in df.collect()}


@pytest.mark.parametrize("ranked_rows", [1_000_000, 20, 1])
def test_equals_percentile_however_far_it_narrows(frame, ranked_rows):
    result = got(
        grouped_quantiles(frame, ["k"], "x", PROBABILITIES, keep_null_keys=True, ranked_rows=ranked_rows), ["k"]
    )
    want = expected(frame, ["k"])
    assert result.keys() == want.keys()
    for key, line in want.items():
        assert result[key] == pytest.approx(line, rel=1e-12, abs=1e-12), key


def test_null_keys_are_dropped_by_default(frame):
    keys = {r["k"] for r in grouped_quantiles(frame, ["k"], "x", {"m": 0.5}).collect()}
    assert None not in keys and "empty" not in keys


def test_whole_frame(frame):
    result = grouped_quantiles(frame, [], "x", PROBABILITIES, ranked_rows=50)
    assert result.columns == list(PROBABILITIES)
    assert list(result.first()) == pytest.approx(expected(frame, [])[()], rel=1e-12)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k string, x double")
    assert grouped_quantiles(empty, ["k"], "x", {"m": 0.5}).collect() == []
    assert grouped_quantiles(empty, [], "x", {"m": 0.5}).columns == ["m"]


def test_integers(spark):
    frame = spark.range(1, 102).withColumnRenamed("id", "n")
    assert grouped_quantiles(frame, [], "n", {"a": 0.25, "b": 0.5}).first().asDict() == {"a": 26.0, "b": 51.0}
