import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bidscope.operators.ranking import ranking_metrics, running_totals, tile_totals, with_position, with_tile


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    # A third of the rows share one value.
    rows = [(f"id{i:05d}", 0.5 if i % 3 == 0 else round(rng.random(), 2), rng.randint(0, 9)) for i in range(3001)]
    return spark.createDataFrame(rows, "id string, x double, n int").persist()



def order():
    return [F.desc("x"), F.asc("id")]


def test_position_is_row_number(frame):
    window = Window.orderBy(*order())
    both = with_position(frame, order()).join(
        frame.select("id", (F.row_number().over(window) - 1).alias("want")), "id"
    )
    assert both.where("position <> want").count() == 0 and both.count() == 3001


@pytest.mark.parametrize("tiles", [1, 4, 10, 3001, 5000])
def test_tile_is_ntile(frame, tiles):
    window = Window.orderBy(*order())
    both = with_tile(frame, tiles, order()).join(frame.select("id", F.ntile(tiles).over(window).alias("want")), "id")
    assert both.where("tile <> want").count() == 0 and both.count() == 3001


@pytest.mark.parametrize("tiles", [1, 3, 10, 100])
def test_tile_totals_are_those_of_ntile(frame, tiles):
    window = Window.orderBy(*order())
    want = frame.withColumn("tile", F.ntile(tiles).over(window)).groupBy("tile").agg(F.count(F.lit(1)), F.sum("n"))
    assert sorted(tile_totals(frame, tiles, "x", "id", ["n"]).collect()) == sorted(want.collect())


def test_running_totals(frame):
    window = Window.orderBy(*order()).rowsBetween(Window.unboundedPreceding, 0)
    both = running_totals(frame, order(), {"total": F.col("n")}).join(
        frame.select("id", F.sum("n").over(window).alias("want")), "id"
    )
    assert both.where("total <> want").count() == 0 and both.count() == 3001


def test_metrics_against_pairs(spark):
    rng = random.Random(5)
    rows = [(round(rng.random(), 1), int(rng.random() < 0.4)) for _ in range(300)]
    hits, misses = [s for s, y in rows if y], [s for s, y in rows if not y]
    won = sum((h > m) + 0.5 * (h == m) for h in hits for m in misses)
    precision, above = 0.0, 0
    for score in sorted({s for s, _ in rows}, reverse=True):
        here = sum(1 for h in hits if h == score)
        above += here
        precision += here / len(hits) * above / sum(1 for s, _ in rows if s >= score)
    result = ranking_metrics(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
    assert result["roc_auc"] == pytest.approx(won / len(hits) / len(misses), abs=1e-4)
    assert result["avg_precision"] == pytest.approx(precision, abs=1e-4)
    assert result["test_samples"] == 300


def test_one_class_has_no_auc(spark):
    result = ranking_metrics(spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int"), "s", "y").first()
    assert result["roc_auc"] is None and result["positive_rate"] == 1.0
