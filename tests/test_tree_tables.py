import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from bidscope.operators import forest as forest_ops
from bidscope.operators.models import EcpmModel, FillModel
from bidscope.operators.tree_tables import CONDITION_LEVELS, NODES, boosted_nodes, ensemble_sum, with_ensemble_sum
from bidscope.session import stage_table


def _widest(one, other, name):
    both = one.select("auction_id", F.col(name).alias("a")).join(other.select("auction_id", F.col(name).alias("b")), "auction_id")
    return both.agg(F.count(F.lit(1)), F.max(F.abs(F.col("a") - F.col("b"))), F.count_if(F.expr("a IS NULL OR b IS NULL"))).first()


def _no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_fill_model_without_mllib(auctions):
    df = auctions.dropDuplicates(["auction_id"]).persist()
    model = FillModel(rounds=12).fit(df)
    nodes = stage_table(model.tree_table(), "nodes")
    assert nodes.select("tree").distinct().count() == 12
    native = model.predict_proba_natively(df, nodes)
    _no_python(native)
    assert native.columns == [*df.columns, "fill_probability"]
    n, apart, missing = _widest(model.predict_proba(df), native, "fill_probability")
    assert n == df.count() and apart < 1e-12 and missing == 0


def test_ecpm_model_without_mllib(auctions):
    df = auctions.dropDuplicates(["auction_id"]).persist()
    # Without the numbers that give the answer away, so that the trees cut by categories.
    model = EcpmModel(rounds=8, numeric=["auction_depth", "hour"]).fit(df)
    native = model.predict_natively(df)
    n, apart, missing = _widest(model.predict(df), native, "predicted_ecpm")
    assert n == df.count() and apart < 1e-9 and missing == 0
    one_hot = len(model.feature_columns()) - 2
    assert model.tree_table().where(f"feature BETWEEN 0 AND {one_hot - 1}").count() > 0


def test_unknown_categories_and_missing_columns(auctions, make_auctions):
    model = FillModel(rounds=3).fit(auctions)
    df = make_auctions([{"category": "never seen"}, {}, {"placement_type": None, "bid_floor_usd": None}]).drop("ecpm", "device_type")
    n, apart, missing = _widest(model.predict_proba(df), model.predict_proba_natively(df), "fill_probability")
    assert (n, missing) == (3, 0) and apart < 1e-12


def test_a_cut_by_two_categories(spark):
    """MLlib may list either of the two on the left."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = [(float(i % 2), float(i % 7), float((i % 2 == 0) ^ (i % 7 > 3))) for i in range(400)]
    df = spark.createDataFrame(rows, "flag double, number double, label double")
    df = df.withColumn("flag", F.col("flag").alias("flag", metadata={"ml_attr": {"type": "binary", "vals": ["no", "yes"]}}))
    df = VectorAssembler(inputCols=["flag", "number"], outputCol="features").transform(df)
    model = GBTClassifier(maxIter=5, maxDepth=3).fit(df)
    split = model.trees[0]
    assert "in {" in split.toDebugString
    native = 1 / (1 + F.exp(-2 * ensemble_sum(boosted_nodes(model, spark), [F.col("flag"), F.col("number")])))
    apart = model.transform(df).select(F.max(F.abs(native - vector_to_array("probability")[1]))).first()[0]
    assert apart < 1e-12


@pytest.mark.parametrize("trees", [1, 30])
def test_forest_scores_are_the_same(auctions, trees):
    df = auctions.dropDuplicates(["auction_id"]).persist()
    plain = forest_ops.AnomalyForest(trees=trees).fit(df)
    native = forest_ops.AnomalyForest(trees=trees, native=True).fit(df)
    _no_python(native.predict(df))
    columns = ["auction_id", "anomaly_score", "is_anomaly"]
    assert plain.predict(df).select(columns).exceptAll(native.predict(df).select(columns)).isEmpty()


def test_a_value_at_the_cut_a_null_and_nan(spark):
    nodes = spark.createDataFrame([(0, 0, 0, 1.0, 1, 2, None), (0, 1, -1, None, None, None, 10.0), (0, 2, -1, None, None, None, 20.0)], NODES)
    df = spark.createDataFrame([(1, 0.5), (2, 1.0), (3, 1.0000001), (4, None), (5, float("nan"))], "id int, x double")
    got = {r["id"]: r["s"] for r in df.select("id", ensemble_sum(nodes, [F.col("x")]).alias("s")).collect()}
    assert got == {1: 10.0, 2: 10.0, 3: 20.0, 4: 20.0, 5: 20.0}
    assert df.select(ensemble_sum(nodes.where("tree < 0"), [F.col("x")]).alias("s")).distinct().collect() == [(0.0,)]
    assert df.limit(0).select(ensemble_sum(nodes, [F.col("x")])).isEmpty()


def test_broken_tables_are_refused(spark):
    def table(*lines):
        return spark.createDataFrame(list(lines), NODES)

    leaf = (0, 1, -1, None, None, None, 1.0)
    with pytest.raises(ValueError, match="lacks"):
        ensemble_sum(table((0, 0, 0, 1.0, 1, 2, None), leaf), [F.lit(1.0)])
    with pytest.raises(ValueError, match="twice"):
        ensemble_sum(table((0, 0, 0, 1.0, 1, 2, None), leaf, (0, 2, 0, 1.0, 0, 1, None)), [F.lit(1.0)])
    with pytest.raises(ValueError, match="features"):
        ensemble_sum(table((0, 0, 3, 1.0, 1, 2, None), leaf, (0, 2, -1, None, None, None, 1.0)), [F.lit(1.0)])


def _drawn_trees(trees, levels, features, draw):
    """Trees with a leaf here and there above the last level, in heap order."""
    lines = []
    for tree in range(trees):
        waiting = [(0, 0)]
        while waiting:
            node, level = waiting.pop()
            if level == levels or (level and draw.random() < 0.1):
                lines.append((tree, node, -1, None, None, None, float(draw.randrange(10**9))))
                continue
            cut = draw.choice([0.0, -0.5, 1e-7, 2.5, 1e9, draw.uniform(-3, 3)])
            lines.append((tree, node, draw.randrange(features), cut, 2 * node + 1, 2 * node + 2, None))
            waiting += [(2 * node + 1, level + 1), (2 * node + 2, level + 1)]
    return lines


@pytest.mark.parametrize("trees, levels", [(1, 1), (40, 4), (100, 8)])
def test_conditions_reach_the_leaves_of_the_walk(spark, trees, levels):
    """100 trees of 8 levels are more than one compiled method holds."""
    draw = random.Random(levels)
    nodes = spark.createDataFrame(_drawn_trees(trees, levels, 3, draw), NODES)
    values = [None, float("nan"), float("inf"), -float("inf"), -0.0, 0.0, -0.5, 1e-7, 2.5, 1e9]
    rows = [(i, *[draw.choice([*values, draw.uniform(-3, 3)]) for _ in range(2)], draw.randrange(-3, 4)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x double, y double, n int")
    features = [F.col("x"), F.col("y") * 2, F.col("n")]
    walked = df.withColumn("s", ensemble_sum(nodes, features))
    written = with_ensemble_sum(df, "s", nodes, features)
    assert written.columns == walked.columns
    expected = {row["id"]: row["s"] for row in walked.collect()}
    assert len(expected) == 300 and {row["id"]: row["s"] for row in written.collect()} == expected


def test_the_forest_is_scored_by_generated_code(auctions):
    """Functions of arrays run without it: no tree is walked by one, and no method holds all trees."""
    df = stage_table(auctions.select("auction_id", *forest_ops.FEATURES), "features")
    scored = forest_ops.AnomalyForest(trees=100, native=True).fit(df).predict(df).select("auction_id", "anomaly_score")
    lines = scored._jdf.queryExecution().executedPlan().toString().splitlines()
    assert "*(" in "".join(lines) and not any("from_json" in line for line in lines)
    (trees,) = [line for line in lines if "if ((_feature_" in line]
    assert "aggregate(array(_feature_0" in trees and not trees.lstrip(" :+-").startswith("*(")


def test_deep_trees_and_none_are_walked(spark):
    deep = CONDITION_LEVELS + 1
    lines = [(0, 2 * i, 0, float(-i), 2 * i + 2, 2 * i + 1, None) for i in range(deep)]
    lines += [(0, 2 * i + 1, -1, None, None, None, float(i)) for i in range(deep)]
    nodes = spark.createDataFrame([*lines, (0, 2 * deep, -1, None, None, None, 100.0)], NODES)
    df = spark.createDataFrame([(0.5,), (-3.5,), (-99.0,), (None,)], "x double")
    assert [r["s"] for r in with_ensemble_sum(df, "s", nodes, [F.col("x")]).collect()] == [0.0, 4.0, 100.0, 0.0]
    assert [r["s"] for r in with_ensemble_sum(df, "s", nodes.where("tree < 0"), [F.col("x")]).collect()] == [0.0] * 4
    with pytest.raises(ValueError, match="features"):
        with_ensemble_sum(df, "s", spark.createDataFrame([(0, 0, 3, 1.0, 1, 2, None), *[(0, i, -1, None, None, None, 1.0) for i in (1, 2)]], NODES), [F.col("x")])
