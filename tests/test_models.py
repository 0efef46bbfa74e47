import pytest
from pyspark.sql import functions as F

from bidscope.operators import forest as forest_ops
from bidscope.operators.models import EcpmModel, FillModel, hold_out
from bidscope.plans import registered
from tests.conftest import rows


@pytest.fixture(scope="module")
def fill_model(auctions):
    return FillModel(rounds=5).fit(auctions)


@pytest.fixture(scope="module")
def forest(auctions):
    return forest_ops.AnomalyForest().fit(auctions)


def test_hold_out_is_exact_per_class(auctions):
    marked = hold_out(auctions, "auction_id", ["filled"]).persist()
    assert marked.count() == auctions.count()
    for row in rows(marked.groupBy("filled").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_test").cast("int")).alias("t"))):
        assert abs(row["t"] - 0.2 * row["n"]) <= 1
    again = hold_out(auctions, "auction_id", ["filled"]).where("_test").select("auction_id")
    assert again.exceptAll(marked.where("_test").select("auction_id")).count() == 0


def test_fill_metrics(fill_model):
    assert fill_model.metrics["roc_auc"] > 0.5 and fill_model.metrics["avg_precision"] > 0.5
    assert fill_model.metrics["test_samples"] > 0


def test_probabilities_and_predictions(fill_model, auctions):
    scored = fill_model.predict(auctions, threshold=0.6)
    assert scored.count() == auctions.count()
    assert scored.where("fill_probability < 0 OR fill_probability > 1 OR predicted_fill NOT IN (0, 1)").count() == 0
    assert scored.where("predicted_fill <> CAST(fill_probability >= 0.6 AS INT)").count() == 0


def test_fit_does_not_depend_on_the_layout(auctions):
    few = auctions.limit(2000).persist()
    columns = ["auction_id", F.round("fill_probability", 6).alias("p")]
    one, other = (FillModel(rounds=3).fit(few.repartition(n)).predict_proba(few).select(columns) for n in (1, 5))
    assert one.exceptAll(other).isEmpty()


def test_importance_has_every_feature(fill_model, auctions):
    lines = rows(fill_model.feature_importance())
    names = {r["feature"] for r in lines}
    assert {"ecpm", "hour", "placement_type_top_of_search"} <= names
    assert len(lines) == 4 + 4 + 4 + auctions.select("category").distinct().count() + 5
    assert sum(r["importance"] for r in lines) == pytest.approx(1.0, abs=0.01)


def test_unknown_category_and_missing_columns(fill_model, make_auctions):
    df = make_auctions([{"category": "never seen"}, {}]).drop("ecpm", "device_type")
    scored = fill_model.predict_proba(df)
    assert scored.count() == 2 and scored.where("fill_probability IS NULL").count() == 0


def test_save_and_load(fill_model, auctions, tmp_path):
    fill_model.save(str(tmp_path / "model"))
    loaded = FillModel.load(str(tmp_path / "model"))
    columns = ["auction_id", "fill_probability"]
    before = fill_model.predict_proba(auctions).select(columns)
    assert loaded.predict_proba(auctions).select(columns).exceptAll(before).count() == 0


def test_one_class_is_skipped(make_auctions):
    model = FillModel(rounds=2).fit(make_auctions([{}, {}, {}]))
    assert model.metrics["roc_auc"] is None and model.metrics["positive_rate"] == 1.0
    with pytest.raises(RuntimeError):
        model.feature_importance()


def test_unfitted(auctions):
    with pytest.raises(RuntimeError):
        FillModel().predict(auctions)
    with pytest.raises(RuntimeError):
        EcpmModel().predict(auctions)
    with pytest.raises(RuntimeError):
        forest_ops.AnomalyForest().predict(auctions)


def test_ecpm_model(auctions):
    model = EcpmModel(rounds=20).fit(auctions)
    assert model.metrics["r2"] > 0
    scored = model.predict(auctions)
    assert scored.count() == auctions.count() and scored.where("predicted_ecpm <= 0").count() == 0


def test_forest_flags_about_its_share(forest, auctions):
    rate = rows(forest_ops.flag_rate(forest.predict(auctions)))[0]
    assert rate["n_auctions"] == auctions.count() and abs(rate["anomaly_rate"] - 0.02) < 0.01


def test_forest_is_reproducible(forest, auctions):
    again = forest_ops.AnomalyForest().fit(auctions).predict(auctions).select("auction_id", "anomaly_score")
    assert again.exceptAll(forest.predict(auctions).select("auction_id", "anomaly_score")).count() == 0


def test_forest_scores_its_own_rows_in_one_pass(forest, auctions):
    columns = ["auction_id", "anomaly_score", "is_anomaly"]
    once = forest_ops.AnomalyForest().fit_predict(auctions).select(columns)
    assert once.exceptAll(forest.predict(auctions).select(columns)).count() == 0


def test_model_is_fitted_anew_when_the_data_differ(auctions):
    first = registered._fingerprint(auctions)
    assert registered._fingerprint(auctions.repartition(3)) == first
    assert registered._fingerprint(auctions.withColumn("ecpm", F.col("ecpm") + 1)) != first


def test_forest_finds_a_planted_outlier(forest, make_auctions):
    odd = {"winning_bid_usd": 500.0, "clearing_price_usd": 1.0, "ecpm": 1e6, "bid_floor_usd": 90.0, "auction_depth": 90}
    scored = rows(forest.predict(make_auctions([{}, odd])).orderBy("auction_id"))
    assert scored[1]["is_anomaly"] and scored[1]["anomaly_score"] > scored[0]["anomaly_score"]


def test_forest_fills_gaps_with_training_medians(forest, make_auctions):
    scored = forest.predict(make_auctions([{"ecpm": None, "bid_floor_usd": None}]))
    assert scored.first()["anomaly_score"] is not None


def test_forest_summary_and_reports(forest, auctions):
    summary = rows(forest.summary(auctions))
    assert sum(r["total"] for r in summary) == auctions.count()
    assert all(0 <= r["anomaly_rate"] <= 1 for r in summary)
    top = rows(forest_ops.top_anomalies(forest.predict(auctions), 7))
    assert len(top) == 7 and top[0]["anomaly_score"] >= top[-1]["anomaly_score"]


def test_forest_on_the_columns_there_are(make_auctions):
    data = [{"winning_bid_usd": 1.0 + i / 100} for i in range(50)]
    forest = forest_ops.AnomalyForest(trees=10).fit(make_auctions(data, drop=["bid_floor_usd", "ecpm"]))
    assert forest.features == ["winning_bid_usd", "clearing_price_usd", "bid_spread", "auction_depth"]
    with pytest.raises(ValueError):
        forest_ops.AnomalyForest().fit(make_auctions(data).where("false"))


@pytest.fixture(scope="module")
def whole_models(auctions):
    """Both models at their own settings."""
    return FillModel().fit(auctions), EcpmModel().fit(auctions)


@pytest.mark.slow
def test_models_at_their_settings_have_all_rounds_and_predict(whole_models, auctions):
    fill, ecpm = whole_models
    assert fill.rounds == ecpm.rounds == 200
    # Bid and floor decide fill here, and the bid most of the eCPM, so boosted trees come close to both.
    assert fill.metrics["roc_auc"] > 0.95 and fill.metrics["avg_precision"] > 0.95
    assert ecpm.metrics["r2"] > 0.8 and 0 < ecpm.metrics["mae_log"] < 0.5
    # What the metrics say is what the predictions of the held-out rows give.
    held = hold_out(auctions, "auction_id", ["filled"]).where("_test")
    scored = fill.predict(held).agg(F.avg(F.abs(F.col("fill_probability") - F.col("filled"))), F.count(F.lit(1))).first()
    assert scored[0] < 0.1 and scored[1] == fill.metrics["test_samples"]
