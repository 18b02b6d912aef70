from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareloom.functions import metrics as M
from fareloom.operators import models
from fareloom.operators.compare import MetricThreshold, ValidationFailed, frames_equal
from fareloom.plans import jobs, medallion, training
from fareloom.plans.features import run_feature_job
from fareloom.sources import views
from fareloom.sources.tables import overwrite_table, register_view


@pytest.fixture(scope="module")
def trips(spark, small):
    return views.trips(spark, small)


@pytest.fixture(scope="module")
def lookups(spark, trips, tmp_path_factory):
    root = tmp_path_factory.mktemp("features")
    pickup = run_feature_job(trips, "pickup_features", f"{root}/p", training.PICKUP_TS)
    dropoff = run_feature_job(trips, "dropoff_features", f"{root}/d", training.DROPOFF_TS)
    return training.trip_lookups(pickup.read(spark), dropoff.read(spark))


def test_train_save_score(spark, trips, lookups, tmp_path):
    model, rmse = jobs.train_model(trips, model="elastic_net")
    assert 0 < rmse < 200
    path = str(tmp_path / "model")
    models.save_model(model, path)
    overwrite_table(training.inference_input(trips), "scoring_input", str(tmp_path / "in"))
    jobs.predict_batch(
        spark, path, "scoring_input", "predictions", "4", "2024-02-01 08:00:00", lookups,
        output_path=str(tmp_path / "out"),
    )
    out = spark.table("predictions")
    assert out.count() == trips.count()
    assert out.filter("prediction IS NULL").count() == 0
    row = out.first()
    assert (row["model_id"], row["timestamp"]) == ("4", dt(2024, 2, 1, 8))
    again = models.score_batch(
        training.inference_input(trips), model, models.FEATURES, "4", "2024-02-01 08:00:00", lookups
    )
    assert frames_equal(out.select("trip_id", "prediction"), again.select("trip_id", "prediction"))


def test_train_on_gold(trips):
    gold = medallion.gold_from_raw(trips)
    model, rmse = jobs.train_on(gold, rounds=5)
    assert model.stages[-1].getNumTrees == 5 and rmse > 0


def test_validation_job(spark, trips, lookups):
    register_view(trips, "validation_trips")
    text = "SELECT * FROM validation_trips WHERE fare_amount > 0"
    good = lambda x: x["trip_distance"] * 0 + 50
    bad = lambda x: x["trip_distance"] * 0 - 5000
    custom = {"shifted": M.squared_diff_plus_one("fare_amount", "prediction")}
    limits = {"max_error": MetricThreshold(500), "shifted": MetricThreshold(1e12)}
    args = dict(lookups=lookups, thresholds=limits, custom=custom)
    verdicts, passed = jobs.validate_model(spark, good, text, **args)
    assert passed and {r["metric_name"] for r in verdicts.collect()} == set(limits)
    with pytest.raises(ValidationFailed):
        jobs.validate_model(spark, bad, text, **args)
    assert jobs.validate_model(spark, bad, text, mode="dry_run", **args)[1] is False
    assert jobs.validate_model(spark, bad, text, mode="disabled", **args)[1] is True
    args["thresholds"] = {"mean_squared_error": MetricThreshold(1e9, min_relative_change=0.1)}
    assert jobs.validate_model(spark, good, text, baseline=bad, **args)[1]
    with pytest.raises(ValidationFailed):
        jobs.validate_model(spark, bad, text, baseline=good, **args)


def test_retraining_decision(spark, trips):
    log = trips.select(
        "trip_id",
        F.col("tpep_pickup_datetime").alias("timestamp"),
        F.lit(0.0).alias("prediction"),
        F.when(F.col("trip_id") % 2 == 0, "even").otherwise("odd").alias("model_id"),
    )
    labels = trips.select(
        "trip_id", F.when(F.col("trip_id") % 2 == 0, 500.0).otherwise(50.0).alias("price")
    )
    assert jobs.retraining_needed(log, labels, "trip_id") == {"even": True, "odd": False}
