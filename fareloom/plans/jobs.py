"""The scheduled jobs: train, validate, score, watch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession

from fareloom.functions.metrics import regression_metrics
from fareloom.operators import compare, models, quality
from fareloom.operators.asof import FeatureLookup, create_training_set
from fareloom.operators.split import train_test_split
from fareloom.operators.validity import join_ground_truth
from fareloom.plans.training import TRAINING_DATA, rounded_trips
from fareloom.sources.readers import read_sql, read_table
from fareloom.sources.staging import stage
from fareloom.sources.tables import overwrite_table


def train_on(
    frame: DataFrame,
    model: str = "gbt",
    label: str = models.LABEL,
    test_fraction: float = 0.2,
    seed: int = 42,
    **params,
) -> tuple[Model, float]:
    """Fit on a table of label and features, e.g. the gold layer; returns model and test RMSE.

    Rows are split by a hash of their content, so copies of a row are all on one side. The frame
    is staged: a fit reads it many times and should not compute it as often.
    """
    frame = stage(frame.dropna(subset=[label]), "training")
    features = [c for c in frame.columns if c != label]
    train, test = train_test_split(frame, frame.columns, test_fraction, seed)
    fitted = models.fit(model, train, features, label, **params)
    return fitted, models.holdout_rmse(fitted, test, label)


def train_model(
    raw: DataFrame,
    training_data: str = "taxi_training_data",
    model: str = "gbt",
    test_fraction: float = 0.2,
    seed: int = 123,
    **params,
) -> tuple[Model, float]:
    """Registered training data and registered model, put together by name."""
    frame = TRAINING_DATA[training_data](raw)
    return train_on(frame, model, models.LABEL, test_fraction, seed, **params)


def validate_model(
    spark: SparkSession,
    model: Model | models.Predict,
    validation_input: str,
    lookups: Sequence[FeatureLookup] = (),
    features: Sequence[str] = models.FEATURES,
    target: str = models.LABEL,
    thresholds: Mapping[str, compare.MetricThreshold] = compare.VALIDATION_THRESHOLDS,
    custom: Mapping[str, Column] | None = None,
    mode: str = "enabled",
    baseline: Model | models.Predict | None = None,
) -> tuple[DataFrame, bool]:
    """Score the rows of a SELECT and hold the metrics against the thresholds.

    Returns the verdicts and whether all passed. With a baseline model the change rules of the
    thresholds apply as well. Only mode `enabled` raises; `disabled` computes nothing.
    """
    if mode == "disabled":
        return spark.createDataFrame([], "metric_name string, passed boolean"), True
    rows = create_training_set(
        rounded_trips(read_sql(spark, validation_input)), lookups, target, staged=True
    )

    def metrics(m: Model | models.Predict) -> DataFrame:
        scored = models.apply_model(rows, m, features)
        # One row, read by several checks.
        return stage(regression_metrics(scored, target, "prediction", custom), "metrics")

    found = metrics(model)
    verdicts = compare.validate(found, thresholds)
    passed = compare.enforce(verdicts, mode)
    if baseline is not None:
        changes = compare.baseline_compare(found, metrics(baseline), thresholds)
        passed = compare.enforce(changes, mode) and passed
    return verdicts, passed


def predict_batch(
    spark: SparkSession,
    model_path: str,
    input_table: str,
    output_table: str,
    model_version: str,
    ts: str,
    lookups: Sequence[FeatureLookup] = (),
    features: Sequence[str] = models.FEATURES,
    output_path: str | None = None,
) -> None:
    """Score a table with a saved model and replace the predictions table."""
    scored = models.score_batch(
        read_table(spark, input_table),
        models.load_model(model_path),
        features,
        model_version,
        ts,
        lookups,
        staged=True,
    )
    overwrite_table(scored, output_table, output_path)


def retraining_needed(
    predictions: DataFrame,
    labels: DataFrame,
    row_id: str,
    label: str = "price",
    metric: str = "root_mean_squared_error",
    threshold: float = 100,
    n_eval: int = 5,
    n_viol: int = 2,
) -> dict[str, bool]:
    """Join the labels that came in, profile per day, and check each model for violations."""
    log = join_ground_truth(predictions, labels, row_id)
    profile = quality.quality_profile(log, label=label)
    checks = quality.metric_violation_by_model(profile, metric, threshold, n_eval, n_viol)
    # One row per model version.
    return {r["model_id"]: bool(r["query_result"]) for r in checks.collect()}
