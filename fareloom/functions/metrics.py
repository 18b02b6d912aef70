"""Regression metrics as aggregate columns. A row counts when label and prediction are both set."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Guard against division by a zero label in the percentage error (float64 epsilon).
EPSILON = 2.220446049250313e-16


def _error(label: str, prediction: str) -> Column:
    return F.col(prediction).cast("double") - F.col(label).cast("double")


def _paired_label(label: str, prediction: str) -> Column:
    """The label where a prediction stands next to it, else NULL."""
    return F.when(F.col(prediction).isNotNull(), F.col(label).cast("double"))


def mse(label: str, prediction: str) -> Column:
    e = _error(label, prediction)
    return F.avg(e * e)


def rmse(label: str, prediction: str) -> Column:
    return F.sqrt(mse(label, prediction))


def mae(label: str, prediction: str) -> Column:
    return F.avg(F.abs(_error(label, prediction)))


def mape(label: str, prediction: str) -> Column:
    size = F.greatest(F.abs(F.col(label).cast("double")), F.lit(EPSILON))
    return F.avg(F.abs(_error(label, prediction)) / size)


def max_error(label: str, prediction: str) -> Column:
    return F.max(F.abs(_error(label, prediction)))


def r2(label: str, prediction: str) -> Column:
    """1 - SSE / SST; NULL when the labels do not vary."""
    e = _error(label, prediction)
    y = _paired_label(label, prediction)
    return 1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))


def squared_diff_plus_one(label: str, prediction: str) -> Column:
    """The custom metric: sum of |prediction - label + 1| squared."""
    return F.sum(F.pow(F.abs(_error(label, prediction) + 1), F.lit(2.0)))


def default_metrics(label: str, prediction: str) -> dict[str, Column]:
    y = _paired_label(label, prediction)
    return {
        "example_count": F.count(_error(label, prediction)),
        "mean_absolute_error": mae(label, prediction),
        "mean_squared_error": mse(label, prediction),
        "root_mean_squared_error": rmse(label, prediction),
        "sum_on_target": F.sum(y),
        "mean_on_target": F.avg(y),
        "r2_score": r2(label, prediction),
        "max_error": max_error(label, prediction),
        "mean_absolute_percentage_error": mape(label, prediction),
    }


def regression_metrics(
    df: DataFrame,
    label: str,
    prediction: str,
    custom: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row with the default metrics, plus any named aggregates of the caller's own."""
    metrics = {**default_metrics(label, prediction), **(custom or {})}
    return df.agg(*[c.alias(name) for name, c in metrics.items()])
