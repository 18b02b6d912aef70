"""Comparing frames and metric tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ValidationFailed(RuntimeError):
    """At least one metric is outside its threshold."""


def frame_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with `surplus` = copies in `a` minus copies in `b`.

    One aggregate answers both directions of a multiset difference; copies are summed before
    the shuffle, so a row repeated very often does not weigh on one task.
    """
    cols = a.columns
    tagged = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    return tagged.groupBy(*cols).agg(F.sum("_n").alias("surplus")).filter("surplus <> 0")


def frames_equal(a: DataFrame, b: DataFrame) -> bool:
    if set(a.columns) != set(b.columns):
        return False
    return frame_diff(a, b).isEmpty()


@dataclass(frozen=True)
class MetricThreshold:
    threshold: float
    greater_is_better: bool = False
    min_absolute_change: float | None = None
    min_relative_change: float | None = None


# Fixed limits of the model validation.
VALIDATION_THRESHOLDS = {
    "max_error": MetricThreshold(500),
    "mean_squared_error": MetricThreshold(500),
}

MODES = ("disabled", "dry_run", "enabled")


def _long(metrics: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    pairs = [
        F.struct(F.lit(n).alias("metric_name"), F.col(n).cast("double").alias(value))
        for n in names
    ]
    return metrics.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")


def validate(
    metrics: DataFrame, thresholds: Mapping[str, MetricThreshold] = VALIDATION_THRESHOLDS
) -> DataFrame:
    """One row per threshold with its verdict. A missing (NULL) metric does not pass."""
    checks = []
    for name, t in thresholds.items():
        x = F.col(name).cast("double")
        ok = x >= t.threshold if t.greater_is_better else x <= t.threshold
        checks.append(
            F.struct(
                F.lit(name).alias("metric_name"),
                x.alias("candidate"),
                F.lit(float(t.threshold)).alias("threshold"),
                F.coalesce(ok, F.lit(False)).alias("passed"),
            )
        )
    return metrics.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def _verdict(t: MetricThreshold) -> Column:
    """Is the candidate better than the baseline by the asked-for margins?"""
    gain = (
        F.col("candidate") - F.col("baseline")
        if t.greater_is_better
        else F.col("baseline") - F.col("candidate")
    )
    ok = F.lit(True)
    if t.min_absolute_change is not None:
        ok = ok & (gain >= t.min_absolute_change)
    if t.min_relative_change is not None:
        # No relative change over a zero baseline: any gain will do.
        share = F.try_divide(gain, F.abs("baseline"))
        ok = ok & F.coalesce(share >= t.min_relative_change, gain > 0)
    return F.coalesce(ok, F.lit(False))


def baseline_compare(
    candidate: DataFrame,
    baseline: DataFrame | None,
    thresholds: Mapping[str, MetricThreshold],
) -> DataFrame:
    """Candidate and baseline side by side with absolute and relative change.

    Both inputs are one-row metric tables. Without a baseline its columns are NULL and the
    change rules do not apply.
    """
    names = list(thresholds)
    out = _long(candidate, names, "candidate")
    if baseline is None:
        out = out.withColumn("baseline", F.lit(None).cast("double"))
    else:
        out = out.join(_long(baseline, names, "baseline"), "metric_name", "left")
    change = F.col("candidate") - F.col("baseline")
    passed = F.lit(True)
    if baseline is not None:
        for name, t in thresholds.items():
            passed = F.when(F.col("metric_name") == name, _verdict(t)).otherwise(passed)
    return out.select(
        "metric_name",
        "candidate",
        "baseline",
        change.alias("absolute_change"),
        F.try_divide(change, F.abs("baseline")).alias("relative_change"),
        passed.alias("passed"),
    )


def enforce(verdicts: DataFrame, mode: str = "enabled") -> bool:
    """Act on a verdict table: True if all passed. Only mode `enabled` raises."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "disabled":
        return True
    failed = [r["metric_name"] for r in verdicts.filter("NOT passed").collect()]
    if failed and mode == "enabled":
        raise ValidationFailed(f"outside threshold: {', '.join(sorted(failed))}")
    return not failed
