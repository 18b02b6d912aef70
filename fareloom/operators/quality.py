"""Prediction-quality and feature-distribution profiles over time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions.metrics import EPSILON
from fareloom.functions.predicates import table_level_rows

ALL_MODELS = "*"
TABLE = ":table"
PRIMARY_LOG = "INPUT"


def quality_profile(
    pred: DataFrame,
    granularity: str = "1 day",
    model: str = "model_id",
    label: str = "label",
    prediction: str = "prediction",
    ts: str = "timestamp",
    slices: Sequence[str] = (),
    log_type: str = PRIMARY_LOG,
) -> DataFrame:
    """Regression metrics per time window: by model and for all models, whole and per slice.

    The log is reduced to sums per (window, model, slice values) first. Only those few rows go
    through the grouping sets, which would otherwise copy every prediction once per set.
    """
    state = profile_state(pred, granularity, model, label, prediction, ts, slices)
    return profile_of_state(state, granularity, slices, log_type)


def profile_state(
    pred: DataFrame,
    granularity: str = "1 day",
    model: str = "model_id",
    label: str = "label",
    prediction: str = "prediction",
    ts: str = "timestamp",
    slices: Sequence[str] = (),
) -> DataFrame:
    """Counts, error sums, and mean and spread of labels per (window, model, slice values).

    States of several parts of a log are merged by `merge_profile_states`.
    """
    e = F.col(prediction).cast("double") - F.col(label).cast("double")
    y = F.when(F.col(prediction).isNotNull(), F.col(label).cast("double"))
    base = pred.select(
        F.window(ts, granularity).alias("window"),
        F.col(model).cast("string").alias("_model"),
        *[F.col(s).cast("string").alias(f"_s{i}") for i, s in enumerate(slices)],
        e.alias("_e"),
        y.alias("_y"),
    )
    dims = _profile_dims(slices)
    size = F.greatest(F.abs("_y"), F.lit(EPSILON))
    return base.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("_e").alias("n"),
        F.sum(F.abs("_e")).alias("ae"),
        F.sum(F.col("_e") * F.col("_e")).alias("se"),
        F.max(F.abs("_e")).alias("me"),
        F.sum(F.abs("_e") / size).alias("pe"),
        F.avg("_y").alias("my"),
        (F.var_pop("_y") * F.count("_y")).alias("within"),
    )


def _profile_dims(slices: Sequence[str]) -> list[str]:
    return ["window", "_model", *[f"_s{i}" for i in range(len(slices))]]


def merge_profile_states(states: DataFrame, slices: Sequence[str] = ()) -> DataFrame:
    """One row per (window, model, slice values) from those of several parts.

    The spread of a group is that inside its parts and that of the parts' means around the group's,
    so large labels do not cancel. Parts without a label have no mean and add none.
    """
    dims = _profile_dims(slices)
    group = W.partitionBy(*dims)
    mean = F.try_divide(F.sum(F.col("n") * F.col("my")).over(group), F.sum("n").over(group))
    off = F.coalesce(F.col("my") - F.col("_mean"), F.lit(0.0))
    # The window holds one row per part of a group, not its predictions.
    return (
        states.withColumn("_mean", mean)
        .groupBy(*dims)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("n").alias("n"),
            F.sum("ae").alias("ae"),
            F.sum("se").alias("se"),
            F.max("me").alias("me"),
            F.sum("pe").alias("pe"),
            F.first("_mean").alias("my"),
            F.sum(F.coalesce("within", F.lit(0.0)) + F.col("n") * off * off).alias("within"),
        )
    )


def profile_of_state(
    sums: DataFrame,
    granularity: str = "1 day",
    slices: Sequence[str] = (),
    log_type: str = PRIMARY_LOG,
) -> DataFrame:
    """The profile from one state row per (window, model, slice values)."""
    dims = _profile_dims(slices)
    # Spread around the mean without squares of the labels themselves: inside the finest groups, and
    # of their means around the window's. The window frame is over one row per finest group.
    whole = W.partitionBy("window")
    middle = F.try_divide(F.sum(F.col("n") * F.col("my")).over(whole), F.sum("n").over(whole))
    sums = sums.withColumn("off", F.coalesce(F.col("my") - middle, F.lit(0.0))).withColumns(
        {"sy": F.col("n") * F.col("off"), "syy": F.col("within") + F.col("n") * F.col("off") * F.col("off")}
    )
    sets = [["window", "_model"], ["window"]]
    for i in range(len(slices)):
        sets += [["window", "_model", f"_s{i}"], ["window", f"_s{i}"]]
    total = sums.groupingSets(sets, *dims).agg(
        *[F.sum(c).alias(c) for c in ("rows", "n", "ae", "se", "pe", "sy", "syy")],
        F.max("me").alias("me"),
        F.grouping("_model").alias("_any_model"),
        *[F.grouping(f"_s{i}").alias(f"_g{i}") for i in range(len(slices))],
    )
    slice_key = F.lit(None).cast("string")
    slice_value = F.lit(None).cast("string")
    for i, s in enumerate(slices):
        own = F.col(f"_g{i}") == 0
        slice_key = F.when(own, F.lit(s)).otherwise(slice_key)
        slice_value = F.when(own, F.col(f"_s{i}")).otherwise(slice_value)
    n = F.col("n")
    spread = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)
    return total.select(
        "window",
        F.lit(granularity).alias("granularity"),
        F.when(F.col("_any_model") == 1, F.lit(ALL_MODELS)).otherwise(F.col("_model")).alias(
            "model_id"
        ),
        slice_key.alias("slice_key"),
        slice_value.alias("slice_value"),
        F.lit(TABLE).alias("column_name"),
        F.lit(log_type).alias("log_type"),
        F.col("rows").alias("count"),
        F.try_divide("ae", n).alias("mean_absolute_error"),
        F.try_divide("se", n).alias("mean_squared_error"),
        F.sqrt(F.try_divide("se", n)).alias("root_mean_squared_error"),
        F.try_divide("pe", n).alias("mean_absolute_percentage_error"),
        (1 - F.try_divide("se", spread)).alias("r2_score"),
        F.col("me").alias("max_error"),
    )


def update_profile(
    batch: DataFrame,
    path: str,
    batch_id: int,
    granularity: str = "1 day",
    model: str = "model_id",
    label: str = "label",
    prediction: str = "prediction",
    ts: str = "timestamp",
    slices: Sequence[str] = (),
) -> None:
    """Add one batch of predictions to a stored profile; its rows alone are read.

    The batch's state goes to a folder of its own, so a batch given again replaces itself and
    counts once. A batch without rows adds nothing.
    """
    state = profile_state(batch, granularity, model, label, prediction, ts, slices)
    state.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={int(batch_id)}")


def read_profile(
    spark: SparkSession,
    path: str,
    granularity: str = "1 day",
    slices: Sequence[str] = (),
    log_type: str = PRIMARY_LOG,
) -> DataFrame:
    """The profile of all batches so far, equal to `quality_profile` on all their rows."""
    states = merge_profile_states(spark.read.parquet(path), slices)
    return profile_of_state(states, granularity, slices, log_type)


def column_profile(
    df: DataFrame,
    columns: Sequence[str],
    ts: str,
    granularity: str = "1 day",
    log_type: str = PRIMARY_LOG,
) -> DataFrame:
    """Count, nulls, mean, deviation and range per window and numeric column.

    One aggregate over the input; its one row per window is then turned into one per column.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.count_if(x.isNull()).alias(f"z{i}"),
            F.avg(x).alias(f"m{i}"),
            F.stddev_samp(x).alias(f"d{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
    wide = df.groupBy(F.window(ts, granularity).alias("window")).agg(*aggs)
    per_column = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"n{i}").alias("num_values"),
                F.col(f"z{i}").alias("num_nulls"),
                F.col(f"m{i}").alias("avg"),
                F.col(f"d{i}").alias("stddev"),
                F.col(f"lo{i}").alias("min"),
                F.col(f"hi{i}").alias("max"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return wide.select("window", F.explode(per_column).alias("s")).select(
        "window", F.lit(granularity).alias("granularity"), F.lit(log_type).alias("log_type"), "s.*"
    )


def _violated(metric: str, threshold: float, n_viol: int):
    over = F.count_if(F.col(metric) > threshold) >= n_viol
    newest = F.max_by(metric, F.col("window.start")) > threshold
    return F.when(over & newest, 1).otherwise(0).alias("query_result")


def recent_windows(profile: DataFrame, metric: str, n: int) -> DataFrame:
    """The metric in the newest `n` windows of the whole table, newest first."""
    return (
        profile.filter(table_level_rows())
        .select(metric, "window")
        .orderBy(F.col("window.start").desc())
        .limit(n)
    )


def metric_violation(
    profile: DataFrame,
    metric: str = "root_mean_squared_error",
    threshold: float = 100,
    n_eval: int = 5,
    n_viol: int = 2,
) -> DataFrame:
    """1 when at least `n_viol` of the newest `n_eval` windows and the newest are over, else 0.

    One row, for a table that is watched as a whole (one model per window); no windows give 0.
    """
    return recent_windows(profile, metric, n_eval).agg(_violated(metric, threshold, n_viol))


def metric_violation_by_model(
    profile: DataFrame,
    metric: str = "root_mean_squared_error",
    threshold: float = 100,
    n_eval: int = 5,
    n_viol: int = 2,
) -> DataFrame:
    """The same check for each model on its own windows."""
    newest = W.partitionBy("model_id").orderBy(F.col("window.start").desc())
    recent = (
        profile.filter(table_level_rows())
        .select("model_id", metric, "window")
        .withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") <= n_eval)
    )
    return recent.groupBy("model_id").agg(_violated(metric, threshold, n_viol))


def rolling_drift(
    pred: DataFrame,
    baseline_rmse: float,
    days: int = 7,
    model: str = "model_id",
    label: str = "label",
    prediction: str = "prediction",
    ts: str = "timestamp",
) -> DataFrame:
    """RMSE over the rolling last `days` days, next to the training RMSE.

    The window runs over one row per model and day.
    """
    e = F.col(prediction).cast("double") - F.col(label).cast("double")
    daily = pred.groupBy(
        F.col(model).alias("model_id"), F.to_date(ts).alias("day")
    ).agg(F.sum(e * e).alias("se"), F.count(e).alias("n"))
    roll = (
        W.partitionBy("model_id").orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    )
    rolling = F.sqrt(F.try_divide(F.sum("se").over(roll), F.sum("n").over(roll)))
    return daily.select(
        "model_id", "day", rolling.alias("rolling_rmse"), F.lit(baseline_rmse).alias("base_rmse")
    ).withColumn("is_drifted", (F.col("rolling_rmse") > F.col("base_rmse")).cast("int"))


def retune_flag(drift: DataFrame, rise: float = 0.15) -> DataFrame:
    """1 where the rolling RMSE is more than `rise` above the training RMSE."""
    over = F.col("rolling_rmse") > (1 + rise) * F.col("base_rmse")
    return drift.withColumn("needs_retune", F.when(over, 1).otherwise(0))


def version_compare(
    profile: DataFrame, models: Sequence[str], metric: str = "root_mean_squared_error"
) -> DataFrame:
    """One column per model version, one row per window."""
    return (
        profile.filter(table_level_rows())
        .groupBy("window")
        .pivot("model_id", list(models))
        .agg(F.first(metric))
    )


def profile_schema(metric: str = "root_mean_squared_error") -> T.StructType:
    """The columns the violation checks read."""
    window = T.StructType(
        [T.StructField("start", T.TimestampNTZType()), T.StructField("end", T.TimestampNTZType())]
    )
    text = T.StringType()
    return T.StructType(
        [
            T.StructField("window", window),
            T.StructField("model_id", text),
            T.StructField("slice_key", text),
            T.StructField("column_name", text),
            T.StructField("log_type", text),
            T.StructField(metric, T.DoubleType()),
        ]
    )
