"""Row filters. Bounds are cast to the column's type so that they reach the parquet scan."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wall_clock(bound: str | datetime) -> str:
    """A bound as text, so that it is not moved by the Python process's own time zone."""
    if isinstance(bound, str):
        return bound
    if bound.tzinfo is not None:
        bound = bound.astimezone(timezone.utc).replace(tzinfo=None)
    return bound.isoformat(sep=" ")


def filter_by_ts(
    df: DataFrame,
    ts: str | None,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
) -> DataFrame:
    """Keep rows in [start, end). An empty or missing bound is no bound."""
    if not ts:
        return df
    kind = df.schema[ts].dataType
    if start:
        df = df.filter(F.col(ts) >= F.lit(wall_clock(start)).cast(kind))
    if end:
        df = df.filter(F.col(ts) < F.lit(wall_clock(end)).cast(kind))
    return df


def positive_if_present(df: DataFrame, column: str) -> DataFrame:
    """`column > 0` when the input has that column, else the input unchanged."""
    return df.filter(F.col(column) > 0) if column in df.columns else df


def all_positive(*columns: str) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & (F.col(c) > 0)
    return cond


def table_level_rows(
    column_name: str = ":table", log_type: str = "INPUT", all_models: str = "*"
) -> Column:
    """Profile rows for the whole primary table, one model at a time."""
    return (
        (F.col("column_name") == column_name)
        & F.col("slice_key").isNull()
        & (F.col("model_id") != all_models)
        & (F.col("log_type") == log_type)
    )
