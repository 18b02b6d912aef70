"""Projections shared by the layers, the training frames and the scoring output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.timefn import parse_ts


def add_ingest_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("ingest_ts", F.current_timestamp())


def with_model_stamp(df: DataFrame, model_id: str, ts: str) -> DataFrame:
    """Constant `model_id` and `timestamp` columns of a scoring run."""
    return df.withColumn("model_id", F.lit(model_id)).withColumn("timestamp", parse_ts(F.lit(ts)))


def numeric_frame(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Label and features as doubles; nothing leaves the executors."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in (label, *features)])


def split_xy(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Features frame and label frame."""
    return df.drop(label), df.select(label)
