"""Batch and streaming sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_path(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_sql(spark: SparkSession, text: str | None) -> DataFrame:
    """A caller's SELECT, e.g. the validation input. Empty text is refused."""
    if not text or not text.strip():
        raise ValueError("a SELECT statement is required")
    return spark.sql(text)


def read_path_sql(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The path used as a table name inside SQL."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def stream_path(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    file_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New files under `path` as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def from_rows(spark: SparkSession, rows: Iterable, schema) -> DataFrame:
    """Small in-memory input: rows, dicts or a pandas frame."""
    return spark.createDataFrame(rows, schema)
