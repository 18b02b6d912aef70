"""Table writes: feature tables, upsert, overwrite, views.

A feature table is a parquet folder partitioned by month (`yyyy_mm`) and unique on its keys plus
the timestamp key. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.sources.staging import scratch_path

PARTITION = "yyyy_mm"


class DuplicateKeyError(ValueError):
    """The rows are not unique on the table's key."""


class SchemaConflictError(ValueError):
    """A table of that name exists with other columns."""


def parse_keys(text: str) -> list[str]:
    """A comma list of key columns, blanks trimmed."""
    return [k.strip() for k in text.split(",") if k.strip()]


@dataclass(frozen=True)
class FeatureTable:
    path: str
    keys: tuple[str, ...]
    ts_key: str
    # Columns to give while the table has no rows, and so no file that tells them.
    schema: StructType | None = field(default=None, compare=False)

    @property
    def primary_key(self) -> list[str]:
        return [*self.keys, self.ts_key]

    def read(self, spark: SparkSession) -> DataFrame:
        if self.schema is not None and not feature_table_exists(spark, self.path):
            return spark.createDataFrame([], self.schema)
        df = spark.read.parquet(self.path)
        return df.withColumn(PARTITION, F.col(PARTITION).cast("string"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. Counts are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    hit = duplicate_keys(df, keys).first()
    if hit is not None:
        raise DuplicateKeyError(f"key {list(keys)} is not unique, e.g. {hit.asDict()}")


def assert_month(df: DataFrame) -> None:
    """A row without a month belongs to no partition that a later run could find again."""
    if not df.filter(F.col(PARTITION).isNull()).isEmpty():
        raise ValueError(f"{PARTITION} must not be null")


def _columns(df: DataFrame) -> set[tuple[str, str]]:
    return {(f.name, f.dataType.simpleString()) for f in df.schema.fields}


def feature_table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def _write_months(df: DataFrame, path: str, mode: str) -> None:
    # Rebalance by month: small months share a task, a large month is split over several.
    (
        df.hint("rebalance", F.col(PARTITION))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def create_feature_table(path: str, keys: str, ts_key: str, df: DataFrame) -> FeatureTable:
    """Create and fill the table. A table with the same columns is left alone."""
    table = FeatureTable(path, tuple(k for k in parse_keys(keys) if k != ts_key), ts_key, df.schema)
    missing = [c for c in (*table.primary_key, PARTITION) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    if feature_table_exists(df.sparkSession, path):
        old = table.read(df.sparkSession)
        if _columns(old) != _columns(df):
            raise SchemaConflictError(f"{path} exists with columns {old.columns}")
        return table
    assert_month(df)
    assert_unique(df, table.primary_key)
    # A folder that holds no rows yet is filled.
    _write_months(df, path, "append")
    return table


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched keys replaced, new keys inserted, all others kept. A NULL key matches a NULL key."""
    replaced = source.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return target.join(replaced, same, "left_anti").unionByName(source)


def upsert_feature_table(table: FeatureTable, source: DataFrame) -> None:
    """Merge `source` into the stored table, rewriting only the months it touches.

    The key holds the timestamp and the month follows from it, so a replaced row is always in
    the month of its replacement. The merged months are written to the shared folder first and
    put in place from there: the table is never overwritten while it is being read, and a run
    that dies in between can be repeated. Frames read before the upsert have to be read again.
    """
    spark = source.sparkSession
    assert_month(source)
    assert_unique(source, table.primary_key)
    # One short label per calendar month.
    months = [r[0] for r in source.select(PARTITION).distinct().collect()]
    target = table.read(spark).filter(F.col(PARTITION).isin(months))
    merged = merge_upsert(target, source, table.primary_key).select(*target.columns)
    staged = scratch_path(spark, "upsert")
    merged.write.parquet(staged)
    _write_months(spark.read.schema(merged.schema).parquet(staged), table.path, "overwrite")


def overwrite_path(df: DataFrame, path: str) -> None:
    """Replace a parquet folder, columns included."""
    df.write.mode("overwrite").parquet(path)


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table, e.g. the predictions table."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def create_schema(spark: SparkSession, table_name: str) -> str:
    """Create the schema of a dotted table name if it is not there.

    The schema is the part before the table: the second of `catalog.schema.table`.
    """
    parts = table_name.split(".")
    if len(parts) < 2:
        raise ValueError(f"{table_name} names no schema")
    schema = parts[-2]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    return schema
