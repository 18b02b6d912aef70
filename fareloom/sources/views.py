"""Domain tables as projections of the generic input tables.

All of them are row-by-row projections, so filters and column selections on a view still reach
the parquet scan; `prices_from_usage` is the one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def trips_from_events(ev: DataFrame) -> DataFrame:
    """Taxi-like trips. Works on a batch and on a streaming frame."""
    return ev.selectExpr(
        "event_id AS trip_id",
        "ts AS tpep_pickup_datetime",
        "ts + make_dt_interval(0, 0, CAST(5 + event_id % 40 AS INT), 0) AS tpep_dropoff_datetime",
        "CAST(get_json_object(props, '$.k') AS DOUBLE) / 10 AS trip_distance",
        "CASE WHEN event_type = 'error' THEN -value ELSE value END AS fare_amount",
        "CAST(10000 + user_id % 20 AS INT) AS pickup_zip",
        "CAST(10000 + (event_id * 7) % 20 AS INT) AS dropoff_zip",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(events(spark, sf_dir))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing usage lines, the endpoint name nested as in the billing schema."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_orderkey * 10 + l_linenumber AS usage_id",
        "CONCAT('SKU_SERVERLESS_REAL_TIME_INFERENCE_', l_returnflag, l_linestatus) AS sku_name",
        "CASE WHEN l_suppkey % 2 = 0 THEN 'AWS' ELSE 'AZURE' END AS cloud",
        "CASE WHEN l_linenumber % 4 = 0 THEN 'GB' ELSE 'DBU' END AS usage_unit",
        "l_quantity AS usage_quantity",
        "l_shipdate AS usage_start_time",
        "l_shipdate + INTERVAL '1' HOUR AS usage_end_time",
        "named_struct('endpoint_name', CONCAT('ep_', CAST(l_suppkey % 5 AS STRING)))"
        " AS usage_metadata",
    )


def prices_from_usage(use: DataFrame) -> DataFrame:
    """One price row per cloud, SKU and calendar year; the newest one is open."""
    year = F.date_trunc("year", F.col("usage_start_time").cast("timestamp")).cast("timestamp_ntz")
    yearly = use.groupBy("cloud", "sku_name", year.alias("price_start_time")).agg(
        (
            F.min("usage_quantity") + F.year(F.min("usage_start_time")) - 1994
        ).alias("unit_price")
    )
    order = W.partitionBy("cloud", "sku_name").orderBy("price_start_time")
    return yearly.select(
        F.lit("acct_1").alias("account_id"),
        "cloud",
        "sku_name",
        "price_start_time",
        F.lead("price_start_time").over(order).alias("price_end_time"),
        F.struct(
            F.col("unit_price").alias("default"),
            F.struct(F.col("unit_price").alias("default")).alias("effective_list"),
        ).alias("pricing"),
    )


def monthly_prices_from_usage(use: DataFrame) -> DataFrame:
    """Prices of two accounts that change half an hour into every month.

    Usage of the first hour of a month spans a change.
    """
    month = F.date_trunc("month", F.col("usage_start_time").cast("timestamp")).cast("timestamp_ntz")
    start = month + F.expr("INTERVAL 30 MINUTES")
    monthly = use.groupBy("cloud", "sku_name", start.alias("price_start_time")).agg(
        (F.min("usage_quantity") + F.month(F.min("usage_start_time"))).alias("base")
    )
    order = W.partitionBy("cloud", "sku_name").orderBy("price_start_time")
    ended = monthly.withColumn("price_end_time", F.lead("price_start_time").over(order))
    price = F.col("base") + F.col("account")
    return ended.withColumn("account", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        F.concat(F.lit("acct_"), F.col("account").cast("string")).alias("account_id"),
        "cloud",
        "sku_name",
        "price_start_time",
        "price_end_time",
        F.struct(price.alias("default"), F.struct(price.alias("default")).alias("effective_list")).alias("pricing"),
    )


def predictions_from_trips(t: DataFrame) -> DataFrame:
    """A prediction log with the closed-form predictor 3 * distance + 1."""
    return t.selectExpr(
        "trip_id",
        "3 * trip_distance + 1 AS prediction",
        "fare_amount AS label",
        "CAST(trip_id % 2 + 1 AS STRING) AS model_id",
        "tpep_pickup_datetime AS timestamp",
        "pickup_zip",
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per served request."""
    return events(spark, sf_dir).selectExpr(
        "event_id AS request_id", "value AS latency_ms", "event_type = 'error' AS failed"
    )
