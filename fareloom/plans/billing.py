"""Cost reports over usage lines and price history.

Rolling windows end at an explicit `as_of` date so that a report can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.timefn import days_before, months_before, open_end, parse_ts
from fareloom.operators.validity import half_open_join, latest_price, validity_join

SERVING_SKU = "%SERVERLESS_REAL_TIME_INFERENCE%"


def serving_usage(usage: DataFrame, since: Column) -> DataFrame:
    """DBU lines of the serving SKUs from `since` on."""
    return usage.filter(
        F.col("sku_name").like(SERVING_SKU)
        & (F.col("usage_unit") == "DBU")
        & (F.col("usage_start_time") >= since)
    )


def priced(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Usage with the list price valid over its whole span, `price_per_dbu`."""
    lookup = prices.select(
        "cloud",
        "sku_name",
        "price_start_time",
        "price_end_time",
        F.col("pricing.default").alias("price_per_dbu"),
    )
    return validity_join(usage, lookup, ["cloud", "sku_name"])


def daily_cost(usage: DataFrame, prices: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Units and cost per day. `unpriced_dbus` shows what no price row covered."""
    lines = serving_usage(usage, days_before(as_of, days))
    quantity = F.col("usage_quantity")
    return (
        priced(lines, prices)
        .groupBy(F.to_date("usage_start_time").alias("usage_date"))
        .agg(
            F.sum(quantity).alias("dbus"),
            F.sum(quantity * F.col("price_per_dbu")).alias("cost_usd"),
            F.coalesce(
                F.sum(F.when(F.col("price_per_dbu").isNull(), quantity)), F.lit(0.0)
            ).alias("unpriced_dbus"),
        )
        .orderBy("usage_date")
    )


def flat_prices(prices: DataFrame) -> DataFrame:
    """Price history with its nested price pulled up and open ends filled in."""
    return prices.select(
        "account_id",
        "sku_name",
        parse_ts("price_start_time").alias("price_start_ts"),
        open_end(parse_ts("price_end_time")).alias("price_end_ts"),
        F.col("pricing.effective_list.default").alias("unit_price"),
    )


def sku_cost_latest_price(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost per SKU, counting only usage inside the validity of its latest price."""
    latest = latest_price(flat_prices(prices), ["account_id", "sku_name"])
    return (
        half_open_join(usage.select("sku_name", "usage_quantity", "usage_start_time"), latest, ["sku_name"])
        .groupBy("sku_name")
        .agg(F.sum(F.col("usage_quantity") * F.col("unit_price")).alias("total_cost"))
        .orderBy("sku_name")
    )


def endpoint_month_cost(
    usage: DataFrame, prices: DataFrame, as_of: str, months: int = 12
) -> DataFrame:
    """Cost per month and endpoint, dearest endpoint first within a month."""
    lines = serving_usage(usage, months_before(as_of, months))
    month = F.date_trunc("month", F.col("usage_start_time").cast("timestamp")).cast("timestamp_ntz")
    return (
        priced(lines, prices)
        .groupBy(
            month.alias("usage_month"),
            F.col("usage_metadata.endpoint_name").cast("string").alias("endpoint"),
        )
        .agg(F.sum(F.col("usage_quantity") * F.col("price_per_dbu")).alias("cost_usd"))
        .orderBy(F.col("usage_month"), F.col("cost_usd").desc())
    )
