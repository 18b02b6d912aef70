"""Joins against rows that are valid for a stretch of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


_MONTH = "_month"


def _month(ts: str) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def _by_month(usage: DataFrame, prices: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a month as one more equi key.

    A usage row has the month it starts in. A price row, valid from `start` to `end` (NULL is open),
    is spread over the months of its validity that the usage reaches. A match lies in the month of
    its usage row, so it is found in that month and in no other.
    """
    first, last = usage.agg(F.min(_month("usage_start_time")), F.max(_month("usage_start_time"))).first()
    low, high = F.lit(1 if first is None else first), F.lit(0 if last is None else last)
    since, until = F.greatest(_month(start), low), F.least(_month(end), high)  # NULLs are passed over
    months = F.when(since <= until, F.sequence(since, until))
    spread = prices.filter(F.col(start).isNotNull()).withColumn(_MONTH, F.explode(months))
    return usage.withColumn(_MONTH, _month("usage_start_time")), spread


def _on(keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in (*keys, _MONTH):
        on = on & (F.col(f"u.{k}") == F.col(f"p.{k}"))
    return on


def validity_join(usage: DataFrame, prices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to the price row whose validity holds the whole usage row.

    `price_end_time` NULL is open-ended. A usage row that spans a price change matches none, and one
    whose span several price rows hold (of several accounts) comes once with each. Keys and month
    make it a hash or sort-merge join in which a usage row meets the price rows of its month only,
    however long the history; no broadcast is forced, so Catalyst broadcasts the prices by their
    size and otherwise splits skewed usage partitions.
    """
    extra = [c for c in prices.columns if c not in usage.columns]
    own = usage.columns
    usage, prices = _by_month(usage, prices, "price_start_time", "price_end_time")
    on = (
        _on(keys)
        & (F.col("u.usage_start_time") >= F.col("p.price_start_time"))
        & (
            (F.col("u.usage_end_time") <= F.col("p.price_end_time"))
            | F.col("p.price_end_time").isNull()
        )
    )
    found = usage.alias("u").join(prices.alias("p"), on, "left")
    return found.select(*[f"u.{c}" for c in own], *[f"p.{c}" for c in extra])


def half_open_join(usage: DataFrame, prices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on the keys and `price_start_ts <= usage_start_time < price_end_ts`, month by month."""
    extra = [c for c in prices.columns if c not in usage.columns]
    own = usage.columns
    usage, prices = _by_month(usage, prices, "price_start_ts", "price_end_ts")
    on = (
        _on(keys)
        & (F.col("u.usage_start_time") >= F.col("p.price_start_ts"))
        & (F.col("u.usage_start_time") < F.col("p.price_end_ts"))
    )
    found = usage.alias("u").join(prices.alias("p"), on, "inner")
    return found.select(*[f"u.{c}" for c in own], *[f"p.{c}" for c in extra])


def latest_price(prices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The price row with the newest start per key; of several, the longest and cheapest."""
    newest = W.partitionBy(*keys).orderBy(
        F.col("price_start_ts").desc(), F.col("price_end_ts").desc(), F.col("unit_price")
    )
    return prices.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("rn")


def join_ground_truth(predictions: DataFrame, labels: DataFrame, row_id: str) -> DataFrame:
    """Predictions with the labels that came in later; no label yet gives NULL."""
    return predictions.join(labels, row_id, "left")
