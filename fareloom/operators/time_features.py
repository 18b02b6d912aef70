"""Per-key time-window features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.predicates import filter_by_ts
from fareloom.functions.timefn import is_weekend_tz, partition_id

Bound = str | datetime | None

WINDOW_MINUTES = 60
SLIDE_MINUTES = 15
TUMBLE_MINUTES = 30


def sliding_panes(df: DataFrame, ts: str) -> DataFrame:
    """zip, pane_end, fares, priced and trips per pickup ZIP and 15 minutes; sums that can be merged."""
    fare = F.col("fare_amount").cast("double")
    return (
        df.groupBy(F.col("pickup_zip").alias("zip"), F.window(ts, f"{SLIDE_MINUTES} minutes").alias("pane"))
        .agg(
            F.sum(fare).alias("fares"),
            F.count(fare).alias("priced"),
            F.count(F.lit(1)).alias("trips"),
        )
        .select("zip", F.col("pane.end").alias("pane_end"), "fares", "priced", "trips")
    )


def sliding_from_panes(panes: DataFrame, ts: str) -> DataFrame:
    """The windows that hold any of the panes, one pane per ZIP and time."""
    slide = F.expr(f"INTERVAL {SLIDE_MINUTES} MINUTES")
    reach = F.expr(f"INTERVAL {WINDOW_MINUTES - SLIDE_MINUTES} MINUTES")
    ends = F.sequence(F.col("pane_end"), F.col("pane_end") + reach, slide)
    return (
        panes.select("zip", F.explode(ends).alias(ts), "fares", "priced", "trips")
        .groupBy("zip", ts)
        .agg(
            F.try_divide(F.sum("fares"), F.sum("priced")).alias("mean_fare"),
            F.sum("trips").alias("trips"),
        )
        .select(
            "zip",
            ts,
            partition_id(ts).alias("yyyy_mm"),
            F.col("mean_fare").cast("float").alias("mean_fare_window_1h_pickup_zip"),
            F.col("trips").cast("int").alias("count_trips_window_1h_pickup_zip"),
        )
    )


def sliding_features(
    df: DataFrame, ts: str, start: Bound = None, end: Bound = None
) -> DataFrame:
    """Mean fare and trip count per pickup ZIP over one hour, every 15 minutes.

    Trips are first reduced to one (sum, count) per ZIP and 15-minute pane, combined before the
    shuffle, and only the panes are spread over the four windows they belong to. Expanding the
    trips themselves would put four times the rows through the aggregate. A busy ZIP is spread
    over its panes and costs no more than one row per pane and task in the shuffle.
    """
    return sliding_from_panes(sliding_panes(filter_by_ts(df, ts, start, end), ts), ts)


def tumbling_panes(df: DataFrame, ts: str) -> DataFrame:
    """zip, pane_end and trips per dropoff ZIP and half hour."""
    return (
        df.groupBy(F.col("dropoff_zip").alias("zip"), F.window(ts, f"{TUMBLE_MINUTES} minutes").alias("pane"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .select("zip", F.col("pane.end").alias("pane_end"), "trips")
    )


def tumbling_from_panes(panes: DataFrame, ts: str) -> DataFrame:
    """A pane is a window here."""
    end = F.col("pane_end")
    return panes.select(
        "zip",
        end.alias(ts),
        partition_id(end).alias("yyyy_mm"),
        F.col("trips").cast("int").alias("count_trips_window_30m_dropoff_zip"),
        is_weekend_tz(end).alias("dropoff_is_weekend"),
    )


def tumbling_features(
    df: DataFrame, ts: str, start: Bound = None, end: Bound = None
) -> DataFrame:
    """Trip count per dropoff ZIP and half hour, with the weekend flag of the window end."""
    return tumbling_from_panes(tumbling_panes(filter_by_ts(df, ts, start, end), ts), ts)


def pickup_zip_avg(df: DataFrame) -> DataFrame:
    """Average fare per pickup ZIP."""
    return (
        df.groupBy("pickup_zip")
        .agg(F.avg("fare_amount").alias("avg_fare_per_zip"))
        .withColumnRenamed("pickup_zip", "zip")
    )


def dropoff_trip_count(df: DataFrame) -> DataFrame:
    """Trips per dropoff ZIP."""
    return df.groupBy("dropoff_zip").agg(F.count(F.lit(1)).alias("trip_count"))


def sparse_key_flag(features: DataFrame, minimum: int = 50) -> DataFrame:
    """Mark windows with too few trips for a steady mean."""
    few = F.col("count_trips_window_1h_pickup_zip") < minimum
    return features.withColumn("is_sparse", few.cast("int"))
