"""Bronze, silver and gold as functions of frames, and a batch run that writes every layer.

The functions are shared with the streaming run. Silver keeps `trip_distance`, which the
drop-off step filters on, and gold joins one trip count per drop-off ZIP, so it has exactly one
row per silver row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.predicates import all_positive, positive_if_present
from fareloom.functions.projections import add_ingest_ts
from fareloom.operators.time_features import dropoff_trip_count, pickup_zip_avg
from fareloom.sources.staging import stage


@dataclass(frozen=True)
class Layer:
    name: str
    comment: str
    properties: dict[str, str]


# Fixed names, comments and quality tags of the layers.
LAYERS = {
    layer.name: layer
    for layer in (
        Layer("bronze_nyc_taxi", "Raw NYC taxi demo subset", {"quality": "bronze"}),
        Layer("silver_nyc_taxi", "Cleaned trips (positive fare)", {"quality": "silver"}),
        Layer("trip_pickup_features", "Average fare per pickup ZIP", {"quality": "gold"}),
        Layer(
            "trip_dropoff_features",
            "Gold-quality features for ML models (one row per trip drop-off)",
            {"quality": "gold"},
        ),
        Layer("trip_dropoff_counts", "Trips per drop-off ZIP", {"quality": "gold"}),
        Layer("gold_nyc_taxi", "Denormalised training set", {"quality": "gold"}),
    )
}


def bronze(raw: DataFrame) -> DataFrame:
    return add_ingest_ts(raw)


def silver(bronze_df: DataFrame) -> DataFrame:
    """Trips with a positive fare and, where known, a positive distance."""
    kept = [
        c
        for c in ("fare_amount", "trip_distance", "pickup_zip", "dropoff_zip")
        if c in bronze_df.columns
    ]
    return positive_if_present(bronze_df, "trip_distance").filter(F.col("fare_amount") > 0).select(
        *kept
    )


def dropoff_rows(silver_df: DataFrame) -> DataFrame:
    """One row per valid trip drop-off."""
    return silver_df.filter(all_positive("fare_amount", "trip_distance")).select(
        "fare_amount", "pickup_zip", "dropoff_zip"
    )


def gold(silver_df: DataFrame, pickup: DataFrame, counts: DataFrame) -> DataFrame:
    """Silver rows with the averages of their pickup and the trips of their drop-off ZIP."""
    return (
        silver_df.join(pickup.withColumnRenamed("zip", "pickup_zip"), "pickup_zip", "left")
        .join(counts, "dropoff_zip", "left")
        .select("fare_amount", "pickup_zip", "dropoff_zip", "avg_fare_per_zip", "trip_count")
    )


def zip_tables(silver_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`pickup_zip_avg` and `dropoff_trip_count` from one pass over the trips, staged."""
    sums = silver_df.groupingSets(
        [["pickup_zip"], ["dropoff_zip"]], "pickup_zip", "dropoff_zip"
    ).agg(
        F.avg("fare_amount").alias("avg_fare_per_zip"),
        F.count(F.lit(1)).alias("trip_count"),
        F.grouping("pickup_zip").alias("by_dropoff"),
    )
    kept = stage(sums, "zips")
    return (
        kept.filter("by_dropoff = 0").select(F.col("pickup_zip").alias("zip"), "avg_fare_per_zip"),
        kept.filter("by_dropoff = 1").select("dropoff_zip", "trip_count"),
    )


def gold_from_raw(raw: DataFrame, staged: bool = True) -> DataFrame:
    """Gold without stored layers. Staging gives the per-ZIP tables a measured size."""
    clean = silver(raw)
    if staged:
        return gold(clean, *zip_tables(clean))
    return gold(clean, pickup_zip_avg(clean), dropoff_trip_count(dropoff_rows(clean)))


def run_batch(spark: SparkSession, raw: DataFrame, root: str) -> dict[str, str]:
    """Write every layer once, upstream first; each step reads what the one before it stored."""
    paths = {name: f"{root}/{name}" for name in LAYERS}

    def put(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(paths[name])
        return spark.read.parquet(paths[name])

    b = put("bronze_nyc_taxi", bronze(raw))
    s = put("silver_nyc_taxi", silver(b))
    pickup = put("trip_pickup_features", pickup_zip_avg(s))
    drops = put("trip_dropoff_features", dropoff_rows(s))
    counts = put("trip_dropoff_counts", dropoff_trip_count(drops))
    put("gold_nyc_taxi", gold(s, pickup, counts))
    return paths
