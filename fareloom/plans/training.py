"""Training frames: features looked up in feature tables, or computed inline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from fareloom.functions.projections import numeric_frame
from fareloom.functions.timefn import ceil_ts, epoch_seconds, is_weekend
from fareloom.operators.asof import FeatureLookup, create_training_set
from fareloom.operators.models import FEATURES, LABEL
from fareloom.operators.trailing import with_trailing

PICKUP_TS, DROPOFF_TS = "tpep_pickup_datetime", "tpep_dropoff_datetime"
ROUNDED_PICKUP, ROUNDED_DROPOFF = "rounded_pickup_datetime", "rounded_dropoff_datetime"


def rounded_trips(trips: DataFrame) -> DataFrame:
    """Pickup rounded up to 15 and drop-off to 30 minutes; the raw times go."""
    return (
        trips.withColumn(ROUNDED_PICKUP, ceil_ts(PICKUP_TS, 15))
        .withColumn(ROUNDED_DROPOFF, ceil_ts(DROPOFF_TS, 30))
        .drop(PICKUP_TS, DROPOFF_TS)
    )


def inline_training_features(
    trips: DataFrame,
    keep: tuple[str, ...] = (),
    exclude_current: bool = False,
    staged: bool = True,
) -> DataFrame:
    """The label and seven features from trailing frames over the rounded times.

    Frames reach 3600 s (pickup) and 1800 s (drop-off) back from the rounded time and take in
    all trips of the same slot, the row's own among them. `exclude_current` leaves that slot
    out. `keep` names further input columns to carry along.

    Rounded times give a key at most 96 or 48 peers a day, so the frames need no chunking.
    """
    df = (
        rounded_trips(trips)
        .withColumn("_pickup_s", epoch_seconds(ROUNDED_PICKUP))
        .withColumn("_dropoff_s", epoch_seconds(ROUNDED_DROPOFF))
        .withColumn("dropoff_is_weekend", is_weekend(ROUNDED_DROPOFF))
        .select(
            *keep,
            LABEL,
            "trip_distance",
            "pickup_zip",
            "dropoff_zip",
            "dropoff_is_weekend",
            "_pickup_s",
            "_dropoff_s",
        )
    )
    source = df
    df = with_trailing(
        df,
        "pickup_zip",
        "_pickup_s",
        3600,
        count_as="count_trips_window_1h_pickup_zip",
        mean_of=LABEL,
        mean_as="mean_fare_window_1h_pickup_zip",
        include_current=not exclude_current,
        frame_of=source,
        staged=staged,
    )
    df = with_trailing(
        df,
        "dropoff_zip",
        "_dropoff_s",
        1800,
        count_as="count_trips_window_30m_dropoff_zip",
        include_current=not exclude_current,
        frame_of=source,
        staged=staged,
    )
    return df.select(*keep, LABEL, *FEATURES)


def training_frame(trips: DataFrame, staged: bool = True) -> DataFrame:
    """`inline_training_features` as doubles, ready for a vector assembler."""
    return numeric_frame(inline_training_features(trips, staged=staged), LABEL, FEATURES)


def trip_lookups(pickup_table: DataFrame, dropoff_table: DataFrame) -> list[FeatureLookup]:
    """The two feature lookups of a trip. Its rounded times need no chunking."""
    return [
        FeatureLookup(
            table=pickup_table,
            features=["mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip"],
            lookup_key=["pickup_zip"],
            table_key=["zip"],
            lookup_ts=ROUNDED_PICKUP,
            table_ts=PICKUP_TS,
            chunk_seconds=None,
        ),
        FeatureLookup(
            table=dropoff_table,
            features=["count_trips_window_30m_dropoff_zip", "dropoff_is_weekend"],
            lookup_key=["dropoff_zip"],
            table_key=["zip"],
            lookup_ts=ROUNDED_DROPOFF,
            table_ts=DROPOFF_TS,
            chunk_seconds=None,
        ),
    ]


def lookup_training_set(
    trips: DataFrame, pickup_table: DataFrame, dropoff_table: DataFrame, staged: bool = True
) -> DataFrame:
    """Rounded trips with point-in-time features; the times themselves are left out."""
    return create_training_set(
        rounded_trips(trips),
        trip_lookups(pickup_table, dropoff_table),
        label=LABEL,
        exclude=[ROUNDED_PICKUP, ROUNDED_DROPOFF],
        staged=staged,
    )


def inference_input(trips: DataFrame) -> DataFrame:
    """Scoring input: rounded times, no label."""
    return rounded_trips(trips).drop(LABEL)


# Training-data contract: raw trips -> label and features.
TrainingData = Callable[[DataFrame], DataFrame]
TRAINING_DATA: dict[str, TrainingData] = {"taxi_training_data": training_frame}


def register_training_data(name: str, fn: TrainingData) -> None:
    TRAINING_DATA[name] = fn
