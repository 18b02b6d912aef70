"""The feature job: compute a registered feature set and keep its table up to date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.predicates import wall_clock
from fareloom.operators.time_features import (
    TUMBLE_MINUTES,
    WINDOW_MINUTES,
    Bound,
    sliding_features,
    tumbling_features,
)
from fareloom.sources.staging import stage
from fareloom.sources.tables import (
    FeatureTable,
    create_feature_table,
    feature_table_exists,
    parse_keys,
    upsert_feature_table,
)

# Feature contract: (input, timestamp column, start, end) -> features with `yyyy_mm`.
ComputeFeatures = Callable[[DataFrame, str, Bound, Bound], DataFrame]

FEATURE_SETS: dict[str, ComputeFeatures] = {
    "pickup_features": sliding_features,
    "dropoff_features": tumbling_features,
}

# Minutes of input before its end that a window reads; sets without an entry have no windows.
REACH_MINUTES = {"pickup_features": WINDOW_MINUTES, "dropoff_features": TUMBLE_MINUTES}


def register_features(name: str, fn: ComputeFeatures, reach_minutes: int | None = None) -> None:
    """With `reach_minutes`, column `ts` of the features is the end of a window of that length."""
    FEATURE_SETS[name] = fn
    REACH_MINUTES.pop(name, None)
    if reach_minutes:
        REACH_MINUTES[name] = reach_minutes


def compute_features(
    name: str, df: DataFrame, ts: str, start: Bound = None, end: Bound = None
) -> DataFrame:
    if name not in FEATURE_SETS:
        raise KeyError(f"no feature set {name}; known: {sorted(FEATURE_SETS)}")
    return FEATURE_SETS[name](df, ts, start, end)


def whole_windows(
    name: str, df: DataFrame, ts: str, start: Bound = None, end: Bound = None
) -> DataFrame:
    """The windows that end in (start, end], each from all of its input.

    The input is read from one window length before `start`. A window that is not over at `end` is
    left to the next run, so runs back to back write what one run over everything would.
    """
    reach = REACH_MINUTES.get(name)
    if not reach:
        return compute_features(name, df, ts, start, end)
    kind = df.schema[ts].dataType
    after = F.lit(wall_clock(start)).cast(kind) if start else None
    if start:
        df = df.filter(F.col(ts) >= after - F.expr(f"INTERVAL {reach} MINUTES"))
    found = compute_features(name, df, ts, None, end)
    if start:
        found = found.filter(F.col(ts) > after)
    if end:
        found = found.filter(F.col(ts) <= F.lit(wall_clock(end)).cast(kind))
    return found


def run_feature_job(
    raw: DataFrame,
    feature_set: str,
    path: str,
    ts: str,
    keys: str = "zip",
    start: Bound = None,
    end: Bound = None,
) -> FeatureTable:
    """Create the table on the first run, then merge this run's rows into it."""
    _require(feature_set=feature_set, path=path, ts=ts)
    return _put(whole_windows(feature_set, raw, ts, start, end), path, keys, ts)


def _require(**arguments: str) -> None:
    for name, value in arguments.items():
        if not value:
            raise ValueError(f"{name} is required")


def _put(features: DataFrame, path: str, keys: str, ts: str) -> FeatureTable:
    # Computed once: the key check, the list of months and the merge all read the staged rows.
    features = stage(features, "features")
    existed = feature_table_exists(features.sparkSession, path)
    table = create_feature_table(path, keys, ts, features)
    if existed:
        upsert_feature_table(table, features)
    return table


def ledger_path(path: str) -> str:
    """Where the arrival times taken into a feature table are kept."""
    return f"{path.rstrip('/')}_ledger"


def _same(left: DataFrame, right: DataFrame, names: list[str]):
    """Equality of the named columns with those numbered _k0, _k1, ..; a null equals a null."""
    hit = F.lit(True)
    for i, name in enumerate(names):
        hit = hit & left[name].eqNullSafe(right[f"_k{i}"])
    return hit


def touched_windows(
    feature_set: str, known: DataFrame, new: DataFrame, ts: str, keys: str = "zip"
) -> DataFrame:
    """The windows that rows of `new` fall into, each computed from all of `known`.

    The new rows alone tell which windows those are. Only the days such a window reads are taken from
    `known`, before anything is shuffled; a feature set without a reach reads all of it.
    """
    names = [k for k in parse_keys(keys) if k != ts] + [ts]
    hit = compute_features(feature_set, new, ts).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(names)])
    hit = stage(hit.distinct(), "touched")
    reach = REACH_MINUTES.get(feature_set)
    if reach:
        end = F.col(f"_k{len(names) - 1}")
        first, last = F.to_date(end - F.expr(f"INTERVAL {reach} MINUTES")), F.to_date(end)
        days = stage(hit.select(F.explode(F.sequence(first, last)).alias("_day")).distinct(), "days")
        known = known.join(days, F.to_date(known[ts]) == days["_day"], "left_semi")
    found = compute_features(feature_set, known, ts)
    return found.join(hit, _same(found, hit, names), "left_semi")


def catch_up(
    raw: DataFrame,
    feature_set: str,
    path: str,
    ts: str,
    ingested: str,
    until: Bound,
    keys: str = "zip",
) -> FeatureTable:
    """Take the rows that arrived since the last run, up to `until`, into the table, however late they are.

    `ingested` is the column of arrival times; rows without one were there from the start. Windows that
    new rows fall into are computed anew from all rows known by then and merged; no other window is
    touched, so after any number of runs the table is what one run over everything would write. The
    ledger beside the table gets `until` last: a run that died before is done again by the next one,
    which writes the same windows. Arrival times must not be given out below a mark already taken.
    """
    _require(feature_set=feature_set, path=path, ts=ts, ingested=ingested)
    spark, arrived = raw.sparkSession, F.col(ingested)
    until = F.lit(wall_clock(until)).cast(raw.schema[ingested].dataType)
    known = raw.filter(arrived.isNull() | (arrived <= until))
    ledger = ledger_path(path)
    mark = spark.read.parquet(ledger).agg(F.max("until")).first()[0] if feature_table_exists(spark, ledger) else None
    if mark is None:
        table = _put(compute_features(feature_set, known, ts), path, keys, ts)
    else:
        new = known.filter(arrived > F.lit(mark).cast(raw.schema[ingested].dataType))
        table = _put(touched_windows(feature_set, known, new, ts, keys), path, keys, ts)
    spark.range(1).select(until.alias("until")).coalesce(1).write.mode("append").parquet(ledger)
    return table
