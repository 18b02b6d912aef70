"""Every operator bound to the input tables, as (spark, sf_dir) -> DataFrame.

Each query reads its tables in full. Averages and metrics are rounded where the order of a
floating-point sum would show in the last digits; 1e-9 on top keeps exact halves, which means of
two-digit amounts often are, from going either way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions import metrics as M
from fareloom.functions import timefn as tf
from fareloom.functions.predicates import all_positive, filter_by_ts, positive_if_present
from fareloom.functions.projections import numeric_frame
from fareloom.operators import compare, drift, knn, latency, models, quality, split, validity
from fareloom.operators.asof import FeatureLookup, asof_lookup, latest_per_key
from fareloom.operators.time_features import (
    dropoff_trip_count,
    pickup_zip_avg,
    sliding_features,
    sparse_key_flag,
    tumbling_features,
)
from fareloom.operators.trailing import with_trailing
from fareloom.operators.validity import join_ground_truth
from fareloom.plans import billing, features, medallion, training
from fareloom.sources import readers, tables, views
from fareloom.sources.staging import scratch_path, stage
from fareloom.streaming import layers
from fareloom.streaming.snapshot import Snapshot
from fareloom.streaming.window_features import SLIDING, TUMBLING, FeatureStream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PICKUP, DROPOFF = training.PICKUP_TS, training.DROPOFF_TS
AS_OF = "2001-11-05"
BASE_RMSE = 60.0
KNN_FEATURES = ("trip_distance", "pickup_zip")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in columns})


def _trips(spark: SparkSession, d: str) -> DataFrame:
    return views.trips(spark, d)


def _predictions(spark: SparkSession, d: str) -> DataFrame:
    return views.predictions_from_trips(_trips(spark, d))


def _billing(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    use = views.usage(spark, d)
    return use, stage(views.prices_from_usage(use), "prices")


# --- sources and sinks -----------------------------------------------------------------------


@query
def read_path(spark, d):
    ev = readers.read_path(spark, f"{d}/events.parquet")
    return ev.select("event_id", "ts", "value")


@query
def read_table(spark, d):
    tables.register_view(_trips(spark, d), "taxi_data")
    return readers.read_table(spark, "taxi_data").select("trip_id", "fare_amount", "trip_distance")


@query
def read_sql(spark, d):
    tables.register_view(_trips(spark, d), "taxi_data")
    text = "SELECT trip_id, fare_amount FROM taxi_data WHERE fare_amount > 100"
    return readers.read_sql(spark, text)


@query
def read_path_sql(spark, d):
    return readers.read_path_sql(spark, f"{d}/orders.parquet").select("o_orderkey", "o_totalprice")


@query
def read_stream(spark, d):
    """A streaming scan run to its end."""
    store = layers.run_all(spark, _trip_stream(spark, d), scratch_path(spark, "s"), "bronze_nyc_taxi")
    return store.read("bronze_nyc_taxi").drop("ingest_ts")


@query
def overwrite_path(spark, d):
    """A table replaced by one with other columns."""
    path = scratch_path(spark, "overwrite")
    tables.overwrite_path(_trips(spark, d).select("trip_id"), path)
    tables.overwrite_path(training.inference_input(_trips(spark, d)), path)
    return spark.read.parquet(path)


@query
def overwrite_table(spark, d):
    """A catalog table written twice: the second run replaces the first."""
    name = "fareloom_predictions"
    tables.overwrite_table(_trips(spark, d), name, scratch_path(spark, "table"))
    tables.overwrite_table(_predictions(spark, d), name, scratch_path(spark, "table"))
    return readers.read_table(spark, name)


@query
def feature_job(spark, d):
    """Two runs over overlapping periods: the second replaces, adds and keeps."""
    path = scratch_path(spark, "features")
    t = _trips(spark, d)
    args = dict(raw=t, feature_set="dropoff_features", path=path, ts=DROPOFF)
    features.run_feature_job(**args, end="2024-01-20")
    return features.run_feature_job(**args, start="2024-01-15").read(spark)


def _three_runs(spark, d, feature_set: str, ts: str) -> DataFrame:
    """Three runs back to back, cut off the grid of windows."""
    cuts = (None, "2024-01-12 07:10:00", "2024-01-20 18:37:30", None)
    path, t = scratch_path(spark, "features"), _trips(spark, d)
    for start, end in zip(cuts, cuts[1:]):
        table = features.run_feature_job(t, feature_set, path, ts, start=start, end=end)
    return table.read(spark)


@query
def feature_job_sliding(spark, d):
    return _three_runs(spark, d, "pickup_features", PICKUP)


@query
def feature_job_tumbling(spark, d):
    return _three_runs(spark, d, "dropoff_features", DROPOFF)


@query
def feature_job_late(spark, d):
    """Trips that arrive up to ten days after their pickup, taken in by three runs."""
    delay = F.make_interval(hours=F.pmod(F.xxhash64("trip_id"), F.lit(240)).cast("int"))
    t = _trips(spark, d).withColumn("ingested", F.col(PICKUP) + delay)
    path = scratch_path(spark, "late")
    for until in ("2024-01-12 07:10:00", "2024-01-20 18:37:30", "2100-01-01"):
        table = features.catch_up(t, "pickup_features", path, PICKUP, "ingested", until)
    return table.read(spark)


@query
def create_feature_table(spark, d):
    """A new table partitioned by month, its key checked."""
    df = sliding_features(_trips(spark, d), PICKUP)
    return tables.create_feature_table(scratch_path(spark, "t"), "zip", PICKUP, df).read(spark)


@query
def merge_upsert(spark, d):
    t = _trips(spark, d)
    old = tumbling_features(t, DROPOFF, None, "2024-01-20")
    new = tumbling_features(t, DROPOFF, "2024-01-15", None)
    return tables.merge_upsert(old, new, ["zip", DROPOFF])


@query
def key_duplicates(spark, d):
    return tables.duplicate_keys(_trips(spark, d), ["pickup_zip", "dropoff_zip"])


@query
def latest_row_per_key(spark, d):
    return latest_per_key(sliding_features(_trips(spark, d), PICKUP), ["zip"], PICKUP)


# --- scalar functions, filters, projections -------------------------------------------------


@query
def ceil_ts(spark, d):
    return _trips(spark, d).select(
        "trip_id",
        tf.ceil_ts(PICKUP, 15).alias("pickup_15"),
        tf.ceil_ts(DROPOFF, 30).alias("dropoff_30"),
    )


@query
def partition_id(spark, d):
    return _trips(spark, d).select("trip_id", tf.partition_id(DROPOFF).alias("yyyy_mm"))


@query
def is_weekend_tz(spark, d):
    return _trips(spark, d).select("trip_id", tf.is_weekend_tz(PICKUP).alias("weekend_ny"))


@query
def is_weekend(spark, d):
    return _trips(spark, d).select("trip_id", tf.is_weekend(PICKUP).alias("weekend"))


@query
def epoch_and_calendar(spark, d):
    seconds = tf.epoch_seconds(PICKUP)
    return _trips(spark, d).select(
        "trip_id",
        seconds.alias("epoch_s"),
        tf.from_epoch_seconds(seconds).alias("whole_second"),
        F.to_date(PICKUP).alias("day"),
        F.date_trunc("month", F.col(PICKUP).cast("timestamp")).cast("timestamp_ntz").alias("month"),
        tf.parse_ts(F.date_format(PICKUP, "yyyy-MM-dd HH:mm:ss")).alias("parsed"),
    )


@query
def rolling_cutoff(spark, d):
    """Usage inside the rolling 30 days and 12 months that end at a date."""
    start = F.col("usage_start_time")
    return (
        views.usage(spark, d)
        .filter(start >= tf.months_before(AS_OF, 12))
        .select("usage_id", (start >= tf.days_before(AS_OF, 30)).alias("in_30_days"))
    )


@query
def open_end(spark, d):
    _, prices = _billing(spark, d)
    return billing.flat_prices(prices)


@query
def filter_by_time(spark, d):
    return filter_by_ts(_trips(spark, d), PICKUP, "2024-01-10", "2024-01-20 12:00:00").select(
        "trip_id", PICKUP
    )


@query
def positive_fares(spark, d):
    t = positive_if_present(_trips(spark, d).drop("trip_distance"), "trip_distance")
    return t.filter(all_positive("fare_amount")).select("trip_id", "fare_amount")


@query
def serving_usage(spark, d):
    use = views.usage(spark, d)
    return billing.serving_usage(use, tf.months_before(AS_OF, 12)).select(
        "usage_id", "sku_name", "usage_quantity"
    )


@query
def numeric_columns(spark, d):
    return numeric_frame(_trips(spark, d), "fare_amount", ("trip_distance", "pickup_zip"))


@query
def label_renamed(spark, d):
    t = _trips(spark, d).select("trip_id", "fare_amount")
    return models.label_as(t, "fare_amount", "price")


# --- layers ---------------------------------------------------------------------------------


@query
def silver(spark, d):
    return medallion.silver(_trips(spark, d))


@query
def pickup_zip_average(spark, d):
    return rounded(pickup_zip_avg(medallion.silver(_trips(spark, d))), "avg_fare_per_zip")


@query
def dropoff_rows(spark, d):
    return medallion.dropoff_rows(medallion.silver(_trips(spark, d)))


@query
def dropoff_trip_counts(spark, d):
    return dropoff_trip_count(medallion.silver(_trips(spark, d)))


@query
def gold(spark, d):
    return rounded(medallion.gold_from_raw(_trips(spark, d)), "avg_fare_per_zip")


@query
def row_counts(spark, d):
    """Rows after each stage."""
    t = _trips(spark, d)
    stages = {"raw": t, "silver": medallion.silver(t), "gold": medallion.gold_from_raw(t)}
    counts = [
        df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("n_rows"))
        for name, df in stages.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def medallion_batch(spark, d):
    """All layers written and read back."""
    paths = medallion.run_batch(spark, _trips(spark, d), scratch_path(spark, "medallion"))
    return rounded(spark.read.parquet(paths["gold_nyc_taxi"]), "avg_fare_per_zip")


def _trip_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = views.events(spark, d).schema
    raw = readers.stream_path(spark, d, schema, file_glob="events.parquet")
    return views.trips_from_events(raw)


@query
def stream_silver(spark, d):
    store = layers.run_all(spark, _trip_stream(spark, d), scratch_path(spark, "s"), "silver_nyc_taxi")
    return store.read("silver_nyc_taxi")


@query
def stream_pickup_avg(spark, d):
    name = "trip_pickup_features"
    store = layers.run_all(spark, _trip_stream(spark, d), scratch_path(spark, "s"), name)
    return rounded(store.current(name), "avg_fare_per_zip")


@query
def stream_dropoff(spark, d):
    name = "trip_dropoff_features"
    store = layers.run_all(spark, _trip_stream(spark, d), scratch_path(spark, "s"), name)
    return store.read(name)


@query
def stream_gold(spark, d):
    store = layers.run_all(spark, _trip_stream(spark, d), scratch_path(spark, "s"))
    return rounded(store.read("gold_nyc_taxi"), "avg_fare_per_zip")


ARRIVALS = 6  # lots the trips of a streaming feature query come in


def _shuffled_trip_stream(spark: SparkSession, d: str) -> DataFrame:
    """All trips in lots that are not in time order, two lots to a micro-batch."""
    ev = views.events(spark, d)
    path = scratch_path(spark, "arrivals")
    ev.repartition(ARRIVALS, F.xxhash64("event_id")).write.option("maxRecordsPerFile", 0).parquet(path)
    return views.trips_from_events(readers.stream_path(spark, path, ev.schema, max_files_per_trigger=2))


@query
def stream_sliding(spark, d):
    features = FeatureStream(spark, scratch_path(spark, "s"), SLIDING, PICKUP)
    return features.run(_shuffled_trip_stream(spark, d))


@query
def stream_tumbling(spark, d):
    features = FeatureStream(spark, scratch_path(spark, "s"), TUMBLING, DROPOFF)
    return features.run(_shuffled_trip_stream(spark, d))


@query
def stream_snapshot(spark, d):
    """The newest window per ZIP, from changes that come in any order, a few files per batch."""
    changes = sliding_features(_trips(spark, d), PICKUP)
    path = scratch_path(spark, "changes")
    changes.repartition(6, F.xxhash64("zip", PICKUP)).write.parquet(path)
    stream = readers.stream_path(spark, path, changes.schema, max_files_per_trigger=2)
    return Snapshot(spark, scratch_path(spark, "snapshot"), ["zip"], PICKUP, buckets=8).run(stream)


# --- features and training sets -------------------------------------------------------------


@query
def sliding_window_features(spark, d):
    return sliding_features(_trips(spark, d), PICKUP)


@query
def tumbling_window_features(spark, d):
    return tumbling_features(_trips(spark, d), DROPOFF)


@query
def sparse_keys(spark, d):
    return sparse_key_flag(sliding_features(_trips(spark, d), PICKUP), 3)


@query
def inline_training_features(spark, d):
    df = training.inline_training_features(_trips(spark, d), keep=("trip_id",))
    return rounded(df, "mean_fare_window_1h_pickup_zip")


@query
def training_frame(spark, d):
    """The registered training data: label and features as doubles."""
    df = training.TRAINING_DATA["taxi_training_data"](_trips(spark, d))
    return rounded(df, "mean_fare_window_1h_pickup_zip")


@query
def inline_features_without_own_slot(spark, d):
    df = training.inline_training_features(
        _trips(spark, d), keep=("trip_id",), exclude_current=True
    )
    return rounded(df, "mean_fare_window_1h_pickup_zip")


@query
def trailing_seconds(spark, d):
    """A trailing frame over unrounded times, in stretches of six hours."""
    t = _trips(spark, d).select(
        "trip_id", "pickup_zip", "fare_amount", tf.epoch_seconds(PICKUP).alias("s")
    )
    df = with_trailing(
        t, "pickup_zip", "s", 3600, "trips_1h", "fare_amount", "mean_fare_1h",
        chunk=21_600,
    )
    return rounded(df, "mean_fare_1h")


@query
def asof_join(spark, d):
    """Lookup at the unrounded pickup time."""
    t = _trips(spark, d)
    lookup = FeatureLookup(
        table=sliding_features(t, PICKUP).withColumnRenamed(PICKUP, "feature_ts"),
        features=["mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip"],
        lookup_key=["dropoff_zip"],
        table_key=["zip"],
        lookup_ts=PICKUP,
        table_ts="feature_ts",
    )
    return asof_lookup(t.select("trip_id", "dropoff_zip", PICKUP), lookup)


@query
def training_set(spark, d):
    t = _trips(spark, d)
    return training.lookup_training_set(
        t, sliding_features(t, PICKUP), tumbling_features(t, DROPOFF)
    )


@query
def ground_truth_join(spark, d):
    pred = _predictions(spark, d).drop("label")
    late = _trips(spark, d).filter("fare_amount > 0").select("trip_id", "fare_amount")
    return join_ground_truth(pred, models.label_as(late), "trip_id").select(
        "trip_id", "model_id", "prediction", "price"
    )


@query
def inference_input(spark, d):
    return training.inference_input(_trips(spark, d))


# --- billing --------------------------------------------------------------------------------


@query
def validity_join(spark, d):
    use, prices = _billing(spark, d)
    return billing.priced(use, prices).select(
        "usage_id", "cloud", "sku_name", "usage_quantity", "price_per_dbu"
    )


@query
def daily_cost(spark, d):
    return billing.daily_cost(*_billing(spark, d), AS_OF)


def _monthly_billing(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    use = views.usage(spark, d)
    return use, stage(views.monthly_prices_from_usage(use), "prices")


@query
def validity_join_of_accounts(spark, d):
    """Prices change inside usage lines, and two accounts have prices of their own."""
    use, prices = _monthly_billing(spark, d)
    lookup = prices.select(
        "account_id", "cloud", "sku_name", "price_start_time", "price_end_time", F.col("pricing.default").alias("price_per_dbu")
    )
    found = validity.validity_join(use, lookup, ["cloud", "sku_name"])
    return found.select("usage_id", "account_id", "price_per_dbu")


@query
def daily_cost_with_gaps(spark, d):
    """Cost under one account's monthly prices; lines over a change show up as unpriced."""
    use, prices = _monthly_billing(spark, d)
    return billing.daily_cost(use, prices.filter("account_id = 'acct_1'"), AS_OF)


@query
def sku_cost_latest_price(spark, d):
    return billing.sku_cost_latest_price(*_billing(spark, d))


@query
def endpoint_month_cost(spark, d):
    return billing.endpoint_month_cost(*_billing(spark, d), AS_OF)


# --- metrics and monitoring -----------------------------------------------------------------

METRICS = (
    "mean_absolute_error",
    "mean_squared_error",
    "root_mean_squared_error",
    "mean_absolute_percentage_error",
    "r2_score",
    "max_error",
)


@query
def regression_metrics(spark, d):
    df = M.regression_metrics(_predictions(spark, d), "label", "prediction")
    return rounded(df, *METRICS, "sum_on_target", "mean_on_target")


@query
def custom_metric(spark, d):
    metric = F.round(M.squared_diff_plus_one("label", "prediction"), 2)
    return _predictions(spark, d).agg(metric.alias("squared_diff_plus_one"))


@query
def validate(spark, d):
    found = M.regression_metrics(_predictions(spark, d), "label", "prediction")
    return rounded(compare.validate(found), "candidate")


@query
def baseline_compare(spark, d):
    """Model 1 as the candidate, model 2 as the baseline."""
    pred = _predictions(spark, d)
    one, two = (
        M.regression_metrics(pred.filter(F.col("model_id") == m), "label", "prediction")
        for m in ("1", "2")
    )
    rules = {
        "max_error": compare.MetricThreshold(500),
        "mean_squared_error": compare.MetricThreshold(500, min_relative_change=0.01),
    }
    out = compare.baseline_compare(one, two, rules)
    return rounded(out, "candidate", "baseline", "absolute_change", "relative_change")


def _flat_window(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.col("window.start")).drop("window")


@query
def quality_profile(spark, d):
    df = quality.quality_profile(_predictions(spark, d), slices=("pickup_zip",))
    return rounded(_flat_window(df), *METRICS)


@query
def quality_profile_incremental(spark, d):
    """Three batches that cut through days, models and ZIPs, one of them given twice."""
    log = _predictions(spark, d).withColumn("_part", F.pmod(F.hash("timestamp"), F.lit(3)))
    path = scratch_path(spark, "profile")
    for batch in (0, 1, 2, 1):
        part = log.where(F.col("_part") == batch).drop("_part")
        quality.update_profile(part, path, batch, slices=("pickup_zip",))
    df = quality.read_profile(spark, path, slices=("pickup_zip",))
    return rounded(_flat_window(df), *METRICS)


@query
def column_profile(spark, d):
    df = quality.column_profile(_trips(spark, d), ("trip_distance", "fare_amount"), PICKUP)
    return rounded(_flat_window(df), "avg", "stddev")


@query
def feature_drift(spark, d):
    """Every day's distributions against the first week's."""
    t, columns = _trips(spark, d), ("trip_distance", "fare_amount")
    first = t.agg(F.min(F.date_trunc("day", PICKUP))).first()[0]
    week = F.col(PICKUP) < F.lit(first).cast("timestamp_ntz") + F.expr("INTERVAL 7 DAYS")
    counts = stage(drift.histograms(t, PICKUP, drift.limits(t.filter(week), columns)), "histograms")
    base = counts.filter(F.col("window_start") < F.lit(first).cast("timestamp_ntz") + F.expr("INTERVAL 7 DAYS"))
    return rounded(drift.drift(counts, base), "psi", "ks")


def _profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_profile(_predictions(spark, d))


@query
def recent_windows(spark, d):
    """The newest five windows of the whole table."""
    one = _predictions(spark, d).withColumn("model_id", F.lit("1"))
    recent = quality.recent_windows(quality.quality_profile(one), "root_mean_squared_error", 5)
    return rounded(_flat_window(recent), "root_mean_squared_error")


@query
def metric_violation(spark, d):
    one = _predictions(spark, d).withColumn("model_id", F.lit("1"))
    return quality.metric_violation(quality.quality_profile(one), threshold=BASE_RMSE)


@query
def metric_violation_by_model(spark, d):
    return quality.metric_violation_by_model(_profile(spark, d), threshold=BASE_RMSE)


@query
def rolling_drift(spark, d):
    return rounded(quality.rolling_drift(_predictions(spark, d), BASE_RMSE), "rolling_rmse")


@query
def retune_flag(spark, d):
    drift = quality.rolling_drift(_predictions(spark, d), 50.0)
    return rounded(quality.retune_flag(drift), "rolling_rmse").drop("is_drifted")


@query
def version_compare(spark, d):
    df = _flat_window(quality.version_compare(_profile(spark, d), ["1", "2"]))
    df = df.withColumnsRenamed({"1": "rmse_model_1", "2": "rmse_model_2"})
    return rounded(df, "rmse_model_1", "rmse_model_2")


@query
def latency_summary(spark, d):
    return latency.latency_summary(views.request_log(spark, d), 300, 20)


@query
def latency_slo(spark, d):
    return latency.latency_slo(latency.latency_summary(views.request_log(spark, d), 300, 20))


@query
def latency_sketch(spark, d):
    return latency.latency_summary_approx(views.request_log(spark, d))


@query
def latency_trend(spark, d):
    """Daily quantiles from hourly sketches, held against the ranks in the log."""
    log = views.events(spark, d).select("ts", F.col("value").alias("latency_ms"))
    probs = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    sketches = stage(latency.latency_sketches(log, "ts", "1 hour"), "sketches")
    trend = latency.latency_trend(sketches, "1 day", probs)
    found = latency.rank_errors(log, trend, "ts", "1 day", probs)
    return found.join(trend.select("window_start", F.col("requests").alias("sketched")), "window_start")


# --- splits, comparison, scoring ------------------------------------------------------------


@query
def train_test_split(spark, d):
    return split.with_split(_trips(spark, d).select("trip_id"), "trip_id")


@query
def traffic_split(spark, d):
    return split.traffic_split(_trips(spark, d).select("trip_id"), "trip_id", 90, 10)


@query
def bernoulli_sample(spark, d):
    return split.bernoulli_sample(_trips(spark, d).select("trip_id"), 0.1)


@query
def frame_diff(spark, d):
    cols = ["fare_amount", "pickup_zip", "dropoff_zip"]
    t = _trips(spark, d)
    return compare.frame_diff(t.select(*cols), medallion.silver(t).select(*cols))


@query
def frames_equal(spark, d):
    clean = medallion.silver(_trips(spark, d))
    diff = compare.frame_diff(medallion.dropoff_rows(clean), clean.drop("trip_distance"))
    return diff.agg((F.count(F.lit(1)) == 0).alias("equal"))


def _fare_rule(x):
    return 3 * x["trip_distance"] + 1


def _zip_rule(x):
    return 2.5 * x["trip_distance"] + (x["pickup_zip"] - 10000) / 4


@query
def score_batch(spark, d):
    """Feature lookup, a user model on Arrow batches, and the run's stamp."""
    t = _trips(spark, d)
    lookups = training.trip_lookups(sliding_features(t, PICKUP), tumbling_features(t, DROPOFF))

    def rule(x):
        return 3 * x["trip_distance"] + x["count_trips_window_1h_pickup_zip"].fillna(0)

    return models.score_batch(
        training.inference_input(t),
        rule,
        ("trip_distance", "count_trips_window_1h_pickup_zip"),
        "7",
        "2024-02-01 08:00:00",
        lookups,
        staged=True,
    ).select("trip_id", "prediction", "model_id", "timestamp")


@query
def score_ab(spark, d):
    t = _trips(spark, d).select("trip_id", "trip_distance", "pickup_zip")
    return models.score_ab(t, _fare_rule, _zip_rule, ("trip_distance", "pickup_zip")).select(
        "trip_id", "pred_a", "pred_b"
    )


@query
def knn_regress(spark, d):
    t = _trips(spark, d).select("trip_id", *KNN_FEATURES, "fare_amount")
    train, test = split.train_test_split(t, "trip_id")
    df = knn.knn_regress(train, test, KNN_FEATURES, "fare_amount", "trip_id")
    return rounded(df.select("trip_id", "prediction"), "prediction")


@query
def signature_sample(spark, d):
    """Ten example rows with their prediction."""
    t = models.signature_sample(_trips(spark, d).select("trip_id", "trip_distance"), 10)
    return models.score_frame(t, {"prediction": _fare_rule}, ("trip_distance",))


# --- model fitting --------------------------------------------------------------------------


def _learning_frames(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Train and hold-out rows. Staged, since a fit reads its input many times."""
    raw = _trips(spark, d)
    frame = stage(training.inline_training_features(raw, keep=("trip_id",)), "training")
    # A small file is one partition; give every core a share.
    spread = frame.repartition(spark.sparkContext.defaultParallelism, "trip_id")
    return split.train_test_split(spread, "trip_id")


def _held_out(model, test: DataFrame) -> DataFrame:
    return model.transform(test).select("trip_id", "fare_amount", "prediction")


@query
def fit_gbt(spark, d):
    train, test = _learning_frames(spark, d)
    return _held_out(models.fit_gbt(train, models.FEATURES), test)


def _with_held_out(train: DataFrame) -> DataFrame:
    """A fifth of the training rows, by hash, decide when boosting stops."""
    return train.withColumn("held", F.pmod(F.xxhash64("trip_id", F.lit("stop")), F.lit(5)) == 0)


@query
def fit_boosted(spark, d):
    train, test = _learning_frames(spark, d)
    model = models.fit_boosted(_with_held_out(train), models.FEATURES, held_out="held")
    return _held_out(model, test)


@query
def boosted_stump(spark, d):
    """One split of all trips, the best of both ZIPs, and the mean fare on its sides."""
    zips = ("pickup_zip", "dropoff_zip")
    trips = _trips(spark, d).select("trip_id", *zips, "fare_amount")
    model = models.fit_boosted(trips, zips, rounds=1, leaves=2, rate=1.0)
    # Residuals are counted in steps of the labels' range, so the last digits are not compared.
    return model.transform(trips).select("trip_id", F.round("prediction", 3).alias("prediction"))


@query
def tune_boosted(spark, d):
    """Four draws: five trees each, ten for the better two, twenty for the best."""
    train, _ = _learning_frames(spark, d)
    frame = _with_held_out(train)
    _, trials = models.tune_boosted(frame, models.FEATURES, "held", rounds=20, first=5)
    return spark.createDataFrame(
        trials, "leaves int, rate double, min_child int, grown int, rounds int, rmse double"
    )


@query
def compare_families(spark, d):
    """Twenty boosted trees, a line and the k nearest rows on the same hold-out rows."""
    train, test = _learning_frames(spark, d)
    return models.compare_models(
        _with_held_out(train),
        test,
        models.FEATURES,
        params={"boosted": {"held_out": "held", "rounds": 20}},
        families=("boosted", "elastic_net", "k_nearest"),
    )


@query
def score_gaps(spark, d):
    """A line fitted and scored on rows with ZIPs as text, gaps, and a feature without values."""
    train, test = _learning_frames(spark, d)

    def with_gaps(df: DataFrame) -> DataFrame:
        far = F.when(F.col("trip_id") % 5 != 0, F.col("trip_distance"))
        zips = {z: F.col(z).cast("string") for z in ("pickup_zip", "dropoff_zip")}
        return df.withColumns({"trip_distance": far, "tip": F.lit(None).cast("double"), **zips})

    model = models.fit_elastic_net(with_gaps(train), (*models.FEATURES, "tip"))
    return _held_out(model, with_gaps(test))


@query
def fit_elastic_net(spark, d):
    train, test = _learning_frames(spark, d)
    return _held_out(models.fit_elastic_net(train, models.FEATURES), test)


@query
def fit_random_forest(spark, d):
    train, test = _learning_frames(spark, d)
    return _held_out(models.fit_random_forest(train, models.FEATURES), test)


@query
def tune(spark, d):
    train, _ = _learning_frames(spark, d)
    _, trials = models.tune(train, models.FEATURES)
    return spark.createDataFrame(trials, "leaves int, rate double, min_child int, rmse double")


@query
def compare_models(spark, d):
    train, test = _learning_frames(spark, d)
    return models.compare_models(train, test, models.FEATURES)
