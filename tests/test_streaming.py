import random
from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from fareloom.operators.compare import frames_equal
from fareloom.operators.time_features import pickup_zip_avg, sliding_features, tumbling_features
from fareloom.plans import medallion
from fareloom.sources.readers import stream_path
from fareloom.streaming import layers
from fareloom.streaming.window_features import KEPT_VERSIONS, SLIDING, TUMBLING, FeatureStream

TRIP = "fare_amount double, trip_distance double, pickup_zip string, dropoff_zip string"


def arrive(spark, path, rows):
    spark.createDataFrame(rows, TRIP).coalesce(1).write.mode("append").parquet(path)


def update(spark, src, root, max_files=10_000):
    raw = stream_path(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=max_files)
    return layers.run_all(spark, raw, root, max_files=max_files)


def test_two_updates_equal_the_batch_run(spark, tmp_path):
    src, root = str(tmp_path / "raw"), str(tmp_path / "run")
    first = [(10.0, 1.0, "a", "x"), (-1.0, 1.0, "a", "x"), (20.0, 2.0, "b", "x")]
    arrive(spark, src, first)
    store = update(spark, src, root)
    batch = medallion.gold_from_raw(spark.createDataFrame(first, TRIP))
    assert frames_equal(store.read("gold_nyc_taxi"), batch)

    arrive(spark, src, [(30.0, 1.0, "a", "y")])
    store = update(spark, src, root)
    assert store.read("bronze_nyc_taxi").count() == 4
    silver = medallion.silver(spark.read.parquet(src))
    assert frames_equal(store.read("silver_nyc_taxi"), silver)
    assert frames_equal(store.current("trip_pickup_features"), pickup_zip_avg(silver))
    # Rows joined earlier keep the averages of that time; the new row has the new ones.
    gold = store.read("gold_nyc_taxi").filter("pickup_zip = 'a'").orderBy("fare_amount").collect()
    assert [(r["fare_amount"], r["avg_fare_per_zip"], r["trip_count"]) for r in gold] == [
        (10.0, 10.0, 2),
        (30.0, 20.0, 1),
    ]

    # Nothing new: nothing is added.
    store = update(spark, src, root)
    assert store.read("gold_nyc_taxi").count() == 3


def test_a_backlog_in_many_batches_equals_one(spark, tmp_path):
    src = str(tmp_path / "raw")
    for i in range(4):
        arrive(spark, src, [(10.0 + i, 1.0, "a", "x"), (5.0, 1.0, "b", f"y{i}")])
    one = update(spark, src, str(tmp_path / "one"))
    many = update(spark, src, str(tmp_path / "many"), max_files=1)
    assert frames_equal(one.read("gold_nyc_taxi"), many.read("gold_nyc_taxi"))
    assert many.read("trip_pickup_features").select("version").distinct().count() == 4


def test_batch_run_writes_all_layers(spark, tmp_path):
    raw = spark.createDataFrame([(10.0, 1.0, "a", "x"), (5.0, -1.0, "a", "x")], TRIP)
    paths = medallion.run_batch(spark, raw, str(tmp_path))
    assert set(paths) == set(medallion.LAYERS)
    assert spark.read.parquet(paths["bronze_nyc_taxi"]).columns[-1] == "ingest_ts"
    assert spark.read.parquet(paths["gold_nyc_taxi"]).count() == 1


def test_unknown_layer(spark, tmp_path):
    with pytest.raises(KeyError):
        layers.run_all(spark, None, str(tmp_path), "platinum")


def test_layers_as_catalog_tables(spark, tmp_path):
    src = str(tmp_path / "raw")
    arrive(spark, src, [(10.0, 1.0, "a", "x")])
    for expected in (10.0, 15.0):
        store = update(spark, src, str(tmp_path / "run"))
        store.register("taxi")
        assert spark.table("taxi.trip_pickup_features").first()["avg_fare_per_zip"] == expected
        arrive(spark, src, [(20.0, 1.0, "a", "x")])
    for name, layer in medallion.LAYERS.items():
        facts = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED taxi.{name}").collect()}
        assert facts["Comment"] == layer.comment
        assert f"quality={layer.properties['quality']}" in facts["Table Properties"]


def test_update_before_any_data(spark, tmp_path):
    src, root = str(tmp_path / "raw"), str(tmp_path / "run")
    (tmp_path / "raw").mkdir()
    schema = spark.createDataFrame([], TRIP).schema
    raw = stream_path(spark, src, schema)
    store = layers.run_all(spark, raw, root)
    assert store.read("gold_nyc_taxi").count() == 0
    arrive(spark, src, [(10.0, 1.0, "a", "x")])
    store = layers.run_all(spark, stream_path(spark, src, schema), root)
    assert store.read("gold_nyc_taxi").count() == 1


RIDE = "trip_id bigint, ts timestamp_ntz, fare_amount double, pickup_zip int, dropoff_zip int"
BATCH = {"sliding": (SLIDING, sliding_features), "tumbling": (TUMBLING, tumbling_features)}


def _rides():
    """Over three days, in no order of time; hot ZIP, null ZIP, null fare, null time, midnight."""
    rnd = random.Random(4)
    rows = [
        (i, dt(2024, 1, 30) + timedelta(seconds=rnd.randrange(3 * 86400)), float(rnd.randrange(4, 80)) / 4, rnd.choice((1, 1, 1, 2, None)), i % 3)
        for i in range(240)
    ]
    edge = dt(2024, 2, 1)
    return rows + [(900, edge, None, 1, 1), (901, edge - timedelta(seconds=1), 3.0, 1, 1), (902, None, 3.0, 1, 1), (903, dt(2023, 5, 5, 23, 50), 8.0, 2, 2)]


@pytest.mark.parametrize("name", BATCH)
def test_window_features_of_shuffled_files_equal_the_batch(spark, tmp_path, name):
    feature, batch = BATCH[name]
    rides, src = _rides(), str(tmp_path / "raw")
    for k in range(4):
        spark.createDataFrame(rides[k::4], RIDE).coalesce(1).write.mode("append").parquet(src)
    schema = spark.createDataFrame([], RIDE).schema

    def stream():
        return stream_path(spark, src, schema, max_files_per_trigger=1)

    own = FeatureStream(spark, str(tmp_path / "out"), feature, "ts")
    assert frames_equal(own.run(stream()), batch(spark.read.parquet(src), "ts"))

    # Another run of the job, with rows far older than any seen so far.
    late = [(950, dt(2024, 1, 30, 5, 1), 7.0, 1, 1), (951, dt(2022, 1, 1), 9.0, 9, 9)]
    spark.createDataFrame(late, RIDE).coalesce(1).write.mode("append").parquet(src)
    own = FeatureStream(spark, str(tmp_path / "out"), feature, "ts")
    assert frames_equal(own.run(stream()), batch(spark.read.parquet(src), "ts"))
    assert max(map(len, own.panes.versions().values())) <= KEPT_VERSIONS
    assert max(map(len, own.features.versions().values())) <= KEPT_VERSIONS


@pytest.mark.parametrize("name", BATCH)
@pytest.mark.parametrize("table,step", [("panes", "write"), ("features", "write")])
def test_a_batch_run_again_counts_once(spark, tmp_path, monkeypatch, name, table, step):
    """A batch may die before or after any of its writes and is then given again."""
    feature, batch = BATCH[name]
    rides = spark.createDataFrame(_rides(), RIDE)
    first, second = rides.filter("trip_id % 2 = 0"), rides.filter("trip_id % 2 = 1")
    for after in (False, True):
        own = FeatureStream(spark, str(tmp_path / f"out{after}"), feature, "ts")
        own.merge(first, 0)
        put = getattr(getattr(own, table), step)

        def die(*a, put=put):
            if after:
                put(*a)
            raise RuntimeError("executor lost")

        monkeypatch.setattr(getattr(own, table), step, die)
        with pytest.raises(RuntimeError, match="executor lost"):
            own.merge(second, 1)
        again = FeatureStream(spark, own.root, feature, "ts")
        again.merge(second, 1)
        again.merge(second, 1)
        assert frames_equal(again.read(rides), batch(rides, "ts"))


def test_window_features_before_any_trip(spark, tmp_path):
    none = spark.createDataFrame([], RIDE)
    own = FeatureStream(spark, str(tmp_path / "out"), SLIDING, "ts")
    own.merge(none, 0)
    assert own.read(none).columns == sliding_features(none, "ts").columns
    assert own.read(none).count() == 0
