"""Late rows end up in the feature table; the snapshot equals the newest rows whatever the order."""

import random
from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from fareloom.operators.compare import frames_equal
from fareloom.operators.time_features import sliding_features, tumbling_features
from fareloom.plans import features
from fareloom.sources.readers import stream_path
from fareloom.streaming.snapshot import Snapshot, newest_rows
from fareloom.streaming.window_features import KEPT_VERSIONS

TRIP = "pickup_zip string, dropoff_zip string, fare_amount double, at timestamp_ntz, ingested timestamp_ntz"


def trips(spark, n=400):
    rnd = random.Random(5)
    rows = []
    for _ in range(n):
        # A third of the rows is in one ZIP; some have none, some no arrival time.
        zips = [rnd.choice(["hot", rnd.choice("abc"), None]) for _ in range(2)]
        at = dt(2024, 1, 30) + timedelta(minutes=rnd.randrange(4 * 24 * 60))
        rows.append((*zips, float(rnd.randrange(50)), at, at + timedelta(hours=rnd.randrange(100)) if rnd.random() < 0.9 else None))
    return spark.createDataFrame(rows, TRIP)


@pytest.mark.parametrize("name, fn", [("pickup_features", sliding_features), ("dropoff_features", tumbling_features)])
def test_late_rows_equal_one_run(spark, tmp_path, name, fn):
    raw, path = trips(spark), str(tmp_path / name)
    for until in ("2024-01-31 03:07:00", "2024-02-02", "2024-02-02", "2024-03-01"):
        table = features.catch_up(raw, name, path, "at", "ingested", until)
        known = raw.filter(F.col("ingested").isNull() | (F.col("ingested") <= until))
        assert frames_equal(table.read(spark), fn(known, "at"))


def test_a_run_that_died_before_its_mark(spark, tmp_path, monkeypatch):
    raw, path = trips(spark), str(tmp_path / "t")
    features.catch_up(raw, "pickup_features", path, "at", "ingested", "2024-02-01")
    put = features._put

    def die(*args):
        put(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(features, "_put", die)
    with pytest.raises(RuntimeError):
        features.catch_up(raw, "pickup_features", path, "at", "ingested", "2024-03-01")
    monkeypatch.undo()
    assert spark.read.parquet(features.ledger_path(path)).count() == 1
    table = features.catch_up(raw, "pickup_features", path, "at", "ingested", "2024-03-01")
    assert frames_equal(table.read(spark), sliding_features(raw, "at"))


def test_only_touched_windows_are_written(spark):
    raw = trips(spark)
    new = spark.createDataFrame([("a", "b", 5.0, dt(2024, 1, 31, 0, 10), dt(2024, 3, 1))], TRIP)
    found = features.touched_windows("pickup_features", raw.unionByName(new), new, "at")
    want = sliding_features(raw.unionByName(new), "at").filter(
        "zip = 'a' and at > '2024-01-31 00:10:00' and at <= '2024-01-31 01:10:00'"
    )
    assert found.count() == 4 and frames_equal(found, want)


def test_no_new_rows_and_an_empty_table(spark, tmp_path):
    raw = trips(spark).limit(0)
    for until in ("2024-02-01", "2024-02-02"):
        table = features.catch_up(raw, "pickup_features", str(tmp_path / "e"), "at", "ingested", until)
        assert table.read(spark).count() == 0


CHANGE = "zip string, at timestamp_ntz, fare double, note string"


def changes(n=300):
    rnd = random.Random(9)
    rows = [
        (rnd.choice(["hot", "hot", *"abcdefgh", None]), dt(2024, 1, 1) + timedelta(hours=rnd.randrange(40)) if rnd.random() < 0.9 else None,
         float(rnd.randrange(9)), rnd.choice(["x", "", None]))
        for _ in range(n)
    ]
    return rows + [("never", None, 1.0, None)]


def by_hand(rows):
    best = {}
    order = lambda r: tuple((v is not None, v if v is not None else 0) for v in r[1:3]) + ((r[3] is not None, r[3] or ""),)
    for r in rows:
        if r[0] not in best or order(r) > order(best[r[0]]):
            best[r[0]] = r
    return sorted(best.values(), key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_snapshot_of_shuffled_batches(spark, tmp_path):
    rows, src, root = changes(), str(tmp_path / "src"), str(tmp_path / "root")
    want = by_hand(rows)
    assert collected(newest_rows(spark.createDataFrame(rows, CHANGE), ["zip"], "at")) == want
    random.Random(1).shuffle(rows)
    schema = spark.createDataFrame([], CHANGE).schema
    assert Snapshot(spark, root, ["zip"], "at", 4).read(schema).count() == 0
    for part in (rows[:100], rows[100:101], rows[101:]):  # a new process for each part
        spark.createDataFrame(part, CHANGE).repartition(2).write.mode("append").parquet(src)
        got = Snapshot(spark, root, ["zip"], "at", 4).run(stream_path(spark, src, schema, max_files_per_trigger=1))
    assert collected(got) == want
    kept = Snapshot(spark, root, ["zip"], "at", 4).rows.versions()
    assert len(kept) <= 4 and all(len(v) <= KEPT_VERSIONS for v in kept.values())


def test_snapshot_batch_run_again(spark, tmp_path):
    rows = changes()
    snap = Snapshot(spark, str(tmp_path / "s"), ["zip"], "at", 4)
    parts = [spark.createDataFrame(rows[k::3], CHANGE) for k in range(3)]
    for batch_id, k in enumerate((2, 0, 0, 1)):
        snap.merge(parts[k], batch_id)
    snap.merge(parts[1], 3)
    assert collected(snap.read(parts[0].schema)) == by_hand(rows)
