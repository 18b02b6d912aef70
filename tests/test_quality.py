import math
import random
from datetime import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.operators import compare, latency, quality, split


def profile(spark, values, model="1", **over):
    rows = []
    for day, v in enumerate(values, 1):
        row = {"model_id": model, "slice_key": None, "column_name": ":table", "log_type": "INPUT"}
        row |= over
        window = (dt(2024, 1, day), dt(2024, 1, day + 1))
        rows.append(
            (window, row["model_id"], row["slice_key"], row["column_name"], row["log_type"], v)
        )
    return spark.createDataFrame(rows, quality.profile_schema())


@pytest.mark.parametrize(
    "values,want",
    [
        ([101.0, 50.0, 50.0, 50.0, 101.0], 1),  # two over, the newest over
        ([101.0, 101.0, 50.0, 50.0, 50.0], 0),  # newest is under
        ([50.0, 50.0, 50.0, 50.0, 101.0], 0),  # one over
        ([50.0, 50.0, 50.0, 100.0, 100.0], 0),  # exactly at the threshold
        ([101.0, 101.0, 101.0, 50.0, 50.0, 50.0, 50.0, 101.0], 0),  # older ones do not count
        ([101.0, 101.0], 1),  # fewer windows than asked for
        ([], 0),
        ([101.0, 101.0, None], 0),
    ],
)
def test_violation_check(spark, values, want):
    df = profile(spark, values)
    assert [r[0] for r in quality.metric_violation(df).collect()] == [want]
    by_model = [r["query_result"] for r in quality.metric_violation_by_model(df).collect()]
    assert by_model == ([want] if values else [])


def test_violation_check_reads_table_rows_only(spark):
    high = [500.0] * 5
    df = profile(spark, [1.0] * 5)
    for other in (
        profile(spark, high, model="*"),
        profile(spark, high, slice_key="zip"),
        profile(spark, high, column_name="fare"),
        profile(spark, high, log_type="BASELINE"),
    ):
        df = df.unionByName(other)
    assert quality.metric_violation(df).first()[0] == 0


def test_violation_by_model(spark):
    df = profile(spark, [101.0, 101.0], "a").unionByName(profile(spark, [101.0, 1.0], "b"))
    got = {r["model_id"]: r["query_result"] for r in quality.metric_violation_by_model(df).collect()}
    assert got == {"a": 1, "b": 0}


def test_profile_levels(spark):
    rows = [
        ("1", "x", dt(2024, 1, 1, 5), 1.0, 2.0),
        ("1", None, dt(2024, 1, 1, 6), 3.0, 6.0),
        ("2", "x", dt(2024, 1, 1, 7), 5.0, 5.0),
        ("2", "x", dt(2024, 1, 2, 7), 5.0, None),
    ]
    df = spark.createDataFrame(
        rows, "model_id string, z string, timestamp timestamp_ntz, label double, prediction double"
    )
    got = quality.quality_profile(df, slices=("z",))
    day1 = got.filter("window.start = TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    table = {r["model_id"]: r for r in day1.filter("slice_key IS NULL").collect()}
    assert {k: r["count"] for k, r in table.items()} == {"1": 2, "2": 1, "*": 3}
    assert table["1"]["mean_squared_error"] == 5.0
    assert table["*"]["max_error"] == 3.0
    sliced = day1.filter("slice_key = 'z'").collect()
    assert {(r["model_id"], r["slice_value"]): r["count"] for r in sliced} == {
        ("1", "x"): 1, ("1", None): 1, ("2", "x"): 1, ("*", "x"): 2, ("*", None): 1,
    }
    day2 = got.filter("window.start = TIMESTAMP_NTZ '2024-01-02 00:00:00' AND model_id = '2'")
    row = day2.filter("slice_key IS NULL").first()
    assert row["count"] == 1 and row["root_mean_squared_error"] is None


def test_rolling_drift_spans_gaps(spark):
    rows = [("1", dt(2024, 1, d), 0.0, float(e)) for d, e in ((1, 3), (7, 4), (9, 2))]
    df = spark.createDataFrame(
        rows, "model_id string, timestamp timestamp_ntz, label double, prediction double"
    )
    got = quality.retune_flag(quality.rolling_drift(df, 3.0)).orderBy("day").collect()
    assert [round(r["rolling_rmse"] ** 2, 6) for r in got] == [9.0, 12.5, 10.0]
    assert [r["is_drifted"] for r in got] == [0, 1, 1]
    assert [r["needs_retune"] for r in got] == [0, 1, 0]


def test_exact_quantiles_match_numpy(spark):
    rng = random.Random(3)
    values = [round(rng.lognormvariate(4, 1), 2) for _ in range(2000)] + [100.0] * 1000 + [-5.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    probs = {"a": 0.0, "b": 0.5, "c": 0.95, "d": 0.999, "e": 1.0}
    got = latency.exact_quantiles(df, "v", probs).first()
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(values, p), abs=1e-9)


PROBS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 0.99, "f": 1.0}


@pytest.mark.parametrize("kind", ["wide", "close", "outlier", "tiny", "huge", "steps"])
def test_exact_quantiles_of_any_range(spark, kind):
    rng = random.Random(8)
    values = {
        "wide": [rng.uniform(-1e9, 1e9) for _ in range(3000)],
        "close": [100 + rng.random() / 10 for _ in range(3000)],
        "outlier": [rng.random() / 10 for _ in range(3000)] + [1e18],
        "tiny": [rng.choice((1, -1)) * 10.0 ** rng.uniform(-40, 10) for _ in range(300)] + [0.0, -0.0, 5e-324, 1e-323],
        "huge": [rng.choice((1.7e308, -1.7e308, 1.0)) for _ in range(50)],
        "steps": [float(rng.randrange(3)) for _ in range(1000)] + [math.inf],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "v double").repartition(3)
    for bins in (2, latency.BINS) if kind == "close" else (latency.BINS,):
        got = latency.exact_quantiles(df, "v", PROBS, bins).first()
        order = sorted(values)
        for name, p in PROBS.items():
            at = (len(order) - 1) * p
            a, b = order[math.floor(at)], order[math.ceil(at)]
            assert got[name] == (a if a == b else pytest.approx(a + (b - a) * (at - math.floor(at))))


def test_quantile_state_is_bounded(spark):
    """No pass brings more rows to the driver than there are bins."""
    values = spark.range(50_000).select((F.rand(5) * 1e6).alias("v"))
    counted = latency._binned(values, [(0.0, 5e5), (5.1e5, 1e6)], 64)
    assert [len(c) <= 64 for c in counted.values()] == [True, True]


def test_sketches_merge_to_coarser_windows(spark):
    rng = random.Random(9)
    log = [(dt(2024, 1, 1 + i % 2, i % 24), rng.lognormvariate(4, 1)) for i in range(8000)]
    df = spark.createDataFrame([*log, (dt(2024, 1, 1), None)], "ts timestamp_ntz, latency_ms double")
    probs = {"p50": 0.5, "p99": 0.99}
    sketches = latency.latency_sketches(df, "ts", "1 hour")
    assert sketches.count() == 24
    trend = latency.latency_trend(sketches, "1 day", probs)
    for r in trend.collect():
        own = sorted(v for t, v in log if t.date() == r["window_start"].date())
        assert r["requests"] == len(own)
        for q, p in probs.items():
            assert abs(np.searchsorted(own, r[q]) / len(own) - p) <= latency.RANK_ERROR
    checks = latency.rank_errors(df, trend, "ts", "1 day", probs).collect()
    assert all(r["p50_within"] and r["p99_within"] for r in checks)
    off = trend.withColumn("p50", F.col("p50") * 2)
    assert not any(r["p50_within"] for r in latency.rank_errors(df, off, "ts", "1 day", probs).collect())


def test_quantiles_of_one_value_and_of_none(spark):
    one = spark.createDataFrame([(7.0,)], "v double")
    assert latency.exact_quantiles(one, "v", {"m": 0.5}).first()["m"] == 7.0
    assert latency.exact_quantiles(one.filter("v < 0"), "v", {"m": 0.5}).first()["m"] is None


def test_latency_limits(spark):
    log = spark.createDataFrame([(100.0, False), (180.0, True)], "latency_ms double, failed boolean")
    summary = latency.latency_summary(log, 10)
    row = summary.first()
    assert (row["requests"], row["failures"], row["reqs_per_s_observed"]) == (2, 1, 0.2)
    got = {r["metric"]: r["passed"] for r in latency.latency_slo(summary, {"avg_ms": 140, "p99_ms": 170}).collect()}
    assert got == {"avg_ms": True, "p99_ms": False}
    assert latency.latency_summary(log, 0).first()["reqs_per_s_observed"] == 0.0


def test_validation_modes(spark):
    bad = spark.createDataFrame([(600.0, 1.0)], "max_error double, mean_squared_error double")
    verdicts = compare.validate(bad)
    with pytest.raises(compare.ValidationFailed):
        compare.enforce(verdicts, "enabled")
    assert compare.enforce(verdicts, "dry_run") is False
    assert compare.enforce(verdicts, "disabled") is True
    with pytest.raises(ValueError):
        compare.enforce(verdicts, "maybe")
    edge = spark.createDataFrame([(500.0, None)], "max_error double, mean_squared_error double")
    got = {r["metric_name"]: r["passed"] for r in compare.validate(edge).collect()}
    assert got == {"max_error": True, "mean_squared_error": False}


def test_baseline_rules(spark):
    make = lambda v: spark.createDataFrame([(v,)], "mse double")
    rule = lambda **kw: {"mse": compare.MetricThreshold(500, **kw)}
    better = compare.baseline_compare(make(90.0), make(100.0), rule(min_relative_change=0.1)).first()
    assert (better["absolute_change"], better["relative_change"], better["passed"]) == (-10.0, -0.1, True)
    assert not compare.baseline_compare(
        make(95.0), make(100.0), rule(min_absolute_change=10)
    ).first()["passed"]
    assert not compare.baseline_compare(make(1.0), make(0.0), rule(min_relative_change=0.1)).first()["passed"]
    alone = compare.baseline_compare(make(1.0), None, rule(min_relative_change=0.1)).first()
    assert alone["baseline"] is None and alone["passed"]


def test_frame_diff_counts_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 2), (None, 1)], "s string, i int")
    assert [(r["i"], r["surplus"]) for r in compare.frame_diff(a, b).collect()] == [(1, 1)]
    assert not compare.frames_equal(a, b)
    assert compare.frames_equal(a, a.orderBy("i"))
    assert not compare.frames_equal(a, a.drop("s"))


def test_splits(spark):
    df = spark.range(20_000).repartition(7)
    train, test = split.train_test_split(df, "id", 0.2)
    assert train.count() + test.count() == 20_000
    assert 0.18 < test.count() / 20_000 < 0.22
    again = split.train_test_split(df.repartition(3), "id", 0.2)[1]
    assert compare.frames_equal(test, again)
    assert not compare.frames_equal(test, split.train_test_split(df, "id", 0.2, seed=7)[1])
    share = split.traffic_split(df, "id", 90, 10).filter("served_model = 'a'").count() / 20_000
    assert 0.88 < share < 0.92
    with pytest.raises(ValueError):
        split.traffic_split(df, "id", 90, 20)
    assert 0 < split.bernoulli_sample(df, 0.1).count() < 4000


def test_column_profile_counts_nulls(spark):
    df = spark.createDataFrame(
        [(dt(2024, 1, 1), 1.0), (dt(2024, 1, 1, 1), None), (dt(2024, 1, 1, 2), 3.0)],
        "t timestamp_ntz, x double",
    )
    row = quality.column_profile(df.withColumn("y", F.col("x")), ("x", "y"), "t").filter("column_name = 'y'").first()
    assert (row["num_values"], row["num_nulls"], row["avg"], row["min"], row["max"]) == (2, 1, 2.0, 1.0, 3.0)


def test_r2_of_large_labels(spark):
    """Labels near 1e9: the spread must not drown in their squares."""
    rnd = random.Random(9)
    rows = [
        (dt(2024, 1, 1, i % 24), f"m{i % 3}", "a" if i % 2 else "b", 1e9 + rnd.random() * 50, 1e9 + rnd.random() * 50)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, model_id string, s string, prediction double, label double")
    got = quality.quality_profile(df, prediction="prediction", label="label", ts="ts", model="model_id", slices=["s"])
    r = got.filter("model_id = '*' and slice_key is null").first()
    p, y = (np.array([x[k] for x in rows]) for k in (3, 4))
    assert r["r2_score"] == pytest.approx(1 - ((p - y) ** 2).sum() / ((y - y.mean()) ** 2).sum(), rel=1e-6)


def test_profile_of_batches_equals_one_run(spark, tmp_path):
    """Labels around 1e9, rows without labels, a model that comes late, a batch run again, an empty one."""
    rng = np.random.default_rng(11)
    rows = [
        (
            dt(2024, 1, 1 + int(rng.integers(0, 3)), int(rng.integers(0, 24))),
            None if i % 17 == 0 else str(int(rng.integers(0, 3))),
            None if i % 13 == 0 else 1e9 + float(rng.normal(0, 5)),
            None if i % 29 == 0 else 1e9 + float(rng.normal(0, 5)),
            int(rng.integers(0, 4)),
        )
        for i in range(900)
    ]
    schema = "timestamp timestamp, model_id string, label double, prediction double, zip int"
    batches = [rows[:500], rows[500:520], rows[520:], []]
    path = str(tmp_path / "profile")
    for i in (0, 1, 2, 3, 1):
        quality.update_profile(spark.createDataFrame(batches[i], schema), path, i, slices=("zip",))
    keys = ["window", "model_id", "slice_key", "slice_value"]

    def by_key(df):
        return {tuple(r[k] for k in keys): r for r in df.collect()}

    got = by_key(quality.read_profile(spark, path, slices=("zip",)))
    want = by_key(quality.quality_profile(spark.createDataFrame(rows, schema), slices=("zip",)))
    assert set(got) == set(want) and len(got) > 40
    for k, w in want.items():
        for name, value in w.asDict().items():
            if isinstance(value, float):
                assert got[k][name] == pytest.approx(value, rel=1e-6), (k, name)
            else:
                assert got[k][name] == value, (k, name)
