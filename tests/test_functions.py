from datetime import datetime as dt
from datetime import timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fareloom.functions import metrics as M
from fareloom.functions import timefn as tf
from fareloom.functions.predicates import filter_by_ts, positive_if_present
from fareloom.functions.projections import add_ingest_ts, split_xy, with_model_stamp


def one_column(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_ceil_ts_edges(spark, kind):
    cases = [
        ("2024-03-01 10:00:00", dt(2024, 3, 1, 10, 0)),
        ("2024-03-01 10:00:00.000001", dt(2024, 3, 1, 10, 15)),
        ("2024-03-01 10:14:59.999999", dt(2024, 3, 1, 10, 15)),
        ("2024-03-01 10:15:00", dt(2024, 3, 1, 10, 15)),
        ("2024-12-31 23:59:59", dt(2025, 1, 1, 0, 0)),
        ("1969-12-31 23:50:00", dt(1970, 1, 1, 0, 0)),
        (None, None),
    ]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, s string")
    df = df.orderBy("i").select(tf.ceil_ts(F.col("s").cast(kind), 15).alias("r"))
    assert df.schema["r"].dataType.simpleString() == "timestamp_ntz"
    assert one_column(df) == [b for _, b in cases]


def test_ceil_ts_needs_a_divisor_of_the_hour():
    with pytest.raises(ValueError):
        tf.ceil_ts("t", 25)


def test_weekend_depends_on_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2022-01-10 03:00:00' AS t")
    assert df.select(tf.is_weekend_tz("t"), tf.is_weekend_tz("t", "UTC"), tf.is_weekend("t")).first()[
        0:3
    ] == (1, 0, 0)


def test_partition_id_of_midnight_is_the_new_month(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-02-01 00:00:00' AS t")
    assert df.select(tf.partition_id("t")).first()[0] == "2024-02"


def test_filter_by_ts_is_half_open(spark):
    days = [dt(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    assert one_column(filter_by_ts(df, "t", dt(2024, 1, 1), "2024-01-03")) == days[:2]
    new_york = timezone(timedelta(hours=-5))
    aware = dt(2024, 1, 1, 19, tzinfo=new_york)  # 2024-01-02 00:00 in UTC
    assert one_column(filter_by_ts(df, "t", aware)) == days[1:]
    assert one_column(filter_by_ts(df, "t", "", None)) == days
    assert one_column(filter_by_ts(df, None, "2024-01-02", None)) == days


def test_time_bound_reaches_the_scan(spark, small, capsys):
    df = spark.read.parquet(f"{small}/events.parquet")
    filter_by_ts(df, "ts", "2024-01-10", "2024-01-20").explain()
    assert "GreaterThanOrEqual(ts" in capsys.readouterr().out


def test_filter_on_a_missing_column_is_skipped(spark):
    df = spark.createDataFrame([(-1,)], "a int")
    assert positive_if_present(df, "b").count() == 1
    assert positive_if_present(df, "a").count() == 0


def test_metrics_skip_rows_without_label(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (3.0, 3.0), (None, 9.0), (5.0, None)], "y double, p double"
    )
    got = M.regression_metrics(df, "y", "p", {"custom": M.squared_diff_plus_one("y", "p")}).first()
    assert got["example_count"] == 2
    assert got["mean_squared_error"] == 0.5
    assert got["max_error"] == 1.0
    assert got["sum_on_target"] == 4.0
    assert got["r2_score"] == 0.5
    assert got["custom"] == 5.0


def test_metrics_of_nothing(spark):
    got = M.regression_metrics(spark.createDataFrame([], "y double, p double"), "y", "p").first()
    assert got["example_count"] == 0 and got["root_mean_squared_error"] is None


def test_stamps_and_split(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    row = with_model_stamp(df, "3", "2024-02-01 08:00:00").first()
    assert (row["model_id"], row["timestamp"]) == ("3", dt(2024, 2, 1, 8))
    assert "ingest_ts" in add_ingest_ts(df).columns
    x, y = split_xy(df, "y")
    assert (x.columns, y.columns) == (["x"], ["y"])
