import random
from collections import Counter
from datetime import datetime as dt
from datetime import timedelta

from pyspark.sql import functions as F

from fareloom.operators.validity import half_open_join, join_ground_truth, validity_join
from fareloom.plans import billing

USAGE = (
    "usage_id int, cloud string, sku_name string, usage_unit string, usage_quantity double,"
    " usage_start_time timestamp_ntz, usage_end_time timestamp_ntz,"
    " usage_metadata struct<endpoint_name:string>"
)
PRICES = (
    "account_id string, cloud string, sku_name string, price_start_time timestamp_ntz,"
    " price_end_time timestamp_ntz,"
    " pricing struct<default:double,effective_list:struct<default:double>>"
)
SKU = "X_SERVERLESS_REAL_TIME_INFERENCE_Y"


def usage(spark, *spans, sku=SKU, unit="DBU"):
    rows = [(i, "AWS", sku, unit, 2.0, a, b, (f"ep{i % 2}",)) for i, (a, b) in enumerate(spans)]
    return spark.createDataFrame(rows, USAGE)


def prices(spark, *items, sku=SKU):
    rows = [(acct, "AWS", sku, a, b, (p, (p,))) for acct, a, b, p in items]
    return spark.createDataFrame(rows, PRICES)


JAN, FEB, MAR = dt(2024, 1, 1), dt(2024, 2, 1), dt(2024, 3, 1)
TWO_PRICES = (("a", JAN, FEB, 1.0), ("a", FEB, None, 3.0))


def test_usage_at_and_over_a_price_change(spark):
    use = usage(
        spark,
        (dt(2024, 1, 31, 23), FEB),  # ends exactly with the price
        (dt(2024, 1, 31, 23), dt(2024, 2, 1, 1)),  # spans the change
        (FEB, dt(2030, 1, 1)),  # open end
        (dt(2023, 12, 1), dt(2023, 12, 2)),  # before any price
    )
    got = billing.priced(use, prices(spark, *TWO_PRICES)).select("usage_id", "price_per_dbu")
    assert {r[0]: r[1] for r in got.collect()} == {0: 1.0, 1: None, 2: 3.0, 3: None}


def test_two_accounts_fan_out(spark):
    use = usage(spark, (JAN, dt(2024, 1, 2)))
    both = prices(spark, ("a", JAN, None, 1.0), ("b", JAN, None, 5.0))
    assert billing.priced(use, both).count() == 2


def test_validity_join_without_broadcast_keeps_every_row(spark):
    spans = [(dt(2024, 1, 1 + i % 28, i % 24), dt(2024, 1, 1 + i % 28, i % 24)) for i in range(500)]
    use = usage(spark, *spans)
    lookup = prices(spark, *TWO_PRICES).drop("pricing", "account_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert validity_join(use, lookup, ["cloud", "sku_name"]).count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_long_history_is_joined_month_by_month(spark):
    """Intervals of minutes to years, open ones, reversed ones; a match is found once."""
    rnd = random.Random(6)
    start = dt(2023, 11, 1)

    def at(days):
        return start + timedelta(minutes=rnd.randrange(days * 1440))

    history = []
    for i in range(300):
        a, b = at(120), at(150)
        history.append((f"a{i % 4}", a, None if i % 10 == 0 else b, float(i)))
    lines = [(a, a + timedelta(minutes=rnd.randrange(3000))) for a in (at(100) for _ in range(200))]
    use, lookup = usage(spark, *lines), prices(spark, *history).select("account_id", "cloud", "sku_name", "price_start_time", "price_end_time", "pricing.default")
    for bound in ("-1", "64MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        try:
            got = Counter((r["usage_id"], r["default"]) for r in validity_join(use, lookup, ["cloud", "sku_name"]).collect())
            flat = lookup.select("account_id", "sku_name", F.col("price_start_time").alias("price_start_ts"), F.coalesce("price_end_time", F.lit(dt(9999, 12, 31))).alias("price_end_ts"), "default")
            half = Counter((r["usage_id"], r["default"]) for r in half_open_join(use, flat, ["sku_name"]).collect())
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        want, inner = Counter(), Counter()
        for i, (a, b) in enumerate(lines):
            hits = [p for _, s, e, p in history if s <= a and (e is None or b <= e)]
            want.update((i, p) for p in hits or [None])
            inner.update((i, p) for _, s, e, p in history if s <= a and (e is None or a < e))
        assert got == want and half == inner
    assert validity_join(use.limit(0), lookup, ["cloud"]).count() == 0
    assert validity_join(use, lookup.limit(0), ["cloud"]).count() == len(lines)


def test_daily_cost_shows_what_has_no_price(spark):
    use = usage(spark, (JAN, dt(2024, 1, 1, 1)), (dt(2024, 1, 31, 23), dt(2024, 2, 1, 1)))
    rows = billing.daily_cost(use, prices(spark, *TWO_PRICES), "2024-01-31").collect()
    assert [(r["dbus"], r["cost_usd"], r["unpriced_dbus"]) for r in rows] == [
        (2.0, 2.0, 0.0),
        (2.0, None, 2.0),
    ]


def test_only_serving_skus_in_dbu_inside_the_window(spark):
    span = (dt(2024, 1, 5), dt(2024, 1, 5, 1))
    price = prices(spark, *TWO_PRICES)
    for other in (
        usage(spark, span, sku="JOBS_COMPUTE"),
        usage(spark, span, unit="GB"),
        usage(spark, (dt(2023, 11, 1), dt(2023, 11, 1, 1))),
    ):
        assert billing.daily_cost(other, price, "2024-01-31").count() == 0
    # The first day of the window is in.
    assert billing.daily_cost(usage(spark, (JAN, JAN)), price, "2024-01-31").count() == 1


def test_latest_price_only_counts_its_own_time(spark):
    use = usage(spark, (JAN, JAN), (FEB, FEB), (MAR, MAR))
    got = billing.sku_cost_latest_price(use, prices(spark, *TWO_PRICES)).collect()
    assert [(r["sku_name"], r["total_cost"]) for r in got] == [(SKU, 12.0)]


def test_endpoint_months_are_ordered(spark):
    use = usage(spark, *[(dt(2024, m, 3), dt(2024, m, 4)) for m in (2, 1, 1, 2)])
    use = use.withColumn("usage_quantity", F.col("usage_id") + 1.0)
    got = billing.endpoint_month_cost(use, prices(spark, *TWO_PRICES), "2024-03-01").collect()
    assert [(r["usage_month"].month, r["endpoint"], r["cost_usd"]) for r in got] == [
        (1, "ep0", 3.0), (1, "ep1", 2.0), (2, "ep1", 12.0), (2, "ep0", 3.0),
    ]


def test_late_labels(spark):
    pred = spark.createDataFrame([(1, 5.0), (2, 6.0)], "id int, prediction double")
    labels = spark.createDataFrame([(1, 4.0)], "id int, price double")
    got = {r["id"]: r["price"] for r in join_ground_truth(pred, labels, "id").collect()}
    assert got == {1: 4.0, 2: None}
