"""The SQL counterpart of each catalog query, for DuckDB on the same parquet tables.

Written from the definition of the result, not from the Spark plan. Rounded values get 1e-9 first,
as on the Spark side. Queries without a fixed SQL
answer (fits, samples, sketches) have none.
"""

from __future__ import annotations

from fareloom.plans.catalog import AS_OF, BASE_RMSE

TRIPS = """
trips AS (
  SELECT event_id AS trip_id,
         ts AS tpep_pickup_datetime,
         ts + to_minutes(5 + event_id % 40) AS tpep_dropoff_datetime,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS trip_distance,
         CASE WHEN event_type = 'error' THEN -value ELSE value END AS fare_amount,
         CAST(10000 + user_id % 20 AS INTEGER) AS pickup_zip,
         CAST(10000 + (event_id * 7) % 20 AS INTEGER) AS dropoff_zip
  FROM events)"""

SILVER = """
silver AS (
  SELECT fare_amount, trip_distance, pickup_zip, dropoff_zip
  FROM trips WHERE fare_amount > 0 AND trip_distance > 0)"""

ROUNDED = """
rounded AS (
  SELECT *,
         time_bucket(INTERVAL '15 minutes', tpep_pickup_datetime - INTERVAL 1 MICROSECOND)
           + INTERVAL '15 minutes' AS rp,
         time_bucket(INTERVAL '30 minutes', tpep_dropoff_datetime - INTERVAL 1 MICROSECOND)
           + INTERVAL '30 minutes' AS rd
  FROM trips)"""


def sliding(name: str = "sliding") -> str:
    return f"""
{name} AS (
  SELECT pickup_zip AS zip, wend AS tpep_pickup_datetime, strftime(wend, '%Y-%m') AS yyyy_mm,
         CAST(AVG(fare_amount) AS FLOAT) AS mean_fare_window_1h_pickup_zip,
         CAST(COUNT(*) AS INTEGER) AS count_trips_window_1h_pickup_zip
  FROM (SELECT t.pickup_zip, t.fare_amount,
               time_bucket(INTERVAL '15 minutes', t.tpep_pickup_datetime)
                 + to_minutes(15 * g.i) AS wend
        FROM trips t CROSS JOIN (VALUES (1), (2), (3), (4)) g(i)) e
  GROUP BY pickup_zip, wend)"""


def tumbling(name: str = "tumbling", ts: str = "tpep_dropoff_datetime", where: str = "TRUE") -> str:
    wend = f"time_bucket(INTERVAL '30 minutes', {ts}) + INTERVAL '30 minutes'"
    return f"""
{name} AS (
  SELECT zip, wend AS {ts}, strftime(wend, '%Y-%m') AS yyyy_mm,
         CAST(COUNT(*) AS INTEGER) AS count_trips_window_30m_dropoff_zip,
         CAST(isodow(timezone('America/New_York', wend AT TIME ZONE 'UTC')) >= 6 AS INTEGER)
           AS dropoff_is_weekend
  FROM (SELECT dropoff_zip AS zip, {wend} AS wend FROM trips WHERE {where}) b
  GROUP BY zip, wend)"""


PREDICTIONS = """
predictions AS (
  SELECT trip_id, 3 * trip_distance + 1 AS prediction, fare_amount AS label,
         CAST(trip_id % 2 + 1 AS VARCHAR) AS model_id,
         tpep_pickup_datetime AS timestamp, pickup_zip
  FROM trips)"""

USAGE = """
usage AS (
  SELECT l_orderkey * 10 + l_linenumber AS usage_id,
         CONCAT('SKU_SERVERLESS_REAL_TIME_INFERENCE_', l_returnflag, l_linestatus) AS sku_name,
         CASE WHEN l_suppkey % 2 = 0 THEN 'AWS' ELSE 'AZURE' END AS cloud,
         CASE WHEN l_linenumber % 4 = 0 THEN 'GB' ELSE 'DBU' END AS usage_unit,
         l_quantity AS usage_quantity,
         l_shipdate AS usage_start_time,
         l_shipdate + INTERVAL '1' HOUR AS usage_end_time,
         CONCAT('ep_', CAST(l_suppkey % 5 AS VARCHAR)) AS endpoint_name
  FROM lineitem)"""

PRICES = """
prices AS (
  SELECT 'acct_1' AS account_id, cloud, sku_name, y_start AS price_start_time,
         LEAD(y_start) OVER (PARTITION BY cloud, sku_name ORDER BY y_start) AS price_end_time,
         unit_price
  FROM (SELECT cloud, sku_name,
               CAST(DATE_TRUNC('year', usage_start_time) AS TIMESTAMP) AS y_start,
               MIN(usage_quantity) + EXTRACT(YEAR FROM MIN(usage_start_time)) - 1994 AS unit_price
        FROM usage
        GROUP BY cloud, sku_name, CAST(DATE_TRUNC('year', usage_start_time) AS TIMESTAMP)) q)"""

PRICED = """
priced AS (
  SELECT u.*, p.unit_price AS price_per_dbu
  FROM usage u LEFT JOIN prices p
    ON u.cloud = p.cloud AND u.sku_name = p.sku_name
   AND u.usage_start_time >= p.price_start_time
   AND (u.usage_end_time <= p.price_end_time OR p.price_end_time IS NULL))"""

MONTHLY = """
monthly AS (
  SELECT CONCAT('acct_', account) AS account_id, cloud, sku_name, s AS price_start_time, e AS price_end_time,
         base + account AS unit_price
  FROM (SELECT *, LEAD(s) OVER (PARTITION BY cloud, sku_name ORDER BY s) AS e, UNNEST([1, 2]) AS account
        FROM (SELECT cloud, sku_name,
                     CAST(DATE_TRUNC('month', usage_start_time) AS TIMESTAMP) + INTERVAL 30 MINUTE AS s,
                     MIN(usage_quantity) + EXTRACT(MONTH FROM MIN(usage_start_time)) AS base
              FROM usage GROUP BY ALL) m) n)"""

SERVING = "sku_name LIKE '%SERVERLESS_REAL_TIME_INFERENCE%' AND usage_unit = 'DBU'"


def sql(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n" + body.strip()


def over_trips(body: str) -> str:
    return sql(TRIPS, body=body)


ORACLES: dict[str, str] = {}

# --- sources and sinks -----------------------------------------------------------------------

ORACLES["read_path"] = "SELECT event_id, ts, value FROM events"
ORACLES["read_table"] = over_trips("SELECT trip_id, fare_amount, trip_distance FROM trips")
ORACLES["read_sql"] = over_trips("SELECT trip_id, fare_amount FROM trips WHERE fare_amount > 100")
ORACLES["read_path_sql"] = "SELECT o_orderkey, o_totalprice FROM orders"
ORACLES["read_stream"] = over_trips("SELECT * FROM trips")

ORACLES["overwrite_table"] = sql(TRIPS, PREDICTIONS, body="SELECT * FROM predictions")

_INFERENCE = """
SELECT trip_id, trip_distance, pickup_zip, dropoff_zip,
       rp AS rounded_pickup_datetime, rd AS rounded_dropoff_datetime
FROM rounded"""
ORACLES["overwrite_path"] = sql(TRIPS, ROUNDED, body=_INFERENCE)
ORACLES["inference_input"] = sql(TRIPS, ROUNDED, body=_INFERENCE)

_UPSERTED = sql(
    TRIPS,
    tumbling("old", where="tpep_dropoff_datetime < TIMESTAMP '2024-01-20'"),
    tumbling("new", where="tpep_dropoff_datetime >= TIMESTAMP '2024-01-15'"),
    body="""
SELECT * FROM new
UNION ALL
SELECT * FROM old o WHERE NOT EXISTS (
  SELECT 1 FROM new n
  WHERE n.zip = o.zip AND n.tpep_dropoff_datetime = o.tpep_dropoff_datetime)""",
)
ORACLES["create_feature_table"] = sql(TRIPS, sliding(), body="SELECT * FROM sliding")
ORACLES["feature_job"] = _UPSERTED
# One run over everything: runs back to back leave no window partly filled.
ORACLES["feature_job_sliding"] = ORACLES["create_feature_table"]
ORACLES["feature_job_tumbling"] = sql(TRIPS, tumbling("halves"), body="SELECT * FROM halves")
ORACLES["feature_job_late"] = ORACLES["create_feature_table"]
ORACLES["merge_upsert"] = _UPSERTED
ORACLES["key_duplicates"] = over_trips(
    "SELECT pickup_zip, dropoff_zip, COUNT(*) AS n FROM trips GROUP BY ALL HAVING COUNT(*) > 1"
)
ORACLES["latest_row_per_key"] = sql(
    TRIPS,
    sliding(),
    body="""
SELECT zip, tpep_pickup_datetime, yyyy_mm, mean_fare_window_1h_pickup_zip,
       count_trips_window_1h_pickup_zip
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY zip ORDER BY tpep_pickup_datetime DESC) AS rn
      FROM sliding) r
WHERE rn = 1""",
)
ORACLES["stream_snapshot"] = ORACLES["latest_row_per_key"]

# --- scalar functions, filters, projections -------------------------------------------------

ORACLES["ceil_ts"] = sql(
    TRIPS, ROUNDED, body="SELECT trip_id, rp AS pickup_15, rd AS dropoff_30 FROM rounded"
)
ORACLES["partition_id"] = over_trips(
    "SELECT trip_id, strftime(tpep_dropoff_datetime, '%Y-%m') AS yyyy_mm FROM trips"
)
ORACLES["is_weekend_tz"] = over_trips("""
SELECT trip_id, CAST(isodow(timezone('America/New_York',
         tpep_pickup_datetime AT TIME ZONE 'UTC')) >= 6 AS INTEGER) AS weekend_ny
FROM trips""")
ORACLES["is_weekend"] = over_trips("""
SELECT trip_id, CASE WHEN dayofweek(tpep_pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END AS weekend
FROM trips""")
ORACLES["epoch_and_calendar"] = over_trips("""
SELECT trip_id,
       CAST(floor(epoch_us(tpep_pickup_datetime) / 1000000) AS BIGINT) AS epoch_s,
       CAST(DATE_TRUNC('second', tpep_pickup_datetime) AS TIMESTAMP) AS whole_second,
       CAST(tpep_pickup_datetime AS DATE) AS day,
       CAST(DATE_TRUNC('month', tpep_pickup_datetime) AS TIMESTAMP) AS month,
       CAST(DATE_TRUNC('second', tpep_pickup_datetime) AS TIMESTAMP) AS parsed
FROM trips""")
ORACLES["rolling_cutoff"] = sql(
    USAGE,
    body=f"""
SELECT usage_id, usage_start_time >= DATE '{AS_OF}' - INTERVAL 30 DAY AS in_30_days
FROM usage WHERE usage_start_time >= DATE '{AS_OF}' - INTERVAL 12 MONTH""",
)
ORACLES["open_end"] = sql(
    USAGE,
    PRICES,
    body="""
SELECT account_id, sku_name, price_start_time AS price_start_ts,
       COALESCE(price_end_time, TIMESTAMP '9999-12-31 23:59:59') AS price_end_ts, unit_price
FROM prices""",
)
ORACLES["filter_by_time"] = over_trips("""
SELECT trip_id, tpep_pickup_datetime FROM trips
WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-10'
  AND tpep_pickup_datetime < TIMESTAMP '2024-01-20 12:00:00'""")
ORACLES["positive_fares"] = over_trips(
    "SELECT trip_id, fare_amount FROM trips WHERE fare_amount > 0"
)
ORACLES["serving_usage"] = sql(
    USAGE,
    body=f"""
SELECT usage_id, sku_name, usage_quantity FROM usage
WHERE {SERVING} AND usage_start_time >= DATE '{AS_OF}' - INTERVAL 12 MONTH""",
)
ORACLES["numeric_columns"] = over_trips(
    "SELECT fare_amount, trip_distance, CAST(pickup_zip AS DOUBLE) AS pickup_zip FROM trips"
)
ORACLES["label_renamed"] = over_trips("SELECT trip_id, fare_amount AS price FROM trips")

# --- layers ---------------------------------------------------------------------------------

_SILVER = sql(TRIPS, SILVER, body="SELECT * FROM silver")
_PICKUP_AVG = sql(
    TRIPS,
    SILVER,
    body="""
SELECT pickup_zip AS zip, ROUND(AVG(fare_amount) + 1e-9, 6) AS avg_fare_per_zip
FROM silver GROUP BY pickup_zip""",
)
_DROPOFF_ROWS = sql(TRIPS, SILVER, body="SELECT fare_amount, pickup_zip, dropoff_zip FROM silver")
_GOLD = sql(
    TRIPS,
    SILVER,
    body="""
SELECT s.fare_amount, s.pickup_zip, s.dropoff_zip, p.avg_fare_per_zip, d.trip_count
FROM silver s
LEFT JOIN (SELECT pickup_zip, ROUND(AVG(fare_amount) + 1e-9, 6) AS avg_fare_per_zip
           FROM silver GROUP BY pickup_zip) p ON s.pickup_zip = p.pickup_zip
LEFT JOIN (SELECT dropoff_zip, COUNT(*) AS trip_count
           FROM silver GROUP BY dropoff_zip) d ON s.dropoff_zip = d.dropoff_zip""",
)
ORACLES["silver"] = ORACLES["stream_silver"] = _SILVER
ORACLES["pickup_zip_average"] = ORACLES["stream_pickup_avg"] = _PICKUP_AVG
ORACLES["dropoff_rows"] = ORACLES["stream_dropoff"] = _DROPOFF_ROWS
ORACLES["dropoff_trip_counts"] = sql(
    TRIPS, SILVER, body="SELECT dropoff_zip, COUNT(*) AS trip_count FROM silver GROUP BY 1"
)
ORACLES["gold"] = ORACLES["medallion_batch"] = ORACLES["stream_gold"] = _GOLD

ORACLES["row_counts"] = sql(
    TRIPS,
    SILVER,
    body="""
SELECT 'raw' AS stage, COUNT(*) AS n_rows FROM trips
UNION ALL SELECT 'silver', COUNT(*) FROM silver
UNION ALL SELECT 'gold', COUNT(*) FROM silver""",
)

# --- features and training sets -------------------------------------------------------------

ORACLES["sliding_window_features"] = ORACLES["stream_sliding"] = sql(
    TRIPS, sliding(), body="SELECT * FROM sliding"
)
ORACLES["tumbling_window_features"] = ORACLES["stream_tumbling"] = sql(
    TRIPS, tumbling(), body="SELECT * FROM tumbling"
)
ORACLES["sparse_keys"] = sql(
    TRIPS,
    sliding(),
    body="""
SELECT *, CAST(count_trips_window_1h_pickup_zip < 3 AS INTEGER) AS is_sparse FROM sliding""",
)


def _inline(upper: str) -> str:
    def frame(minutes: int) -> str:
        return f"RANGE BETWEEN INTERVAL {minutes} MINUTE PRECEDING AND {upper}"

    pickup = f"(PARTITION BY pickup_zip ORDER BY rp {frame(60)})"
    dropoff = f"(PARTITION BY dropoff_zip ORDER BY rd {frame(30)})"
    return sql(
        TRIPS,
        ROUNDED,
        body=f"""
SELECT trip_id, fare_amount, trip_distance, pickup_zip, dropoff_zip,
       ROUND(AVG(fare_amount) OVER {pickup} + 1e-9, 6) AS mean_fare_window_1h_pickup_zip,
       COUNT(*) OVER {pickup} AS count_trips_window_1h_pickup_zip,
       COUNT(*) OVER {dropoff} AS count_trips_window_30m_dropoff_zip,
       CASE WHEN dayofweek(rd) IN (0, 6) THEN 1 ELSE 0 END AS dropoff_is_weekend
FROM rounded""",
    )


ORACLES["inline_training_features"] = _inline("CURRENT ROW")
ORACLES["training_frame"] = (
    "SELECT fare_amount, trip_distance, "
    + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}"
        for c in (
            "pickup_zip",
            "dropoff_zip",
            "mean_fare_window_1h_pickup_zip",
            "count_trips_window_1h_pickup_zip",
            "count_trips_window_30m_dropoff_zip",
            "dropoff_is_weekend",
        )
    )
    + " FROM ("
    + _inline("CURRENT ROW")
    + ") f"
)
ORACLES["inline_features_without_own_slot"] = _inline("INTERVAL 1 SECOND PRECEDING")
_SECONDS = "RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW"
ORACLES["trailing_seconds"] = over_trips(f"""
SELECT trip_id, pickup_zip, fare_amount, s,
       COUNT(*) OVER w AS trips_1h, ROUND(AVG(fare_amount) OVER w + 1e-9, 6) AS mean_fare_1h
FROM (SELECT trip_id, pickup_zip, fare_amount,
             CAST(floor(epoch_us(tpep_pickup_datetime) / 1000000) AS BIGINT) AS s,
             DATE_TRUNC('second', tpep_pickup_datetime) AS sec
      FROM trips) t
WINDOW w AS (PARTITION BY pickup_zip ORDER BY sec {_SECONDS})""")
ORACLES["asof_join"] = sql(
    TRIPS,
    sliding(),
    body="""
SELECT t.trip_id, t.dropoff_zip, t.tpep_pickup_datetime,
       s.mean_fare_window_1h_pickup_zip, s.count_trips_window_1h_pickup_zip
FROM trips t ASOF LEFT JOIN sliding s
  ON t.dropoff_zip = s.zip AND t.tpep_pickup_datetime >= s.tpep_pickup_datetime""",
)
_LOOKED_UP = """
looked_up AS (
  SELECT r.trip_id, r.trip_distance, r.fare_amount, r.pickup_zip, r.dropoff_zip,
         s.mean_fare_window_1h_pickup_zip, s.count_trips_window_1h_pickup_zip,
         d.count_trips_window_30m_dropoff_zip, d.dropoff_is_weekend
  FROM rounded r
  ASOF LEFT JOIN sliding s ON r.pickup_zip = s.zip AND r.rp >= s.tpep_pickup_datetime
  ASOF LEFT JOIN tumbling d ON r.dropoff_zip = d.zip AND r.rd >= d.tpep_dropoff_datetime)"""
ORACLES["training_set"] = sql(
    TRIPS, ROUNDED, sliding(), tumbling(), _LOOKED_UP, body="SELECT * FROM looked_up"
)
ORACLES["ground_truth_join"] = sql(
    TRIPS,
    PREDICTIONS,
    body="""
SELECT trip_id, model_id, prediction, CASE WHEN label > 0 THEN label END AS price
FROM predictions""",
)

# --- billing --------------------------------------------------------------------------------

ORACLES["validity_join"] = sql(
    USAGE,
    PRICES,
    PRICED,
    body="SELECT usage_id, cloud, sku_name, usage_quantity, price_per_dbu FROM priced",
)
ORACLES["daily_cost"] = sql(
    USAGE,
    PRICES,
    PRICED,
    body=f"""
SELECT CAST(usage_start_time AS DATE) AS usage_date, SUM(usage_quantity) AS dbus,
       SUM(usage_quantity * price_per_dbu) AS cost_usd,
       COALESCE(SUM(CASE WHEN price_per_dbu IS NULL THEN usage_quantity END), 0) AS unpriced_dbus
FROM priced WHERE {SERVING} AND usage_start_time >= DATE '{AS_OF}' - INTERVAL 30 DAY
GROUP BY 1 ORDER BY 1""",
)
_HELD = """
    ON u.cloud = p.cloud AND u.sku_name = p.sku_name
   AND u.usage_start_time >= p.price_start_time
   AND (u.usage_end_time <= p.price_end_time OR p.price_end_time IS NULL)"""
ORACLES["validity_join_of_accounts"] = sql(
    USAGE,
    MONTHLY,
    body=f"""
SELECT usage_id, account_id, unit_price AS price_per_dbu FROM usage u LEFT JOIN monthly p {_HELD}""",
)
ORACLES["daily_cost_with_gaps"] = sql(
    USAGE,
    MONTHLY,
    body=f"""
SELECT CAST(usage_start_time AS DATE) AS usage_date, SUM(usage_quantity) AS dbus,
       SUM(usage_quantity * unit_price) AS cost_usd,
       COALESCE(SUM(CASE WHEN unit_price IS NULL THEN usage_quantity END), 0) AS unpriced_dbus
FROM (SELECT u.*, p.unit_price FROM usage u
      LEFT JOIN (SELECT * FROM monthly WHERE account_id = 'acct_1') p {_HELD}) q
WHERE {SERVING} AND usage_start_time >= DATE '{AS_OF}' - INTERVAL 30 DAY
GROUP BY 1 ORDER BY 1""",
)
ORACLES["sku_cost_latest_price"] = sql(
    USAGE,
    PRICES,
    body="""
SELECT u.sku_name, SUM(u.usage_quantity * p.unit_price) AS total_cost
FROM usage u JOIN (
  SELECT * FROM (
    SELECT account_id, sku_name, price_start_time AS s,
           COALESCE(price_end_time, TIMESTAMP '9999-12-31 23:59:59') AS e, unit_price,
           ROW_NUMBER() OVER (PARTITION BY account_id, sku_name
                              ORDER BY price_start_time DESC, price_end_time DESC NULLS FIRST,
                                       unit_price) AS rn
    FROM prices) r
  WHERE rn = 1) p
  ON u.sku_name = p.sku_name AND u.usage_start_time >= p.s AND u.usage_start_time < p.e
GROUP BY u.sku_name ORDER BY u.sku_name""",
)
ORACLES["endpoint_month_cost"] = sql(
    USAGE,
    PRICES,
    PRICED,
    body=f"""
SELECT CAST(DATE_TRUNC('month', usage_start_time) AS TIMESTAMP) AS usage_month,
       endpoint_name AS endpoint, SUM(usage_quantity * price_per_dbu) AS cost_usd
FROM priced WHERE {SERVING} AND usage_start_time >= DATE '{AS_OF}' - INTERVAL 12 MONTH
GROUP BY 1, 2 ORDER BY 1, 3 DESC""",
)

# --- metrics and monitoring -----------------------------------------------------------------

_E = "(prediction - label)"
_METRICS = f"""
       ROUND(AVG(ABS({_E})) + 1e-9, 6) AS mean_absolute_error,
       ROUND(AVG({_E} * {_E}) + 1e-9, 6) AS mean_squared_error,
       ROUND(SQRT(AVG({_E} * {_E})) + 1e-9, 6) AS root_mean_squared_error,
       ROUND(AVG(ABS({_E}) / GREATEST(ABS(label), 2.220446049250313e-16)) + 1e-9, 6)
         AS mean_absolute_percentage_error,
       ROUND(1 - SUM({_E} * {_E}) / NULLIF(VAR_POP(label) * COUNT(label), 0) + 1e-9, 6) AS r2_score,
       ROUND(MAX(ABS({_E})) + 1e-9, 6) AS max_error"""
ORACLES["regression_metrics"] = sql(
    TRIPS,
    PREDICTIONS,
    body=f"""
SELECT COUNT(*) AS example_count, {_METRICS},
       ROUND(SUM(label) + 1e-9, 6) AS sum_on_target, ROUND(AVG(label) + 1e-9, 6) AS mean_on_target
FROM predictions""",
)
ORACLES["custom_metric"] = sql(
    TRIPS,
    PREDICTIONS,
    body=f"SELECT ROUND(SUM(POW(ABS({_E} + 1), 2)), 2) AS squared_diff_plus_one FROM predictions",
)
ORACLES["validate"] = sql(
    TRIPS,
    PREDICTIONS,
    body=f"""
SELECT metric_name, ROUND(v + 1e-9, 6) AS candidate, CAST(500 AS DOUBLE) AS threshold, v <= 500 AS passed
FROM (SELECT 'max_error' AS metric_name, MAX(ABS({_E})) AS v FROM predictions
      UNION ALL
      SELECT 'mean_squared_error', AVG({_E} * {_E}) FROM predictions) m""",
)
ORACLES["baseline_compare"] = sql(
    TRIPS,
    PREDICTIONS,
    f"""
m AS (
  SELECT model_id, MAX(ABS({_E})) AS max_error, AVG({_E} * {_E}) AS mse
  FROM predictions GROUP BY model_id),
pairs AS (
  SELECT 'max_error' AS metric_name, a.max_error AS c, b.max_error AS b
  FROM m a, m b WHERE a.model_id = '1' AND b.model_id = '2'
  UNION ALL
  SELECT 'mean_squared_error', a.mse, b.mse
  FROM m a, m b WHERE a.model_id = '1' AND b.model_id = '2')""",
    body="""
SELECT metric_name, ROUND(c + 1e-9, 6) AS candidate, ROUND(b + 1e-9, 6) AS baseline,
       ROUND(c - b + 1e-9, 6) AS absolute_change, ROUND((c - b) / ABS(b) + 1e-9, 6) AS relative_change,
       CASE WHEN metric_name = 'max_error' THEN TRUE ELSE (b - c) / ABS(b) >= 0.01 END AS passed
FROM pairs""",
)
_DAY = "CAST(DATE_TRUNC('day', timestamp) AS TIMESTAMP)"
ORACLES["quality_profile"] = sql(
    TRIPS,
    PREDICTIONS,
    f"""
daily AS (
  SELECT {_DAY} AS window_start, * FROM predictions)""",
    body=f"""
SELECT window_start, '1 day' AS granularity,
       CASE WHEN GROUPING(model_id) = 1 THEN '*' ELSE model_id END AS model_id,
       CASE WHEN GROUPING(pickup_zip) = 0 THEN 'pickup_zip' END AS slice_key,
       CAST(pickup_zip AS VARCHAR) AS slice_value,
       ':table' AS column_name, 'INPUT' AS log_type, COUNT(*) AS count, {_METRICS}
FROM daily
GROUP BY GROUPING SETS ((window_start, model_id), (window_start),
                        (window_start, model_id, pickup_zip), (window_start, pickup_zip))""",
)


ORACLES["quality_profile_incremental"] = ORACLES["quality_profile"]


def _column(c: str) -> str:
    return f"""
SELECT CAST(DATE_TRUNC('day', tpep_pickup_datetime) AS TIMESTAMP) AS window_start,
       '1 day' AS granularity, 'INPUT' AS log_type, '{c}' AS column_name,
       COUNT({c}) AS num_values, COUNT(*) - COUNT({c}) AS num_nulls,
       ROUND(AVG({c}) + 1e-9, 6) AS avg, ROUND(STDDEV_SAMP({c}) + 1e-9, 6) AS stddev,
       MIN({c}) AS min, MAX({c}) AS max
FROM trips GROUP BY 1"""


ORACLES["column_profile"] = over_trips(
    _column("trip_distance") + "\nUNION ALL\n" + _column("fare_amount")
)
ORACLES["feature_drift"] = sql(
    TRIPS,
    """
long AS (
  SELECT CAST(DATE_TRUNC('day', tpep_pickup_datetime) AS TIMESTAMP) AS w,
         UNNEST(['trip_distance', 'fare_amount']) AS c, UNNEST([trip_distance, fare_amount]) AS v
  FROM trips),
week AS (SELECT MIN(w) + INTERVAL 7 DAY AS until FROM long),
ends AS (SELECT c, MIN(v) AS lo, MAX(v) AS hi FROM long, week WHERE w < until GROUP BY c),
binned AS (
  SELECT w, c, CASE WHEN v IS NULL THEN -1
                    ELSE LEAST(GREATEST(FLOOR((v - lo) / (hi - lo) * 20), 0), 19) END AS b, COUNT(*) AS n
  FROM long JOIN ends USING (c) GROUP BY ALL),
grid AS (
  SELECT w, c, b, COALESCE(n, 0) AS n,
         COALESCE((SELECT SUM(n) FROM binned x, week WHERE x.c = k.c AND x.b = k.b AND x.w < until), 0) AS m
  FROM (SELECT DISTINCT w, c, UNNEST(RANGE(-1, 20)) AS b FROM binned) k LEFT JOIN binned USING (w, c, b)),
shares AS (
  SELECT w, c, n, (n + 0.5) / (SUM(n) OVER o + 10.5) AS p, (m + 0.5) / (SUM(m) OVER o + 10.5) AS q,
         ABS(SUM(n) OVER u / SUM(n) OVER o - SUM(m) OVER u / SUM(m) OVER o) AS gap
  FROM grid WINDOW o AS (PARTITION BY w, c), u AS (PARTITION BY w, c ORDER BY b))""",
    body="""
SELECT w AS window_start, c AS column_name, CAST(SUM(n) AS BIGINT) AS n,
       ROUND(SUM((p - q) * LN(p / q)) + 1e-9, 6) AS psi, ROUND(MAX(gap) + 1e-9, 6) AS ks
FROM shares GROUP BY 1, 2""",
)
_RMSE = f"SQRT(AVG({_E} * {_E}))"
ORACLES["recent_windows"] = sql(
    TRIPS,
    PREDICTIONS,
    body=f"""
SELECT {_DAY} AS window_start, ROUND({_RMSE} + 1e-9, 6) AS root_mean_squared_error
FROM predictions GROUP BY 1 ORDER BY 1 DESC LIMIT 5""",
)
# Days numbered from the newest; the answer is one aggregate over the newest five.
ORACLES["metric_violation"] = sql(
    TRIPS,
    PREDICTIONS,
    f"""
daily AS (
  SELECT RANK() OVER (ORDER BY {_DAY} DESC) AS age, {_RMSE} > {BASE_RMSE} AS over
  FROM predictions GROUP BY {_DAY})""",
    body="""
SELECT CAST(COALESCE(COUNT(*) FILTER (over) >= 2 AND BOOL_OR(over) FILTER (age = 1), FALSE) AS INTEGER)
         AS query_result
FROM daily WHERE age <= 5""",
)
ORACLES["metric_violation_by_model"] = sql(
    TRIPS,
    PREDICTIONS,
    f"""
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY model_id ORDER BY w DESC) AS rn
  FROM (SELECT model_id, {_DAY} AS w, {_RMSE} AS rmse FROM predictions GROUP BY 1, 2) d)""",
    body=f"""
SELECT model_id,
       CASE WHEN SUM(CASE WHEN rmse > {BASE_RMSE} THEN 1 ELSE 0 END) >= 2
             AND MAX(CASE WHEN rn = 1 THEN rmse END) > {BASE_RMSE}
            THEN 1 ELSE 0 END AS query_result
FROM ranked WHERE rn <= 5 GROUP BY model_id""",
)


def _drift(base: float) -> str:
    return f"""
drift AS (
  SELECT model_id, day,
         SQRT(SUM(se) OVER w / SUM(n) OVER w) AS rolling, CAST({base} AS DOUBLE) AS base_rmse
  FROM (SELECT model_id, CAST(timestamp AS DATE) AS day, SUM({_E} * {_E}) AS se, COUNT(*) AS n
        FROM predictions GROUP BY 1, 2) d
  WINDOW w AS (PARTITION BY model_id ORDER BY day
               RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW))"""


ORACLES["rolling_drift"] = sql(
    TRIPS,
    PREDICTIONS,
    _drift(BASE_RMSE),
    body="""
SELECT model_id, day, ROUND(rolling + 1e-9, 6) AS rolling_rmse, base_rmse,
       CAST(rolling > base_rmse AS INTEGER) AS is_drifted
FROM drift""",
)
ORACLES["retune_flag"] = sql(
    TRIPS,
    PREDICTIONS,
    _drift(50.0),
    body="""
SELECT model_id, day, ROUND(rolling + 1e-9, 6) AS rolling_rmse, base_rmse,
       CAST(rolling > 1.15 * base_rmse AS INTEGER) AS needs_retune
FROM drift""",
)
ORACLES["version_compare"] = sql(
    TRIPS,
    PREDICTIONS,
    f"""
daily AS (
  SELECT {_DAY} AS window_start, model_id, {_RMSE} AS rmse FROM predictions GROUP BY 1, 2)""",
    body="""
SELECT window_start,
       ROUND(MAX(CASE WHEN model_id = '1' THEN rmse END) + 1e-9, 6) AS rmse_model_1,
       ROUND(MAX(CASE WHEN model_id = '2' THEN rmse END) + 1e-9, 6) AS rmse_model_2
FROM daily GROUP BY window_start""",
)
_SUMMARY = """
summary AS (
  SELECT COUNT(*) AS requests,
         COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS failures,
         ROUND(AVG(value), 2) AS avg_ms,
         ROUND(QUANTILE_CONT(value, 0.5), 2) AS p50_ms,
         ROUND(QUANTILE_CONT(value, 0.95), 2) AS p95_ms,
         ROUND(QUANTILE_CONT(value, 0.99), 2) AS p99_ms,
         ROUND(MIN(value), 2) AS min_ms,
         ROUND(MAX(value), 2) AS max_ms,
         ROUND(COUNT(*) / 300.0, 3) AS reqs_per_s_observed,
         CAST(20 AS DOUBLE) AS tps_target
  FROM events)"""
ORACLES["latency_summary"] = sql(_SUMMARY, body="""
SELECT * REPLACE (CAST(reqs_per_s_observed AS DOUBLE) AS reqs_per_s_observed) FROM summary""")
_LIMITS = [("avg_ms", 150), ("p50_ms", 150), ("p95_ms", 200), ("p99_ms", 400)]
ORACLES["latency_trend"] = """
SELECT CAST(DATE_TRUNC('day', ts) AS TIMESTAMP) AS window_start, COUNT(value) AS requests, COUNT(value) AS sketched,
       TRUE AS p50_ms_within, TRUE AS p95_ms_within, TRUE AS p99_ms_within
FROM events GROUP BY 1"""
ORACLES["latency_slo"] = sql(
    _SUMMARY,
    body="\nUNION ALL\n".join(
        f"SELECT '{m}' AS metric, {m} AS observed, CAST({v} AS DOUBLE) AS limit_ms,"
        f" {m} <= {v} AS passed FROM summary"
        for m, v in _LIMITS
    ),
)

# --- splits, comparison, scoring ------------------------------------------------------------

_HASH = "CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {buckets}"
_SPLIT_TEST = _HASH.format(text="'42:' || CAST(trip_id AS VARCHAR)", buckets=10000) + " < 2000"
ORACLES["train_test_split"] = over_trips(
    f"SELECT trip_id, CASE WHEN {_SPLIT_TEST} THEN 'test' ELSE 'train' END AS split FROM trips"
)
_TO_A = _HASH.format(text="CAST(trip_id AS VARCHAR)", buckets=100) + " < 90"
ORACLES["traffic_split"] = over_trips(
    f"SELECT trip_id, CASE WHEN {_TO_A} THEN 'a' ELSE 'b' END AS served_model FROM trips"
)
ORACLES["frame_diff"] = sql(
    TRIPS,
    SILVER,
    body="""
SELECT fare_amount, pickup_zip, dropoff_zip, CAST(SUM(n) AS BIGINT) AS surplus
FROM (SELECT fare_amount, pickup_zip, dropoff_zip, 1 AS n FROM trips
      UNION ALL
      SELECT fare_amount, pickup_zip, dropoff_zip, -1 FROM silver) u
GROUP BY fare_amount, pickup_zip, dropoff_zip HAVING SUM(n) <> 0""",
)
ORACLES["frames_equal"] = sql(
    TRIPS,
    SILVER,
    body="""
SELECT COUNT(*) = 0 AS equal FROM (
  (SELECT fare_amount, pickup_zip, dropoff_zip FROM silver
   EXCEPT ALL
   SELECT fare_amount, pickup_zip, dropoff_zip FROM trips
   WHERE fare_amount > 0 AND trip_distance > 0)
  UNION ALL
  (SELECT fare_amount, pickup_zip, dropoff_zip FROM trips
   WHERE fare_amount > 0 AND trip_distance > 0
   EXCEPT ALL
   SELECT fare_amount, pickup_zip, dropoff_zip FROM silver)) d""",
)
ORACLES["score_batch"] = sql(
    TRIPS,
    ROUNDED,
    sliding(),
    tumbling(),
    _LOOKED_UP,
    body="""
SELECT trip_id,
       3 * trip_distance + COALESCE(count_trips_window_1h_pickup_zip, 0) AS prediction,
       '7' AS model_id, TIMESTAMP '2024-02-01 08:00:00' AS timestamp
FROM looked_up""",
)
ORACLES["score_ab"] = over_trips("""
SELECT trip_id, 3 * trip_distance + 1 AS pred_a,
       2.5 * trip_distance + (pickup_zip - 10000) / 4.0 AS pred_b
FROM trips""")
ORACLES["knn_regress"] = sql(
    TRIPS,
    f"""
parts AS (SELECT *, {_SPLIT_TEST} AS is_test FROM trips),
near AS (
  SELECT q.trip_id, t.fare_amount AS y,
         (q.trip_distance - t.trip_distance) * (q.trip_distance - t.trip_distance)
         + CAST((q.pickup_zip - t.pickup_zip) * (q.pickup_zip - t.pickup_zip) AS DOUBLE) AS d2,
         t.trip_id AS row_id
  FROM parts q JOIN parts t ON q.is_test AND NOT t.is_test),
best AS (
  SELECT * FROM near
  QUALIFY ROW_NUMBER() OVER (PARTITION BY trip_id ORDER BY d2, row_id) <= 10)""",
    body="""
SELECT trip_id,
       ROUND(CASE WHEN MIN(d2) = 0 THEN AVG(CASE WHEN d2 = 0 THEN y END)
                  ELSE SUM(CASE WHEN d2 > 0 THEN y / SQRT(d2) END)
                       / SUM(CASE WHEN d2 > 0 THEN 1 / SQRT(d2) END) END + 1e-9, 6) AS prediction
FROM best GROUP BY trip_id""",
)


def _cuts(zip_column: str, rank: int) -> str:
    """Every split of the trips at a ZIP, with how much of the fares' spread it explains."""
    return f"""
  SELECT {rank} AS rank, cut, nl * POWER(sl / nl - whole, 2) + nr * POWER(sr / nr - whole, 2) AS gain
  FROM (SELECT c.cut, COUNT(*) FILTER (t.{zip_column} <= c.cut) AS nl,
               COUNT(*) FILTER (t.{zip_column} > c.cut) AS nr,
               SUM(t.fare_amount) FILTER (t.{zip_column} <= c.cut) AS sl,
               SUM(t.fare_amount) FILTER (t.{zip_column} > c.cut) AS sr, AVG(t.fare_amount) AS whole
        FROM trips t CROSS JOIN (SELECT DISTINCT {zip_column} AS cut FROM trips) c GROUP BY c.cut)
  WHERE nl >= 20 AND nr >= 20"""


ORACLES["boosted_stump"] = sql(
    TRIPS,
    f"""
cuts AS ({_cuts("pickup_zip", 0)}
  UNION ALL {_cuts("dropoff_zip", 1)}),
best AS (SELECT rank, cut FROM cuts ORDER BY gain DESC, rank, cut LIMIT 1)""",
    body="""
SELECT trip_id, ROUND(AVG(fare_amount) OVER (
         PARTITION BY CASE WHEN rank = 0 THEN pickup_zip ELSE dropoff_zip END <= cut), 3) AS prediction
FROM trips, best""",
)
