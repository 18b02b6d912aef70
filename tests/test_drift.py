import math
import random
from datetime import datetime as dt

from pyspark.sql import functions as F

from fareloom.operators import drift
from fareloom.operators.compare import frames_equal


def _log(spark):
    """Six alike days, a shifted one and one full of gaps; one constant and one empty column."""
    rng = random.Random(2)
    rows = []
    for day in range(1, 9):
        for i in range(400):
            v = rng.gauss(0, 1) + (1.5 if day == 7 else 0)
            rows.append((dt(2024, 1, day, i % 24), None if day == 8 and i % 2 else v, 5.0, None))
    rows += [(dt(2024, 1, 2), math.nan, 5.0, None), (None, 1.0, 5.0, None)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, v double, same double, none double")


def test_a_planted_shift_is_found(spark):
    df = _log(spark)
    base = df.filter("ts < '2024-01-04'")
    known = drift.limits(base, ("v", "same", "none"))
    assert set(known) == {"v", "same"}
    counts = drift.histograms(df, "ts", known)
    found = drift.drift(counts, counts.filter("window_start < '2024-01-04'"))
    rows = {(r["window_start"].day, r["column_name"]): r for r in found.collect()}
    assert len(rows) == 16 and rows[2, "v"]["n"] == 401
    assert all(rows[d, "v"]["psi"] < 0.2 and rows[d, "v"]["ks"] < 0.1 for d in range(1, 7))
    assert rows[7, "v"]["psi"] > 1 and rows[7, "v"]["ks"] > 0.4
    assert rows[8, "v"]["ks"] > 0.4  # half of the values are missing
    assert all(rows[d, "same"]["ks"] == 0 for d in range(1, 9))


def test_counts_of_days_add_up(spark):
    df = _log(spark).filter("ts is not null")
    known = drift.limits(df, ("v", "same"))
    parts = [drift.histograms(df.filter(F.dayofmonth("ts") % 2 == k), "ts", known) for k in (0, 1)]
    daily = parts[0].unionByName(parts[1])
    assert frames_equal(drift.merged(daily, "2 days"), drift.histograms(df, "ts", known, "2 days"))
