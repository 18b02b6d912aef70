"""Feature drift: histograms per window that can be merged, and their distance from a baseline.

A histogram has a fixed number of equal bins between the baseline's limits; values outside go to the
outer bins, missing ones to bin -1. Counts of the same limits can be added, so a table of them is kept
up by adding new days, and coarser windows come from finer ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BINS = 20
MISSING = -1


def limits(baseline: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Least and largest value of each column; columns without any value are left out."""
    values = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    row = baseline.agg(*[g(v).alias(f"{n}_{c}") for c, v in values.items() for n, g in (("l", F.min), ("h", F.max))]).first()
    return {c: (row[f"l_{c}"], row[f"h_{c}"]) for c in columns if row[f"l_{c}"] is not None}


def _bin(column: str, low: float, high: float, bins: int) -> Column:
    v = F.col(column).cast("double")
    if high > low:
        place = F.floor((v - F.lit(low)) / F.lit(high - low) * bins)
    else:
        place = F.when(v > F.lit(low), F.lit(bins)).otherwise(F.lit(0))
    inside = F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1))
    return F.when(v.isNull() | F.isnan(v), F.lit(MISSING)).otherwise(inside).cast("int")


def histograms(
    df: DataFrame, ts: str, known: Mapping[str, tuple[float, float]], window: str = "1 day", bins: int = BINS
) -> DataFrame:
    """window_start, column_name, bin, n for the columns whose limits are known; combined before the shuffle."""
    each = F.array(
        *[F.struct(F.lit(c).alias("column_name"), _bin(c, *known[c], bins).alias("bin")) for c in known]
    )
    rows = df.select(F.window(ts, window)["start"].alias("window_start"), F.explode(each).alias("e"))
    return rows.groupBy("window_start", "e.column_name", "e.bin").agg(F.count(F.lit(1)).alias("n"))


def merged(counts: DataFrame, window: str) -> DataFrame:
    """Counts of coarser windows from those of finer ones."""
    start = F.window("window_start", window)["start"].alias("window_start")
    return counts.groupBy(start, "column_name", "bin").agg(F.sum("n").alias("n"))


def drift(counts: DataFrame, baseline: DataFrame, bins: int = BINS) -> DataFrame:
    """window_start, column_name, n, psi and ks of every window against the baseline's counts.

    psi is the population stability index with half a row added to each bin, so that empty bins are
    finite; ks the largest difference of the cumulative shares at bin edges (missing values first).
    `baseline` has column_name, bin and n; columns without a baseline are left out.
    """
    base = baseline.groupBy("column_name", "bin").agg(F.sum("n").alias("base_n"))
    bin_of = F.explode(F.sequence(F.lit(MISSING), F.lit(bins - 1))).alias("bin")
    grid = counts.select("window_start", "column_name").distinct().select("window_start", "column_name", bin_of)
    grid = grid.join(base.select("column_name").distinct(), "column_name", "left_semi")
    full = grid.join(counts, ["window_start", "column_name", "bin"], "left").join(base, ["column_name", "bin"], "left")
    full = full.fillna(0, ["n", "base_n"])
    # At most `bins` + 1 rows in each of these windows.
    own = W.partitionBy("window_start", "column_name")
    upto = own.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    total, base_total = F.sum("n").over(own), F.sum("base_n").over(own)
    full = full.withColumns(
        {
            "p": (F.col("n") + 0.5) / (total + 0.5 * (bins + 1)),
            "q": (F.col("base_n") + 0.5) / (base_total + 0.5 * (bins + 1)),
            "gap": F.abs(F.sum("n").over(upto) / total - F.sum("base_n").over(upto) / base_total),
        }
    )
    return full.groupBy("window_start", "column_name").agg(
        F.sum("n").alias("n"), F.sum((F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))).alias("psi"), F.max("gap").alias("ks")
    )
