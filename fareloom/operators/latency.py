"""Latency summary of a request log, with exact percentiles."""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits in milliseconds.
LATENCY_LIMITS = {"avg_ms": 150.0, "p50_ms": 150.0, "p95_ms": 200.0, "p99_ms": 400.0}


BINS = 4096


def _ranks(counted: int, probs: Mapping[str, float]) -> dict[str, tuple[int, int, float]]:
    """Lower and upper rank (from 0) and the place between them, per quantile."""
    out = {}
    for name, p in probs.items():
        at = (counted - 1) * float(p)
        out[name] = (math.floor(at), math.ceil(at), at - math.floor(at))
    return out


def exact_quantiles(df: DataFrame, value: str, probs: Mapping[str, float], bins: int = BINS) -> DataFrame:
    """One row of linearly interpolated quantiles, computed without gathering the values.

    Every pass counts the values in a fixed number of equal bins between the bounds known so far for
    a rank, and the smallest and largest value of each bin: at most `bins` rows a rank, whatever the
    values. The bin that holds the rank gives the bounds of the next pass, until they meet: then the
    value is known. A bin is never wider than its own values, so one far outlier costs one pass.
    Ranks in the same bin share a pass. NULL and NaN are left out; infinities count as values.
    """
    values = df.select(F.col(value).cast("double").alias("v")).dropna()
    n, low, high = values.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    if not n:
        return df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(q) for q in probs])
    ranks = _ranks(n, probs)
    open_ranks = {r: (low, high, 0) for pair in ranks.values() for r in pair[:2]}  # bounds, values before
    known: dict[int, float] = {}
    while open_ranks:
        for rank, (a, b, _) in list(open_ranks.items()):
            if a == b:
                known[rank] = a
                del open_ranks[rank]
        spans = sorted(set(open_ranks.values()))
        if not spans:
            break
        counted = _binned(values, [s[:2] for s in spans], bins)
        for rank, span in open_ranks.items():
            before = span[2]
            for held, a, b in counted[span[:2]]:
                if rank < before + held:
                    open_ranks[rank] = (a, b, before)
                    break
                before += held
    out = {}
    for name, (lo, hi, part) in ranks.items():
        a, b = known[lo], known[hi]
        out[name] = a if a == b else a + (b - a) * part
    return df.sparkSession.range(1).select(*[F.lit(float(v)).alias(q) for q, v in out.items()])


def _binned(values: DataFrame, spans: Sequence[tuple[float, float]], bins: int) -> dict:
    """(count, least, largest) of the bins in order, for each span of values."""
    v, span, place = F.col("v"), F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, (a, b) in enumerate(spans):
        inside = v.between(F.lit(a), F.lit(b))
        span = F.when(inside, F.lit(i)).otherwise(span)
        # Infinities have bins of their own; halves keep the width of the widest span finite.
        low, high = max(a, -sys.float_info.max), min(b, sys.float_info.max)
        width = high / 2 - low / 2
        if width > 0:
            share = (v / 2 - F.lit(low / 2)) / F.lit(width)
            own = F.least(F.greatest(F.floor(share * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
        else:  # neighbours whose distance is lost in the halves
            own = F.when(v > F.lit(a), F.lit(1)).otherwise(F.lit(0))
        own = F.when(v < F.lit(low), F.lit(-1)).when(v > F.lit(high), F.lit(bins)).otherwise(own)
        place = F.when(inside, own).otherwise(place)
    rows = (
        values.select(v, span.alias("span"), place.alias("place"))
        .filter("span is not null")
        .groupBy("span", "place")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    )
    out: dict = {own: [] for own in spans}
    for r in sorted(rows, key=lambda r: (r["span"], r["place"])):
        out[spans[r["span"]]].append((r["n"], r["low"], r["high"]))
    return out


def latency_summary(
    log: DataFrame,
    duration_s: float,
    tps_target: float | None = None,
    latency: str = "latency_ms",
    failed: str = "failed",
) -> DataFrame:
    """Requests, failures, mean, percentiles, range and rate in one row."""
    ms = F.col(latency)
    totals = log.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col(failed)).alias("failures"),
        F.round(F.avg(ms), 2).alias("avg_ms"),
        F.round(F.min(ms), 2).alias("min_ms"),
        F.round(F.max(ms), 2).alias("max_ms"),
    )
    probs = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    quantiles = exact_quantiles(log, latency, probs)
    rate = F.round(F.col("requests") / F.lit(float(duration_s)), 3) if duration_s else F.lit(0.0)
    # Two one-row results with different columns, laid over each other.
    both = totals.unionByName(quantiles, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        "requests",
        "failures",
        "avg_ms",
        *[F.round(q, 2).alias(q) for q in probs],
        "min_ms",
        "max_ms",
        rate.alias("reqs_per_s_observed"),
        F.lit(tps_target).cast("double").alias("tps_target"),
    )


def latency_summary_approx(
    log: DataFrame, latency: str = "latency_ms", accuracy: int = 10_000
) -> DataFrame:
    """Percentiles from one mergeable sketch per task, for when a small rank error will do."""
    q = F.percentile_approx(latency, [0.5, 0.95, 0.99], accuracy)
    return log.agg(q.alias("q")).select(
        *[F.col("q")[i].alias(n) for i, n in enumerate(("p50_ms", "p95_ms", "p99_ms"))]
    )


SKETCH_K = 200  # about 1.65 % rank error with 99 % confidence, a few KB each, whatever the log


def latency_sketches(log: DataFrame, ts: str, window: str, latency: str = "latency_ms") -> DataFrame:
    """One mergeable quantile sketch per time window: a table that can be kept and added to."""
    return (
        log.groupBy(F.window(ts, window).alias("_w"))
        .agg(F.kll_sketch_agg_double(F.col(latency).cast("double"), F.lit(SKETCH_K)).alias("sketch"))
        .select(F.col("_w.start").alias("window_start"), "sketch")
    )


def latency_trend(
    sketches: DataFrame, window: str, probs: Mapping[str, float], start: str = "window_start"
) -> DataFrame:
    """Quantiles per coarser window, from the sketches of finer ones; the log is not read again."""
    merged = sketches.groupBy(F.window(start, window).alias("_w")).agg(F.kll_merge_agg_double("sketch").alias("_s"))
    return merged.select(
        F.col("_w.start").alias("window_start"),
        F.kll_sketch_get_n_double("_s").alias("requests"),
        *[F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(q) for q, p in probs.items()],
    )


RANK_ERROR = 0.03  # twice what a sketch of SKETCH_K promises


def rank_errors(
    log: DataFrame, trend: DataFrame, ts: str, window: str, probs: Mapping[str, float], latency: str = "latency_ms"
) -> DataFrame:
    """Per window: requests, and for each quantile whether its rank in the log is within RANK_ERROR."""
    own = log.select(F.window(ts, window)["start"].alias("window_start"), F.col(latency).alias("_v"))
    n = F.count("_v")
    checks = []
    for q, p in probs.items():
        below, upto = F.count_if(F.col("_v") < F.col(q)), F.count_if(F.col("_v") <= F.col(q))
        checks.append(((below <= (p + RANK_ERROR) * n) & (upto >= (p - RANK_ERROR) * n)).alias(f"{q}_within"))
    return own.join(trend.drop("requests"), "window_start").groupBy("window_start").agg(n.alias("requests"), *checks)


def latency_slo(summary: DataFrame, limits: Mapping[str, float] = LATENCY_LIMITS) -> DataFrame:
    """One row per limit: the observed value and whether it is within."""
    checks: Sequence = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(name).cast("double").alias("observed"),
            F.lit(float(limit)).alias("limit_ms"),
            F.coalesce(F.col(name) <= limit, F.lit(False)).alias("passed"),
        )
        for name, limit in limits.items()
    ]
    return summary.select(F.explode(F.array(*checks)).alias("c")).select("c.*")
