"""Timestamp functions as native expressions.

The session zone is UTC. Results are TIMESTAMP_NTZ wall clocks, so they come out the same
whether the input column is TIMESTAMP or TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(as_col(ts).cast("timestamp"))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970, fractions dropped."""
    return F.unix_seconds(as_col(ts).cast("timestamp"))


def from_epoch_seconds(seconds: Column | str) -> Column:
    return F.timestamp_seconds(as_col(seconds)).cast("timestamp_ntz")


def ceil_ts(ts: Column | str, minutes: int) -> Column:
    """Round up to the next multiple of `minutes` within the hour.

    Exact multiples stay as they are and NULL stays NULL. Integer arithmetic on microseconds,
    so one microsecond past a boundary moves to the next one.
    """
    if minutes <= 0 or 60 % minutes:
        raise ValueError(f"minutes must divide 60, got {minutes}")
    micros = epoch_micros(ts)
    step = F.lit(minutes * MICROS_PER_MINUTE)
    return F.timestamp_micros(micros + F.pmod(-micros, step)).cast("timestamp_ntz")


def partition_id(ts: Column | str) -> Column:
    """Month partition label, YYYY-MM."""
    return F.date_format(as_col(ts).cast("timestamp"), "yyyy-MM")


def is_weekend_tz(ts: Column | str, tz: str = "America/New_York") -> Column:
    """1 on Saturday and Sunday as seen in `tz`, else 0."""
    local = F.from_utc_timestamp(as_col(ts).cast("timestamp"), tz)
    return (F.weekday(local) >= 5).cast("int")


def is_weekend(ts: Column | str) -> Column:
    """1 on Saturday and Sunday of the session zone; NULL counts as 0."""
    return F.when(F.dayofweek(as_col(ts)).isin(1, 7), 1).otherwise(0)


def parse_ts(text: Column | str) -> Column:
    """String or literal to TIMESTAMP_NTZ."""
    return F.to_timestamp_ntz(as_col(text))


def days_before(as_of: str, days: int) -> Column:
    """Start of the rolling window that ends at `as_of`, in days."""
    return F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")


def months_before(as_of: str, months: int) -> Column:
    return F.add_months(F.lit(as_of).cast("date"), -months).cast("timestamp_ntz")


def open_end(ts: Column | str) -> Column:
    """NULL end of validity becomes the far-future sentinel."""
    return F.coalesce(as_col(ts), F.to_timestamp_ntz(F.lit("9999-12-31 23:59:59")))
