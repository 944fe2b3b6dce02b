"""Times: epoch milliseconds, buckets and partition columns. The session's time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds of a metric bucket.
RETENTION = 60


def epoch_ms(ts: Column) -> Column:
    """Milliseconds of a timestamp with or without time zone (read as UTC), rounded down."""
    return F.unix_millis(ts.cast("timestamp"))


def query_ts(time_ms: Column) -> Column:
    return F.timestamp_millis(time_ms)


def bucket(time_ms: Column, retention: int = RETENTION) -> Column:
    """Start of the bucket, in seconds."""
    seconds = F.floor(time_ms / 1000)
    return seconds - F.pmod(seconds, F.lit(retention))


def partition_columns(time_ms: Column) -> dict[str, Column]:
    ts = query_ts(time_ms)
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps."""
    return F.floor((F.unix_millis(end) - F.unix_millis(start)) / 1000).cast("int")
