"""Event-time arithmetic on epoch microseconds, independent of the session time zone."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000


def as_micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def as_interval(span: timedelta) -> str:
    """The span as Spark's window and watermark functions take it."""
    return f"{as_micros(span)} microseconds"


def align_down(us: Column, width: int) -> Column:
    """Start of the epoch-aligned interval of `width` that holds `us`."""
    return us - F.pmod(us, F.lit(width))


def interval_no(us: Column, width: int) -> Column:
    """Number of the epoch-aligned interval of `width` that holds `us` (floor division)."""
    return (align_down(us, width) / F.lit(width)).cast("bigint")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts)


def next_midnight(ts: Column) -> Column:
    """The following midnight, at which daily counters start again."""
    return F.date_add(F.to_date(ts), 1).cast("timestamp")
