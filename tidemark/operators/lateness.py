"""Late rows: what had already been closed when a row arrived."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.eventtime import align_down, as_micros, interval_no

ARRIVALS_PER_BUCKET = 1 << 16
# Fixed value: a window [start, end) ends one millisecond before `end`.
TICK_US = 1000


def with_watermark_at_arrival(
    df: DataFrame,
    disorder: timedelta,
    ts: str = "ts",
    seq: str = "event_id",
    bucket: int = ARRIVALS_PER_BUCKET,
) -> DataFrame:
    """Adds `watermark_us`: the highest event time of earlier arrivals minus `disorder`.

    `seq` numbers arrivals. A running maximum over all rows would be one task, so arrivals are
    cut into buckets of `bucket` numbers and these into groups of `bucket` buckets: the running
    maximum is taken over the groups (one per `bucket` squared arrivals), then over the buckets
    of each group, then over the rows of each bucket.
    """
    rows = df.withColumn("_bucket", interval_no(F.col(seq), bucket))
    buckets = (
        rows.groupBy("_bucket")
        .agg(F.max(F.unix_micros(ts)).alias("_max"))
        .withColumn("_group", interval_no(F.col("_bucket"), bucket))
    )
    groups = buckets.groupBy("_group").agg(F.max("_max").alias("_max"))
    group_carry = groups.select("_group", _max_before("_max", Window.orderBy("_group")).alias("_before"))
    in_group = Window.partitionBy("_group").orderBy("_bucket")
    bucket_carry = buckets.join(group_carry, "_group").select(
        "_bucket", F.greatest("_before", _max_before("_max", in_group)).alias("_before")
    )
    in_bucket = Window.partitionBy("_bucket").orderBy(seq)
    highest = F.greatest("_before", _max_before(F.unix_micros(ts), in_bucket))
    return rows.join(bucket_carry, "_bucket").select(
        *df.columns, (highest - as_micros(disorder)).alias("watermark_us")
    )


def too_late(size: timedelta, slide: timedelta, lateness: timedelta, ts: str = "ts") -> Column:
    """Whether even the last window of a row was closed when it arrived."""
    slide_us = as_micros(slide)
    last_end = align_down(F.unix_micros(ts), slide_us) + as_micros(size)
    closed = F.col("watermark_us") >= last_end - TICK_US + as_micros(lateness)
    return F.coalesce(closed, F.lit(False))


def first_open_end(lateness: timedelta) -> Column:
    """Earliest window end (microseconds) still accepting rows at a row's arrival."""
    return F.col("watermark_us") + TICK_US - as_micros(lateness) + 1


def _max_before(value: str | Column, window) -> Column:
    return F.max(value).over(window.rowsBetween(Window.unboundedPreceding, -1))
