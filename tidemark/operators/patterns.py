"""Sequence patterns on keyed event timelines, in event-time order."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.eventtime import as_micros
from tidemark.operators.slicing import copy_to_slices, home_slice, slice_width


def consecutive(
    events: DataFrame,
    key: str,
    matches: Column,
    times: int,
    within: timedelta,
    ts: str = "ts",
    seq: str = "event_id",
    width: int | None = None,
) -> DataFrame:
    """`times` strictly consecutive matching events of a key, last - first < `within`.

    Overlapping matches are all reported: key, `first_ts`, `last_ts`, `events`.

    Slices of any `width` (microseconds) will do. Matches inside a slice are found there. For the
    rest, only the first and last `times - 1` events of each slice count, as far as they are near
    its border: these few are put in order per key once more.
    """
    span, more = as_micros(within), times - 1
    width = width or slice_width(span)
    rows = home_slice(
        events.filter(F.col(ts).isNotNull()).select(
            key, F.unix_micros(ts).alias("us"), F.col(seq).alias("seq"), matches.alias("hit")
        ),
        F.col("us"),
        width,
    )

    def run(window) -> tuple[Column, Column]:
        """Whether a match starts here, and the time `times - 1` events on (null: not in view)."""
        last = F.lead("us", more).over(window) if more else F.col("us")
        all_hit = F.col("hit")
        for i in range(1, times):
            all_hit = all_hit & F.lead("hit", i).over(window)
        return F.coalesce(all_hit & (last - F.col("us") < span), F.lit(False)), last

    in_slice = Window.partitionBy(key, "slice").orderBy("us", "seq")
    found, last = run(in_slice)
    begin = F.col("slice") * width
    is_head = F.lag("us", more).over(in_slice).isNull() if more else F.lit(False)
    marked = rows.select(
        key,
        "slice",
        "us",
        "seq",
        "hit",
        found.alias("found"),
        last.alias("last"),
        (last.isNull() & (F.col("us") + span > begin + width)).alias("is_tail"),
        (is_head & (F.col("us") - span < begin)).alias("is_head"),
    ).filter("found OR is_tail OR is_head")

    # border events in one line per key, matches already found beside them per slice
    line = F.when(~F.col("is_tail") & ~F.col("is_head"), F.col("slice"))
    across, last_across = run(Window.partitionBy(key, "line").orderBy("us", "seq"))
    return (
        marked.withColumn("line", line)
        .withColumns({"across": across, "last_across": last_across})
        .filter("found OR (is_tail AND across)")
        .select(
            key,
            F.timestamp_micros("us").alias("first_ts"),
            F.timestamp_micros(F.when(F.col("found"), F.col("last")).otherwise(F.col("last_across"))).alias("last_ts"),
            F.lit(times).cast("bigint").alias("events"),
        )
    )


def followed_by(
    events: DataFrame,
    key: str,
    begins: Column,
    ends: Column,
    within: timedelta,
    ts: str = "ts",
    seq: str = "event_id",
) -> DataFrame:
    """For each begin event, the first end event after it, others allowed between.

    `end_ts` is set when that event came in less than `within`; otherwise `timeout_at` is.
    Result: key, `begin_ts`, `end_ts`, `timeout_at`.
    """
    span = as_micros(within)
    rows = events.select(
        key,
        F.unix_micros(ts).alias("us"),
        F.col(seq).alias("seq"),
        begins.alias("begins"),
        ends.alias("ends"),
    ).filter("begins OR ends")
    # only an end event is looked up from an earlier slice
    rows = copy_to_slices(
        rows, F.col("us"), slice_width(span), back=F.when(F.col("ends"), span).otherwise(0)
    )
    backwards = (
        Window.partitionBy(key, "slice")
        .orderBy(F.desc("us"), F.desc("seq"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    end_us = F.last(F.when(F.col("ends"), F.col("us")), ignorenulls=True).over(backwards)
    found = F.col("_end") - F.col("us") < span
    return (
        rows.withColumn("_end", end_us)
        .filter("begins AND is_home")
        .select(
            key,
            F.timestamp_micros("us").alias("begin_ts"),
            F.when(found, F.timestamp_micros("_end")).alias("end_ts"),
            F.when(F.coalesce(found, F.lit(False)), None)
            .otherwise(F.timestamp_micros(F.col("us") + span))
            .alias("timeout_at"),
        )
    )
