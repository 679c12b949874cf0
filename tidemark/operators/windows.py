"""Counts per key in tumbling and sliding event-time windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.eventtime import align_down, as_interval, as_micros, interval_no

BLOCK_SIZES = 8


def tumbling_counts(
    df: DataFrame, keys: Sequence[str], size: timedelta, ts: str = "ts", cnt: str = "cnt"
) -> DataFrame:
    """Rows per key and epoch-aligned window: keys, `window_start`, `window_end`, `cnt`."""
    width = as_micros(size)
    start = align_down(F.unix_micros(ts), width)
    dated = df.filter(F.col(ts).isNotNull())
    counted = dated.groupBy(*keys, start.alias("_start")).agg(F.count("*").alias(cnt))
    return counted.select(
        *keys,
        F.timestamp_micros("_start").alias("window_start"),
        F.timestamp_micros(F.col("_start") + width).alias("window_end"),
        cnt,
    )


def sliding_counts(
    df: DataFrame,
    keys: Sequence[str],
    size: timedelta,
    slide: timedelta,
    ts: str = "ts",
    cnt: str = "cnt",
    first_open: Column | None = None,
) -> DataFrame:
    """Rows per key and sliding window, without copying a row into each of its windows.

    Rows are first counted per pane of one slide. A pane raises the count at the first window end
    it belongs to and lowers it after the last, so a running sum over these changes gives the
    count of every window. Window ends are cut into blocks, and a pane that reaches into the next
    block raises the count again at the block's start: a key with a long history, or no key at
    all, is spread over as many tasks as there are blocks, and no total is carried between them.

    `first_open` (epoch microseconds), if given, is the earliest window end a row may still
    count in; rows that find all their windows closed count nowhere.
    """
    panes = open_panes(df, keys, size, slide, ts, first_open)
    return counts_of_open_panes(panes, keys, size, slide, cnt)


def open_panes(
    df: DataFrame, keys: Sequence[str], size: timedelta, slide: timedelta, ts: str = "ts", first_open: Column | None = None
) -> DataFrame:
    """(keys, `_first`, `_stop`, `_n`): rows by the first window end they count in and the one after the last."""
    size_us, slide_us = as_micros(size), as_micros(slide)
    if size_us % slide_us:
        raise ValueError("the window size must be a multiple of the slide")
    pane_first = align_down(F.unix_micros(ts), slide_us) + slide_us
    df = df.filter(F.col(ts).isNotNull())
    rows = df.select(
        *keys,
        pane_first.alias("_first"),
        (pane_first + size_us).alias("_stop"),
    )
    if first_open is not None:
        opened = align_down(first_open + slide_us - 1, slide_us)
        rows = df.select(
            *keys,
            F.greatest(pane_first, opened).alias("_first"),
            (pane_first + size_us).alias("_stop"),
        ).filter("_first < _stop")
    return rows.groupBy(*keys, "_first", "_stop").agg(F.count("*").alias("_n"))


def counts_of_open_panes(
    panes: DataFrame, keys: Sequence[str], size: timedelta, slide: timedelta, cnt: str = "cnt"
) -> DataFrame:
    """Sliding counts from the rows of `open_panes`, which may be added up in several steps."""
    return _running_counts(panes, keys, as_micros(size), as_micros(slide), cnt)


def sliding_counts_of_panes(
    panes: DataFrame, keys: Sequence[str], size: timedelta, slide: timedelta, pane: str = "pane", cnt: str = "cnt"
) -> DataFrame:
    """Sliding counts from counts per key and slide (`pane` is where the slide starts)."""
    size_us, slide_us = as_micros(size), as_micros(slide)
    first = F.unix_micros(pane) + slide_us
    rows = panes.select(*keys, first.alias("_first"), (first + size_us).alias("_stop"), F.col(cnt).alias("_n"))
    return _running_counts(rows, keys, size_us, slide_us, cnt)


def _running_counts(panes: DataFrame, keys: Sequence[str], size_us: int, slide_us: int, cnt: str) -> DataFrame:
    """Counts per window from panes: `_first` and `_stop` bound their window ends, `_n` is their count."""
    block_us = size_us * BLOCK_SIZES
    first, stop, n = F.col("_first"), F.col("_stop"), F.col("_n")

    # a block is longer than a window, so a pane reaches into at most one more
    block, last_block = interval_no(first, block_us), interval_no(stop - slide_us, block_us)

    def change(block: Column, at: Column, delta: Column) -> Column:
        return F.struct(block.alias("block"), at.alias("at"), delta.alias("delta"))

    within = [change(block, first, n), change(block, F.least(stop, (block + 1) * block_us), -n)]
    beyond = [change(last_block, last_block * block_us, n), change(last_block, stop, -n)]
    changes = F.when(block == last_block, F.array(*within)).otherwise(F.array(*within, *beyond))
    deltas = panes.select(*keys, F.explode(changes).alias("_c")).select(
        *keys, "_c.block", "_c.at", "_c.delta"
    )

    timeline = Window.partitionBy(*keys, "block").orderBy("at")
    steps = deltas.select(
        *keys,
        "at",
        # the default frame takes in all changes at the same window end
        F.sum("delta").over(timeline).alias(cnt),
        F.lead("at").over(timeline).alias("_next"),
    ).filter((F.col("_next") > F.col("at")) & (F.col(cnt) > 0))
    ends = steps.select(
        *keys, F.explode(F.sequence("at", F.col("_next") - slide_us, F.lit(slide_us))).alias("_end"), cnt
    )
    return ends.select(
        *keys,
        F.timestamp_micros(F.col("_end") - size_us).alias("window_start"),
        F.timestamp_micros("_end").alias("window_end"),
        cnt,
    )


def sliding_counts_direct(
    df: DataFrame, keys: Sequence[str], size: timedelta, slide: timedelta, ts: str = "ts", cnt: str = "cnt"
) -> DataFrame:
    """The built-in sliding window: for streams, and for windows of few slides."""
    window = F.window(ts, as_interval(size), as_interval(slide))
    return (
        df.groupBy(*keys, window.alias("_w"))
        .agg(F.count("*").alias(cnt))
        .select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), cnt)
    )
