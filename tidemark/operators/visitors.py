"""Distinct visitors per tumbling window."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.eventtime import align_down, as_micros
from tidemark.functions.hashing import rolling_offset


def _in_windows(df: DataFrame, size: timedelta, visitor: Column, ts: str) -> DataFrame:
    return df.filter(F.col(ts).isNotNull()).select(
        align_down(F.unix_micros(ts), as_micros(size)).alias("_start"), visitor.alias("_visitor")
    )


def _with_bounds(df: DataFrame, size: timedelta) -> DataFrame:
    return df.select(
        F.timestamp_micros("_start").alias("window_start"),
        F.timestamp_micros(F.col("_start") + as_micros(size)).alias("window_end"),
        "uv",
    )


def exact(df: DataFrame, size: timedelta, visitor: str = "user_id", ts: str = "ts") -> DataFrame:
    """Exact distinct count; Spark spreads it by (window, visitor) before counting."""
    rows = _in_windows(df, size, F.col(visitor), ts)
    return _with_bounds(rows.groupBy("_start").agg(F.count_distinct("_visitor").alias("uv")), size)


def from_full_set(df: DataFrame, size: timedelta, visitor: str = "user_id", ts: str = "ts") -> DataFrame:
    """Size of each window's whole visitor set.

    The set stays distributed as (window, visitor) rows; no window's set sits in one buffer.
    """
    members = _in_windows(df, size, F.col(visitor), ts).distinct()
    return _with_bounds(members.groupBy("_start").agg(F.count("*").alias("uv")), size)


def hashed_bitmap(df: DataFrame, size: timedelta, visitor: str = "user_id", ts: str = "ts") -> DataFrame:
    """Set bits of a 2^30-bit bitmap per window, one hash per visitor, so collisions undercount.

    The hash is computed once per distinct visitor of a window. Hashed offsets lie scattered, so
    the bitmap is kept sparse, as the distinct offsets.
    """
    members = _in_windows(df, size, F.col(visitor).cast("string"), ts).distinct()
    offsets = members.select("_start", rolling_offset(F.col("_visitor")).alias("_offset"))
    return _with_bounds(offsets.groupBy("_start").agg(F.count_distinct("_offset").alias("uv")), size)


def id_bitmap(df: DataFrame, size: timedelta, visitor: str = "user_id", ts: str = "ts") -> DataFrame:
    """Exact distinct count of whole-number ids from bitmaps indexed by the id itself.

    For ids that lie close together: a window's bitmap is aggregated in chunks of 4 KiB, one per
    32,768 neighbouring ids.
    """
    chunks = (
        _in_windows(df, size, F.col(visitor), ts)
        .groupBy("_start", F.bitmap_bucket_number("_visitor").alias("_chunk"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_visitor")).alias("_bits"))
    )
    return _with_bounds(chunks.groupBy("_start").agg(F.sum(F.bitmap_count("_bits")).alias("uv")), size)


def approximate(
    df: DataFrame, size: timedelta, visitor: str = "user_id", ts: str = "ts", rsd: float = 0.02
) -> DataFrame:
    """Sketch-based distinct count: constant state per window."""
    rows = _in_windows(df, size, F.col(visitor), ts)
    return _with_bounds(
        rows.groupBy("_start").agg(F.approx_count_distinct("_visitor", rsd).alias("uv")), size
    )
