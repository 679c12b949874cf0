"""Totals and averages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.eventtime import align_down, as_micros


def two_phase_counts(
    df: DataFrame, size: timedelta, spread_by: Column, salts: int = 32, ts: str = "ts", cnt: str = "cnt"
) -> DataFrame:
    """Rows per tumbling window, counted per (window, salt) first and summed afterwards.

    The salt is a hash of the row, so that a retried task gives the same partial counts.
    """
    width = as_micros(size)
    salted = df.filter(F.col(ts).isNotNull()).select(
        align_down(F.unix_micros(ts), width).alias("_start"),
        F.pmod(F.xxhash64(spread_by), F.lit(salts)).alias("_salt"),
    )
    partial = salted.groupBy("_start", "_salt").agg(F.count("*").alias("_n"))
    total = partial.groupBy("_start").agg(F.sum("_n").alias(cnt))
    return total.select(
        F.timestamp_micros("_start").alias("window_start"),
        F.timestamp_micros(F.col("_start") + width).alias("window_end"),
        cnt,
    )


def average_by(df: DataFrame, keys: Sequence[str], value: Column, name: str = "average") -> DataFrame:
    """Average of whole numbers per key: an exact sum divided once, as (sum, count) would."""
    return df.groupBy(*keys).agg((F.sum(value) / F.count(value)).alias(name))
