"""Time slices of a keyed timeline.

A window or join partitioned by a key alone puts a hot key into one task. All patterns and joins
here are bounded in time, so the timeline of a key is cut into slices, and a row that matters to a
neighbouring slice is copied there. Tasks then hold one slice of one key. Every result belongs to
the home slice of one of its rows, so copies never add results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.eventtime import interval_no

SPANS_PER_SLICE = 4


def slice_width(span: int, spans_per_slice: int = SPANS_PER_SLICE) -> int:
    """Width that keeps copies to about `1/spans_per_slice` of the rows."""
    return max(span, 1) * spans_per_slice


def copy_to_slices(
    df: DataFrame, us: Column, width: int, back: int | Column = 0, ahead: int | Column = 0
) -> DataFrame:
    """Adds `slice`, one row per slice that overlaps `[us - back, us + ahead]`, and `is_home`."""
    home = interval_no(us, width)
    return df.select(
        "*",
        home.alias("_home"),
        F.explode(
            F.sequence(interval_no(us - _lit(back), width), interval_no(us + _lit(ahead), width))
        ).alias("slice"),
    ).select(*df.columns, "slice", (F.col("slice") == F.col("_home")).alias("is_home"))


def home_slice(df: DataFrame, us: Column, width: int) -> DataFrame:
    """Adds `slice`, without copies."""
    return df.withColumn("slice", interval_no(us, width))


def _lit(span: int | Column) -> Column:
    return span if isinstance(span, Column) else F.lit(span)
