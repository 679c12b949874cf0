"""Click-fraud cap per (user, ad, day) with one alert per offender."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.limits import number_first

DEFAULT_KEYS = ("user_id", "ad_id")


def _first_clicks(
    clicks: DataFrame, limit: int, keys: Sequence[str], ts: str, seq: str
) -> DataFrame:
    """The first `limit + 1` clicks of each group, numbered in `_rn`.

    A bot with a third of all clicks adds next to nothing to the shuffle.
    """
    dated = clicks.withColumn("_day", F.to_date(ts))
    return number_first(dated, limit + 1, [*keys, "_day"], [F.col(ts), F.col(seq)], spread_by=seq, name="_rn")


def capped_clicks(
    clicks: DataFrame,
    limit: int,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    seq: str = "event_id",
    mode: Literal["drop_all", "drop_first_only"] = "drop_all",
) -> DataFrame:
    """Clicks that pass the cap.

    `drop_all` drops every click of the day after the first `limit`; `drop_first_only` drops only
    the click that raised the alert and lets later ones pass.
    """
    first = _first_clicks(clicks, limit, keys, ts, seq)
    if mode == "drop_all":
        return first.filter(F.col("_rn") <= limit).select(*clicks.columns)
    if mode == "drop_first_only":
        raised = first.filter(F.col("_rn") == limit + 1).select(seq)
        return clicks.join(raised, seq, "left_anti").select(*clicks.columns)
    raise ValueError(f"unknown mode {mode!r}")


def cap_alerts(
    clicks: DataFrame,
    limit: int,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    seq: str = "event_id",
) -> DataFrame:
    """One row per group and day that went over the limit, at the click that did."""
    return (
        _first_clicks(clicks, limit, keys, ts, seq)
        .filter(F.col("_rn") == limit + 1)
        .select(*keys, ts, F.lit(f"click over {limit} times today").alias("msg"))
    )
