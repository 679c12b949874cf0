"""Top-N per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.report import ranking_text
from tidemark.operators.limits import number_first


def top_n(
    counts: DataFrame, n: int, key: str, by: Sequence[str] = ("window_end",), cnt: str = "cnt"
) -> DataFrame:
    """The `n` highest counts per window, ties by key."""
    ranked = number_first(counts, n, by, [F.desc(cnt), F.asc(key)], spread_by=key, name="rank")
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def top_n_report(ranked: DataFrame, key: str, label: str, cnt: str = "cnt") -> DataFrame:
    """One text block per window from the rows of `top_n`, so at most n rows per group."""
    places = F.sort_array(F.collect_list(F.struct("rank", F.col(key).alias("key"), F.col(cnt).alias("cnt"))))
    title = F.date_format("window_end", "yyyy-MM-dd HH:mm:ss")
    return (
        ranked.groupBy("window_end")
        .agg(places.alias("_places"))
        .select("window_end", ranking_text(title, F.col("_places"), label).alias("report"))
    )
