"""Text rendering of a ranking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RULE = "=" * 30


def ranking_text(title: Column, ranked: Column, label: str) -> Column:
    """One text block per ranking: the time, one line per place, a closing rule.

    `ranked` is an array of structs `(rank, key, cnt)` in rank order.
    """
    lines = F.transform(
        ranked,
        lambda r: F.concat(
            F.lit("Top"), r["rank"].cast("string"),
            F.lit(f": {label}="), r["key"].cast("string"),
            F.lit(" count="), r["cnt"].cast("string"),
        ),
    )
    header = F.concat(F.lit("time: "), title)
    return F.concat_ws("\n", header, F.array_join(lines, "\n"), F.lit(RULE))
