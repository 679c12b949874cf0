"""The first rows of each group, without bringing a group together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIMIT_BEFORE_SHUFFLE = "spark.sql.optimizer.windowGroupLimitThreshold"
SALTS = 64


def number_first(
    df: DataFrame, n: int, by: Sequence[str], order: Sequence[Column], spread_by: str, name: str
) -> DataFrame:
    """The first `n` rows per group, numbered from 1 in `name`.

    Spark applies a small bound on the row number in each task before the shuffle, so a group
    with very many rows adds at most `n` per task. Beyond the size up to which it does so, rows
    are first limited per group and salt, a hash of `spread_by`: none of the first `n` rows of a
    group can be missing from the first `n` of its salt.
    """
    largest = int(df.sparkSession.conf.get(LIMIT_BEFORE_SHUFFLE, "1000"))
    if n > largest:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
        df = _first(salted, n, [*by, "_salt"], order, name).drop("_salt", name)
    return _first(df, n, by, order, name)


def _first(df: DataFrame, n: int, by: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
