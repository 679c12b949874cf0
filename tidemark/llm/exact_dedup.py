"""Exact duplicates by distributed MSD radix partitioning."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty, written

#: Bytes of the first digit; each further digit is so many times as wide.
FIRST_DIGIT = 64
WIDER = 4


def exact_groups(
    documents: DataFrame, carry: Mapping[str, Column] | None = None, first_digit: int = FIRST_DIGIT
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept) and the columns of `carry`, for each row of (doc_id, text).

    Texts are split by successive digits, strings of bytes that grow in width. In each round the
    rows of a group that share the next digit become a group of their own; a group is done when it
    has one row or when its texts have ended, and only the others go on with the rest of their
    texts. Bytes are compared themselves, no digest of them. A digit's rows are counted before the
    shuffle, so a large group of copies counts as a few rows, and rows find their group by a join
    whose large partitions Spark splits.

    Of equal texts the row with the largest doc_id stays, and one of those rows if several have it; a
    null doc_id is below all others. Null texts are empty texts, and empty texts are equal. An empty
    table gives an empty table. Columns of `documents` other than those two and what `carry` reads are
    ignored.
    """
    carry = dict(carry or {})
    names = list(carry)
    none = F.lit(None).cast("bigint")
    rows = documents.select(
        F.lit(0).cast("bigint").alias("_group"),
        none.alias("_row"),
        F.col("doc_id"),
        F.struct(F.lit(0).alias("_none"), *(column.alias(name) for name, column in carry.items())).alias("_carried"),
        text_or_empty("text").cast("binary").alias("_rest"),
    )
    width, done, numbered = first_digit, [], False
    while True:
        digit = F.substring("_rest", 1, width)
        dealt = rows.withColumn("_digit", digit)
        shared = (
            dealt.groupBy("_group", "_digit")
            .agg(F.count(F.lit(1)).alias("_size"), F.max(F.struct("doc_id", "_row")).alias("_largest"))
            .filter("_size > 1")
        )
        nodes = written(
            shared.select(
                F.col("_group").alias("_from"),
                F.col("_digit").alias("_by"),
                "_size",
                "_largest",
                F.monotonically_increasing_id().alias("_next"),
            ),
            "radix-groups",
        )
        # by sorted partitions at any size: only these are split where a group is large
        joined = dealt.join(nodes.hint("merge"), (F.col("_group") == F.col("_from")) & (F.col("_digit") == F.col("_by")), "left")
        # no group ends before its rows are written with a number, which tells equal rows apart
        goes_on = F.col("_next").isNotNull() & (F.length("_digit") == width if numbered else F.lit(True))
        split = written(
            joined.select(
                F.when(goes_on, F.col("_next")).alias("_group"),
                F.col("_row") if numbered else F.monotonically_increasing_id().alias("_row"),
                "doc_id",
                "_carried",
                F.when(goes_on, F.expr(f"substring(_rest, {width + 1})")).alias("_rest"),
                F.when(F.col("_next").isNotNull(), F.col("_largest")).alias("_largest"),
                F.coalesce("_size", F.lit(1)).cast("bigint").alias("group_size"),
            ),
            "radix-rows",
        )
        done.append(split.filter("_group IS NULL"))
        rows = split.filter("_group IS NOT NULL").select("_group", "_row", "doc_id", "_carried", "_rest")
        if rows.isEmpty():
            break
        width, numbered = width * WIDER, True
    alone = F.col("_largest").isNull()
    return reduce(DataFrame.unionByName, done).select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_largest.doc_id")).alias("keep_id"),
        "group_size",
        (alone | (F.col("_row") == F.col("_largest._row"))).alias("kept"),
        *(F.col(f"_carried.{name}") for name in names),
    )
