"""Mixing of sources to target weights, by hash-random order and distributed prefix sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, prefix_sums, text_or_empty, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = 20


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most_epochs: int) -> DataFrame:
    """`target` of each row of (source, source_size).

    Sources take `weights` in turn by code point, null last. All targets together are `share` of
    all sizes; a target stops at `most_epochs` times its source's size, and what is above goes to
    the others by weight. So every target is the lesser of its stop and `level * weight`, and the
    level follows from the sources in the order in which they reach their stops.
    """
    numbered = prefix_sums(
        sizes.withColumn("_null", F.col("source").isNull().cast("int")).withColumn("_all", F.lit(0)),
        "_all", ["_null", "source"], "source_size", "mix-sources",
    )
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (F.col("row_before") % len(weights) + 1).cast("int")
    )
    weighed = numbered.select(
        "source",
        "source_size",
        weight.alias("weight"),
        (F.col("source_size") * F.lit(most_epochs)).alias("stop"),
        (F.col("source_size") * F.lit(most_epochs) / weight).alias("_stops_at"),
        F.lit(0).alias("_all"),
    )
    # the stops and the weights of the sources that stop before, in one order
    by_stop = prefix_sums(weighed, "_all", ["_stops_at", "source"], "stop", "mix-stops")
    by_stop = prefix_sums(
        by_stop.withColumnRenamed("before", "stops_before").drop("row_before"),
        "_all", ["_stops_at", "source"], "weight", "mix-weights",
    ).withColumnRenamed("before", "weights_before")
    whole = weighed.groupBy("_all").agg(F.sum("source_size").alias("_size"), F.sum("weight").alias("_weight"))
    # the level, if this source is the first in that order that doesn't reach its stop
    level = (F.col("_size") * F.lit(share) - F.col("stops_before")) / (F.col("_weight") - F.col("weights_before"))
    levels = by_stop.join(F.broadcast(whole), "_all").withColumn("_level", level)
    below = F.col("_stops_at") >= F.col("_level")
    found = levels.groupBy("_all").agg(
        F.min_by(F.when(below, F.col("_level")), F.when(below, F.struct("_stops_at", "weights_before"))).alias("_at")
    )
    # both joined tables are one row
    target = F.least(F.col("stop"), F.col("_at") * F.col("weight"))
    return levels.join(F.broadcast(found), "_all").select("source", "source_size", target.alias("target"))


def mix(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
    seed: int = SEED,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) and the columns of `carry`, for each row of (doc_id, text, source).

    `size` is the number of words, null texts having none. A source's documents stand in the order
    of a hash of `doc_id` and `seed`. The mix takes the whole source as often as its target allows
    and then, in that order, words up to the exact rest of the target, which may end within a
    document. `taken` counts the words the mix takes of a document, repeats included.

    Nulls: a null source is a source, the last; a null doc_id is an id like others. Repeated rows
    count as often as they occur and follow one another. An empty table gives an empty table, and
    sources without words have the target 0. Other columns are not read.
    """
    carry = dict(carry or {})
    carried = F.struct(F.lit(0).alias("_none"), *(column.alias(name) for name, column in carry.items()))
    sized = documents.select(
        "doc_id",
        "source",
        word_count("text").alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")).alias("_key"),
        carried.alias("_carried"),
    )
    rows = written(sized, "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = written(targets(sizes, weights, share, most_epochs), "mix-targets").withColumnRenamed("source", "_of")
    placed = prefix_sums(rows, "source", ["_key", "doc_id", "size"], "size", "mix-order").drop("row_before")
    joined = placed.join(goals, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    goal = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = goal - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return joined.select(
        "doc_id", "size", "source_size", "target", (epochs * F.col("size") + part).cast("bigint").alias("taken"),
        *(F.col(f"_carried.{name}") for name in carry),
    )


def taken_documents(documents: DataFrame, taken: Column, size: Column) -> DataFrame:
    """The rows of (text) as often as `taken` words fill them, the last time up to the word where they end."""
    pieces = F.split(text_or_empty("text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("_words")), "")
    counted = documents.withColumn("_epochs", F.floor(taken / size).cast("int")).withColumn("_words", (taken % size).cast("int"))
    copies = F.concat(
        F.array_repeat(F.lit(False), F.col("_epochs")), F.array_repeat(F.lit(True), F.when(F.col("_words") > 0, 1).otherwise(0))
    )
    repeated = counted.filter(taken > 0).withColumn("_cut", F.explode(copies))
    return repeated.withColumn("text", F.when(F.col("_cut"), cut).otherwise(F.col("text"))).drop("_epochs", "_words", "_cut")
