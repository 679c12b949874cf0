"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.runtime import scratch_dir

#: A word: a run without space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Links between nodes that a task contracts at a time.
EDGES_AT_ONCE = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(frame: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """The frame as a table in the shared folder, read back.

    This cuts the lineage in a way that survives lost executors, fixes values that depend on how
    rows were partitioned, and lets Spark choose joins by the table's real size.
    """
    path = scratch_dir(frame.sparkSession, purpose)
    frame.write.option("compression", codec).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def prefix_sums(rows: DataFrame, group: str, order: list[str], value: str, purpose: str) -> DataFrame:
    """Adds `before`, the sum of `value` over the earlier rows of the same group, and `row_before`, their number.

    Rows are sorted by range over all groups, so a group of any size spreads over many partitions.
    Each partition sums its own part of a group; the totals of the parts, one row for each group and
    partition that holds any of it, give the offsets. Rows equal in group and order come in any order.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the partition is part of the written rows, so a repeated task can't change it
    dealt = written(
        rows.repartitionByRange(tasks, group, *order).withColumn("_part", F.spark_partition_id()), purpose
    )
    totals = dealt.groupBy(group, "_part").agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    offsets = totals.selectExpr(
        f"`{group}` AS _group",
        "_part AS _of",
        f"coalesce(sum(_sum) OVER (PARTITION BY `{group}` ORDER BY _part"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _offset",
        f"coalesce(sum(_rows) OVER (PARTITION BY `{group}` ORDER BY _part"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _row_offset",
    )
    ordered = ", ".join(f"`{name}`" for name in order)
    within = f"OVER (PARTITION BY _part, `{group}` ORDER BY {ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    summed = dealt.selectExpr(
        "*", f"coalesce(sum(`{value}`) {within}, 0) AS _inside", f"count(1) {within} AS _row_inside"
    )
    return (
        summed.join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
        .withColumn("before", F.col("_offset") + F.col("_inside"))
        .withColumn("row_before", F.col("_row_offset") + F.col("_row_inside"))
        .drop("_part", "_group", "_of", "_offset", "_row_offset", "_inside", "_row_inside")
    )


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components, of which each task gives a star for each component of its own part.

    A task holds `EDGES_AT_ONCE` edges at a time and gives at most as many as it takes; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                waiting.append(batch)
                rows += batch.num_rows
            if waiting and (batch is None or rows >= EDGES_AT_ONCE):
                a, b = (np.concatenate([w.column(k).to_numpy() for w in waiting]) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in stars(a, b)], ["a", "b"])
                waiting, rows = [], 0

    return edges.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges that is not its component's least, and that least node."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = place[: len(a)], place[len(a) :]
    least = np.arange(len(nodes))
    while True:
        low, high = np.minimum(least[one], least[other]), np.maximum(least[one], least[other])
        if (low == high).all():
            break
        np.minimum.at(least, high, low)
        while (least != (further := least[least])).any():
            least = further
    led = least != np.arange(len(nodes))
    return nodes[led], nodes[least[led]]


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, component) of each node of the edges (a, b); a component is named by its least node.

    Tasks contract the edges they read. Then large stars and small stars in turn: each node's larger
    neighbours, then its smaller ones, are linked to the least node next to it, until each node is
    linked with one that has no smaller neighbour. The least is counted before the shuffle, and edges
    meet it by a join whose large partitions Spark splits, so a node with very many neighbours is no
    single task's work.
    """

    def least(links: DataFrame) -> DataFrame:
        return links.groupBy(F.col("a").alias("_u")).agg(F.min("b").alias("_m")).select("_u", F.least("_u", "_m").alias("_m"))

    def unfinished(links: DataFrame) -> bool:
        sides = both_ways(links).groupBy("a").agg(F.count_if(F.col("b") < F.col("a")).alias("low"), F.count_if(F.col("b") > F.col("a")).alias("high"))
        return not sides.filter("low > 1 OR low = 1 AND high > 0").isEmpty()

    def both_ways(links: DataFrame) -> DataFrame:
        return links.union(links.select("b", "a").toDF("a", "b"))

    links = written(contracted(edges.filter("a <> b")), purpose)
    while unfinished(links):
        both = both_ways(links)
        large = both.filter("b > a").join(least(both).hint("merge"), F.col("a") == F.col("_u"))
        links = written(large.select(F.col("b").alias("a"), F.col("_m").alias("b")), purpose)
        small = links.join(least(links).hint("merge"), F.col("a") == F.col("_u"))
        joined = small.select(F.col("b").alias("a"), F.col("_m").alias("b")).union(small.select("a", F.col("_m").alias("b")))
        links = written(contracted(written(joined.filter("a <> b").distinct(), purpose)), purpose)
    roots = links.select("b").distinct()
    return links.toDF("node", "component").union(roots.select("b", F.col("b").alias("component")))
