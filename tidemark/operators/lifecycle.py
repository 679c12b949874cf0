"""Outcomes of orders from their create and pay events."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.eventtime import as_micros
from tidemark.runtime import scratch_dir

# Outcome messages.
PAID = "payed successfully"
PAID_LATE = "payed but already timeout"
NO_CREATE = "already payed but not found create log"
TIMED_OUT = "order timeout"

#: Events that one task sorts for an order.
EVENTS_OF_ONE_TASK = 1_000_000
PAIRED = ["_key", "_pay", "_us", "_before", "_second", "_taken"]


def order_outcomes(
    events: DataFrame,
    timeout: timedelta,
    disorder: timedelta,
    key: str = "order_id",
    event_type: str = "event_type",
    ts: str = "ts",
    most: int = EVENTS_OF_ONE_TASK,
) -> DataFrame:
    """One row for each pair of a create and a pay, and for each event left alone.

    An order is a state machine over its events in time order, creates first at equal times: a create
    waits for the next pay, and that pay takes it, late or not. A pay without a waiting create waits
    for a create up to `disorder` later, which arrived out of order, and that pair counts as paid. The
    event that comes next replaces a waiting one that it can't match, which then stands alone.

    An event is matched with the one before it or after it or with none, so the machine needs no state:
    where each event could match the one before it, runs of such events pair up from their first on.
    Orders of up to `most` events are sorted in one task each. The events of larger ones are sorted by
    range, so that an order of any size is spread over many tasks; see `_paired_in_ranges`.
    """
    timeout_us, disorder_us = as_micros(timeout), as_micros(disorder)
    is_pay = F.col(event_type) == "pay"
    rows = events.filter(F.col(event_type).isin("create", "pay") & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), is_pay.alias("_pay"), F.unix_micros(ts).alias("_us")
    )
    path = scratch_dir(rows.sparkSession, "large-orders")
    rows.groupBy(F.col("_key").alias("_large")).agg(F.count("*").alias("_events")).filter(F.col("_events") > most).write.parquet(path)
    large = rows.sparkSession.read.parquet(path)
    if large.isEmpty():
        paired = _paired_per_key(rows, disorder_us)
    else:
        theirs = F.col("_key") == F.col("_large")
        paired = _paired_per_key(rows.join(large, theirs, "left_anti"), disorder_us).unionByName(
            _paired_in_ranges(rows.join(large, theirs, "left_semi"), disorder_us)
        )
    late = F.col("_pay") & (F.col("_us") - F.col("_before._us") >= timeout_us)
    outcome = F.when(F.col("_second"), F.when(late, PAID_LATE).otherwise(PAID)).otherwise(
        F.when(F.col("_pay"), NO_CREATE).otherwise(TIMED_OUT)
    )
    other = F.when(F.col("_second"), F.col("_before._us"))
    return paired.filter(F.col("_second") | ~F.col("_taken")).select(
        F.col("_key").alias(key),
        outcome.alias("outcome"),
        F.timestamp_micros(F.when(F.col("_pay"), other).otherwise(F.col("_us"))).alias("create_ts"),
        F.timestamp_micros(F.when(F.col("_pay"), F.col("_us")).otherwise(other)).alias("pay_ts"),
    )


def _linked(rows: DataFrame, timeline: WindowSpec, before: Column, disorder_us: int) -> DataFrame:
    """Adds the event before, whether an event fits it, its number, and that of the last one that began a run."""
    linked = rows.withColumn("_before", before)
    waited = F.col("_us") - F.col("_before._us")
    fits = (F.col("_before._pay") != F.col("_pay")) & (F.col("_pay") | (waited <= disorder_us))
    numbered = linked.withColumn("_fits", F.coalesce(fits, F.lit(False))).withColumn("_n", F.row_number().over(timeline))
    # an event that doesn't fit begins a run; within a run the second takes the first, the fourth the third
    so_far = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)  # equal events one by one
    return numbered.withColumn("_start", F.max(F.when(~F.col("_fits"), F.col("_n"))).over(so_far))


def _paired_per_key(rows: DataFrame, disorder_us: int) -> DataFrame:
    """(_key, _pay, _us, _before, _second, _taken): whether an event takes the one before it, or is taken by the next."""
    timeline = Window.partitionBy("_key").orderBy("_us", "_pay")
    placed = _linked(rows, timeline, F.lag(F.struct("_us", "_pay")).over(timeline), disorder_us)
    paired = placed.withColumn("_second", (F.col("_n") - F.col("_start")) % 2 == 1)
    taken = F.coalesce(F.lead("_second").over(timeline), F.lit(False))
    return paired.withColumn("_taken", taken).select(*PAIRED)


def _paired_in_ranges(rows: DataFrame, disorder_us: int) -> DataFrame:
    """The same of events sorted by range over all keys, each range cut where keys change.

    A key may go over from one range to the next. One row for each range has the last event before it,
    and whether its own last event is the first or second of a pair; by these few rows the next one
    knows whether its first event fits, and which of a pair it is.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "order-ranges")
    order = ["_us", "_pay", "_row"]  # the last tells equal events apart, which may be many
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    # the range is part of the written rows, so a repeated task can't change it
    numbered.repartitionByRange(tasks, "_key", *order).withColumn("_part", F.spark_partition_id()).write.parquet(f"{path}/events")
    dealt = spark.read.parquet(f"{path}/events")
    dealt.groupBy("_part").agg(F.min("_key").alias("low"), F.max("_key").alias("high")).coalesce(1).write.parquet(f"{path}/edges")
    edges = spark.read.parquet(f"{path}/edges")

    timeline = Window.partitionBy("_part", "_key").orderBy(*order)
    here = (F.col("_part") == F.col("part")) & (F.col("_key") == F.col("of"))
    lowest, highest = (edges.select(F.col("_part").alias("part"), F.col(edge).alias("of")) for edge in ("low", "high"))
    last = dealt.join(highest, here).groupBy("part", "of").agg(F.max(F.struct("_us", "_pay")).alias("last"))
    # the next range that is not empty
    following = edges.select(F.col("_part").alias("from"), F.lead(F.struct("_part", "low")).over(Window.orderBy("_part")).alias("to"))
    entering = last.join(following, (F.col("part") == F.col("from")) & (F.col("of") == F.col("to.low"))).select(
        F.col("to._part").alias("part"), "of", F.col("last").alias("entering")
    )

    def placed(some: DataFrame) -> DataFrame:
        before = F.coalesce(F.lag(F.struct("_us", "_pay")).over(timeline), "entering")
        return _linked(some.join(entering, here, "left"), timeline, before, disorder_us).drop("part", "of", "entering")

    # per range and key at its edge: its events, whether its first fits, and the place in its run of its last, if that began here
    parts = Window.partitionBy("of").orderBy("part")
    at_edge = placed(dealt.join(lowest.union(highest).distinct(), here, "left_semi"))
    effect = at_edge.groupBy(F.col("_part").alias("part"), F.col("_key").alias("of")).agg(
        F.max("_n").alias("n"),
        F.min_by("_fits", "_n").alias("goes_on"),
        (F.max("_n") - F.max("_start")).alias("place"),
    )
    through = F.sum("n").over(parts.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = effect.withColumn("through", through).withColumn("began", F.col("place") - F.col("through"))
    earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
    # the place, counted from 0, that the first event of the range has if it goes on with the run before
    carried = run.withColumn("next", F.last("began", ignorenulls=True).over(earlier) + F.col("through") - F.col("n") + 1)
    follower = F.lead(F.col("goes_on") & (F.col("next") % 2 == 1)).over(parts)
    place = F.coalesce(F.col("_n") - F.col("_start"), F.col("_n") - 1 + F.col("next"))
    paired = placed(dealt).join(carried.select("part", "of", "next", follower.alias("follower")), here, "left")
    paired = paired.withColumn("_second", place % 2 == 1)
    return paired.withColumn("_taken", F.coalesce(F.lead("_second").over(timeline), "follower", F.lit(False))).select(*PAIRED)
