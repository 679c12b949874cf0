"""Time-bounded matching of two event tables."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.eventtime import as_micros
from tidemark.operators.slicing import copy_to_slices, home_slice, slice_width

#: Times the longest wait that a slice spans in the search for breaks.
SLICES_OF_PIECES = 64


def interval_join(
    left: DataFrame, right: DataFrame, key: str, lower: timedelta, upper: timedelta, ts: str = "ts"
) -> DataFrame:
    """All pairs of equal key with `left.ts + lower <= right.ts <= left.ts + upper`.

    Left columns come back prefixed `left_`, right ones `right_`. The time slice is part of the
    equi-join key, so a key with very many rows is joined slice by slice.
    """
    left_ts, right_ts = F.col(f"left_{ts}"), F.col(f"right_{ts}")
    lower_us, upper_us = as_micros(lower), as_micros(upper)
    width = slice_width(upper_us - lower_us)
    l_rows = copy_to_slices(
        _prefixed(left, "left_"), F.unix_micros(left_ts), width, back=-lower_us, ahead=upper_us
    )
    r_rows = home_slice(_prefixed(right, "right_"), F.unix_micros(right_ts), width).withColumnRenamed(
        "slice", "_slice"
    )
    # on the event-time columns themselves, so that a stream can tell when a row may be forgotten
    in_range = (right_ts >= left_ts + F.lit(lower)) & (right_ts <= left_ts + F.lit(upper))
    return l_rows.join(
        r_rows,
        (F.col(f"left_{key}") == F.col(f"right_{key}")) & (F.col("slice") == F.col("_slice")) & in_range,
    ).drop("slice", "_slice", "is_home")


def match_one_to_one(
    pays: DataFrame,
    receipts: DataFrame,
    key: str,
    early: timedelta,
    late: timedelta,
    pay_id: str,
    receipt_id: str,
    ts: str = "ts",
) -> DataFrame:
    """Pairs pays and receipts of a key one to one; every row of both sides with a key comes back once.

    Rows are read in time order, pays first at equal times, then by id. Each takes the oldest row of the
    other side that still waits for it, a pay waiting for `late` and a receipt for `early`; if there is
    none, it waits itself. Result: `outcome` (`matched`, `unmatched_pay`, `unmatched_receipt`), the key,
    and `pay_id`, `pay_ts`, `receipt_id`, `receipt_ts`.

    A key's timeline breaks where nothing comes for longer than any row waits. The pieces between breaks
    are spread over the tasks, and a task holds the rows that wait, never a piece. Only a key that never
    pauses is read by one task.
    """
    reach = {True: as_micros(late), False: as_micros(early)}
    side = lambda df, is_pay, name: df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.lit(is_pay).alias("is_pay"), F.unix_micros(ts).alias("us"), F.col(name).alias("id")
    )
    rows = _in_pieces(side(pays, True, pay_id).unionByName(side(receipts, False, receipt_id)), max(reach.values()))
    number = rows.select("id").schema[0].dataType.simpleString()
    of_key = rows.select("key").schema[0].dataType.simpleString()
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, "key", "piece").sortWithinPartitions("key", "piece", "us", F.desc("is_pay"), "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, waiting = None, {True: deque(), False: deque()}

        def alone(is_pay: bool, upto: int | None) -> Iterator[tuple]:
            queue = waiting[is_pay]
            while queue and (upto is None or queue[0][0] + reach[is_pay] < upto):
                us, name = queue.popleft()
                pair = (name, us, None, None) if is_pay else (None, None, name, us)
                yield ("unmatched_pay" if is_pay else "unmatched_receipt", place[0], *pair)

        def shown(found: list[tuple]) -> pd.DataFrame:
            names = ["outcome", "key", "pay_id", "pay_us", "receipt_id", "receipt_us"]
            return pd.DataFrame(found, columns=names, dtype=object)

        for batch in batches:
            found: list[tuple] = []
            columns = (batch[name].tolist() for name in ("key", "piece", "is_pay", "us", "id"))
            for own_key, piece, is_pay, us, name in zip(*columns, strict=True):
                new = (own_key, piece) != place
                for each in (True, False):
                    found.extend(alone(each, None if new else us))
                place = own_key, piece
                if waiting[not is_pay]:
                    other_us, other = waiting[not is_pay].popleft()
                    pair = (name, us, other, other_us) if is_pay else (other, other_us, name, us)
                    found.append(("matched", own_key, *pair))
                else:
                    waiting[is_pay].append((us, name))
            yield shown(found)
        yield shown([*alone(True, None), *alone(False, None)])

    matched = dealt.mapInPandas(
        run,
        f"outcome string, key {of_key}, pay_id {number}, pay_us bigint, receipt_id {number}, receipt_us bigint",
    )
    return matched.select(
        "outcome",
        F.col("key").alias(key),
        "pay_id",
        F.timestamp_micros("pay_us").alias("pay_ts"),
        "receipt_id",
        F.timestamp_micros("receipt_us").alias("receipt_ts"),
    )


def _in_pieces(rows: DataFrame, reach_us: int) -> DataFrame:
    """Adds `piece`, the time at which an unbroken piece of the key's timeline begins.

    Breaks are found slice by slice; of earlier slices only the last time and the last beginning count.
    """
    sliced = home_slice(rows, F.col("us"), slice_width(reach_us, SLICES_OF_PIECES))
    within = Window.partitionBy("key", "slice").orderBy("us")
    slices = Window.partitionBy("_key").orderBy("_slice")
    ends = sliced.groupBy(F.col("key").alias("_key"), F.col("slice").alias("_slice")).agg(F.max("us").alias("_end"))
    ends = ends.withColumn("_end", F.lag("_end").over(slices))
    same = (F.col("key") == F.col("_key")) & (F.col("slice") == F.col("_slice"))
    before = F.coalesce(F.lag("us").over(within), F.col("_end"))
    begins = F.when(before.isNull() | (F.col("us") - before > reach_us), F.col("us"))
    marked = sliced.join(ends, same).withColumn("_begins", begins).drop("_key", "_slice", "_end")
    starts = marked.groupBy(F.col("key").alias("_key"), F.col("slice").alias("_slice")).agg(F.max("_begins").alias("_start"))
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_start", F.max("_start").over(earlier))
    piece = F.coalesce(F.max("_begins").over(within), F.col("_start"))
    return marked.join(starts, same).withColumn("piece", piece).select("key", "is_pay", "us", "id", "piece")


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(prefix + c) for c in df.columns))
