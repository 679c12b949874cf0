"""Streaming pipelines: sliding rankings, page traffic, visitors and joins."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.eventtime import as_interval, as_micros
from tidemark.functions.hashing import rolling_offset
from tidemark.operators import lateness, ranking, windows
from tidemark.operators.joins import interval_join
from tidemark.streaming import processors
from tidemark.streaming.panes import PaneStore
from tidemark.streaming.processors import OneToOne, process_in_order
from tidemark.streaming.sinks import BatchLog, each_batch


def rank_final_counts(
    events: DataFrame, folder: str, key: str, n: int, size: timedelta, slide: timedelta, disorder: timedelta
) -> DataFrame:
    """Top-N of each sliding window once the watermark has closed it.

    All counts of a window are finalised in the same micro-batch, so each batch is ranked with the
    batch operator and nothing of it is kept in state.
    """
    counts = windows.sliding_counts_direct(
        events.withWatermark("ts", as_interval(disorder)), [key], size, slide
    )
    schema = f"{_ddl(counts, key)}, window_end timestamp, cnt bigint, rank bigint"
    log = BatchLog(events.sparkSession, f"{folder}/table", schema)

    def rank(batch: DataFrame, batch_id: int) -> None:
        log.write(ranking.top_n(batch.select(key, "window_end", "cnt"), n, key), batch_id)

    each_batch(counts, folder, rank)
    return log.read().drop("batch_id")


def final_panes(events: DataFrame, keys: Sequence[str], slide: timedelta, disorder: timedelta) -> DataFrame:
    """Counts per key and slide, appended once the watermark has closed them.

    For windows of many slides: state holds one count per slide instead of one per window.
    """
    pane = F.window("ts", as_interval(slide))
    return (
        events.withWatermark("ts", as_interval(disorder))
        .groupBy(*keys, pane.alias("_w"))
        .agg(F.count("*").alias("cnt"))
        .select(*keys, F.col("_w.start").alias("pane"), "cnt")
    )


def rank_changing_counts(
    hits: DataFrame,
    folder: str,
    key: str,
    n: int,
    size: timedelta,
    slide: timedelta,
    disorder: timedelta,
    allowed_lateness: timedelta,
    seq: str,
) -> DataFrame:
    """Top-N per window that is corrected as late rows come in; the newest ranking of each window."""
    return folded(ranking_changes(hits, folder, key, n, size, slide, disorder, allowed_lateness, seq))


def folded(changes: DataFrame) -> DataFrame:
    """The rows that a changelog leaves: those inserted (`delta` 1) and not deleted (-1) since."""
    kept = [name for name in changes.columns if name not in ("delta", "batch_id")]
    return changes.groupBy(*kept).agg(F.sum("delta").alias("_left")).filter("_left > 0").select(*kept)


def ranking_changes(
    hits: DataFrame,
    folder: str,
    key: str,
    n: int,
    size: timedelta,
    slide: timedelta,
    disorder: timedelta,
    allowed_lateness: timedelta,
    seq: str,
) -> DataFrame:
    """Top-N per window as a changelog: rows that a micro-batch inserts into the rankings, and those it deletes.

    A row counts in those of its windows that are open when it arrives, as in the batch: a window takes
    rows until the watermark at their arrival has passed its end by `allowed_lateness`. `seq` numbers
    the arrivals of a micro-batch. Kept are counts per key, first open window and end, which raise the
    counts of all windows between these two. A micro-batch adds to them, ranks again the windows
    that it adds to, and no others; counts of which all windows are closed are dropped. Changes are
    the difference of a window's rankings before and after, so ranks that stay are not written; the
    rankings before are kept until their windows are closed. `batch_id` tells the micro-batches apart.
    """
    spark = hits.sparkSession
    size_us, slide_us = as_micros(size), as_micros(slide)
    panes = PaneStore(spark, f"{folder}/panes", [key, "_first", "_stop"], "_n", f"{_ddl(hits, key)}, _first bigint, _stop bigint, _n bigint")
    ranked = [key, "window_end", "cnt", "rank"]
    schema = f"{_ddl(hits, key)}, window_end timestamp, cnt bigint, rank bigint, delta bigint"
    ranks = BatchLog(spark, f"{folder}/ranks", schema)
    current = PaneStore(spark, f"{folder}/current", ranked, "delta", schema)
    marks = Marks(spark, f"{folder}/marks", disorder)

    def rank_touched(batch: DataFrame, batch_id: int) -> None:
        dated = batch.filter(F.col("ts").isNotNull())
        dated.persist()
        try:
            seen = marks.write(dated, batch_id)
            if seen is None:
                return
            rows = marks.at_arrival(dated, batch_id, seq)
            added = windows.open_panes(rows, [key], size, slide, first_open=lateness.first_open_end(allowed_lateness))
            own = panes.write(added, batch_id)
            first, last = own.agg(F.min("_first"), F.max("_stop")).first()
            if first is not None:
                near = panes.read(batch_id).filter((F.col("_stop") > first) & (F.col("_first") < last))
                counts = windows.counts_of_open_panes(near, [key], size, slide)
                ends = F.sequence(F.col("_first"), F.col("_stop") - slide_us, F.lit(slide_us))
                touched = own.select("_first", "_stop").distinct().select(F.explode(ends).alias("_end")).distinct()
                open_ends = touched.select(F.timestamp_micros("_end").alias("window_end"))
                top = ranking.top_n(counts.join(open_ends, "window_end", "left_semi"), n, key)
                versions = top.select(*ranked, F.lit(1).cast("bigint").alias("delta"))
                if current.paths(batch_id - 1):
                    before = current.read(batch_id - 1).join(open_ends, "window_end", "left_semi")
                    versions = versions.unionByName(before.withColumn("delta", -F.col("delta")))
                changes = versions.groupBy(*ranked).agg(F.sum("delta").alias("delta")).filter("delta <> 0")
                ranks.write(current.write(changes, batch_id), batch_id)
            # windows that end by then take no more rows
            closed = seen - as_micros(disorder) + lateness.TICK_US - as_micros(allowed_lateness)
            panes.compact(batch_id, F.col("_stop") > closed)
            if current.paths(batch_id):
                current.compact(batch_id, F.unix_micros("window_end") > closed)
        finally:
            dated.unpersist()

    each_batch(hits, folder, rank_touched)
    return ranks.read()


class Marks:
    """The highest event time of all micro-batches so far, which each batch leaves for the next."""

    def __init__(self, spark: SparkSession, folder: str, disorder: timedelta):
        self.spark, self.folder, self.disorder = spark, folder, disorder

    def write(self, batch: DataFrame, batch_id: int) -> int | None:
        """Leaves the highest time up to this batch, and returns it; none if there was no row yet."""
        own, before = batch.agg(F.max(F.unix_micros("ts"))).first()[0], self.before(batch_id)
        seen = max((us for us in (own, before) if us is not None), default=None)
        self.spark.createDataFrame([(seen,)], "seen bigint").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{batch_id}")
        return seen

    def before(self, batch_id: int) -> int | None:
        return self.spark.read.parquet(f"{self.folder}/{batch_id - 1}").first()[0] if batch_id else None

    def at_arrival(self, batch: DataFrame, batch_id: int, seq: str) -> DataFrame:
        """Adds `watermark_us`, which follows from all earlier batches and the earlier arrivals of this one."""
        rows, before = lateness.with_watermark_at_arrival(batch, self.disorder, seq=seq), self.before(batch_id)
        if before is None:
            return rows
        return rows.withColumn("watermark_us", F.greatest("watermark_us", F.lit(before - as_micros(self.disorder))))


def final_visitors(events: DataFrame, size: timedelta, disorder: timedelta, visitor: str = "user_id") -> DataFrame:
    """Exact distinct visitors per closed window: distinct pairs first, then their count."""
    window = F.window("ts", as_interval(size))
    pairs = (
        events.withWatermark("ts", as_interval(disorder))
        .groupBy(window.alias("window"), visitor)
        .agg(F.count("*").alias("_n"))
    )
    return (
        pairs.groupBy("window")
        .agg(F.count("*").alias("uv"))
        .select(F.col("window.end").alias("window_end"), "uv")
    )


def final_bitmap_visitors(events: DataFrame, size: timedelta, disorder: timedelta, visitor: str = "user_id") -> DataFrame:
    """Set bits of a hashed bitmap per closed window, as in the batch, collisions included.

    State holds the bitmap's words of 64 bits that have any bit set, merged by OR; their bits are
    counted once the window is closed. So a window holds 2^24 words at most, however many visitors it has.
    """
    window = F.window("ts", as_interval(size))
    offsets = events.withWatermark("ts", as_interval(disorder)).select(
        window.alias("window"), rolling_offset(F.col(visitor).cast("string")).alias("_offset")
    )
    words = offsets.groupBy("window", F.shiftright("_offset", 6).alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(_offset & 63 AS INT)))").alias("_bits")
    )
    counted = words.groupBy("window").agg(F.sum(F.bit_count("_bits")).cast("bigint").alias("uv"))
    return counted.select(F.col("window.end").alias("window_end"), F.coalesce("uv", F.lit(0)).alias("uv"))


def running_visitors(
    events: DataFrame, folder: str, size: timedelta, disorder: timedelta, visitor: str = "user_id"
) -> DataFrame:
    """Distinct visitors so far per window, updated by each micro-batch.

    State holds the (window, visitor) pairs seen; a batch writes how many new ones it brought, and
    the sum of these is the running count. No row of a window is kept.
    """
    log = BatchLog(events.sparkSession, f"{folder}/table", "window_end timestamp, uv bigint")
    fresh = (
        events.withWatermark("ts", as_interval(disorder))
        .select(F.window("ts", as_interval(size)).alias("window"), visitor)
        .dropDuplicates(["window", visitor])
    )

    def add(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy(F.col("window.end").alias("window_end")).agg(F.count("*").alias("uv"))
        log.write(counted, batch_id)

    each_batch(fresh, folder, add)
    return log.read().groupBy("window_end").agg(F.sum("uv").alias("uv"))


def late_rows(
    hits: DataFrame,
    folder: str,
    size: timedelta,
    slide: timedelta,
    disorder: timedelta,
    allowed_lateness: timedelta,
    seq: str,
) -> DataFrame:
    """Rows that came after all their windows had closed, which Spark itself only counts.

    Each batch leaves the highest event time it saw; the watermark at an arrival follows from the
    earlier batches' marks and the earlier arrivals of its own batch.
    """
    spark = hits.sparkSession
    late = BatchLog(spark, f"{folder}/late", ", ".join(_ddl(hits, c) for c in hits.columns))
    marks = Marks(spark, f"{folder}/marks", disorder)

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            marks.write(batch, batch_id)
            found = marks.at_arrival(batch, batch_id, seq).filter(lateness.too_late(size, slide, allowed_lateness))
            late.write(found.drop("watermark_us"), batch_id)
        finally:
            batch.unpersist()

    each_batch(hits, folder, split)
    return late.read().drop("batch_id")


def joined_in_range(
    pays: DataFrame, receipts: DataFrame, key: str, early: timedelta, late: timedelta, disorder: timedelta
) -> DataFrame:
    """All pairs in range; both sides forget rows once the watermark rules out partners."""
    delay = as_interval(disorder)
    return interval_join(
        pays.withWatermark("ts", delay), receipts.withWatermark("ts", delay), key, -early, late
    )


def matched_or_alone(
    pays: DataFrame, receipts: DataFrame, key: str, early: timedelta, late: timedelta, disorder: timedelta
) -> DataFrame:
    """The one-to-one match of the batch, as the stream goes on; to be started with `custom_state`.

    Both inputs are one stream of events, told apart by a flag and read in time order per key, pays
    first at equal times, then by id. A row that is left alone is given once its time has run out.
    """
    side = lambda df, receipt, name: df.select(
        key, "ts", F.lit(receipt).alias("receipt"), F.col(name).cast("bigint").alias("id")
    )
    events = side(pays, False, "pay_id").unionByName(side(receipts, True, "receipt_id"))
    columns = {name: F.col(name) for name in ("receipt", "id")}
    found = process_in_order(events, key, columns, OneToOne(early, late), as_interval(disorder))
    return found.select(
        "outcome",
        key,
        "pay_id",
        "receipt_id",
        F.timestamp_micros("pay_us").alias("pay_ts"),
        F.timestamp_micros("receipt_us").alias("receipt_ts"),
    )


def capped_panes(clicks: DataFrame, limit: int, slide: timedelta, disorder: timedelta, label: str, first_only: bool = False) -> DataFrame:
    """Counts of capped clicks per label and slide, and the alerts of the cap, appended once the watermark has closed them.

    One query of two stateful steps, to be started with `custom_state`: the cap gives changes with the
    times of their clicks, and a windowed count adds them up. `kind` tells counts and alerts apart; of an
    alert, the slide is that of the click that raised it, given by its key and `us`.
    """
    changes = processors.cap_by_event_day(clicks, limit, as_interval(disorder), label, first_only=first_only)
    of_alert = F.col("kind") == "alert"
    keys = [F.when(of_alert, F.col(name)).alias(name) for name in ("user_id", "ad_id", "us")]
    summed = changes.groupBy(
        F.window("ts", as_interval(slide)).alias("_w"), "kind", F.when(~of_alert, F.col("label")).alias(label), *keys
    ).agg(F.sum("delta").alias("cnt"))
    return summed.filter("cnt <> 0").select(F.col("_w.start").alias("pane"), "kind", label, "user_id", "ad_id", "us", "cnt")


def _ddl(df: DataFrame, column: str) -> str:
    return f"{column} {df.schema[column].dataType.simpleString()}"
