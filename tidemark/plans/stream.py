"""Streaming reports: each streams the whole table and, as the table is all there is, ends its input."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.eventtime import as_interval, epoch_seconds
from tidemark.operators import ranking, windows
from tidemark.plans import batch
from tidemark.plans.batch import HOUR, SECOND, Report
from tidemark.runtime import scratch_dir
from tidemark.sources.tables import LAST_ID, Tables
from tidemark.streaming import pipelines, processors
from tidemark.streaming.sinks import append_available, custom_state

DISORDER = SECOND
STREAM_CLICK_LIMIT = 2


def _streams(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder, stream=True)


def _bounded(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder, stream=True, ending=scratch_dir(spark, "ending"))


def stream_hot_items_top5(spark: SparkSession, folder: str) -> DataFrame:
    """Closed five-minute counts from the stream, then ranked sliding hours over them."""
    tables, (size, slide) = _bounded(spark, folder), batch.ITEM_WINDOW
    panes = append_available(
        pipelines.final_panes(tables.page_views(), ["item_id"], slide, DISORDER),
        scratch_dir(spark, "hot-items"),
        tables.end_input,
    )
    top = ranking.top_n(windows.sliding_counts_of_panes(panes, ["item_id"], size, slide), 5, "item_id")
    return top.select(epoch_seconds("window_end").alias("window_end"), "item_id", "cnt", "rank")


def stream_hot_pages_top3(spark: SparkSession, folder: str) -> DataFrame:
    top = pipelines.rank_changing_counts(
        _streams(spark, folder).url_hits(),
        scratch_dir(spark, "hot-pages"),
        "url",
        3,
        *batch.PAGE_WINDOW,
        batch.PAGE_DISORDER,
        batch.PAGE_LATENESS,
        seq="arrival",
    )
    return top.select(epoch_seconds("window_end").alias("window_end"), "url", "cnt", "rank")


def stream_hot_items_updates(spark: SparkSession, folder: str) -> DataFrame:
    """The ranked table folded from its changelog: the newest ranking of every window, open ones included."""
    top = pipelines.rank_changing_counts(
        _streams(spark, folder).page_views(),
        scratch_dir(spark, "hot-items-updates"),
        "item_id",
        5,
        *batch.ITEM_WINDOW,
        DISORDER,
        timedelta(0),
        seq="event_id",
    )
    return top.select(
        epoch_seconds("window_end").alias("window_end"), "item_id", "cnt", F.col("rank").alias("row_num")
    )


def stream_late_events(spark: SparkSession, folder: str) -> DataFrame:
    late = pipelines.late_rows(
        _streams(spark, folder).url_hits(),
        scratch_dir(spark, "late"),
        *batch.PAGE_WINDOW,
        batch.PAGE_DISORDER,
        batch.PAGE_LATENESS,
        seq="arrival",
    )
    return late.select("event_id", "url", F.unix_micros("ts").alias("us"))


def _market_counts(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """Closed five-second counts from the stream, then sliding hours over them."""
    tables, (size, slide) = _bounded(spark, folder), batch.MARKET_WINDOW
    kept = tables.marketing().filter(F.col("behavior") != "error")
    panes = append_available(
        pipelines.final_panes(kept, keys, slide, DISORDER), scratch_dir(spark, "market"), tables.end_input
    )
    return windows.sliding_counts_of_panes(panes, keys, size, slide).select(
        epoch_seconds("window_start").alias("window_start"),
        epoch_seconds("window_end").alias("window_end"),
        *keys,
        "cnt",
    )


def stream_market_total(spark: SparkSession, folder: str) -> DataFrame:
    total = F.lit("total")
    return _market_counts(spark, folder, []).select("*", total.alias("channel"), total.alias("behavior"))


def stream_market_by_channel(spark: SparkSession, folder: str) -> DataFrame:
    return _market_counts(spark, folder, ["channel", "behavior"])


def stream_pv_hourly(spark: SparkSession, folder: str) -> DataFrame:
    tables = _bounded(spark, folder)
    panes = append_available(
        pipelines.final_panes(tables.page_views(), [], HOUR, DISORDER), scratch_dir(spark, "pv"), tables.end_input
    )
    return panes.select(epoch_seconds(F.col("pane") + F.lit(HOUR)).alias("window_end"), "cnt")


def stream_uv(spark: SparkSession, folder: str) -> DataFrame:
    tables = _bounded(spark, folder)
    uv = append_available(
        pipelines.final_visitors(tables.page_views(), HOUR, DISORDER), scratch_dir(spark, "uv"), tables.end_input
    )
    return uv.select(epoch_seconds("window_end").alias("window_end"), "uv")


def stream_uv_bitmap(spark: SparkSession, folder: str) -> DataFrame:
    tables = _bounded(spark, folder)
    uv = append_available(
        pipelines.final_bitmap_visitors(tables.page_views(), HOUR, DISORDER), scratch_dir(spark, "uv-bitmap"), tables.end_input
    )
    return uv.select(epoch_seconds("window_end").alias("window_end"), "uv")


def stream_uv_running(spark: SparkSession, folder: str) -> DataFrame:
    uv = pipelines.running_visitors(
        _streams(spark, folder).page_views(), scratch_dir(spark, "uv-running"), HOUR, DISORDER
    )
    return uv.select(epoch_seconds("window_end").alias("window_end"), "uv")


def stream_interval_join(spark: SparkSession, folder: str) -> DataFrame:
    tables = _streams(spark, folder)
    pairs = pipelines.joined_in_range(
        tables.pays(), tables.receipts(), "tx_id", batch.RECEIPT_EARLY, batch.RECEIPT_LATE, DISORDER
    )
    shown = pairs.select(
        F.col("left_tx_id").alias("tx_id"),
        F.col("left_pay_id").alias("pay_id"),
        F.col("right_receipt_id").alias("receipt_id"),
        F.unix_micros("left_ts").alias("pay_us"),
        F.unix_micros("right_ts").alias("receipt_us"),
    )
    return append_available(shown, scratch_dir(spark, "interval-join"))


def stream_pay_receipt(spark: SparkSession, folder: str) -> DataFrame:
    tables = _bounded(spark, folder)
    with custom_state(spark):
        rows = pipelines.matched_or_alone(
            tables.pays(), tables.receipts(), "tx_id", batch.RECEIPT_EARLY, batch.RECEIPT_LATE, DISORDER
        )
        shown = rows.select(
            "outcome",
            "tx_id",
            "pay_id",
            "receipt_id",
            F.unix_micros("pay_ts").alias("pay_us"),
            F.unix_micros("receipt_ts").alias("receipt_us"),
        )
        # the rows that end the input match nothing and are none of the table's
        ended = shown.filter(F.col("tx_id") < LAST_ID)
        return append_available(ended, scratch_dir(spark, "pay-receipt"), tables.end_input)


def stream_login_fail(spark: SparkSession, folder: str) -> DataFrame:
    tables = _bounded(spark, folder)
    logins = tables.logins()
    with custom_state(spark):
        bursts = processors.process_in_order(
            logins,
            "user_id",
            {"seq": F.col("event_id"), "fail": F.col("event_type") == "fail"},
            processors.FailureBurst(2, batch.LOGIN_SPAN),
            as_interval(DISORDER),
        )
        return append_available(bursts, scratch_dir(spark, "login-fail"), tables.end_input)


def stream_login_fail_next(spark: SparkSession, folder: str) -> DataFrame:
    tables = _bounded(spark, folder)
    logins = tables.logins()
    with custom_state(spark):
        runs = processors.process_in_order(
            logins,
            "user_id",
            {"seq": F.col("event_id"), "hit": F.col("event_type") == "fail"},
            processors.ConsecutiveHits(2, batch.LOGIN_SPAN),
            as_interval(DISORDER),
        )
        return append_available(runs, scratch_dir(spark, "login-fail-next"), tables.end_input)


def stream_order_timeouts(spark: SparkSession, folder: str) -> DataFrame:
    """Paid and timed-out orders, told apart by which of `end_us` and `timeout_us` is set."""
    tables = _bounded(spark, folder)
    orders = tables.order_events()
    with custom_state(spark):
        found = processors.process_in_order(
            orders,
            "order_id",
            {"seq": (F.col("event_type") == "pay").cast("bigint"), "begins": F.col("event_type") == "create"},
            processors.FollowedBy(batch.ORDER_TIMEOUT),
            as_interval(batch.ORDER_DISORDER),
        )
        return append_available(found, scratch_dir(spark, "order-timeouts"), tables.end_input)


def stream_order_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    tables = _bounded(spark, folder)
    orders = tables.order_events()
    with custom_state(spark):
        outcomes = processors.process_in_order(
            orders,
            "order_id",
            {"seq": (F.col("event_type") == "pay").cast("bigint"), "event_type": F.col("event_type")},
            processors.OrderLifecycle(batch.ORDER_TIMEOUT, batch.ORDER_DISORDER),
            as_interval(batch.ORDER_DISORDER),
        )
        return append_available(outcomes, scratch_dir(spark, "orders"), tables.end_input)


def stream_ad_cap(spark: SparkSession, folder: str) -> DataFrame:
    """Passed clicks and alerts of each day: the sums of the changes that the stream gives."""
    with custom_state(spark):
        changes = processors.cap_by_event_day(_streams(spark, folder).ad_clicks(), STREAM_CLICK_LIMIT, as_interval(DISORDER), "province")
        shown = changes.select("user_id", "ad_id", "event_id", "us", "kind", "delta")
        table = append_available(shown, scratch_dir(spark, "ad-cap"))
    return table.groupBy("user_id", "ad_id", "event_id", "us", "kind").agg(F.sum("delta").alias("n")).filter("n > 0").drop("n")


def _capped_panes(spark: SparkSession, folder: str) -> DataFrame:
    tables = _bounded(spark, folder)
    with custom_state(spark):
        panes = pipelines.capped_panes(tables.ad_clicks(), batch.CLICK_LIMIT, batch.MARKET_WINDOW[1], DISORDER, "province")
        return append_available(panes, scratch_dir(spark, "ad-panes"), tables.end_input)


def stream_ad_by_province(spark: SparkSession, folder: str) -> DataFrame:
    """Closed five-second counts of capped clicks from the stream, then sliding hours over them."""
    panes = _capped_panes(spark, folder).filter("kind = 'click'")
    counts = windows.sliding_counts_of_panes(panes, ["province"], *batch.MARKET_WINDOW)
    return counts.select(epoch_seconds("window_end").alias("window_end"), "province", "cnt")


def stream_ad_alerts(spark: SparkSession, folder: str) -> DataFrame:
    alerts = _capped_panes(spark, folder).filter("kind = 'alert'")
    return alerts.select("user_id", "ad_id", "us", F.lit(f"click over {batch.CLICK_LIMIT} times today").alias("msg"))


REPORTS: dict[str, Report] = {
    "stream_hot_items_top5": stream_hot_items_top5,
    "stream_hot_pages_top3": stream_hot_pages_top3,
    "stream_hot_items_updates": stream_hot_items_updates,
    "stream_late_events": stream_late_events,
    "stream_market_total": stream_market_total,
    "stream_market_by_channel": stream_market_by_channel,
    "stream_pv_hourly": stream_pv_hourly,
    "stream_uv": stream_uv,
    "stream_uv_running": stream_uv_running,
    "stream_uv_bitmap": stream_uv_bitmap,
    "stream_interval_join": stream_interval_join,
    "stream_pay_receipt": stream_pay_receipt,
    "stream_login_fail": stream_login_fail,
    "stream_login_fail_next": stream_login_fail_next,
    "stream_order_timeouts": stream_order_timeouts,
    "stream_order_lifecycle": stream_order_lifecycle,
    "stream_ad_cap": stream_ad_cap,
    "stream_ad_by_province": stream_ad_by_province,
    "stream_ad_alerts": stream_ad_alerts,
}
