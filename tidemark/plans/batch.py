"""Batch reports over the parquet tables of a folder.

Times come back as epoch seconds (`window_end`, ...) or epoch microseconds (`*_us`), so that the
results do not depend on how a reader shows timestamps.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.eventtime import as_micros, epoch_seconds, next_midnight
from tidemark.functions.hashing import rolling_offset
from tidemark.operators import aggregates, clickcap, joins, lateness, patterns, ranking, visitors, windows
from tidemark.operators.bursts import failure_bursts
from tidemark.operators.lifecycle import order_outcomes
from tidemark.operators.outputs import Outputs
from tidemark.sources import kafka, schemas, text
from tidemark.sources.tables import Tables

HOUR, MINUTE, SECOND = timedelta(hours=1), timedelta(minutes=1), timedelta(seconds=1)

ITEM_WINDOW = (HOUR, 5 * MINUTE)
PAGE_WINDOW = (10 * MINUTE, 5 * SECOND)
MARKET_WINDOW = (HOUR, 5 * SECOND)
PAGE_DISORDER, PAGE_LATENESS = SECOND, MINUTE
# The tables' events are minutes apart, so the pattern and join spans are hours and days.
LOGIN_SPAN = 2 * HOUR
LOGIN_SLICE = HOUR
CLICK_LIMIT = 1
ORDER_TIMEOUT, ORDER_DISORDER = timedelta(days=365), timedelta(days=30)
RECEIPT_EARLY, RECEIPT_LATE = 3 * HOUR, 5 * HOUR

Report = Callable[[SparkSession, str], DataFrame]


def _bounds(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *keep,
        epoch_seconds("window_start").alias("window_start"),
        epoch_seconds("window_end").alias("window_end"),
    )


def _end(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(epoch_seconds("window_end").alias("window_end"), *keep)


def _micros(df: DataFrame, **renamed: str) -> DataFrame:
    """Times as epoch microseconds under a new name, given as `new="old"`."""
    names = {old: new for new, old in renamed.items()}
    return df.select(*(F.unix_micros(c).alias(names[c]) if c in names else F.col(c) for c in df.columns))


# sources and sinks


def scan_events(spark: SparkSession, folder: str) -> DataFrame:
    rows = Tables(spark, folder).behaviors()
    lines = kafka.encode(
        rows.withColumn("ts", F.unix_seconds("ts")), schemas.USER_BEHAVIOR.fieldNames()
    )
    parsed = text.parse_records(lines, schemas.USER_BEHAVIOR)
    return parsed.withColumn("ts", epoch_seconds("ts"))


def parse_access_log(spark: SparkSession, folder: str) -> DataFrame:
    parsed = text.parse_access_log(Tables(spark, folder).log_lines())
    return parsed.withColumn("ts", epoch_seconds("ts"))


def kafka_value_encode(spark: SparkSession, folder: str) -> DataFrame:
    rows = Tables(spark, folder).behaviors().withColumn("ts", F.unix_seconds("ts"))
    return kafka.encode(rows, schemas.USER_BEHAVIOR.fieldNames(), key="item_id")


# filters and scalar functions


def filter_behavior(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).page_views().select("event_id", "user_id", "item_id")


def filter_not_behavior(spark: SparkSession, folder: str) -> DataFrame:
    events = Tables(spark, folder).events().filter(F.col("event_type") != "error")
    return events.select("event_id", "user_id", "event_type")


def filter_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    """Events that carry a transaction id: purchases with an even item, others null or empty."""
    rows = Tables(spark, folder).behaviors()
    tx_id = F.when(
        F.col("behavior") == "purchase",
        F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("tx"), F.col("event_id").cast("string"))).otherwise(""),
    )
    return rows.select("event_id", tx_id.alias("tx_id")).filter(text.not_empty("tx_id"))


def bloom_offset(spark: SparkSession, folder: str) -> DataFrame:
    users = Tables(spark, folder).events().select("user_id").distinct()
    return users.select("user_id", rolling_offset(F.col("user_id").cast("string")).alias("offset"))


def next_midnight_per_event(spark: SparkSession, folder: str) -> DataFrame:
    events = Tables(spark, folder).events()
    return events.select("event_id", epoch_seconds(next_midnight(F.col("ts"))).alias("midnight"))


# hot items


def _item_counts(tables: Tables) -> DataFrame:
    return windows.sliding_counts(tables.page_views(), ["item_id"], *ITEM_WINDOW)


def hot_items_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _end(_item_counts(Tables(spark, folder)), "item_id", "cnt")


def hot_items_top5(spark: SparkSession, folder: str) -> DataFrame:
    top = ranking.top_n(_item_counts(Tables(spark, folder)), 5, "item_id")
    return _end(top, "item_id", "cnt", "rank")


def top_n_report(spark: SparkSession, folder: str) -> DataFrame:
    top = ranking.top_n(_item_counts(Tables(spark, folder)), 5, "item_id")
    return _end(ranking.top_n_report(top, "item_id", "item"), "report")


RANK_SQL = """
    SELECT unix_seconds(window_end) AS window_end, item_id, cnt, CAST(row_num AS BIGINT) AS row_num
    FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num
          FROM {counts})
    WHERE row_num <= 5
"""


def hot_items_sql(spark: SparkSession, folder: str) -> DataFrame:
    """Pure SQL. Counting per five minutes first leaves the hopping window far fewer rows."""
    counts = spark.sql(
        """
        SELECT item_id, window(pane, '1 hour', '5 minutes').end AS window_end, sum(n) AS cnt
        FROM (SELECT item_id, window(ts, '5 minutes').start AS pane, count(item_id) AS n
              FROM {behaviors} WHERE behavior = 'pv'
              GROUP BY item_id, window(ts, '5 minutes'))
        GROUP BY item_id, window(pane, '1 hour', '5 minutes')
        """,
        behaviors=Tables(spark, folder).behaviors(),
    )
    return spark.sql(RANK_SQL, counts=counts)


def hot_items_table(spark: SparkSession, folder: str) -> DataFrame:
    """DataFrame aggregate, SQL ranking."""
    views = Tables(spark, folder).behaviors().filter(F.col("behavior") == "pv")
    counts = windows.sliding_counts(views, ["item_id"], *ITEM_WINDOW)
    return spark.sql(RANK_SQL, counts=counts.select("item_id", "window_end", "cnt"))


# page traffic


def _page_counts(tables: Tables) -> DataFrame:
    return windows.sliding_counts(tables.url_hits(), ["url"], *PAGE_WINDOW)


def hot_pages_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _end(_page_counts(Tables(spark, folder)), "url", "cnt")


def _hits_with_watermark(tables: Tables) -> DataFrame:
    return lateness.with_watermark_at_arrival(tables.url_hits(), PAGE_DISORDER, seq="arrival")


def late_events(spark: SparkSession, folder: str) -> DataFrame:
    hits = _hits_with_watermark(Tables(spark, folder))
    late = hits.filter(lateness.too_late(*PAGE_WINDOW, PAGE_LATENESS))
    return _micros(late.select("event_id", "url", "ts"), us="ts")


def _on_time_counts(tables: Tables) -> DataFrame:
    return windows.sliding_counts(
        _hits_with_watermark(tables), ["url"], *PAGE_WINDOW, first_open=lateness.first_open_end(PAGE_LATENESS)
    )


def hot_pages_on_time_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts from rows as they arrive: a row adds to the windows still open for it."""
    return _end(_on_time_counts(Tables(spark, folder)), "url", "cnt")


def hot_pages_top3(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks what the windows have counted; rows that came too late for a window are not in its count."""
    return _end(ranking.top_n(_on_time_counts(Tables(spark, folder)), 3, "url"), "url", "cnt", "rank")


def pv_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return _end(windows.tumbling_counts(Tables(spark, folder).page_views(), [], HOUR), "cnt")


def pv_two_phase(spark: SparkSession, folder: str) -> DataFrame:
    views = Tables(spark, folder).page_views()
    return _end(aggregates.two_phase_counts(views, HOUR, spread_by=F.col("event_id")), "cnt")


def uv_exact(spark: SparkSession, folder: str) -> DataFrame:
    return _end(visitors.exact(Tables(spark, folder).page_views(), HOUR), "uv")


def uv_collect_set(spark: SparkSession, folder: str) -> DataFrame:
    return _end(visitors.from_full_set(Tables(spark, folder).page_views(), HOUR), "uv")


def uv_bitmap(spark: SparkSession, folder: str) -> DataFrame:
    return _end(visitors.hashed_bitmap(Tables(spark, folder).page_views(), HOUR), "uv")


def uv_bitmap_native(spark: SparkSession, folder: str) -> DataFrame:
    return _end(visitors.id_bitmap(Tables(spark, folder).page_views(), HOUR), "uv")


def uv_approx(spark: SparkSession, folder: str) -> DataFrame:
    return _end(visitors.approximate(Tables(spark, folder).page_views(), HOUR), "uv")


def avg_by_key(spark: SparkSession, folder: str) -> DataFrame:
    events = Tables(spark, folder).behaviors()
    return aggregates.average_by(events, ["item_id"], F.unix_seconds("ts"), "avg_ts")


# marketing and ads


def market_by_channel(spark: SparkSession, folder: str) -> DataFrame:
    kept = Tables(spark, folder).marketing().filter(F.col("behavior") != "error")
    counts = windows.sliding_counts(kept, ["channel", "behavior"], *MARKET_WINDOW)
    return _bounds(counts, "channel", "behavior", "cnt")


def market_total(spark: SparkSession, folder: str) -> DataFrame:
    kept = Tables(spark, folder).marketing().filter(F.col("behavior") != "error")
    counts = windows.sliding_counts(kept, [], *MARKET_WINDOW)
    total = F.lit("total")
    return _bounds(counts.select("*", total.alias("channel"), total.alias("behavior")), "channel", "behavior", "cnt")


def ad_click_capped(spark: SparkSession, folder: str) -> DataFrame:
    capped = clickcap.capped_clicks(Tables(spark, folder).ad_clicks(), CLICK_LIMIT)
    return _micros(capped, us="ts")


def ad_click_capped_once(spark: SparkSession, folder: str) -> DataFrame:
    """The variant that drops only the click raising the alert."""
    capped = clickcap.capped_clicks(Tables(spark, folder).ad_clicks(), CLICK_LIMIT, mode="drop_first_only")
    return _micros(capped, us="ts")


def ad_blacklist_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _micros(clickcap.cap_alerts(Tables(spark, folder).ad_clicks(), CLICK_LIMIT), us="ts")


def ad_by_province(spark: SparkSession, folder: str) -> DataFrame:
    capped = clickcap.capped_clicks(Tables(spark, folder).ad_clicks(), CLICK_LIMIT)
    return _end(windows.sliding_counts(capped, ["province"], *MARKET_WINDOW), "province", "cnt")


# logins


def login_fail_burst(spark: SparkSession, folder: str) -> DataFrame:
    bursts = failure_bursts(
        Tables(spark, folder).logins(), "user_id", F.col("event_type") == "fail", 2, LOGIN_SPAN
    )
    return _micros(bursts, first_us="first_ts", last_us="last_ts")


def login_warnings(spark: SparkSession, folder: str) -> DataFrame:
    """The warning of each burst, which names the span that failures are collected for."""
    span = f"login fail in {int(LOGIN_SPAN.total_seconds())}s for "
    message = F.concat(F.lit(span), F.col("fails").cast("string"), F.lit(" times."))
    return login_fail_burst(spark, folder).select("user_id", "first_us", "last_us", message.alias("msg"))


def _login_fail_run(spark: SparkSession, folder: str, times: int, within: timedelta) -> DataFrame:
    runs = patterns.consecutive(
        Tables(spark, folder).logins(),
        "user_id",
        F.col("event_type") == "fail",
        times,
        within,
        width=as_micros(LOGIN_SLICE),
    )
    return _micros(runs, first_us="first_ts", last_us="last_ts")


def login_fail_next(spark: SparkSession, folder: str) -> DataFrame:
    return _login_fail_run(spark, folder, 2, LOGIN_SPAN)


def login_fail_consecutive(spark: SparkSession, folder: str) -> DataFrame:
    return _login_fail_run(spark, folder, 3, 24 * HOUR)


# orders and payments


def _order_pattern(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return patterns.followed_by(
        Tables(spark, folder).order_events(), "order_id", kind == "create", kind == "pay", ORDER_TIMEOUT, seq="seq"
    )


def order_paid(spark: SparkSession, folder: str) -> DataFrame:
    paid = _order_pattern(spark, folder).filter("end_ts IS NOT NULL")
    return _micros(paid.select("order_id", "begin_ts", "end_ts"), begin_us="begin_ts", end_us="end_ts")


def order_timeouts(spark: SparkSession, folder: str) -> DataFrame:
    unpaid = _order_pattern(spark, folder).filter("end_ts IS NULL")
    return _micros(unpaid.select("order_id", "begin_ts", "timeout_at"), begin_us="begin_ts", timeout_us="timeout_at")


def order_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    outcomes = order_outcomes(Tables(spark, folder).order_events(), ORDER_TIMEOUT, ORDER_DISORDER)
    return _micros(outcomes, create_us="create_ts", pay_us="pay_ts")


def pay_receipt_interval_join(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    pairs = joins.interval_join(tables.pays(), tables.receipts(), "tx_id", -RECEIPT_EARLY, RECEIPT_LATE)
    return pairs.select(
        F.col("left_tx_id").alias("tx_id"),
        F.col("left_pay_id").alias("pay_id"),
        F.col("right_receipt_id").alias("receipt_id"),
        F.unix_micros("left_ts").alias("pay_us"),
        F.unix_micros("right_ts").alias("receipt_us"),
    )


def pay_receipt_match(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    matched = joins.match_one_to_one(
        tables.pays(), tables.receipts(), "tx_id", RECEIPT_EARLY, RECEIPT_LATE, "pay_id", "receipt_id"
    )
    return _micros(matched, pay_us="pay_ts", receipt_us="receipt_ts")


def unmatched_pays(spark: SparkSession, folder: str) -> DataFrame:
    rows = pay_receipt_match(spark, folder).filter("outcome = 'unmatched_pay'")
    return rows.select("tx_id", "pay_id", "pay_us")


def unmatched_receipts(spark: SparkSession, folder: str) -> DataFrame:
    rows = pay_receipt_match(spark, folder).filter("outcome = 'unmatched_receipt'")
    return rows.select("tx_id", "receipt_id", "receipt_us")


def pay_receipt_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """The matched pairs and both unmatched outputs, out of one pass."""
    found = Outputs(pay_receipt_match(spark, folder), "outcome", "pay-receipt-outputs")
    return found.of("matched").unionByName(found.of("unmatched_pay")).unionByName(found.of("unmatched_receipt"))


def order_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Paid orders and timed-out ones, out of one pass."""
    kind = F.when(F.col("end_ts").isNull(), "timeout").otherwise("paid")
    found = Outputs(_order_pattern(spark, folder).withColumn("output", kind), "output", "order-outputs")
    rows = found.of("paid").unionByName(found.of("timeout"))
    return _micros(rows, begin_us="begin_ts", end_us="end_ts", timeout_us="timeout_at").drop("output")


REPORTS: dict[str, Report] = {
    "scan_events": scan_events,
    "parse_access_log": parse_access_log,
    "kafka_value_encode": kafka_value_encode,
    "filter_behavior": filter_behavior,
    "filter_not_behavior": filter_not_behavior,
    "filter_nonempty": filter_nonempty,
    "bloom_offset": bloom_offset,
    "next_midnight": next_midnight_per_event,
    "hot_items_counts": hot_items_counts,
    "hot_items_top5": hot_items_top5,
    "top_n_report": top_n_report,
    "hot_items_sql": hot_items_sql,
    "hot_items_table": hot_items_table,
    "hot_pages_counts": hot_pages_counts,
    "hot_pages_top3": hot_pages_top3,
    "hot_pages_on_time_counts": hot_pages_on_time_counts,
    "late_events": late_events,
    "pv_hourly": pv_hourly,
    "pv_two_phase": pv_two_phase,
    "uv_exact": uv_exact,
    "uv_collect_set": uv_collect_set,
    "uv_bitmap": uv_bitmap,
    "uv_bitmap_native": uv_bitmap_native,
    "avg_by_key": avg_by_key,
    "market_by_channel": market_by_channel,
    "market_total": market_total,
    "ad_click_capped": ad_click_capped,
    "ad_click_capped_once": ad_click_capped_once,
    "ad_blacklist_alerts": ad_blacklist_alerts,
    "ad_by_province": ad_by_province,
    "login_fail_burst": login_fail_burst,
    "login_warnings": login_warnings,
    "login_fail_next": login_fail_next,
    "login_fail_consecutive": login_fail_consecutive,
    "order_paid": order_paid,
    "order_timeouts": order_timeouts,
    "order_lifecycle": order_lifecycle,
    "pay_receipt_interval_join": pay_receipt_interval_join,
    "pay_receipt_match": pay_receipt_match,
    "pay_receipt_outputs": pay_receipt_outputs,
    "order_outputs": order_outputs,
    "unmatched_pays": unmatched_pays,
    "unmatched_receipts": unmatched_receipts,
}
