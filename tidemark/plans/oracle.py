"""DuckDB statements giving the results of the reports, written apart from the Spark plans."""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
SECS = "(epoch_us(ts) // 1000000)"
DAY_US = 86_400_000_000

BEHAVIORS = f"""
    SELECT event_id, user_id, {K} AS item_id, CAST({K} % 10 AS INTEGER) AS category_id,
           CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior,
           {SECS} AS secs, ts
    FROM events
"""
VIEWS = f"""
    SELECT event_id, user_id, {K} AS item_id, '/page/' || {K} AS url, {SECS} AS secs, epoch_us(ts) AS us,
           event_id - event_id % 97 + event_id % 97 * 31 % 97 AS arrival
    FROM events WHERE event_type = 'view'
"""
MARKETING = f"""
    SELECT ['appstore', 'huaweiStore', 'weibo', 'wechat'][CAST({K} % 4 AS INTEGER) + 1] AS channel,
           event_type AS behavior, {SECS} AS secs
    FROM events WHERE event_type <> 'error'
"""
CLICKS = f"""
    SELECT event_id, user_id, {K} % 5 AS ad_id,
           ['beijing', 'shanghai', 'guangdong', 'zhejiang', 'jiangsu'][CAST(user_id % 5 AS INTEGER) + 1] AS province,
           epoch_us(ts) AS us, {SECS} AS secs,
           row_number() OVER (PARTITION BY user_id, {K} % 5, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
    FROM events WHERE event_type = 'click'
"""
LOGINS = """
    SELECT event_id, user_id, event_type = 'error' AS fail, epoch_us(ts) AS us FROM events
"""


def sliding(source: str, keys: list[str], size: int, slide: int, extra: str = "TRUE") -> str:
    """Rows of `source` copied into each of their windows (seconds) and counted."""
    listed = "".join(f"{k}, " for k in keys)
    return f"""
        SELECT {listed}secs // {slide} * {slide} + {slide} * (i + 1) AS window_end, count(*) AS cnt
        FROM ({source}) AS src, range({size // slide}) AS r(i)
        WHERE {extra}
        GROUP BY ALL
    """


def hourly(source: str, value: str, name: str) -> str:
    return f"SELECT secs // 3600 * 3600 + 3600 AS window_end, {value} AS {name} FROM ({source}) GROUP BY 1"


def ranked(counts: str, n: int, key: str, rank: str = "rank") -> str:
    return f"""
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key}) AS {rank}
            FROM ({counts}))
        WHERE {rank} <= {n}
    """


ITEM_COUNTS = sliding(VIEWS, ["item_id"], 3600, 300)
PAGE_COUNTS = sliding(VIEWS, ["url"], 600, 5)
UTF_HASH = """
    list_reduce(list_prepend(0::BIGINT, list_transform(string_split(CAST({0} AS VARCHAR), ''),
        lambda c: ascii(c)::BIGINT)), lambda a, c: (a * 79 + c) & 1073741823)
"""
ARRIVALS = f"""
    SELECT *, max(us) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000000 AS wm
    FROM ({VIEWS})
"""

# the first failure of each span in turn, per streak of failures without a success between
BURSTS = f"""
    WITH RECURSIVE numbered AS (
        SELECT *, sum(CASE WHEN fail THEN 0 ELSE 1 END) OVER (
            PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS streak
        FROM ({LOGINS})
    ),
    fails AS (SELECT user_id, streak, us FROM numbered WHERE fail),
    closings AS (SELECT user_id, streak - 1 AS streak, us AS closed FROM numbered WHERE NOT fail),
    openings AS (
        SELECT user_id, streak, min(us) AS opened FROM fails GROUP BY ALL
        UNION ALL
        SELECT o.user_id, o.streak, min(f.us) AS opened
        FROM openings o JOIN fails f
          ON f.user_id = o.user_id AND f.streak = o.streak AND f.us > o.opened + 7200000000
        GROUP BY o.user_id, o.streak, o.opened
    )
    SELECT o.user_id, o.opened AS first_us, max(f.us) AS last_us, count(*) AS fails
    FROM openings o
    JOIN fails f ON f.user_id = o.user_id AND f.streak = o.streak
        AND f.us BETWEEN o.opened AND o.opened + 7200000000
    LEFT JOIN closings c ON c.user_id = o.user_id AND c.streak = o.streak
    WHERE c.closed IS NULL OR c.closed > o.opened + 7200000000
    GROUP BY ALL HAVING count(*) >= 2
"""


def fail_run(times: int, within_us: int) -> str:
    steps = range(1, times)
    leads = ", ".join(f"lead(fail, {i}) OVER w AS f{i}, lead(us, {i}) OVER w AS u{i}" for i in steps)
    hits = " AND ".join(f"f{i}" for i in steps)
    return f"""
        SELECT user_id, us AS first_us, u{times - 1} AS last_us, CAST({times} AS BIGINT) AS events
        FROM (SELECT *, {leads} FROM ({LOGINS}) WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
        WHERE fail AND {hits} AND u{times - 1} - us < {within_us}
    """


ORDER_TIMES = "SELECT o_orderkey AS order_id, epoch_us(o_orderdate) AS c FROM orders"
YEAR_US = 365 * DAY_US
# the first shipment at or after each create
NEXT_PAY = f"""
    SELECT order_id, c, (SELECT min(epoch_us(l_shipdate)) FROM lineitem WHERE l_orderkey = order_id AND epoch_us(l_shipdate) >= c) AS p
    FROM ({ORDER_TIMES})
"""


def lifecycle(expires: bool) -> str:
    """An order's events one after the other, with what waits after each; a waiting create may expire."""
    in_time = f"us - wait_us <= CASE WHEN pay = 0 THEN {30 * DAY_US} ELSE {YEAR_US if expires else 10**18} END"
    return f"""
    WITH RECURSIVE log AS (
        SELECT order_id, c AS us, 0 AS pay FROM ({ORDER_TIMES})
        UNION ALL SELECT l_orderkey, epoch_us(l_shipdate), 1 FROM lineitem),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY us, pay) AS n FROM log),
    steps AS (
        SELECT order_id, 0::BIGINT AS n, NULL::BIGINT AS wait_us, NULL::INTEGER AS wait_pay,
            NULL::VARCHAR AS outcome, NULL::BIGINT AS create_us, NULL::BIGINT AS pay_us
        FROM (SELECT DISTINCT order_id FROM log)
        UNION ALL
        SELECT s.order_id, s.n + 1,
            CASE WHEN match THEN NULL ELSE us END, CASE WHEN match THEN NULL ELSE pay END,
            CASE WHEN match AND pay = 1 AND us - wait_us >= {YEAR_US} THEN 'payed but already timeout'
                 WHEN match THEN 'payed successfully'
                 WHEN wait_pay = 1 THEN 'already payed but not found create log'
                 WHEN wait_pay = 0 THEN 'order timeout' END,
            CASE WHEN wait_pay = 0 THEN wait_us WHEN match THEN us END,
            CASE WHEN wait_pay = 1 THEN wait_us WHEN match THEN us END
        FROM (SELECT s.*, e.us, e.pay, coalesce(wait_pay <> pay AND {in_time}, FALSE) AS match
              FROM steps s JOIN numbered e ON e.order_id = s.order_id AND e.n = s.n + 1) s),
    ends AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY n DESC) = 1 AS last FROM steps)
    SELECT order_id, outcome, create_us, pay_us FROM steps WHERE outcome IS NOT NULL
    UNION ALL
    SELECT order_id, CASE wait_pay WHEN 1 THEN 'already payed but not found create log' ELSE 'order timeout' END,
        CASE WHEN wait_pay = 0 THEN wait_us END, CASE WHEN wait_pay = 1 THEN wait_us END
    FROM ends WHERE last AND wait_pay IS NOT NULL
"""


SIDES = """
    pays AS (SELECT event_id AS pay_id, user_id AS tx_id, epoch_us(ts) AS pay_us
             FROM events WHERE event_type = 'click'),
    receipts AS (SELECT event_id AS receipt_id, user_id AS tx_id, epoch_us(ts) AS receipt_us
                 FROM events WHERE event_type = 'purchase'),
    pairs AS (SELECT tx_id, pay_id, receipt_id, pay_us, receipt_us FROM pays JOIN receipts USING (tx_id)
              WHERE receipt_us BETWEEN pay_us - 10800000000 AND pay_us + 18000000000)
"""
# a key's rows one after the other, with what waits after each and what it takes
MATCHES = f"""
    WITH RECURSIVE {SIDES},
    log AS (SELECT tx_id, TRUE AS pay, pay_us AS us, pay_id AS id FROM pays
            UNION ALL SELECT tx_id, FALSE, receipt_us, receipt_id FROM receipts),
    numbered AS (SELECT tx_id, {{'pay': pay, 'us': us, 'id': id}} AS me,
                 row_number() OVER (PARTITION BY tx_id ORDER BY us, pay DESC, id) AS n FROM log),
    steps AS (
        SELECT tx_id, 0::BIGINT AS n, [me][1:0] AS waiting, me AS taken, me FROM numbered WHERE n = 1
        UNION ALL
        SELECT tx_id, n, CASE WHEN len(fit) > 0 THEN list_filter(live, lambda w: w <> fit[1]) ELSE list_append(live, me) END,
            fit[1], me
        FROM (SELECT tx_id, n, me, live, list_filter(live, lambda w: w.pay <> me.pay) AS fit
              FROM (SELECT e.tx_id, e.n, e.me, list_filter(s.waiting, lambda w:
                        e.me.us - w.us <= CASE WHEN w.pay THEN 18000000000 ELSE 10800000000 END) AS live
                    FROM steps s JOIN numbered e ON e.tx_id = s.tx_id AND e.n = s.n + 1))),
    matched AS (
        SELECT tx_id, CASE WHEN me.pay THEN me.id ELSE taken.id END AS pay_id, CASE WHEN me.pay THEN taken.id ELSE me.id END AS receipt_id,
            CASE WHEN me.pay THEN me.us ELSE taken.us END AS pay_us, CASE WHEN me.pay THEN taken.us ELSE me.us END AS receipt_us
        FROM steps WHERE n > 0 AND taken IS NOT NULL),
    lone_pays AS (SELECT tx_id, pay_id, pay_us FROM pays
                  WHERE pay_id NOT IN (SELECT pay_id FROM matched)),
    lone_receipts AS (SELECT tx_id, receipt_id, receipt_us FROM receipts
                      WHERE receipt_id NOT IN (SELECT receipt_id FROM matched))
"""
HIT_COLUMNS = "tx_id, pay_id, receipt_id, pay_us, receipt_us"

ON_TIME_COUNTS = sliding(
ARRIVALS, ["url"], 600, 5,
extra="wm IS NULL OR (secs // 5 * 5 + 5 * (i + 1)) * 1000000 - 1000 + 60000000 > wm",
)

STATEMENTS: dict[str, str] = {
    "scan_events": f"SELECT user_id, item_id, category_id, behavior, secs AS ts FROM ({BEHAVIORS})",
    "parse_access_log": f"""
        SELECT '10.0.' || user_id // 256 || '.' || user_id % 256 AS ip, CAST(user_id AS VARCHAR) AS user_id,
               secs AS ts, 'GET' AS method, url FROM ({VIEWS})""",
    "kafka_value_encode": f"""
        SELECT CAST(item_id AS VARCHAR) AS key,
               concat_ws(',', user_id, item_id, category_id, behavior, secs) AS value FROM ({BEHAVIORS})""",
    "filter_behavior": f"SELECT event_id, user_id, item_id FROM ({VIEWS})",
    "filter_not_behavior": "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'",
    "filter_nonempty": f"""
        SELECT event_id, 'tx' || event_id AS tx_id FROM ({BEHAVIORS})
        WHERE behavior = 'purchase' AND item_id % 2 = 0""",
    "bloom_offset": f"SELECT user_id, {UTF_HASH.format('user_id')} AS \"offset\" FROM (SELECT DISTINCT user_id FROM events)",
    "next_midnight": f"""
        SELECT event_id, (epoch_us(ts) // {DAY_US} + 1) * 86400 AS midnight FROM events""",
    "hot_items_counts": ITEM_COUNTS,
    "hot_items_top5": ranked(ITEM_COUNTS, 5, "item_id"),
    "hot_items_sql": ranked(ITEM_COUNTS, 5, "item_id", "row_num"),
    "hot_items_table": ranked(ITEM_COUNTS, 5, "item_id", "row_num"),
    "top_n_report": f"""
        SELECT window_end,
               'time: ' || strftime(make_timestamp(window_end * 1000000), '%Y-%m-%d %H:%M:%S') || chr(10)
               || string_agg('Top' || rank || ': item=' || item_id || ' count=' || cnt, chr(10) ORDER BY rank)
               || chr(10) || repeat('=', 30) AS report
        FROM ({ranked(ITEM_COUNTS, 5, "item_id")}) GROUP BY window_end""",
    "hot_pages_counts": PAGE_COUNTS,
    "hot_pages_top3": ranked(ON_TIME_COUNTS, 3, "url"),
    "hot_pages_on_time_counts": ON_TIME_COUNTS,
    "late_events": f"""
        SELECT event_id, url, us FROM ({ARRIVALS})
        WHERE wm >= (secs // 5 * 5 + 600) * 1000000 - 1000 + 60000000""",
    "pv_hourly": hourly(VIEWS, "count(*)", "cnt"),
    "pv_two_phase": hourly(VIEWS, "count(*)", "cnt"),
    "uv_exact": hourly(VIEWS, "count(DISTINCT user_id)", "uv"),
    "uv_collect_set": hourly(VIEWS, "count(DISTINCT user_id)", "uv"),
    "uv_bitmap": hourly(VIEWS, f"count(DISTINCT {UTF_HASH.format('user_id')})", "uv"),
    "uv_bitmap_native": hourly(VIEWS, "count(DISTINCT user_id)", "uv"),
    "avg_by_key": f"""
        SELECT item_id, CAST(sum(secs) AS DOUBLE) / count(*) AS avg_ts FROM ({BEHAVIORS}) GROUP BY 1""",
    "market_by_channel": f"""
        SELECT *, window_end - 3600 AS window_start
        FROM ({sliding(MARKETING, ["channel", "behavior"], 3600, 5)})""",
    "market_total": f"""
        SELECT *, window_end - 3600 AS window_start, 'total' AS channel, 'total' AS behavior
        FROM ({sliding(MARKETING, [], 3600, 5)})""",
    "ad_click_capped": f"SELECT event_id, user_id, ad_id, province, us FROM ({CLICKS}) WHERE rn <= 1",
    "ad_click_capped_once": f"SELECT event_id, user_id, ad_id, province, us FROM ({CLICKS}) WHERE rn <> 2",
    "ad_blacklist_alerts": f"""
        SELECT user_id, ad_id, us, 'click over 1 times today' AS msg FROM ({CLICKS}) WHERE rn = 2""",
    "ad_by_province": sliding(f"SELECT * FROM ({CLICKS}) WHERE rn <= 1", ["province"], 3600, 5),
    "login_fail_burst": BURSTS,
    "login_warnings": f"""
        SELECT user_id, first_us, last_us, 'login fail in 7200s for ' || fails || ' times.' AS msg FROM ({BURSTS})""",
    "login_fail_next": fail_run(2, 7_200_000_000),
    "login_fail_consecutive": fail_run(3, DAY_US),
    "order_paid": f"""
        SELECT order_id, c AS begin_us, p AS end_us
        FROM ({NEXT_PAY}) WHERE p - c < {YEAR_US}""",
    "order_timeouts": f"""
        SELECT order_id, c AS begin_us, c + {YEAR_US} AS timeout_us
        FROM ({NEXT_PAY}) WHERE (p - c < {YEAR_US}) IS NOT TRUE""",
    "order_lifecycle": lifecycle(expires=False),
    "pay_receipt_interval_join": f"WITH {SIDES} SELECT {HIT_COLUMNS} FROM pairs",
    "pay_receipt_match": f"""
        {MATCHES}
        SELECT 'matched' AS outcome, {HIT_COLUMNS} FROM matched
        UNION ALL SELECT 'unmatched_pay', tx_id, pay_id, NULL, pay_us, NULL FROM lone_pays
        UNION ALL SELECT 'unmatched_receipt', tx_id, NULL, receipt_id, NULL, receipt_us FROM lone_receipts""",
    "unmatched_pays": f"{MATCHES} SELECT tx_id, pay_id, pay_us FROM lone_pays",
    "unmatched_receipts": f"{MATCHES} SELECT tx_id, receipt_id, receipt_us FROM lone_receipts",
}

# streams: an ended input gives what the batch gives

STATEMENTS |= {
    "stream_hot_items_top5": STATEMENTS["hot_items_top5"],
    "stream_hot_pages_top3": STATEMENTS["hot_pages_top3"],
    "stream_hot_items_updates": STATEMENTS["hot_items_sql"],
    "stream_late_events": STATEMENTS["late_events"],
    "stream_market_total": STATEMENTS["market_total"],
    "stream_market_by_channel": STATEMENTS["market_by_channel"],
    "stream_pv_hourly": STATEMENTS["pv_hourly"],
    "stream_uv": STATEMENTS["uv_exact"],
    "stream_uv_running": STATEMENTS["uv_exact"],
    "stream_uv_bitmap": STATEMENTS["uv_bitmap"],
    "stream_interval_join": STATEMENTS["pay_receipt_interval_join"],
    "stream_pay_receipt": STATEMENTS["pay_receipt_match"],
    "stream_login_fail": BURSTS,
    "stream_login_fail_next": fail_run(2, 7_200_000_000),
    "stream_order_timeouts": f"""
        SELECT order_id, c AS begin_us, CASE WHEN p - c < {YEAR_US} THEN p END AS end_us,
            CASE WHEN (p - c < {YEAR_US}) IS NOT TRUE THEN c + {YEAR_US} END AS timeout_us
        FROM ({NEXT_PAY})""",
    "stream_order_lifecycle": f"SELECT order_id, outcome FROM ({lifecycle(expires=True)})",
    "stream_ad_cap": f"""
        SELECT user_id, ad_id, event_id, us, CASE WHEN n <= 2 THEN 'click' ELSE 'alert' END AS kind
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, us // {DAY_US} ORDER BY us, event_id) AS n
              FROM ({CLICKS}))
        WHERE n <= 3""",
    "stream_ad_by_province": STATEMENTS["ad_by_province"],
    "stream_ad_alerts": STATEMENTS["ad_blacklist_alerts"],
}

# several outputs of one pass, read back

STATEMENTS |= {
    "pay_receipt_outputs": STATEMENTS["pay_receipt_match"],
    "order_outputs": STATEMENTS["stream_order_timeouts"],
}
