import random
from collections import Counter, defaultdict
from datetime import timedelta

import pytest
from times import seconds
from pyspark.sql import functions as F

from tidemark.operators import bursts, clickcap, joins, patterns
from tidemark.operators.bursts import failure_bursts
from tidemark.operators.lifecycle import NO_CREATE, PAID, PAID_LATE, TIMED_OUT, order_outcomes
from tidemark.operators.limits import LIMIT_BEFORE_SHUFFLE
from tidemark.streaming.sinks import settings

SECOND = timedelta(seconds=1)
LOGIN = "user_id bigint, event_type string, ts timestamp, event_id bigint"


def logins(seed, n=900, fail_rate=0.6, span=1500, grain=1):
    """Logins in which one user has a third of all rows and mostly fails."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34
        user = 0 if hot else rng.randrange(1, 25)
        fails = rng.random() < (0.97 if hot else fail_rate)
        rows.append(
            {
                "user_id": user,
                "event_type": "fail" if fails else "success",
                "ts": round(rng.uniform(0, span) / grain) * grain,
                "event_id": i,
            }
        )
    return rows


def timelines(rows, key="user_id", seq="event_id"):
    by_key = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r["ts"], r[seq])):
        by_key[row[key]].append(row)
    return by_key


def simulate_bursts(rows, times, span):
    found = []

    def close(user, run):
        if len(run) >= times:
            found.append((user, run[0], run[-1], len(run)))

    for user, timeline in timelines(rows).items():
        run = []
        for row in timeline:
            if run and row["ts"] > run[0] + span:
                close(user, run)
                run = []
            if row["event_type"] == "fail":
                run.append(row["ts"])
            else:
                run = []
        close(user, run)
    return sorted(found)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("times,span,width,grain", [(2, 2, 2, 1), (2, 5, 7, 0.25), (3, 10, 13, 1), (1, 4, 4, 1), (3, 40, 640, 0.5)])
def test_bursts_equal_a_replay(events, seed, times, span, width, grain):
    rows = logins(seed, grain=grain)
    found = failure_bursts(
        events(rows, LOGIN), "user_id", F.col("event_type") == "fail", times, span * SECOND, width=width * 1_000_000
    )
    result = sorted((r.user_id, seconds(r.first_ts), seconds(r.last_ts), r.fails) for r in found.collect())
    expected = simulate_bursts(rows, times, span)
    assert result == expected and expected


def test_bursts_with_slices_cut_between_batches(spark, events):
    rows = logins(7, n=1500, grain=0.5)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        found = failure_bursts(
            events(rows, LOGIN), "user_id", F.col("event_type") == "fail", 2, 20 * SECOND, width=80_000_000
        ).collect()
    result = sorted((r.user_id, seconds(r.first_ts), seconds(r.last_ts), r.fails) for r in found)
    assert result == simulate_bursts(rows, 2, 20)


@pytest.mark.parametrize("seed,span,width,piece,pause", [(1, 3, 1, 5, 0.5), (2, 20, 4, 9, 0.25), (3, 2, 2, 40, 0.75), (4, 6, 3, 1, 3)])
def test_bursts_of_a_user_who_fails_without_pause(events, monkeypatch, seed, span, width, piece, pause):
    """Slices are shorter than a span, and pieces are smaller than what a span holds, or larger."""
    monkeypatch.setattr(bursts, "PIECE_ROWS", piece)
    rng = random.Random(seed)
    rows, at = logins(seed, n=200), 0.0
    for i in range(500):
        at += rng.choice([0, pause, pause, 2 * pause])
        kind = "success" if i in (201, 333) else "fail"
        rows.append({"user_id": 99, "event_type": kind, "ts": at, "event_id": 1000 + i})
    found = failure_bursts(
        events(rows, LOGIN), "user_id", F.col("event_type") == "fail", 2, span * SECOND, width=width * 1_000_000
    ).collect()
    result = sorted((r.user_id, seconds(r.first_ts), seconds(r.last_ts), r.fails) for r in found)
    assert result == simulate_bursts(rows, 2, span)


def test_bursts_on_both_sides_of_a_success_at_the_same_time(events):
    """The span that the success cancels and the one after it open at the same time."""
    kinds = [("fail", t) for t in (0, 1, 2, 3)] + [("success", 3)] + [("fail", t) for t in (3, 4, 5, 6)]
    rows = [{"user_id": 1, "event_type": k, "ts": t, "event_id": i} for i, (k, t) in enumerate(kinds)]
    found = failure_bursts(events(rows, LOGIN), "user_id", F.col("event_type") == "fail", 1, 2 * SECOND, width=2_000_000)
    result = sorted((r.user_id, seconds(r.first_ts), seconds(r.last_ts), r.fails) for r in found.collect())
    assert result == simulate_bursts(rows, 1, 2) == [(1, 0, 2, 3), (1, 3, 5, 3), (1, 6, 6, 1)]


def test_burst_example(events):
    rows = [
        {"user_id": 7, "event_type": t, "ts": s, "event_id": i}
        for i, (t, s) in enumerate([("fail", 12), ("fail", 14), ("fail", 13), ("success", 15), ("fail", 30)])
    ]
    fail = F.col("event_type") == "fail"
    (row,) = failure_bursts(events(rows, LOGIN), "user_id", fail, 2, 2 * SECOND).collect()
    assert (row.user_id, seconds(row.first_ts), seconds(row.last_ts), row.fails) == (7, 12, 14, 3)
    in_time = [*rows, {"user_id": 7, "event_type": "success", "ts": 14, "event_id": 9}]
    assert failure_bursts(events(in_time, LOGIN), "user_id", fail, 2, 2 * SECOND).count() == 0


@pytest.mark.parametrize("times,within", [(1, 1), (2, 2), (3, 5), (4, 30)])
@pytest.mark.parametrize("width", [None, 1, 7])
def test_consecutive_equals_a_scan(events, times, within, width):
    rows = logins(9)
    expected = Counter()
    for user, timeline in timelines(rows).items():
        for i in range(len(timeline) - times + 1):
            run = timeline[i : i + times]
            if all(r["event_type"] == "fail" for r in run) and run[-1]["ts"] - run[0]["ts"] < within:
                expected[user, run[0]["ts"], run[-1]["ts"]] += 1
    found = patterns.consecutive(
        events(rows, LOGIN),
        "user_id",
        F.col("event_type") == "fail",
        times,
        within * SECOND,
        width=width and width * 1_000_000,
    ).collect()
    assert Counter((r.user_id, seconds(r.first_ts), seconds(r.last_ts)) for r in found) == expected and expected


def order_rows(seed=2, n=600):
    rng = random.Random(seed)
    return [
        {
            "order_id": 0 if rng.random() < 0.34 else rng.randrange(150),
            "event_type": rng.choice(["create", "create", "pay", "modify"]),
            "ts": rng.randrange(0, 4000),
            "event_id": i,
        }
        for i in range(n)
    ]


ORDER = "order_id bigint, event_type string, ts timestamp, event_id bigint"


def test_followed_by_equals_a_scan(events):
    rows, span = order_rows(), 60
    expected = Counter()
    for order, timeline in timelines(rows, "order_id").items():
        for i, row in enumerate(timeline):
            if row["event_type"] == "create":
                pay = next((r["ts"] for r in timeline[i + 1 :] if r["event_type"] == "pay"), None)
                paid = pay is not None and pay - row["ts"] < span
                expected[order, row["ts"], pay if paid else None, None if paid else row["ts"] + span] += 1
    kind = F.col("event_type")
    found = patterns.followed_by(events(rows, ORDER), "order_id", kind == "create", kind == "pay", span * SECOND)
    shown = lambda v: None if v is None else seconds(v)
    assert (
        Counter((r.order_id, seconds(r.begin_ts), shown(r.end_ts), shown(r.timeout_at)) for r in found.collect())
        == expected
    )


@pytest.mark.parametrize(
    "create,pay,expected",
    [
        (0, 899, [PAID]),
        (0, 900, [PAID_LATE]),
        (10, 7, [PAID]),
        (10, 6, [NO_CREATE, TIMED_OUT]),
        (0, None, [TIMED_OUT]),
        (None, 0, [NO_CREATE]),
    ],
)
def test_order_outcomes(events, create, pay, expected):
    rows = [
        {"order_id": 1, "event_type": kind, "ts": ts, "event_id": 0}
        for kind, ts in (("create", create), ("pay", pay))
        if ts is not None
    ] + [{"order_id": 2, "event_type": "modify", "ts": 0, "event_id": 1}]
    found = order_outcomes(events(rows, ORDER), 900 * SECOND, 3 * SECOND).collect()
    assert sorted(r.outcome for r in found) == sorted(expected)


def replayed(timeline, timeout, disorder):
    """The outcomes of one order, event by event."""
    waiting, found = None, Counter()
    for row in timeline:
        if waiting and waiting["event_type"] != row["event_type"]:
            waited = row["ts"] - waiting["ts"]
            if row["event_type"] == "pay" or waited <= disorder:
                found[PAID_LATE if row["event_type"] == "pay" and waited >= timeout else PAID] += 1
                waiting = None
                continue
        if waiting:
            found[NO_CREATE if waiting["event_type"] == "pay" else TIMED_OUT] += 1
        waiting = row
    if waiting:
        found[NO_CREATE if waiting["event_type"] == "pay" else TIMED_OUT] += 1
    return found


@pytest.mark.parametrize("seed", range(3))
def test_order_outcomes_equal_a_replay(events, seed):
    rng = random.Random(seed)
    rows = [
        {"order_id": rng.choice([1, 1, 2, 3, 4]), "event_type": rng.choice(["create", "pay"]), "ts": rng.randrange(120), "event_id": i}
        for i in range(200)
    ]
    expected = {}
    for row in sorted(rows, key=lambda r: (r["ts"], r["event_type"])):
        expected.setdefault(row["order_id"], []).append(row)
    found = order_outcomes(events(rows, ORDER), 4 * SECOND, 2 * SECOND).groupBy("order_id", "outcome").count().collect()
    result = {order: Counter({r["outcome"]: r["count"] for r in found if r["order_id"] == order}) for order in expected}
    assert result == {order: replayed(timeline, 4, 2) for order, timeline in expected.items()}


@pytest.mark.parametrize("span,most", [(40, 10), (40, 0), (4000, 100), (4000, 10**6)])
def test_an_order_with_a_third_of_all_events_is_no_single_task(events, span, most):
    rng = random.Random(span)
    rows = [
        {"order_id": 7 if i % 3 == 0 else rng.randrange(400), "event_type": rng.choice(["create", "pay"]), "ts": rng.randrange(span), "event_id": i}
        for i in range(3000)
    ]
    expected = Counter()
    for order in {r["order_id"] for r in rows}:
        own = sorted((r for r in rows if r["order_id"] == order), key=lambda r: (r["ts"], r["event_type"]))
        expected.update({(order, outcome): n for outcome, n in replayed(own, 30, 5).items()})
    found = order_outcomes(events(rows, ORDER).repartition(5), 30 * SECOND, 5 * SECOND, most=most)
    counts = found.groupBy("order_id", "outcome").count().collect()
    assert {(r.order_id, r.outcome): r["count"] for r in counts} == dict(expected)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # by ranges as well, and all other windows leave the large orders out
    assert ("windowspecdefinition(_part#" in plan) == (most < 1000) and ("LeftAnti" in plan) == (most < 1000)


def clicks(n=400):
    rng = random.Random(4)
    return [
        {
            "user_id": 1 if rng.random() < 0.34 else rng.randrange(20),
            "ad_id": 1 if rng.random() < 0.5 else 2,
            "ts": rng.randrange(0, 3 * 86400),
            "event_id": i,
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("limited_by_spark", ["1000", "3"])
def test_click_cap(spark, events, limited_by_spark):
    with settings(spark, {LIMIT_BEFORE_SHUFFLE: limited_by_spark}):
        check_click_cap(events)


def check_click_cap(events):
    rows, limit = clicks(), 5
    df = events(rows, "user_id bigint, ad_id bigint, ts timestamp, event_id bigint")
    seen, passed, passed_main, alerts = Counter(), set(), set(), set()
    for row in sorted(rows, key=lambda r: (r["ts"], r["event_id"])):
        group = (row["user_id"], row["ad_id"], row["ts"] // 86400)
        seen[group] += 1
        if seen[group] <= limit:
            passed.add(row["event_id"])
        if seen[group] != limit + 1:
            passed_main.add(row["event_id"])
        else:
            alerts.add((row["user_id"], row["ad_id"], row["ts"]))
    ids = lambda d: {r.event_id for r in d.collect()}
    assert ids(clickcap.capped_clicks(df, limit)) == passed
    assert ids(clickcap.capped_clicks(df, limit, mode="drop_first_only")) == passed_main
    found = clickcap.cap_alerts(df, limit).collect()
    assert {(r.user_id, r.ad_id, seconds(r.ts)) for r in found} == alerts and alerts
    assert {r.msg for r in found} == {"click over 5 times today"}


def sides(seed, n=300, span=1500):
    rng = random.Random(seed)
    row = lambda i: {"tx_id": "hot" if rng.random() < 0.34 else f"t{rng.randrange(60)}", "ts": rng.randrange(span), "id": i}  # noqa: E731,E501
    return [row(i) for i in range(n)], [row(i) for i in range(n)]


def in_range(p, r):
    return p["tx_id"] == r["tx_id"] and p["ts"] - 3 <= r["ts"] <= p["ts"] + 5


def test_interval_join_equals_nested_loops(events):
    pays, receipts = sides(6)
    schema = "tx_id string, ts timestamp, id bigint"
    found = joins.interval_join(events(pays, schema), events(receipts, schema), "tx_id", -3 * SECOND, 5 * SECOND)
    expected = {(p["id"], r["id"]) for p in pays for r in receipts if in_range(p, r)}
    pairs = [(r.left_id, r.right_id) for r in found.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected


@pytest.mark.parametrize("seed", range(2))
def test_one_to_one_match_equals_a_replay(events, seed):
    pays, receipts = sides(seed)
    log = sorted([(r["tx_id"], r["ts"], side, r["id"]) for side, rows in enumerate((pays, receipts)) for r in rows])
    waiting, expected = {}, set()
    for tx, ts, side, number in log:
        queue = waiting.setdefault((tx, 1 - side), [])
        queue[:] = [(at, n) for at, n in queue if ts - at <= (3 if side == 0 else 5)]
        if queue:
            other = queue.pop(0)[1]
            expected.add(("matched", *((number, other) if side == 0 else (other, number))))
        else:
            waiting.setdefault((tx, side), []).append((ts, number))
    taken = [{pair[k] for pair in expected} for k in (1, 2)]
    expected |= {("unmatched_pay", p["id"], None) for p in pays if p["id"] not in taken[0]}
    expected |= {("unmatched_receipt", None, r["id"]) for r in receipts if r["id"] not in taken[1]}
    schema = "tx_id string, ts timestamp, id bigint"
    found = joins.match_one_to_one(
        events(pays, schema), events(receipts, schema), "tx_id", 3 * SECOND, 5 * SECOND, "id", "id"
    ).collect()
    assert len(found) == len(expected)
    assert {(r.outcome, r.pay_id, r.receipt_id) for r in found} == expected


def test_one_to_one_match_takes_the_oldest(events):
    """Pays at 0 and 2, receipts at 1 and 3: both pairs match."""
    schema = "tx_id string, ts timestamp, id bigint"
    pays, receipts = ([{"tx_id": "t", "ts": ts, "id": ts} for ts in times] for times in ((0, 2), (1, 3)))
    found = joins.match_one_to_one(events(pays, schema), events(receipts, schema), "tx_id", 3 * SECOND, 5 * SECOND, "id", "id")
    assert {(r.outcome, r.pay_id, r.receipt_id) for r in found.collect()} == {("matched", 0, 1), ("matched", 2, 3)}


@pytest.mark.parametrize("receipt,outcome", [(97, "matched"), (96.999999, "alone"), (105, "matched"), (105.000001, "alone")])
def test_match_range_includes_both_ends(events, receipt, outcome):
    pay = events([{"tx_id": "t", "ts": 100, "id": 1}], "tx_id string, ts timestamp, id bigint")
    other = events([{"tx_id": "t", "ts": receipt, "id": 2}], "tx_id string, ts timestamp, id bigint")
    args = (pay, other, "tx_id")
    rows = joins.match_one_to_one(*args, 3 * SECOND, 5 * SECOND, "id", "id").collect()
    assert {r.outcome for r in rows} == ({"matched"} if outcome == "matched" else {"unmatched_pay", "unmatched_receipt"})
    assert joins.interval_join(*args, -3 * SECOND, 5 * SECOND).count() == (outcome == "matched")


def test_orders_that_lost_their_create(events):
    schema = "order_id string, event_type string, ts timestamp"
    rows = [("lost", "pay", 10), ("whole", "create", 0), ("whole", "pay", 10), ("unpaid", "create", 5), (None, "pay", 1)]
    found = order_outcomes(events([dict(zip(("order_id", "event_type", "ts"), r)) for r in rows], schema), 900 * SECOND, 3 * SECOND)
    assert {(r.order_id, r.outcome) for r in found.collect()} == {("lost", NO_CREATE), ("whole", PAID), ("unpaid", TIMED_OUT)}
