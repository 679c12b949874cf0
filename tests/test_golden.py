"""Small cases whose results are known: failed logins, order states, receipts and the click cap."""

from datetime import timedelta

import pytest
from times import seconds
from pyspark.sql import functions as F

from tidemark.operators import clickcap, joins, lifecycle, outputs, patterns
from tidemark.operators.bursts import failure_bursts
from tidemark.plans import batch

SECOND = timedelta(seconds=1)
LOGINS = "event_id bigint, user_id bigint, kind string, ts timestamp"


@pytest.fixture
def logins(events):
    """One user fails three seconds in a row, the last of them arriving after later successes of others."""
    rows = [(5402, "success", 15), (23064, "fail", 26), (5692, "fail", 33), (1035, "fail", 42), (1035, "fail", 43)]
    rows += [(7328, "success", 45), (83, "success", 46), (1035, "fail", 44), (1035, "success", 49), (5692, "success", 60)]
    return events([{"event_id": i, "user_id": u, "kind": k, "ts": t} for i, (u, k, t) in enumerate(rows)], LOGINS)


def test_burst_of_failures(logins):
    (found,) = failure_bursts(logins, "user_id", F.col("kind") == "fail", 2, 2 * SECOND).collect()
    assert found["user_id"] == 1035 and 3 in found.asDict().values()


def test_consecutive_failures(logins):
    def pairs(times, within):
        rows = patterns.consecutive(logins, "user_id", F.col("kind") == "fail", times, within * SECOND).collect()
        return sorted((r["user_id"], seconds(r["first_ts"]), seconds(r["last_ts"])) for r in rows)

    assert pairs(2, 2) == [(1035, 42, 43), (1035, 43, 44)]
    assert pairs(3, 5) == [(1035, 42, 44)]


def test_order_states(events):
    rows = [(34729, "create", 42), (34729, "pay", 44), (34731, "pay", 46), (34731, "create", 45), (34756, "create", 50)]
    rows += [(34767, "create", 49), (34767, "pay", 49 + 1072), (34768, "pay", 55)]
    orders = events([{"order_id": o, "event_type": k, "ts": t} for o, k, t in rows], "order_id bigint, event_type string, ts timestamp")
    found = lifecycle.order_outcomes(orders, 900 * SECOND, 3 * SECOND).collect()
    assert {(r["order_id"], r["outcome"]) for r in found} == {
        (34729, lifecycle.PAID), (34731, lifecycle.PAID), (34756, lifecycle.TIMED_OUT),
        (34767, lifecycle.PAID_LATE), (34768, lifecycle.NO_CREATE),
    }


@pytest.fixture
def payments(events):
    """A receipt in range of two pays, and rows of both sides without a partner."""
    pays = [(1, "sd76f87d6", 44), (2, "3hu3k2432", 45), (3, "3hu3k2432", 46), (4, "35jue34we", 50), (5, "329d09f9f", 60)]
    receipts = [(1, "ewr342as4", 45), (2, "sd76f87d6", 47), (3, "3hu3k2432", 48), (4, "329d09f9f", 80)]
    build = lambda rows, name: events(
        [{"tx_id": x, name: i, "ts": t} for i, x, t in rows], f"tx_id string, {name} bigint, ts timestamp"
    )
    return build(pays, "pay_id"), build(receipts, "receipt_id")


def test_receipts_in_range(payments):
    pairs = joins.interval_join(*payments, "tx_id", -3 * SECOND, 5 * SECOND).collect()
    assert {(r["left_pay_id"], r["right_receipt_id"]) for r in pairs} == {(1, 2), (2, 3), (3, 3)}


def test_outputs_of_a_match_are_read_back_by_themselves(payments):
    """The earliest pay takes the receipt; an output reads its own files and none of the inputs."""
    matched = joins.match_one_to_one(*payments, "tx_id", 3 * SECOND, 5 * SECOND, "pay_id", "receipt_id")
    found = outputs.Outputs(matched, "outcome", "golden")
    ids = lambda label, *names: sorted(tuple(r) for r in found.of(label).select(*names).collect())
    assert ids("matched", "pay_id", "receipt_id") == [(1, 2), (2, 3)]
    assert ids("unmatched_pay", "pay_id") == [(3,), (4,), (5,)]
    assert ids("unmatched_receipt", "receipt_id") == [(1,), (4,)]
    assert found.of("no such").count() == 0 and found.of(None).count() == 0
    assert found.of("matched").columns == matched.columns


@pytest.mark.parametrize("report", ["pay_receipt_outputs", "order_outputs"])
def test_outputs_are_pruned(spark, report):
    plan = batch.REPORTS[report](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [(" in s or "PartitionFilters: [isnotnull(" in s for s in scans)
    assert not any("lineitem" in s or "orders.parquet" in s for s in scans) and "Exchange" not in plan


def test_click_cap(events):
    rows = [{"user_id": 937166, "ad_id": 1715, "event_id": i, "ts": 30 * i} for i in range(121)]
    rows += [{"user_id": 543462, "ad_id": 1715, "event_id": 200 + i, "ts": 1 + i} for i in range(100)]
    clicks = events(rows, "event_id bigint, user_id bigint, ad_id bigint, ts timestamp")
    assert clickcap.capped_clicks(clicks, 100).count() == 200
    assert clickcap.capped_clicks(clicks, 100, mode="drop_first_only").count() == 220
