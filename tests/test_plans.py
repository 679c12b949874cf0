"""What the physical plans must and must not contain."""

import re

import pytest

from tidemark.plans import batch

FOLDER = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return batch.REPORTS[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(batch.REPORTS))
def test_no_report_pairs_everything_or_reads_everything(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # these three follow the watermark over the arrivals, by one row for each 65,536 * 65,536 of them
    if name not in ("late_events", "hot_pages_on_time_counts", "hot_pages_top3"):
        assert "SinglePartition" not in plan
    for columns in re.findall(r"ReadSchema: struct<(.*?)>", plan):
        assert "value" not in columns and "o_totalprice" not in columns and "l_extendedprice" not in columns


@pytest.mark.parametrize("name", ["hot_items_top5", "hot_pages_top3", "pv_hourly", "uv_exact", "late_events", "ad_click_capped"])
def test_event_type_filter_reaches_the_scan(spark, name):
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,(view|click)\)", plan_of(spark, name))


@pytest.mark.parametrize("name", ["hot_items_top5", "hot_items_sql", "hot_items_table", "ad_click_capped", "ad_blacklist_alerts"])
def test_row_number_limits_apply_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize("name", ["hot_items_counts", "market_by_channel", "market_total", "ad_by_province"])
def test_sliding_windows_do_not_expand_rows(spark, name):
    plan = plan_of(spark, name)
    assert "Expand" not in plan
    scan, aggregate = plan.rindex("FileScan"), plan.rindex("HashAggregate")
    below = plan[aggregate:scan]
    assert "Generate" not in below, "rows are counted per slide before anything is multiplied"


def test_patterns_shuffle_by_key_and_slice(spark):
    for name in ("login_fail_next", "pay_receipt_match", "order_paid"):
        assert re.search(r"Exchange hashpartitioning\(\w+#\d+L?, slice#\d+L", plan_of(spark, name)), name


def test_failure_timelines_are_sorted_once(spark):
    report = batch.login_fail_burst(spark, FOLDER)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    # both kinds of streaks are read from what the one sort wrote
    assert "events.parquet" not in final and "Window" not in final
    assert not re.search(r"hashpartitioning\(key#\d+L?, slice#\d+L, \d+\)", final)
