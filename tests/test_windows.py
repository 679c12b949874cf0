import random
from collections import Counter
from datetime import timedelta

import pytest
from times import seconds
from pyspark.sql import functions as F

from tidemark.operators import aggregates, lateness, ranking, visitors, windows

SECOND = timedelta(seconds=1)


def hits(n=600, span=20_000, seed=1):
    """A third of the rows share one key; another sixth one moment."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(8)}"
        ts = 777.0 if rng.random() < 0.16 else round(rng.uniform(0, span), 3)
        rows.append({"key": key, "ts": ts, "seq": i})
    return rows


def counted(df):
    return {(r["key"], seconds(r.window_end)): r.cnt for r in df.collect()}


@pytest.mark.parametrize("size,slide", [(60, 5), (3600, 5), (3600, 300), (10, 10)])
def test_sliding_counts_equal_built_in_windows(events, size, slide):
    df = events(hits(span=9_000), "key string, ts timestamp, seq bigint")
    span = (size * SECOND, slide * SECOND)
    assert counted(windows.sliding_counts(df, ["key"], *span)) == counted(
        windows.sliding_counts_direct(df, ["key"], *span)
    )


def test_sliding_counts_without_key_and_with_null_times(spark, events):
    df = events(hits(), "key string, ts timestamp, seq bigint")
    df = df.unionByName(df.limit(5).withColumn("ts", F.lit(None).cast("timestamp")))
    span = (600 * SECOND, 60 * SECOND)
    ours = windows.sliding_counts(df, [], *span).select("window_end", "cnt").collect()
    built_in = windows.sliding_counts_direct(df, [], *span).select("window_end", "cnt").collect()
    assert sorted(ours) == sorted(built_in)


def test_size_must_hold_whole_slides(events):
    with pytest.raises(ValueError):
        windows.sliding_counts(events(hits(1), "key string, ts timestamp"), [], 7 * SECOND, 5 * SECOND)


def test_top_n_breaks_ties_by_key(events):
    rows = [{"key": k, "ts": 1} for k in "bbaacdddd"]
    top = ranking.top_n(windows.tumbling_counts(events(rows, "key string, ts timestamp"), ["key"], 60 * SECOND), 3, "key")
    assert [(r.key, r.cnt, r["rank"]) for r in top.orderBy("rank").collect()] == [("d", 4, 1), ("a", 2, 2), ("b", 2, 3)]


def test_report_text(events):
    rows = [{"key": k, "ts": 1} for k in "aab"]
    top = ranking.top_n(windows.tumbling_counts(events(rows, "key string, ts timestamp"), ["key"], 60 * SECOND), 3, "key")
    (row,) = ranking.top_n_report(top, "key", "page").collect()
    assert row.report.split("\n") == ["time: 2024-01-01 00:01:00", "Top1: page=a count=2", "Top2: page=b count=1", "=" * 30]


def test_two_phase_equals_one_phase(events):
    df = events(hits(), "key string, ts timestamp, seq bigint")
    hour = timedelta(hours=1)
    one = windows.tumbling_counts(df, [], hour).select("window_end", "cnt").collect()
    two = aggregates.two_phase_counts(df, hour, F.col("seq"), salts=7).select("window_end", "cnt").collect()
    assert sorted(one) == sorted(two)


def test_visitor_counts_agree(events):
    rng = random.Random(5)
    rows = [{"user_id": 1 if rng.random() < 0.4 else rng.randrange(10**10), "ts": rng.uniform(0, 9000)} for _ in range(800)]
    df, hour = events(rows, "user_id bigint, ts timestamp"), timedelta(hours=1)
    expected = Counter(w for w, _ in {(r["ts"] // 3600 * 3600 + 3600, r["user_id"]) for r in rows})
    for count in (visitors.exact, visitors.from_full_set, visitors.id_bitmap, visitors.hashed_bitmap):
        assert {seconds(r.window_end): r.uv for r in count(df, hour).collect()} == expected, count.__name__


def arrivals(rows):
    """(row, watermark in seconds or None) in order of arrival, one second of disorder."""
    highest = None
    for row in sorted(rows, key=lambda r: r["seq"]):
        yield row, None if highest is None else highest - 1
        highest = row["ts"] if highest is None else max(highest, row["ts"])


def late_fixture():
    rng = random.Random(3)
    return [{"key": "u", "seq": i, "ts": round(i * 7 + rng.uniform(-300, 300) + 400, 3)} for i in range(500)]


@pytest.mark.parametrize("bucket", [4, 16, 1 << 16])
def test_late_rows(events, bucket):
    rows = late_fixture()
    df = events(rows, "key string, ts timestamp, seq bigint")
    span = (60 * SECOND, 5 * SECOND)
    marked = lateness.with_watermark_at_arrival(df, SECOND, seq="seq", bucket=bucket)
    late = {r.seq for r in marked.filter(lateness.too_late(*span, 30 * SECOND)).collect()}
    expected = {
        row["seq"]
        for row, mark in arrivals(rows)
        if mark is not None and mark >= row["ts"] // 5 * 5 + 60 - 0.001 + 30 - 1e-9
    }
    assert late == expected and 0 < len(late) < len(rows)


def test_counts_of_windows_open_at_arrival(events):
    rows = late_fixture()
    df = events(rows, "key string, ts timestamp, seq bigint")
    marked = lateness.with_watermark_at_arrival(df, SECOND, seq="seq", bucket=16)
    counts = windows.sliding_counts(
        marked, ["key"], 60 * SECOND, 5 * SECOND, first_open=lateness.first_open_end(30 * SECOND)
    )
    expected = Counter()
    for row, mark in arrivals(rows):
        for i in range(12):
            end = row["ts"] // 5 * 5 + 5 * (i + 1)
            if mark is None or end - 0.001 + 30 > mark + 1e-9:
                expected["u", end] += 1
    assert counted(counts) == expected
