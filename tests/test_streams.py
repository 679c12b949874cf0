"""Streams over several files, cut and ordered in different ways, against the batch operators."""

import random
from datetime import timedelta

import pytest
from times import START, seconds
from pyspark.sql import functions as F

from tidemark.operators import clickcap, joins, ranking, visitors, windows
from tidemark.operators.bursts import failure_bursts
from tidemark.operators.lateness import first_open_end, too_late, with_watermark_at_arrival
from tidemark.streaming import pipelines, processors
from tidemark.streaming.panes import PaneStore
from tidemark.streaming.processors import _next_midnight_ms
from tidemark.streaming.sinks import BatchLog, append_available, custom_state, settings

SECOND = timedelta(seconds=1)
DISORDER = 30
SCHEMA = "event_id bigint, user_id bigint, kind string, ts timestamp"


def event_rows(n=400, span=3000, seed=8):
    """Events in order, then one far ahead, so that the watermark passes all others."""
    rng = random.Random(seed)
    rows = [
        {
            "user_id": 0 if rng.random() < 0.34 else rng.randrange(1, 12),
            "kind": rng.choice(["fail", "fail", "success", "pay", "receipt"]),
            "ts": round(i * span / n + rng.uniform(0, 5), 3),
        }
        for i in range(n)
    ]
    rows.sort(key=lambda r: r["ts"])
    rows += [{"user_id": -1, "kind": k, "ts": 10 * span} for k in ("fail", "pay", "receipt")]
    return [{"event_id": i, **row} for i, row in enumerate(rows)]


@pytest.fixture(params=["in order", "out of order"])
def source(request, spark, events, tmp_path):
    """(batch, stream) of the same rows; the stream reads files of 150 rows, one per micro-batch."""
    rows = event_rows()
    arriving = list(rows)
    if request.param == "out of order":
        rng = random.Random(1)
        arriving.sort(key=lambda r: r["ts"] + rng.uniform(0, DISORDER * 0.9))
    for i in range(0, len(arriving), 150):
        part = events(arriving[i : i + 150], SCHEMA).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "parts" / f"p{i:04d}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "parts" / "*"))
    return events(rows, SCHEMA), stream, str(tmp_path / "run")


def on_time(df):
    """Rows before the one that only pushes the watermark."""
    return df.filter(F.col("user_id") >= 0)


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_ranking_of_closed_windows(source):
    batch, stream, folder = source
    span = (600 * SECOND, 60 * SECOND)
    found = pipelines.rank_final_counts(stream, folder, "user_id", 3, *span, DISORDER * SECOND)
    expected = ranking.top_n(windows.sliding_counts(on_time(batch), ["user_id"], *span), 3, "user_id")
    columns = ("window_end", "user_id", "cnt", "rank")
    assert as_set(found, *columns) == as_set(expected, *columns)


def arrivals(spark, events, tmp_path, spread, n=240, parts=4):
    """(batch, stream) of rows that arrive up to `spread` seconds out of order, numbered as they arrive."""
    rng = random.Random(3)
    rows = [
        {"event_id": i, "user_id": rng.randrange(4), "kind": "x", "ts": round(i * 7 + rng.uniform(-spread, spread) + 400, 3)}
        for i in range(n)
    ]
    for i in range(0, n, n // parts):
        events(rows[i : i + n // parts], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "parts" / f"p{i:04d}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "parts" / "*"))
    return events(rows, SCHEMA), stream


@pytest.mark.parametrize("spread,every", [(20, 16), (300, 2)])
def test_ranking_as_counts_change(spark, events, tmp_path, monkeypatch, spread, every):
    """Rows that are late for some of their windows count in the others, and snapshots keep what these need."""
    monkeypatch.setattr(PaneStore.__init__, "__defaults__", (every,))
    batch, stream = arrivals(spark, events, tmp_path, spread, parts=6)
    span, wait = (600 * SECOND, 60 * SECOND), (30 * SECOND, 60 * SECOND)
    changes = pipelines.ranking_changes(stream, str(tmp_path / "run"), "user_id", 3, *span, *wait, seq="event_id")
    found = pipelines.folded(changes)
    marked = with_watermark_at_arrival(batch, wait[0])
    counts = windows.sliding_counts(marked, ["user_id"], *span, first_open=first_open_end(wait[1]))
    expected = ranking.top_n(counts, 3, "user_id")
    columns = ("window_end", "user_id", "cnt", "rank")
    assert as_set(found, *columns) == as_set(expected, *columns)
    whole = ranking.top_n(windows.sliding_counts(batch, ["user_id"], *span), 3, "user_id")
    assert (as_set(whole, *columns) == as_set(expected, *columns)) == (spread == 20)
    # a batch inserts what isn't there, deletes what is, and doesn't write what stays
    there, batches = set(), set()
    for row in changes.orderBy("batch_id").collect():
        ranked = tuple(row[name] for name in columns)
        assert row["delta"] == (-1 if ranked in there else 1)
        assert (row["batch_id"], ranked) not in batches
        batches.add((row["batch_id"], ranked))
        there ^= {ranked}
    assert there == as_set(expected, *columns) and any(row["delta"] < 0 for row in changes.collect())


def test_kept_counts_stay_few(spark, tmp_path):
    """However many batches there were, a batch reads a snapshot and a few tables of what is still open."""
    store = PaneStore(spark, str(tmp_path / "panes"), ["k", "_stop"], "_n", "k string, _stop bigint, _n bigint", every=4)
    reads, rows = [], []
    for batch_id in range(24):
        for _ in range(1 + batch_id % 2):  # every other batch is retried
            store.write(spark.createDataFrame([("a", batch_id, 1), ("b", 1000, 1)], store.schema), batch_id)
            reads.append(len(store.paths(batch_id)))
            rows.append(store.read(batch_id).count())
            total = {r.k: r.n for r in store.read(batch_id).groupBy("k").agg(F.sum("_n").alias("n")).collect()}
            assert total["b"] == batch_id + 1
            store.compact(batch_id, F.col("_stop") > batch_id - 3)
    assert max(reads) <= 5 and max(rows) <= 12
    assert len(list((tmp_path / "panes").iterdir())) <= 12


def test_sliding_counts_from_closed_slides(source):
    batch, stream, folder = source
    slide = 5 * SECOND
    panes = append_available(pipelines.final_panes(stream, ["kind"], slide, DISORDER * SECOND), folder)
    found = windows.sliding_counts_of_panes(panes, ["kind"], 60 * SECOND, slide)
    expected = windows.sliding_counts(on_time(batch), ["kind"], 60 * SECOND, slide)
    assert as_set(found, "kind", "window_end", "cnt") == as_set(expected, "kind", "window_end", "cnt")


def test_visitors(source):
    batch, stream, folder = source
    size = 300 * SECOND
    closed = append_available(pipelines.final_visitors(stream, size, DISORDER * SECOND), f"{folder}/closed")
    running = pipelines.running_visitors(stream, f"{folder}/running", size, DISORDER * SECOND)
    assert as_set(closed, "window_end", "uv") == as_set(visitors.exact(on_time(batch), size), "window_end", "uv")
    assert as_set(running, "window_end", "uv") == as_set(visitors.exact(batch, size), "window_end", "uv")
    bits = append_available(pipelines.final_bitmap_visitors(stream, size, DISORDER * SECOND), f"{folder}/bits")
    assert as_set(bits, "window_end", "uv") == as_set(visitors.hashed_bitmap(on_time(batch), size), "window_end", "uv")


def split_sides(df):
    side = lambda kind, name: df.filter(F.col("kind") == kind).select(
        F.col("user_id").alias("tx_id"), F.col("event_id").alias(name), "ts"
    )
    return side("pay", "pay_id"), side("receipt", "receipt_id")


def test_interval_join(source):
    batch, stream, folder = source
    found = append_available(
        pipelines.joined_in_range(*split_sides(stream), "tx_id", 30 * SECOND, 50 * SECOND, DISORDER * SECOND), folder
    )
    expected = joins.interval_join(*split_sides(batch), "tx_id", -30 * SECOND, 50 * SECOND)
    assert as_set(found, "left_pay_id", "right_receipt_id") == as_set(expected, "left_pay_id", "right_receipt_id")


def test_matched_or_alone(spark, source):
    batch, stream, folder = source
    wait = ("tx_id", 30 * SECOND, 50 * SECOND)
    with custom_state(spark):
        found = append_available(pipelines.matched_or_alone(*split_sides(stream), *wait, DISORDER * SECOND), folder)
    expected = joins.match_one_to_one(*split_sides(on_time(batch)), *wait, "pay_id", "receipt_id")
    columns = ("outcome", "tx_id", "pay_id", "receipt_id", "pay_ts", "receipt_ts")
    assert found.filter("tx_id >= 0").count() == expected.count()
    assert as_set(found.filter("tx_id >= 0"), *columns) == as_set(expected, *columns)
    assert expected.filter("outcome = 'matched'").count() > 10


class Handle:
    """Processor state in memory, which counts the rows read from map state."""

    def __init__(self):
        self.read, self.timers = 0, set()

    def getMapState(self, *_):  # noqa: N802
        return Values(self)

    def getValueState(self, *_):  # noqa: N802
        return Values(self)

    def registerTimer(self, ms):  # noqa: N802
        self.timers.add(ms)


class Values:
    def __init__(self, handle):
        self.handle, self.values = handle, {}

    def updateValue(self, key, value):  # noqa: N802
        self.values[key] = value

    def getValue(self, key):  # noqa: N802
        self.handle.read += len(self.values[key][0])
        return self.values[key]

    def removeKey(self, key):  # noqa: N802
        del self.values[key]

    def exists(self):
        return bool(self.values)

    def get(self):
        return self.values[None]

    def update(self, value):
        self.values[None] = value

    def clear(self):
        self.values = {}


class Times:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


@pytest.mark.parametrize("wait_s", [1, 400, 90_000])
def test_waiting_rows_are_read_a_few_times_each(wait_s):
    """4,000 rows, four or more batches a second or a day apart, arriving up to `wait_s` before they are due."""

    class Seen(processors.InEventTimeOrder):
        row_schema, state_schema, output_schema = "us bigint, seq bigint", "n bigint", "us bigint, seq bigint"

        def advance(self, state, row, found):
            found.append(row)

        deadline = expire = None

    rng, handle, seen, count = random.Random(1), Handle(), [], 4000
    processor = Seen()
    processor.init(handle)
    rows = [(1_700_000_000_000_000 + i * wait_s * 2500 + rng.randrange(wait_s * 10**6), i) for i in range(count)]
    batches = [rows[k : k + 10] for k in range(0, count, 10)] + [[]]
    watermark = 0
    for batch in batches:
        processor.handleInputRows(("k",), iter([{"us": us, "seq": i} for us, i in batch]), Times(watermark))
        watermark = max(watermark, (max(us for us, _ in batch) // 1000 - wait_s * 1000) if batch else 2**42)
        for ms in sorted(t for t in handle.timers if t <= watermark):
            handle.timers.discard(ms)
            seen += [(r.us, r.seq) for r in processor.handleExpiredTimer(("k",), Times(watermark), None)]
    assert seen == sorted(rows) and not handle.timers
    assert handle.read <= 5 * count


def run_in_order(spark, stream, columns, processor, folder):
    with custom_state(spark):
        found = processors.process_in_order(stream, "user_id", columns, processor, f"{DISORDER} seconds")
        return append_available(found, folder)


def test_failure_bursts(spark, source):
    batch, stream, folder = source
    fail, span = F.col("kind") == "fail", 20 * SECOND
    logins = F.col("kind").isin("fail", "success")
    columns = {"seq": F.col("event_id"), "fail": fail}
    found = run_in_order(spark, stream.filter(logins), columns, processors.FailureBurst(2, span), folder)
    expected = failure_bursts(on_time(batch).filter(logins), "user_id", fail, 2, span)
    times = (F.unix_micros("first_ts"), F.unix_micros("last_ts"))
    assert as_set(found, "user_id", "first_us", "last_us", "fails") == as_set(expected, "user_id", *times, "fails")


def test_order_of_arrival_does_not_matter_to_patterns(spark, source):
    from tidemark.operators import patterns

    batch, stream, folder = source
    fail = F.col("kind") == "fail"
    found = run_in_order(
        spark, stream, {"seq": F.col("event_id"), "hit": fail}, processors.ConsecutiveHits(3, 60 * SECOND), f"{folder}/a"
    )
    expected = patterns.consecutive(on_time(batch), "user_id", fail, 3, 60 * SECOND)
    times = (F.unix_micros("first_ts"), F.unix_micros("last_ts"))
    assert as_set(found, "user_id", "first_us", "last_us") == as_set(expected, "user_id", *times)

    pay, both = F.col("kind") == "pay", F.col("kind").isin("fail", "pay")
    found = run_in_order(
        spark,
        stream.filter(both),
        {"seq": F.col("event_id"), "begins": fail},
        processors.FollowedBy(40 * SECOND),
        f"{folder}/b",
    )
    expected = patterns.followed_by(on_time(batch), "user_id", fail, pay, 40 * SECOND)
    times = [F.unix_micros(c) for c in ("begin_ts", "end_ts", "timeout_at")]
    assert as_set(found, "user_id", "begin_us", "end_us", "timeout_us") == as_set(expected, "user_id", *times)


def test_late_rows(spark, events, tmp_path):
    batch, stream = arrivals(spark, events, tmp_path, 300)
    span = (60 * SECOND, 5 * SECOND)
    found = pipelines.late_rows(stream, str(tmp_path / "run"), *span, SECOND, 30 * SECOND, seq="event_id")
    marked = with_watermark_at_arrival(batch, SECOND)
    expected = marked.filter(too_late(*span, 30 * SECOND))
    assert as_set(found, "event_id") == as_set(expected, "event_id") and found.count() > 0


def test_click_cap(spark, events, tmp_path):
    schema = "event_id bigint, user_id bigint, ad_id bigint, ts timestamp"
    rows = [{"event_id": i, "user_id": i % 2, "ad_id": 1, "ts": i} for i in range(20)]
    for i in range(0, 20, 5):
        events(rows[i : i + 5], schema).coalesce(1).write.parquet(str(tmp_path / "parts" / f"p{i:02d}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "parts" / "*"))
    with custom_state(spark, processing_time=True):
        found = append_available(processors.cap_daily(stream, 3), str(tmp_path / "run")).collect()
    for user in (0, 1):
        assert sorted(r.kind for r in found if r.user_id == user) == ["alert", "click", "click", "click"]
    assert sorted(r.event_id for r in found if r.kind == "click") == list(range(6))


@pytest.mark.parametrize("first_only", [False, True])
def test_capped_report_of_event_days(spark, events, tmp_path, first_only):
    """Clicks out of order over midnight: counts and alerts equal the batch, whichever click came first."""
    schema = "event_id bigint, user_id bigint, ad_id bigint, province string, ts timestamp"
    rng, slide, size = random.Random(6), 60 * SECOND, 600 * SECOND
    rows = [
        {"event_id": i, "user_id": 1 if rng.random() < 0.4 else rng.randrange(2, 9), "ad_id": rng.randrange(2), "ts": 80_000 + 40 * i}
        for i in range(400)
    ]
    rows = [{**r, "province": f"p{r['user_id'] % 3}"} for r in rows]
    arriving = sorted(rows, key=lambda r: r["ts"] + rng.uniform(0, 900))
    ending = [{"event_id": 999, "user_id": -1, "ad_id": 0, "province": "end", "ts": 400_000}]
    for i, part in enumerate([*(arriving[k : k + 80] for k in range(0, 400, 80)), ending]):
        events(part, schema).coalesce(1).write.parquet(str(tmp_path / "parts" / f"p{i:02d}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "parts" / "*"))
    with custom_state(spark):
        panes = append_available(pipelines.capped_panes(stream, 5, slide, 900 * SECOND, "province", first_only), str(tmp_path / "run"))
    batch = events(rows, schema)
    capped = clickcap.capped_clicks(batch, 5, mode="drop_first_only" if first_only else "drop_all")
    expected = windows.sliding_counts(capped, ["province"], size, slide)
    found = windows.sliding_counts_of_panes(panes.filter("kind = 'click'"), ["province"], size, slide)
    assert as_set(found, "province", "window_end", "cnt") == as_set(expected, "province", "window_end", "cnt")
    alerts = clickcap.cap_alerts(batch, 5)
    found = panes.filter("kind = 'alert'").withColumn("ts", F.timestamp_micros("us"))
    assert as_set(found, "user_id", "ad_id", "ts") == as_set(alerts, "user_id", "ad_id", "ts") and alerts.count() > 3
    assert panes.filter("kind = 'alert' AND cnt <> 1").count() == 0


def test_next_midnight_of_the_running_day():
    day_ms = 86_400_000
    assert _next_midnight_ms(0) == day_ms
    assert _next_midnight_ms(day_ms - 1) == day_ms
    assert _next_midnight_ms(day_ms) == 2 * day_ms


def test_batch_log_counts_a_retried_batch_once(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), "k string, v bigint")
    assert log.read().count() == 0
    rows = lambda *values: spark.createDataFrame(list(values), "k string, v bigint")
    log.write(rows(("a", 1), ("b", 2)), 0)
    log.write(rows(("a", 9)), 1)
    log.write(rows(("a", 5), ("c", 3)), 1)
    assert as_set(log.latest(["k"]), "k", "v") == {("a", 5), ("b", 2), ("c", 3)}
    assert log.read(before=1).count() == 2


def test_streams_without_input_give_empty_tables(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "none"))
    minute = 60 * SECOND
    ranked = pipelines.rank_final_counts(stream, str(tmp_path / "a"), "user_id", 3, minute, minute, SECOND)
    updated = pipelines.rank_changing_counts(stream, str(tmp_path / "b"), "user_id", 3, minute, minute, SECOND, minute, seq="event_id")
    visits = append_available(pipelines.final_visitors(stream, minute, SECOND), str(tmp_path / "c"))
    assert [df.count() for df in (ranked, updated, visits)] == [0, 0, 0]


def test_settings_are_put_back(spark):
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    with settings(spark, {name: "false"}):
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name) == before


def test_fixture_times():
    assert seconds(START) == 0
