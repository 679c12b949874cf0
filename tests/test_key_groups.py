"""Keys that share a group's state: each has the results that it has alone, and calls of the state store go by groups."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import Row

from tidemark.streaming import processors

SECOND, START_US = timedelta(seconds=1), 1_700_000_000_000_000
DAY = START_US // 86_400_000_000


class Handle:
    """Processor state in memory, which counts the calls."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getMapState(self, *_):  # noqa: N802
        return State(self)

    getValueState = getMapState  # noqa: N815

    def registerTimer(self, ms):  # noqa: N802
        self.calls += 1
        self.timers.add(ms)


class State:
    def __init__(self, handle):
        self.handle, self.values = handle, {}

    def _called(self, value=None):
        self.handle.calls += 1
        return value

    def updateValue(self, key, value):  # noqa: N802
        self._called(self.values.update({key: value}))

    def getValue(self, key):  # noqa: N802
        return self._called(self.values[key])

    def removeKey(self, key):  # noqa: N802
        self._called(self.values.pop(key))

    def exists(self):
        return self._called(bool(self.values))

    def get(self):
        return self.getValue(None)

    def update(self, value):
        self.updateValue(None, value)

    def clear(self):
        self._called(self.values.clear())


class Times:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


def run(processor, group, batches):
    """The rows given, and the calls, of batches of rows; at last the watermark passes everything."""
    handle, given, watermark = Handle(), [], 0
    processor.init(handle)
    for rows in [*batches, []]:
        if rows:
            processor.handleInputRows(group, iter(rows), Times(watermark))
        watermark = max(row["us"] for row in rows) // 1000 if rows else 2**42
        while due := sorted(t for t in handle.timers if t <= watermark):
            for ms in due:
                handle.timers.discard(ms)
                given += processor.handleExpiredTimer(group, Times(watermark), None)
    return given, handle.calls


RULES = {
    "lifecycle": (lambda: processors.OrderLifecycle(60 * SECOND, SECOND), lambda rng: rng.choice(["create", "pay"])),
    "timeouts": (lambda: processors.FollowedBy(60 * SECOND), lambda rng: rng.random() < 0.5),
    "fail next": (lambda: processors.ConsecutiveHits(2, 60 * SECOND), lambda rng: rng.random() < 0.7),
    "bursts": (lambda: processors.FailureBurst(2, 60 * SECOND), lambda rng: rng.random() < 0.7),
}


@pytest.mark.parametrize("rule", RULES)
@pytest.mark.parametrize("key", [int, str])
def test_keys_of_a_group_have_the_results_they_have_alone(rule, key):
    make, value = RULES[rule]
    rng, keys = random.Random(4), [key(k) for k in range(300)]
    fields = [field.split()[0] for field in make().row_schema.split(",")]
    shared = Row(*fields, "key", "group")
    batches = []
    for start in (0, 200, 1000):  # states and rows wait over several batches
        rows = [(START_US + (start + rng.randrange(400)) * 1_000_000, i, value(rng), rng.choice(keys)) for i in range(1500)]
        batches.append([shared(*row, 7) for row in rows])
        batches[-1] = [row for row in batches[-1] if not batches[:-1] or row["us"] > max(r["us"] for r in batches[-2])]

    grouped = make()
    grouped.key_type = "bigint"
    given, calls = run(grouped, (7,), batches)
    found = sorted(repr(row) for lists in given for row in zip(*lists, strict=True))

    alone, calls_alone = [], 0
    for own in keys:
        its, n = run(make(), (own,), [[row.asDict() for row in rows if row["key"] == own] for rows in batches])
        alone, calls_alone = alone + [repr(tuple(row)) for row in its], calls_alone + n
    assert found == sorted(alone) and len(found) > 300
    assert calls_alone > 10 * calls


@pytest.mark.parametrize("first_only", [False, True])
def test_capped_keys_of_a_group_have_the_changes_they_have_alone(first_only):
    rng, make = random.Random(5), lambda: processors.EventDayCap(3, {"user_id": "bigint", "ad_id": "bigint"}, first_only)
    shape = Row("user_id", "ad_id", "us", "event_id", "label", "group", "day")
    rows = [(rng.choice([None, *range(200)]), rng.randrange(2), START_US + rng.randrange(10**9), i, "x", 7, DAY) for i in range(2500)]
    batches = [[shape(*row) for row in rows[k : k + 500]] for k in range(0, 2500, 500)]

    def changes(parts):
        handle, given, processor = Handle(), [], make()
        processor.init(handle)
        for part in parts:
            given += map(repr, processor.handleInputRows((7, DAY), iter(part), Times(0)) if part else [])
        return given, handle

    given, handle = changes(batches)
    keys, alone, calls_alone = {row[:2] for row in rows}, [], 0
    for own in keys:
        its, one = changes([[row for row in part if row[:2] == own] for part in batches])
        alone, calls_alone = alone + its, calls_alone + one.calls
    assert sorted(given) == sorted(alone) and len(given) > 500
    assert handle.timers == {(DAY + 1) * 86_400_000}
    assert handle.calls < 20 and calls_alone > 20 * handle.calls
