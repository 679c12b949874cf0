"""Keyed stateful operators for event streams."""

from __future__ import annotations

import heapq
from abc import abstractmethod
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime, timedelta, timezone
from itertools import chain, islice

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.eventtime import as_micros, interval_no
from tidemark.operators.lifecycle import NO_CREATE, PAID, PAID_LATE, TIMED_OUT

# Rows that one entry of the state store holds at most.
ENTRY_ROWS = 1000
# Groups in which the keys of a stream share state: a call of the state store serves a group, not a key.
KEY_GROUPS = 1024
# The same for each day, where days have groups of their own.
DAY_GROUPS = 128
# Microseconds of the finest bucket of waiting rows; the buckets of each further level are so many times as wide.
FINEST_US, WIDER = 1 << 16, 64


class WaitingRows:
    """The rows of a key, or of a group of keys, until their time has come, in map state by buckets of time.

    A timing wheel of several levels: a row waits in a bucket that is the wider the further its time is
    off. A bucket is read when its beginning has come; rows that are not due yet go to finer buckets, so
    a row is read once for each level at most, however many rows wait and however often time moves on.
    Time moves in steps of the finest bucket.
    """

    def __init__(self, handle: StatefulProcessorHandle, row_schema: str):
        self._rows = handle.getMapState("waiting", "level bigint, bucket bigint, part bigint", _arrays(row_schema))
        self._buckets = handle.getValueState("buckets", "level array<bigint>, bucket array<bigint>, parts array<bigint>")

    def add(self, rows: Iterator[tuple], now: int) -> set[int]:
        """The times at which buckets that were not there before are to be read."""
        parts, wake = self._parts(), set()
        while fresh := list(islice(rows, ENTRY_ROWS)):
            places: dict[tuple[int, int], list[tuple]] = {}
            for row in fresh:
                places.setdefault(_bucket(row[0], now), []).append(row)
            for place, found in places.items():
                if place not in parts:
                    wake.add(_begin(*place) + FINEST_US)
                number = parts[place] = parts.get(place, 0) + 1
                self._rows.updateValue((*place, number), tuple(map(list, zip(*found, strict=True))))
        if wake or parts:
            self._buckets.update(tuple(map(list, zip(*((*place, n) for place, n in parts.items()), strict=True))))
        return wake

    def due(self, now: int) -> tuple[list[tuple], set[int]]:
        """The rows before `now`, and the times at which buckets that are new are to be read."""
        parts, ready, rest = self._parts(), [], []
        begun = [place for place in parts if _begin(*place) < now]
        for place in begun:
            for number in range(1, parts.pop(place) + 1):
                key = (*place, number)
                for row in zip(*self._rows.getValue(key), strict=True):
                    (ready if row[0] < now else rest).append(row)
                self._rows.removeKey(key)
        if not begun:
            return [], set()
        if parts:
            self._buckets.update(tuple(map(list, zip(*((*place, n) for place, n in parts.items()), strict=True))))
        else:
            self._buckets.clear()
        return ready, self.add(iter(rest), now) if rest else set()

    def _parts(self) -> dict[tuple[int, int], int]:
        if not self._buckets.exists():
            return {}
        return {(level, bucket): n for level, bucket, n in zip(*self._buckets.get(), strict=True)}


def _bucket(us: int, now: int) -> tuple[int, int]:
    """The level and number of the bucket in which a row waits."""
    level, width = 0, FINEST_US
    while us - now >= width * WIDER:
        level, width = level + 1, width * WIDER
    return level, us // width


def _begin(level: int, bucket: int) -> int:
    return bucket * FINEST_US * WIDER**level


class InEventTimeOrder(StatefulProcessor):
    """Handles a key's rows in event-time order, whatever order they arrive in.

    Rows wait in state until the watermark reaches them, so the result does not depend on how
    arrivals are cut into micro-batches. Subclasses keep one small state and may set a deadline,
    which passes as soon as a later row, or the watermark, does. With `key_type`, the keys of a
    group share entries of the state store: a micro-batch costs a few calls for each group, however
    many keys it has. The rows given start with the columns of `row_schema` and `key` then.
    """

    row_schema: str  # starts with `us bigint`, by which and by the columns after it rows are ordered
    state_schema: str
    output_schema: str  # besides the key
    key_type: str | None = None  # if the stream is grouped by groups of keys; rows are given in lists then

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._passed: dict = {}  # groups, with the time up to which this task has handled them
        shared = f", key {self.key_type}" if self.key_type else ""
        self._row = _columns(self.row_schema + shared)
        self._found = Row("key", *_columns(self.output_schema))
        self._waiting = WaitingRows(handle, self.row_schema + shared)
        self._states = handle.getValueState("state", _arrays(self.state_schema + shared))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N803
        names, n = self._row, len(self._row)
        fresh = (row[:n] for row in rows) if self.key_type else (tuple(row[name] for name in names) for row in rows)
        self._wake_at(self._waiting.add(fresh, _now(timerValues)))
        self._passed.pop(key[0], None)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N803
        now = _now(timerValues)
        if self._passed.get(key[0]) == now:  # an earlier timer of this micro-batch has
            return iter(())
        self._passed[key[0]] = now
        ready, wake = self._waiting.due(now)
        stored = list(zip(*self._states.get(), strict=True)) if self._states.exists() else []
        states = {own: self.load(state) for own, state in self._by_key(stored, key[0])}
        rows: dict = {own: [] for own in states}
        for own, row in self._by_key(ready, key[0]):
            rows.setdefault(own, []).append(row)
        given: list[tuple] = []
        for own, its in rows.items():
            state, found = states.pop(own, None), []
            for row in sorted(its):
                state = self._pass_deadlines(state, row[0], found)
                state = self.advance(state, row, found)
            state = self._pass_deadlines(state, now, found)
            if state is not None:
                states[own] = state
            given += ((own, *values) for values in found)
        if states:
            wake.add(min(map(self.deadline, states.values())) + 1 + FINEST_US)
            kept = ((*self.dump(state), own) if self.key_type else self.dump(state) for own, state in states.items())
            self._states.update(tuple(map(list, zip(*kept, strict=True))))
        elif stored:
            self._states.clear()
        self._wake_at(wake)
        return (self._found(*row) for row in given) if self.key_type is None else _in_lists(self._found, given)

    def _by_key(self, rows: list[tuple], group) -> Iterator[tuple]:
        """Each row's key and values; a group that isn't shared is a key."""
        return ((row[-1], row[:-1]) for row in rows) if self.key_type else ((group, row) for row in rows)

    def _pass_deadlines(self, state, us: int, found: list[tuple]):
        while state is not None and self.deadline(state) < us:
            state = self.expire(state, found)
        return state

    def _wake_at(self, times: set[int]) -> None:
        for us in times:
            self._handle.registerTimer(-(-us // 1000))

    def close(self) -> None:
        pass

    def load(self, stored: tuple):
        """The state that `advance` works on, of what is stored between timers."""
        return stored

    def dump(self, state) -> tuple:
        return state

    @abstractmethod
    def advance(self, state, row: tuple, found: list[tuple]):
        """State after `row`; results are added to `found`."""

    @abstractmethod
    def deadline(self, state) -> int:
        """Last microsecond at which the state still waits."""

    @abstractmethod
    def expire(self, state, found: list[tuple]):
        """State once its deadline has passed; results are added to `found`."""


def _now(timer_values) -> int:
    """The watermark, down to the finest bucket: all rows before it have arrived."""
    return timer_values.getCurrentWatermarkInMs() * 1000 // FINEST_US * FINEST_US


class FailureBurst(InEventTimeOrder):
    """A first failure opens a span, a success in it cancels it; see `failure_bursts`."""

    row_schema = "us bigint, seq bigint, fail boolean"
    state_schema = "opened bigint, last bigint, fails bigint"
    output_schema = "first_us bigint, last_us bigint, fails bigint"

    def __init__(self, times: int, within: timedelta):
        self.times, self.span = times, as_micros(within)

    def advance(self, state, row, found):
        us, _, fail = row
        if not fail:
            return None
        if state is None:
            return (us, us, 1)
        opened, _, fails = state
        return (opened, us, fails + 1)

    def deadline(self, state) -> int:
        return state[0] + self.span

    def expire(self, state, found):
        opened, last, fails = state
        if fails >= self.times:
            found.append((opened, last, fails))
        return None


class OrderLifecycle(InEventTimeOrder):
    """Create and pay flags of an order with a deadline.

    An order is reported as timed out when its deadline passes, so a pay after that finds no
    create any more and is reported as such.
    """

    row_schema = "us bigint, seq bigint, event_type string"
    state_schema = "kind string, us bigint"
    output_schema = "outcome string"

    def __init__(self, timeout: timedelta, disorder: timedelta):
        self.wait = {"create": as_micros(timeout), "pay": as_micros(disorder)}

    def advance(self, state, row, found):
        us, _, kind = row
        if state is None:
            return (kind, us)
        if state[0] == kind:  # the later one waits on
            self.expire(state, found)
            return (kind, us)
        late = state[0] == "create" and us >= self.deadline(state)
        found.append((PAID_LATE if late else PAID,))
        return None

    def deadline(self, state) -> int:
        kind, us = state
        return us + self.wait[kind]

    def expire(self, state, found):
        found.append((TIMED_OUT if state[0] == "create" else NO_CREATE,))
        return None


class ConsecutiveHits(InEventTimeOrder):
    """`times` strictly consecutive hits within a span, overlapping matches included."""

    row_schema = "us bigint, seq bigint, hit boolean"
    state_schema = "recent array<bigint>"
    output_schema = "first_us bigint, last_us bigint, events bigint"

    def __init__(self, times: int, within: timedelta):
        self.times, self.span = times, as_micros(within)

    def advance(self, state, row, found):
        us, _, hit = row
        if not hit:
            return None
        recent = [*(state[0] if state else ()), us]
        if len(recent) == self.times:
            if us - recent[0] < self.span:
                found.append((recent[0], us, self.times))
            recent = recent[1:]
        return (recent,) if recent else None

    def deadline(self, state) -> int:
        return state[0][-1] + self.span

    def expire(self, state, found):
        return None


class FollowedBy(InEventTimeOrder):
    """Each begin event with the first end event after it, or its timeout."""

    row_schema = "us bigint, seq bigint, begins boolean"
    state_schema = "open array<bigint>"
    output_schema = "begin_us bigint, end_us bigint, timeout_us bigint"

    def __init__(self, within: timedelta):
        self.span = as_micros(within)

    def load(self, stored):
        return deque(stored[0])

    def dump(self, state):
        return (list(state),)

    def advance(self, state, row, found):
        us, _, begins = row
        if begins:
            state = deque() if state is None else state
            state.append(us)
            return state
        # an end exactly at the deadline is too late, and the deadline has not passed yet
        found.extend(
            (begin, us, None) if us - begin < self.span else (begin, None, begin + self.span)
            for begin in state or ()
        )
        return None

    def deadline(self, state) -> int:
        return state[0] + self.span

    def expire(self, state, found):
        begin = state.popleft()
        found.append((begin, None, begin + self.span))
        return state or None


class OneToOne(InEventTimeOrder):
    """Pairs the two sides one to one; see `match_one_to_one`.

    A row takes the oldest row of the other side that still waits, or waits itself. So rows of one
    side wait at a time, first in, first out, the first until the deadline of its side.
    """

    row_schema = "us bigint, receipt boolean, id bigint"
    state_schema = "receipts boolean, us array<bigint>, id array<bigint>"
    output_schema = "outcome string, pay_id bigint, pay_us bigint, receipt_id bigint, receipt_us bigint"

    def __init__(self, early: timedelta, late: timedelta):
        self.wait = {False: as_micros(late), True: as_micros(early)}

    def load(self, stored):
        receipts, times, ids = stored
        return receipts, deque(zip(times, ids, strict=True))

    def dump(self, state):
        receipts, queue = state
        return (receipts, [us for us, _ in queue], [number for _, number in queue])

    def advance(self, state, row, found):
        us, receipt, number = row
        if state is None or state[0] == receipt:
            state = (receipt, deque()) if state is None else state
            state[1].append((us, number))
            return state
        other_us, other = state[1].popleft()
        pair = (other, other_us, number, us) if receipt else (number, us, other, other_us)
        found.append(("matched", *pair))
        return state if state[1] else None

    def deadline(self, state) -> int:
        return state[1][0][0] + self.wait[state[0]]

    def expire(self, state, found):
        us, number = state[1].popleft()
        found.append(("unmatched_receipt", None, None, number, us) if state[0] else ("unmatched_pay", number, us, None, None))
        return state if state[1] else None


class DailyCap(StatefulProcessor):
    """Passes a key's first `limit` rows per day, alerts at the next, drops the rest.

    Days are those of the running job, in UTC: counting starts again at midnight. The timer frees
    the state of keys that fall silent; a key that goes on is reset by its first row of the day,
    since timers fire only after the rows of a batch.
    """

    state_schema = "passed bigint, alerted boolean, until_ms bigint"
    output_schema = "user_id bigint, ad_id bigint, event_id bigint, us bigint, kind string"

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("clicks", self.state_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N803
        now_ms = timerValues.getCurrentProcessingTimeInMs()
        passed, alerted, until_ms = self._state.get() if self._state.exists() else (0, False, now_ms)
        if now_ms >= until_ms:
            passed, alerted, until_ms = 0, False, _next_midnight_ms(now_ms)
            self._handle.registerTimer(until_ms)
        found = []
        for row in sorted(rows, key=lambda r: (r["us"], r["event_id"])):
            if passed < self.limit:
                passed += 1
                kind = "click"
            elif not alerted:
                alerted = True
                kind = "alert"
            else:
                continue
            found.append(Row(user_id=key[0], ad_id=key[1], event_id=row["event_id"], us=row["us"], kind=kind))
        self._state.update((passed, alerted, until_ms))
        return iter(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N803
        if self._state.exists() and self._state.get()[2] <= expiredTimerInfo.getExpiryTimeInMs():
            self._state.clear()
        return iter(())

    def close(self) -> None:
        pass


class EventDayCap(StatefulProcessor):
    """The cap of `capped_clicks` per key and day of the clicks themselves, as changes of its result.

    State holds the first `limit + 1` clicks of each key seen so far, for a group of keys and a day in
    one entry. A click that arrives before one of them moves the later ones back, so a change may take
    back what was given: `delta` is 1 or -1, and the sums of all changes are what the batch gives. A
    click that moves back is later than the one that arrives, so no change is older than the watermark,
    and windows may follow. State of a day is freed when the watermark has passed it.

    The stream is grouped by group and day; its rows start with the keys, `us`, `event_id` and `label`.
    """

    def __init__(self, limit: int, keys: dict[str, str], first_only: bool = False):
        self.limit, self.keys, self.first_only = limit, list(keys), first_only
        named = ", ".join(f"{name} {kind}" for name, kind in keys.items())
        self.state_schema = f"{named}, us bigint, event_id bigint, label string"
        self.output_schema = f"{named}, event_id bigint, label string, us bigint, ts timestamp, kind string, delta bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._change_row = Row(*_columns(self.output_schema))
        self._state = handle.getValueState("first", _arrays(self.state_schema))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N803
        k = len(self.keys)
        first: dict[tuple, list[tuple]] = {}
        if self._state.exists():
            for row in zip(*self._state.get(), strict=True):
                first.setdefault(row[:k], []).append(row[k:])
        else:
            self._handle.registerTimer((key[-1] + 1) * 86_400_000)
        before: dict[tuple, list[tuple]] = {}
        while part := [row[: k + 3] for row in islice(rows, ENTRY_ROWS)]:
            fresh: dict[tuple, list[tuple]] = {}
            for row in part:
                fresh.setdefault(row[:k], []).append(row[k:])
            for own, clicks in fresh.items():
                had = first.get(own, [])
                before.setdefault(own, had)
                first[own] = heapq.nsmallest(self.limit + 1, chain(had, clicks), key=lambda click: click[:2])
                if self.first_only:  # all of them pass, and below one may be taken back
                    yield from (self._change(own, click, "click", 1) for click in clicks)
        self._state.update(tuple(map(list, zip(*((*own, *click) for own, its in first.items() for click in its), strict=True))))
        kinds = [("alert", slice(self.limit, None), 1)]
        kinds += [("click", slice(self.limit, None), -1)] if self.first_only else [("click", slice(self.limit), 1)]
        for own, had in before.items():
            for kind, part, sign in kinds:
                old, new = had[part], first[own][part]
                yield from (self._change(own, click, kind, sign) for click in new if click not in old)
                yield from (self._change(own, click, kind, -sign) for click in old if click not in new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N803
        self._state.clear()
        return iter(())

    def close(self) -> None:
        pass

    def _change(self, own: tuple, click: tuple, kind: str, delta: int) -> Row:
        us, event_id, label = click
        return self._change_row(*own, event_id, label, us, _EPOCH + timedelta(microseconds=us), kind, delta)


_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _columns(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(",")]


def _arrays(schema: str) -> str:
    """The schema of many rows in one entry, a column an array."""
    return ", ".join(f"{name} array<{kind}>" for name, kind in (field.split() for field in schema.split(",")))


def _in_lists(make: Row, rows: Iterable[tuple]) -> Iterator[Row]:
    """Rows as a few of lists, a column a list; `_unlisted` takes them apart."""
    rows = iter(rows)
    while part := list(islice(rows, ENTRY_ROWS)):
        yield make(*map(list, zip(*part, strict=True)))


def _unlisted(found: DataFrame) -> DataFrame:
    return found.select(F.inline(F.arrays_zip(*found.columns)))


def _group(keys: Sequence[str], groups: int) -> Column:
    """The group of a key, by which a stream is dealt instead of the key itself."""
    return F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int").alias("group")


def _next_midnight_ms(now_ms: int) -> int:
    now = datetime.fromtimestamp(now_ms / 1000, tz=timezone.utc)
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0) + timedelta(days=1)
    return int(midnight.timestamp() * 1000)


def process_in_order(
    stream: DataFrame,
    key: str,
    columns: dict[str, Column],
    processor: InEventTimeOrder,
    disorder: str,
    ts: str = "ts",
) -> DataFrame:
    """Applies an event-time processor per key. `columns` gives the values it reads besides time; null keys are left out.

    Keys are dealt to groups, which share state; a processor still sees each key by itself.
    """
    columns = {"us": F.unix_micros(ts)} | columns
    read = [columns[name].alias(name) for name in _columns(processor.row_schema)]
    processor.key_type = stream.schema[key].dataType.simpleString()
    rows = stream.withWatermark(ts, disorder).filter(F.col(key).isNotNull()).select(
        *read, F.col(key).alias("key"), _group([key], KEY_GROUPS), ts
    )
    found = rows.groupBy("group").transformWithState(
        statefulProcessor=processor,
        outputStructType=_arrays(f"key {processor.key_type}, {processor.output_schema}"),
        outputMode="Append",
        timeMode="EventTime",
    )
    return _unlisted(found).withColumnRenamed("key", key)


def cap_daily(clicks: DataFrame, limit: int) -> DataFrame:
    """Passed clicks and alerts of a click stream, told apart by `kind`."""
    rows = clicks.select("user_id", "ad_id", "event_id", F.unix_micros("ts").alias("us"))
    processor = DailyCap(limit)
    return rows.groupBy("user_id", "ad_id").transformWithState(
        statefulProcessor=processor,
        outputStructType=processor.output_schema,
        outputMode="Append",
        timeMode="ProcessingTime",
    )


def cap_by_event_day(
    clicks: DataFrame, limit: int, disorder: str, label: str, keys: Sequence[str] = ("user_id", "ad_id"), first_only: bool = False
) -> DataFrame:
    """Changes of the capped clicks and of the alerts of a click stream, each with its click's time and `label`."""
    kinds = {name: clicks.schema[name].dataType.simpleString() for name in keys}
    processor = EventDayCap(limit, kinds, first_only)
    us = F.unix_micros("ts")
    rows = clicks.withWatermark("ts", disorder).select(
        *keys, us.alias("us"), "event_id", F.col(label).alias("label"),
        _group(keys, DAY_GROUPS), interval_no(us, as_micros(timedelta(days=1))).alias("day"), "ts",
    )
    return rows.groupBy("group", "day").transformWithState(
        statefulProcessor=processor,
        outputStructType=processor.output_schema,
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="ts",
    )
