"""Failure bursts: a first failure opens a span, a success in it cancels it."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.eventtime import as_micros
from tidemark.operators.outputs import Outputs
from tidemark.operators.slicing import copy_to_slices, slice_width
from tidemark.runtime import scratch_dir

# Stands for "no open span"; below every event time.
NONE = np.iinfo(np.int64).min
#: Stands for the span that was open before, in the place of the failure that opened one.
AS_ENTERED = -1
#: Failures of long streaks that one call of Python holds.
PIECE_ROWS = 65_536
# monotonically_increasing_id has the partition above this many bits
ID_BITS = 33


def failure_bursts(
    events: DataFrame,
    key: str,
    is_fail: Column,
    times: int,
    within: timedelta,
    ts: str = "ts",
    seq: str = "event_id",
    width: int | None = None,
) -> DataFrame:
    """Spans with at least `times` failures: key, `first_ts`, `last_ts`, `fails`.

    A failure outside any span opens one of length `within`, both ends included; a success inside
    closes it without result.

    Failures form streaks: each follows the one before within the span, with no success between.
    Spans of different streaks do not touch, so a streak no longer than a span is one span and
    needs only an aggregation. In longer streaks each span opens where the one before ends; their
    failures are sorted by range, and pieces of them hand on the open span (`_long_streaks`), so
    neither a key nor a slice is any task's work, however densely failures come.

    A slice may be shorter than a span, which spreads a dense key further; each row is then copied to
    the slices within a span of it.
    """
    span = as_micros(within)
    width = width or slice_width(span)
    rows = events.select(
        F.col(key).alias("key"),
        F.unix_micros(ts).alias("us"),
        F.col(seq).alias("seq"),
        is_fail.alias("fail"),
    ).filter(F.col("key").isNotNull())
    # written, so that timelines are sorted once for both kinds of streaks
    streaks = Outputs(_streaks(rows, span, width, times), "short", "streaks")
    long = streaks.of(False)

    short = (
        streaks.of(True)
        .groupBy("key", "slice", "streak")
        .agg(
            F.min("us").alias("opened"),
            F.max("us").alias("last"),
            F.count("*").alias("fails"),
            F.max("closing").alias("closing"),
        )
        .withColumn("cancelled", F.coalesce(F.col("closing") <= F.col("opened") + span, F.lit(False)))
    )
    result = ["key", "opened", "last", "fails", "cancelled"]
    spans = short.select(result)
    if not long.isEmpty():
        spans = spans.unionByName(_long_streaks(long, span).select(result))
    return spans.filter((F.col("fails") >= times) & ~F.col("cancelled")).select(
        F.col("key").alias(key),
        F.timestamp_micros("opened").alias("first_ts"),
        F.timestamp_micros("last").alias("last_ts"),
        "fails",
    )


def _streaks(rows: DataFrame, span: int, width: int, times: int) -> DataFrame:
    """Failures by slice and streak, and whether the streak is `short`.

    `closing` is the time of a success that directly follows within the span. A slice numbers its
    streaks; number 0 came from the slice before, and a streak goes on if its next failure is in
    the slice after. Lone failures cannot matter unless one failure is enough.
    """
    copies = copy_to_slices(rows, F.col("us"), width, back=span, ahead=span)
    timeline = Window.partitionBy("key", "slice").orderBy("us", "seq")
    near_before = F.col("us") - F.lag("us").over(timeline) <= span
    near_after = F.lead("us").over(timeline) - F.col("us") <= span
    follows = F.coalesce(near_before & F.lag("fail").over(timeline), F.lit(False))
    continues = F.coalesce(near_after & F.lead("fail").over(timeline), F.lit(False))
    closing = F.when(near_after & ~F.lead("fail").over(timeline), F.lead("us").over(timeline))
    fails = (
        copies.withColumns({"starts": ~follows, "continues": continues, "closing": closing})
        .filter("fail AND is_home")
        .filter(F.lit(times <= 1) | F.col("continues") | ~F.col("starts"))
    )
    numbered = fails.withColumn("streak", F.sum(F.col("starts").cast("bigint")).over(timeline))
    streak = Window.partitionBy("key", "slice", "streak")
    # streak 0 has no beginning here
    begin = F.min(F.when(F.col("streak") > 0, F.col("us"))).over(streak)
    brief = F.coalesce(F.max("us").over(streak) - begin <= span, F.lit(False))
    goes_on = F.min("continues").over(streak)
    return numbered.select("key", "slice", "streak", "us", "seq", "starts", "closing", (brief & ~goes_on).alias("short"))


def _long_streaks(fails: DataFrame, span: int) -> DataFrame:
    """Spans of streaks that outlast one span or cross a slice border.

    1. Failures are sorted by range over all keys and cut into pieces of bounded size.
    2. A piece states which span leaves it, for each way one may enter (`_effect`); where a streak
       starts in it, that is one span, whatever enters.
    3. Effects of a piece and the one before are combined, then of twice as many pieces, and so on,
       until each piece knows the span that leaves it: rounds grow with the logarithm of the longest
       streak.
    4. Pieces cut their failures into spans, and spans across a border are added up.

    An effect has a step for each time of failure within a span of the piece's first, at most.
    """
    pieces = _pieces(fails)
    effects = _written(
        pieces.groupBy("piece").applyInPandas(lambda pdf: _effect(pdf, span), EFFECT), "burst-effects"
    )
    distance = 1
    while True:
        # a piece is settled if the same span leaves it whatever enters
        steps = effects.groupBy("piece").agg(F.count("*").alias("steps"), F.min("place").alias("least"))
        open_pieces = steps.filter((F.col("steps") > 1) | (F.col("least") == AS_ENTERED)).select("piece")
        if open_pieces.isEmpty():
            break
        earlier = effects.withColumn("piece", F.col("piece") + distance)
        both = effects.withColumn("first", F.lit(False)).unionByName(earlier.withColumn("first", F.lit(True)))
        combined = both.join(open_pieces, "piece", "left_semi").groupBy("piece")
        settled = effects.join(open_pieces, "piece", "left_anti")
        effects = _written(
            settled.unionByName(combined.applyInPandas(lambda pdf: _combined(pdf, span), EFFECT)), "burst-effects"
        )
        distance *= 2
    entering = effects.select(
        (F.col("piece") + 1).alias("piece"), F.col("opened").alias("entered"), F.col("place").alias("entered_at")
    )
    key_type = fails.schema["key"].dataType.simpleString()
    parts = (
        pieces.join(entering, "piece", "left")
        .fillna(NONE, ["entered", "entered_at"])
        .groupBy("piece")
        .applyInPandas(
            lambda pdf: _spans(pdf, span),
            f"key {key_type}, opened bigint, place bigint, fails bigint, last bigint, cancelled boolean",
        )
    )
    # spans may open at the same time on both sides of a success, hence the place
    return parts.groupBy("key", "opened", "place").agg(
        F.sum("fails").alias("fails"), F.max("last").alias("last"), F.max("cancelled").alias("cancelled")
    )


#: The span that leaves a piece, its opening time and the place of the failure that opened it, if the
#: span that enters expires at `from_expiry` or later, up to the next row.
EFFECT = "piece bigint, from_expiry bigint, opened bigint, place bigint"


def _written(frame: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _pieces(fails: DataFrame) -> DataFrame:
    """(key, us, starts, closing, place, piece): places follow time within a key; pieces are numbered without gaps."""
    order = ["key", "us", "seq"]
    tasks = int(fails.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    closing = F.coalesce("closing", F.lit(NONE)).alias("closing")
    # the place is part of the written rows, so a repeated task can't change it
    dealt = _written(
        fails.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .select("key", "us", "starts", closing, F.monotonically_increasing_id().alias("place")),
        "burst-failures",
    )
    part = F.shiftright("place", ID_BITS).alias("part")
    number = F.floor(F.col("place").bitwiseAND((1 << ID_BITS) - 1) / PIECE_ROWS).cast("bigint").alias("number")
    cut = dealt.select("*", part, number)
    before = F.sum("pieces").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = cut.groupBy("part").agg((F.max("number") + 1).alias("pieces"))
    # one row for each range
    offsets = _written(ranges.select("part", F.coalesce(before, F.lit(0)).alias("offset")), "burst-ranges")
    return cut.join(offsets, "part").select(*dealt.columns, (F.col("offset") + F.col("number")).alias("piece"))


def _effect(pdf: pd.DataFrame, span: int) -> pd.DataFrame:
    pdf = pdf.sort_values("place")
    us, place = pdf["us"].to_numpy(), pdf["place"].to_numpy()
    starts = np.flatnonzero(pdf["starts"].to_numpy())
    if len(starts):
        us, place = us[starts[-1] :], place[starts[-1] :]
    new = np.append(True, us[1:] != us[:-1])
    fails, place = us[new], place[new]
    last = _last_opening(fails, span)
    if len(starts):
        expiry, opened, at = [NONE], fails[last[:1]], place[last[:1]]
    else:
        # one that enters has opened at the first failure or before
        may_enter = int(np.searchsorted(fails, fails[0] + span, side="right"))
        expiry = np.append(NONE, fails[:may_enter])
        opened = np.append(fails[last], NONE)[: may_enter + 1]
        at = np.append(place[last], AS_ENTERED)[: may_enter + 1]
    return _steps(pdf["piece"].iat[0], np.asarray(expiry), opened, at)


def _steps(piece: int, expiry: np.ndarray, opened: np.ndarray, place: np.ndarray) -> pd.DataFrame:
    """An effect, without steps that change nothing."""
    changed = np.append(True, place[1:] != place[:-1])
    return pd.DataFrame(
        {"piece": piece, "from_expiry": expiry[changed], "opened": opened[changed], "place": place[changed]}
    )


def _last_opening(fails: np.ndarray, span: int) -> np.ndarray:
    """For each failure taken as an opening, the position of the last span opened after it."""
    following = np.searchsorted(fails, fails + span, side="right")
    jump = np.where(following < len(fails), following, np.arange(len(fails)))
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump
        jump = further


def _combined(pdf: pd.DataFrame, span: int) -> pd.DataFrame:
    """The effect of earlier pieces followed by that of later ones."""
    earlier, later = (
        [part[c].to_numpy() for c in ("from_expiry", "opened", "place")]
        for part in (pdf[f].sort_values("from_expiry") for f in (pdf["first"], ~pdf["first"]))
    )
    expiry, opened, place = earlier
    # only the last step may hand on what enters, from its expiry on
    hands_on = place[-1] == AS_ENTERED
    own = len(place) - int(hands_on)
    then = np.searchsorted(later[0], opened[:own] + span, side="right") - 1
    keeps = later[2][then] == AS_ENTERED
    found = [
        expiry[:own],
        np.where(keeps, opened[:own], later[1][then]),
        np.where(keeps, place[:own], later[2][then]),
    ]
    if hands_on:
        at = np.searchsorted(later[0], expiry[-1], side="right") - 1
        expiries = np.append(expiry[-1:], later[0][at + 1 :])
        found = [np.append(f, more) for f, more in zip(found, (expiries, later[1][at:], later[2][at:]), strict=True)]
    return _steps(pdf["piece"].iat[0], *found)


def _spans(pdf: pd.DataFrame, span: int) -> pd.DataFrame:
    """Cuts the failures of a piece into spans, going on with the span that enters; turns once per span."""
    pdf = pdf.sort_values("place")
    key, us, closing, place = (pdf[c].to_numpy() for c in ("key", "us", "closing", "place"))
    starts = pdf["starts"].to_numpy()
    edges = np.append(np.flatnonzero(starts), len(us))
    opened, opener = pdf["entered"].iat[0], pdf["entered_at"].iat[0]
    found, at = [], 0
    while at < len(us):
        if starts[at] or us[at] > opened + span:
            opened, opener = us[at], place[at]
        stop = edges[np.searchsorted(edges, at, side="right")]
        end = at + int(np.searchsorted(us[at:stop], opened + span, side="right"))
        cancelled = closing[end - 1] != NONE and closing[end - 1] <= opened + span
        found.append((key[at], opened, opener, end - at, us[end - 1], cancelled))
        at = end
    return pd.DataFrame(found, columns=["key", "opened", "place", "fails", "last", "cancelled"]).astype({"cancelled": bool})
