"""Pairing two live streams with keyed state and event-time timers.

The low-latency form: state lives in the state store and timers emit waiting events
as soon as the watermark passes.  A call to a processor or its state costs more than hundreds
of events do, so keys are dealt over parts: the rows a part has in a batch are paired by one
call, and its waiting events lie in entries of bounded size, of which a batch reads and writes
those that its keys fall into.  All rows of a key go through one Python worker, so
use :mod:`eventlab.streaming.reconcile` where a key may be hot.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventlab.operators.multistream import tagged_union
from eventlab.streaming.keyed import MOST, packed, unpacked
from eventlab.streaming.live import watermarked
from eventlab.times import NONE, micros

OUTPUT = "key string, left_ms bigint, right_ms bigint, status string"
EVENT = ["spot", "key", "right", "ms", "reported"]
# Parts that the keys are dealt over.
PARTS = 2048
# Waiting events of a part's entry in the state store, about.
HELD = 256
# Stands for no time and no number in a frame.
LEAST = -(1 << 63)
# Under this name Spark looks for the event time of a column, in whatever form; rows behind the watermark are left out by it.
EVENT_TIME = "spark.watermarkDelayMs"


def entry_of(events: pd.DataFrame, parts: int, entries: int) -> np.ndarray:
    """The entry of each event; ``entries`` is a power of two."""
    return events["spot"].to_numpy() // parts & (entries - 1)


def listed(keys: np.ndarray, left: np.ndarray, right: np.ndarray, status: np.ndarray) -> pd.DataFrame:
    sides = {name: pd.arrays.IntegerArray(ms, ms == LEAST) for name, ms in (("left_ms", left), ("right_ms", right))}
    return pd.DataFrame({"key": keys, **sides, "status": status})


def alone(keys: np.ndarray, right: np.ndarray, ms: np.ndarray) -> pd.DataFrame:
    return listed(keys, np.where(right, LEAST, ms), np.where(right, ms, LEAST), np.where(right, "right_only", "left_only").astype(object))


def paired(events: pd.DataFrame, timeout_ms: int | None) -> tuple[list[pd.DataFrame], pd.DataFrame]:
    """What the events of some keys make, and those that wait behind them.

    Of a key, the event that ``waited`` before comes first, then others by their place ``at``.
    An event waits if it starts a row of events that change sides, or is an even number of
    events behind such a start; others meet the one before.
    """
    code = pd.factorize(events["key"], use_na_sentinel=False)[0]
    column = {name: events[name].to_numpy() for name in [*EVENT, "at", "waited"]}
    order = np.lexsort((column["right"], column["ms"], column["at"], ~column["waited"], code))
    code, key, right, ms, reported = (x[order] for x in (code, column["key"], column["right"], column["ms"], column["reported"]))
    place, same_key = np.arange(len(order)), np.zeros(len(order), bool)
    same_key[1:] = code[1:] == code[:-1]
    start = ~same_key
    start[1:] |= right[1:] == right[:-1]
    waits = (place - np.maximum.accumulate(np.where(start, place, 0))) % 2 == 0

    out = []
    second = np.flatnonzero(~waits)
    if len(second):
        here, before = ms[second], ms[second - 1]
        late = np.zeros(len(second), bool) if timeout_ms is None else np.abs(here - before) > timeout_ms
        out.append(listed(key[second], np.where(right[second], before, here), np.where(right[second], here, before),
                          np.where(late, "matched_late", "matched").astype(object)))
    pushed = np.flatnonzero(start & same_key) - 1  # by one of their own side
    pushed = pushed[waits[pushed] & ~reported[pushed]]
    if len(pushed):
        out.append(alone(key[pushed], right[pushed], ms[pushed]))
    left = order[waits & np.append(~same_key[1:], True)]
    return out, pd.DataFrame({name: column[name][left] for name in EVENT})


class Reconciler(StatefulProcessor):
    """Holds at most one waiting event per key, the newest; takes the rows of many keys at once.

    A pair is emitted when its second event arrives, an event pushed out of its place by
    a newer one of its side is emitted as alone.  An event still waiting ``timeout_ms``
    after its time is emitted as alone, too, and kept marked, so that a partner that comes
    after all is reported as matched late; after ``retention_ms``, if given, it is forgotten.

    The rows of a key in one batch are taken by arrival number, or without one by time, then
    side, so the result does not depend on the order in which the shuffle delivers them.
    The index of a part has for each entry how many events wait in it and when the first is
    due; there is a timer at the earliest.  Entries double in number when they fill up.
    """

    def __init__(self, timeout_ms: int | None, retention_ms: int | None = None):
        self.timeout_ms, self.retention_ms = timeout_ms, retention_ms
        self.parts, self.held = PARTS, HELD

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.index = handle.getValueState("index", "held array<int>, due array<bigint>")
        self.waiting = handle.getMapState("waiting", "entry int", "events binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        us = new["us"].to_numpy()
        new["ms"], new["reported"], new["waited"] = np.where(us == LEAST, LEAST, us // 1000), False, False
        held, due = self._index()
        entries = np.unique(entry_of(new, self.parts, len(held)))
        out, waiting = paired(self._read(entries[held[entries] > 0], [new]), self.timeout_ms)
        yield from out
        self._write(held, due, entries, waiting, int(due.min()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        held, due = self._index()
        entries = np.flatnonzero(due <= max(now, timerValues.getCurrentWatermarkInMs() - 1))
        if not len(entries):
            return
        events = self._read(entries)[EVENT]
        gone = self._due(events) <= max(now, timerValues.getCurrentWatermarkInMs() - 1)
        reported = events["reported"].to_numpy()
        if (gone & ~reported).any():
            yield alone(*(events[name].to_numpy()[gone & ~reported] for name in ("key", "right", "ms")))
        events = events[~(gone & reported)].assign(reported=(reported | gone)[~(gone & reported)])
        if self.retention_ms is not None:
            events = events[~events["reported"].to_numpy() | (self._due(events) > now)]
        self._write(held, due, entries, events, now)

    def close(self) -> None:
        pass

    def _index(self) -> tuple[np.ndarray, np.ndarray]:
        """How many events wait in each entry, and when the first of them is due."""
        kept = self.index.get()
        return (np.zeros(1, np.int64), np.full(1, MOST)) if kept is None else (np.array(kept[0], np.int64), np.array(kept[1], np.int64))

    def _due(self, events: pd.DataFrame) -> np.ndarray:
        """When an event is reported, or forgotten if it was."""
        ms, reported = events["ms"].to_numpy(), events["reported"].to_numpy()
        first, then = (np.full(len(ms), MOST) if wait is None else ms + wait for wait in (self.timeout_ms, self.retention_ms))
        return np.where(reported, then, first)

    def _read(self, entries: np.ndarray, more: list[pd.DataFrame] | tuple = ()) -> pd.DataFrame:
        """The events of some entries, and more."""
        kept = [unpacked(self.waiting.getValue((int(entry),))[0]).assign(at=LEAST, waited=True) for entry in entries]
        return pd.concat([*kept, *more], ignore_index=True) if len(kept) + len(more) != 1 else [*kept, *more][0]

    def _write(self, held: np.ndarray, due: np.ndarray, entries: np.ndarray, events: pd.DataFrame, timer: int) -> None:
        """The events that wait in some entries from now on; ``timer`` was the one of the part, or is being handled."""
        before, others = held.sum(), held.sum() - held[entries].sum()
        if others + len(events) > self.held * len(held):
            rest = np.setdiff1d(np.flatnonzero(held), entries)
            events = pd.concat([events, self._read(rest)[EVENT]], ignore_index=True) if len(rest) else events
            for entry in np.flatnonzero(held):
                self.waiting.removeKey((int(entry),))
            size = 1 << (2 * len(events) // self.held).bit_length()
            held, due, entries = np.zeros(size, np.int64), np.full(size, MOST), np.arange(size)
        place = entry_of(events, self.parts, len(held))
        order = np.argsort(place, kind="stable")
        events, place = events.iloc[order], place[order]
        next_due, low, high = self._due(events), np.searchsorted(place, entries, "left"), np.searchsorted(place, entries, "right")
        for entry, a, b in zip(entries.tolist(), low.tolist(), high.tolist()):
            if b > a:
                self.waiting.updateValue((entry,), (packed(events.iloc[a:b]),))
            elif held[entry]:
                self.waiting.removeKey((entry,))
            held[entry], due[entry] = b - a, next_due[a:b].min(initial=MOST)
        if held.any():
            self.index.update((held.tolist(), due.tolist()))
        elif before:
            self.index.clear()
        if due.min() != timer and due.min() < MOST:
            self.handle.registerTimer(int(due.min()))


def reconcile_with_timers(
    left: DataFrame, right: DataFrame, key: str, ts: str, timeout: timedelta | None = None, delay: timedelta = NONE,
    retention: timedelta | None = None, seq: str | None = None,
) -> DataFrame:
    """Pairs and lone events of two streams, in append mode: ``key``, both times and the status.

    ``seq`` numbers both inputs together in the order of their arrival, rising from batch to batch.

    The watermark of both streams together is that of the slower one.  Without a timeout
    an event waits for ever and only pairs are emitted.  With one, events without a time take no part.
    """
    def side(df: DataFrame) -> DataFrame:
        at = F.lit(0) if seq is None else F.col(seq)
        return watermarked(df.select(F.col(key).cast("string").alias("key"), ts, at.cast("bigint").alias("at")), ts, delay)

    both = tagged_union(side(left), side(right))
    if timeout is not None:
        both = both.filter(F.col(ts).isNotNull())
    spot = F.xxhash64("key")
    # Frames know neither a null in a whole number nor a time far from now.
    us = F.coalesce(F.unix_micros(ts), F.lit(LEAST)).alias("us", metadata={EVENT_TIME: micros(delay) // 1000})
    both = both.select(F.pmod(spot, F.lit(PARTS)).cast("int").alias("part"), spot.alias("spot"), "key", us,
                       F.coalesce("at", F.lit(LEAST)).alias("at"), (F.col("side") == "right").alias("right"))
    out = both.groupBy("part").transformWithStateInPandas(
        Reconciler(*(None if t is None else micros(t) // 1000 for t in (timeout, retention))),
        OUTPUT, "Append", "EventTime" if timeout is not None else "None")
    return out.select("key", F.timestamp_millis("left_ms").alias("left_ts"),
                      F.timestamp_millis("right_ms").alias("right_ts"), "status")
