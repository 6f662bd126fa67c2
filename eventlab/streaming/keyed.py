"""Streams with state per key in Spark's state store: counters, groups, windows, users.

Each operator is one stateful step over the rows of a key; what it keeps lives in the state
store, which writes what a micro-batch changed, so a batch costs what it touches and not what
was seen before.  Where a ``ttl`` is given, state that was not written for so long (in
processing time) is forgotten by the store itself.

The rows that a key has in one micro-batch go to one Python worker and are sorted there, in
the order of ``seq``.  A hot key is bounded by the size of a micro-batch, which the source
sets (files or offsets per trigger), and other keys don't wait for its state.  Counting that
needs no order (windows, totals) is in :mod:`eventlab.streaming.live` and has no hot key.

Rows without a ``seq`` come first in their batch.  A null key is a key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import AtomicType, LongType, StructField, StructType

from eventlab.streaming.live import watermarked
from eventlab.times import NONE, Windows, micros

# Stands for no number in a frame.
MOST = (1 << 63) - 1
# Entries that the users of a window are dealt over.
BUCKETS = 256


def millis(duration: timedelta | None) -> int | None:
    return None if duration is None else micros(duration) // 1000


def with_field(schema: StructType, *names: str) -> StructType:
    """The schema with more whole-number columns behind."""
    return StructType([*schema.fields, *(StructField(n, LongType()) for n in names)])


def named(column: str) -> Column:
    """A key as the text under which a map holds it; null is a key, too."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def in_order(rows: Iterator[Row], seq: str) -> list[Row]:
    return sorted(rows, key=lambda row: (row[seq] is not None, row[seq]))


class Keyed(StatefulProcessor):
    """What the processors share: the output row, the arrival column, how long state lives."""

    def __init__(self, columns: Sequence[str], seq: str, ttl: timedelta | None = None):
        self.columns, self.seq, self.ttl = list(columns), seq, millis(ttl)

    def close(self) -> None:
        pass


class RunningCount(Keyed):
    """Numbers the rows of a key, going on where the last batch ended (value state)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint", self.ttl)
        self.out = Row(*self.columns, "n")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = self.count.get()[0] if self.count.exists() else 0
        for row in in_order(rows, self.seq):
            n += 1
            yield self.out(*row, n)
        self.count.update((n,))


class Groups(Keyed):
    """Hands over the rows of a key in groups of ``size``; fewer wait in a list for the next batch (list state)."""

    def __init__(self, columns: Sequence[str], seq: str, size: int, schema: StructType, ttl: timedelta | None = None):
        super().__init__(columns, seq, ttl)
        self.size, self.schema = size, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rest = handle.getListState("rest", self.schema, self.ttl)
        self.done = handle.getValueState("done", "groups bigint, waiting bigint", self.ttl)
        self.out = Row(*self.columns, "group")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        done, waiting = self.done.get() if self.done.exists() else (0, 0)
        new = [tuple(row) for row in in_order(rows, self.seq)]
        if waiting + len(new) < self.size:
            self.rest.appendList(new)
            self.done.update((done, waiting + len(new)))
            return
        rows = [*(tuple(row) for row in self.rest.get()), *new] if waiting else new
        full = len(rows) // self.size * self.size
        for at, row in enumerate(rows[:full]):
            yield self.out(*row, done + at // self.size)
        if rows[full:]:
            self.rest.put(rows[full:])
        else:
            self.rest.clear()
        self.done.update((done + full // self.size, len(rows) - full))


class AcrossWindows(Keyed):
    """Numbers the rows of a key window by window: a window's rows are listed when it closes (map state, timers).

    A key's rows come and go as frames, and wait as one Arrow table per window and batch.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "n bigint")
        self.open = handle.getMapState("open", "end_ms bigint", "tables array<binary>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: dict[int, list[bytes]] = {}
        for some in joined(rows):
            for end, more in some.groupby("end_ms_"):
                new.setdefault(int(end), []).append(packed(more))
        for end, tables in new.items():
            kept = self.open.getValue((end,))
            self.open.updateValue((end,), ([*(bytes(x) for x in (kept[0] if kept else ())), *tables],))
            self.handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        kept = self.open.getValue((end,))
        if kept is None:
            return
        self.open.removeKey((end,))
        rows = pd.concat([unpacked(x) for x in kept[0]], ignore_index=True)
        rows = rows.sort_values(["numbered_", "seq_"], kind="stable", ignore_index=True)
        n = self.total.get()[0] if self.total.exists() else 0
        rows["n"] = np.arange(n + 1, n + len(rows) + 1)
        self.total.update((n + len(rows),))
        yield rows[[*self.columns, "n"]]


def joined(frames: Iterator[pd.DataFrame], size: int = 1 << 17) -> Iterator[pd.DataFrame]:
    """The frames in portions of about ``size`` rows."""
    held, n = [], 0
    for some in frames:
        held.append(some)
        n += len(some)
        if n >= size:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def packed(rows: pd.DataFrame) -> bytes:
    """Rows as an Arrow file."""
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_pandas()


def bucket(user: str) -> int:
    return zlib.crc32(user.encode("utf-8", "surrogatepass")) % BUCKETS


class Members:
    """The different users of a window in map state, many to an entry: a call to the store costs more than a hundred users do.

    Of what is kept, only the buckets are read that new users fall into, and each once per batch.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.state = handle.getMapState(name, "bucket int", "users array<string>")

    def open(self) -> None:
        """Begin with the rows that a window has in this batch."""
        self.any, self.held, self.changed = self.state.exists(), {}, set()

    def add(self, user: str) -> bool:
        """Whether the user is new."""
        at = bucket(user)
        if at not in self.held:
            kept = self.state.getValue((at,)) if self.any else None
            self.held[at] = set(kept[0]) if kept else set()
        if user in self.held[at]:
            return False
        self.held[at].add(user)
        self.changed.add(at)
        return True

    def keep(self) -> None:
        """Write what the batch changed."""
        for at in self.changed:
            self.state.updateValue((at,), (list(self.held[at]),))

    def count(self) -> int:
        return sum(len(users) for users, in self.state.values())

    def clear(self) -> None:
        self.state.clear()


class ActiveKeys(Keyed):
    """The different users of a window: gathered in a map, counted and dropped by a timer 1 ms after the end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.users = Members(handle, "users")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.users.open()
        for row in rows:
            self.users.add(row["user"])
        self.users.keep()
        self.handle.registerTimer(key[0] + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        users = self.users.count()
        self.users.clear()
        yield Row(end_ms=key[0], active=users)


class Marks(Keyed):
    """For each source and micro-batch the rows it delivered and the watermark that was in force; takes whole frames of rows."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.batches = handle.getValueState("batches", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, least, most = 0, MOST, -MOST
        for some in rows:
            n, least, most = n + len(some), min(least, int(some["low"].min())), max(most, int(some["high"].max()))
        before = self.batches.get()[0] if self.batches.exists() else 0
        self.batches.update((before + 1,))
        mark = timerValues.getCurrentWatermarkInMs()
        yield pd.DataFrame({"source": [key[0]], "n": [n], **{name: pd.array([x], "Int64") for name, x in (
            ("first_seq", least if least < MOST else None), ("last_seq", most if most > -MOST else None), ("mark_ms", mark if mark > 0 else None))}})


def live_running_count(stream: DataFrame, keys: Sequence[str], seq: str, ttl: timedelta | None = None) -> DataFrame:
    """Each row with the number of rows of its key so far; a key unseen for ``ttl`` starts again."""
    return stream.groupBy(*keys).transformWithState(
        RunningCount(stream.columns, seq, ttl), with_field(stream.schema, "n"), "Append", "None" if ttl is None else "ProcessingTime")


def live_row_groups(stream: DataFrame, keys: Sequence[str], seq: str, size: int, ttl: timedelta | None = None) -> DataFrame:
    """The rows of each key in groups of exactly ``size``, numbered from 0 by ``group``, as groups fill up."""
    return stream.groupBy(*keys).transformWithState(
        Groups(stream.columns, seq, size, stream.schema, ttl), with_field(stream.schema, "group"), "Append", "None" if ttl is None else "ProcessingTime")


def live_cross_window_count(stream: DataFrame, keys: Sequence[str], ts: str, seq: str, windows: Windows, delay: timedelta = NONE) -> DataFrame:
    """Rows of closed windows with a count per key that goes on from window to window."""
    rows = windows.assign(watermarked(stream, ts, delay), ts)
    schema = rows.schema
    # Frames know no null in a whole number, so values travel as text, and order by columns without one;
    # a frame's columns can't begin with an underscore.
    texts = [F.col(f.name).cast("string").alias(f"c{i}_") if isinstance(f.dataType, AtomicType) else F.col(f.name).alias(f"c{i}_") for i, f in enumerate(schema.fields)]
    number = F.coalesce(F.col(seq), F.lit(0).cast(schema[seq].dataType))
    rows = rows.select(*keys, ts, *texts, F.unix_millis("window_end").alias("end_ms_"), F.col(seq).isNotNull().alias("numbered_"), number.alias("seq_"))
    names = [f"c{i}_" for i in range(len(schema))]
    out = rows.groupBy(*keys).transformWithStateInPandas(AcrossWindows(names, "seq_"), with_field(rows.select(*names).schema, "n"), "Append", "EventTime")
    return out.select(*[F.col(f"c{i}_").cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)], "n")


def live_active_keys(stream: DataFrame, key: str, ts: str, windows: Windows, delay: timedelta = NONE) -> DataFrame:
    """How many different keys each closed window saw."""
    rows = windows.assign(watermarked(stream.select(named(key).alias("user"), ts), ts, delay), ts)
    rows = rows.select("user", ts, F.unix_millis("window_end").alias("end_ms"))
    out = rows.groupBy("end_ms").transformWithState(ActiveKeys(["user"], ""), "end_ms bigint, active bigint", "Append", "EventTime")
    return out.select(F.timestamp_millis("end_ms").alias("window_end"), "active")


def live_union_watermark(sources: dict[str, tuple[DataFrame, timedelta]], ts: str, seq: str) -> DataFrame:
    """The watermark of a union as each micro-batch of each source meets it: that of the slowest source.

    ``sources`` names the streams and how far each is out of order.  It is unknown until every
    source has delivered.  One row per source and micro-batch that has rows of it.
    """
    parts = []
    for name, (stream, delay) in sources.items():
        spark = stream.sparkSession
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
        numbers = [F.coalesce(F.col(seq).cast("bigint"), F.lit(none)).alias(x) for x, none in (("low", MOST), ("high", -MOST))]
        parts.append(watermarked(stream.select(ts, *numbers), ts, delay).withColumn("source", F.lit(name)))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    out = both.groupBy("source").transformWithStateInPandas(Marks([seq, ts, "source"], seq), "source string, n bigint, first_seq bigint, last_seq bigint, mark_ms bigint", "Append", "EventTime")
    return out.select("source", "n", "first_seq", "last_seq", F.timestamp_millis("mark_ms").alias("watermark"))
