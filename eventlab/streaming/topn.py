"""The busiest keys of each window of a stream."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventlab.operators.topn import rank_counts
from eventlab.streaming.live import live_windows
from eventlab.streaming.sinks import overwrite_batch, to_batches
from eventlab.times import Windows


def live_top_n(
    stream: DataFrame,
    key: str,
    ts: str,
    windows: Windows,
    delay: timedelta,
    folder: str,
    checkpoint: str,
    k: int = 10,
    min_groups: int = 12,
) -> DataStreamWriter:
    """Write the ``k`` largest keys of each window to ``folder`` when the window closes.

    Append mode emits all counts of a window in the batch that closes it, so each batch
    can be ranked as a table; nothing keeps the list of a window's keys.
    """
    counts = live_windows(stream, ts, windows, delay, [F.count(F.lit(1)).alias("n")], [key])

    def rank(closed: DataFrame, batch_id: int) -> None:
        closed = closed.persist()  # read twice, but the state is to be updated once
        overwrite_batch(rank_counts(closed, key, k, min_groups), folder, batch_id)
        closed.unpersist()

    return to_batches(counts, rank, checkpoint)


# Parts of a window's keys, each of which is reduced to its largest by itself.
PARTS = 16


class Largest(StatefulProcessor):
    """The ``k`` rows of a group with the largest count, and how many keys there were.

    All rows of a closed window come in one micro-batch, so nothing stays in state, and only
    ``k`` rows are held while the others pass.
    """

    def __init__(self, k: int, min_groups: int = 0):
        self.k, self.min_groups = k, min_groups

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.keys = 0

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best: list[tuple] = []
        keys = 0
        for row in rows:
            keys += row["keys"] or 0
            if row["n"] is not None:
                best.append((-row["n"], row["name"] is not None, row["name"] or "", row))
                if len(best) > 4 * self.k:
                    best = heapq.nsmallest(self.k, best, key=lambda x: x[:3])
        if keys < self.min_groups:
            return
        for rank, (_, _, _, row) in enumerate(heapq.nsmallest(self.k, best, key=lambda x: x[:3])):
            yield Row(name=row["name"], window_start=row["window_start"], window_end=row["window_end"], n=row["n"], keys=keys if rank == 0 else 0, rank=rank + 1)

    def close(self) -> None:
        pass


def live_top_n_chained(
    stream: DataFrame, key: str, ts: str, windows: Windows, delay: timedelta, k: int = 10, min_groups: int = 12, parts: int = PARTS
) -> DataFrame:
    """The ``k`` largest keys of each window, ranked, in append mode as windows close.

    One query of three stateful steps: counts per window and key; the ``k`` largest of each
    part of a window's keys; the ``k`` largest of the parts.  However many keys a window has,
    its last step sees ``k`` rows per part.
    """
    counts = live_windows(stream, ts, windows, delay, [F.count(F.lit(1)).alias("n")], [key])
    rows = counts.select(F.col(key).cast("string").alias("name"), "window_start", "window_end", "n", F.lit(1).cast("bigint").alias("keys"),
                         F.pmod(F.xxhash64(key), F.lit(parts)).alias("part"))
    schema = "name string, window_start timestamp, window_end timestamp, n bigint, keys bigint, rank bigint"
    some = rows.groupBy("window_start", "part").transformWithState(Largest(k), schema, "Append", "None")
    out = some.groupBy("window_start").transformWithState(Largest(k, min_groups), schema, "Append", "None")
    return out.select(F.col("name").alias(key), "window_start", "window_end", "n", "rank")
