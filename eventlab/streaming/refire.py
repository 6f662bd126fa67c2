"""Live windows that fire at their end and again for every late row they still accept.

Two steps.  The first finds, per micro-batch and with SQL alone, the watermark that each row
meets, to the row, going on from the newest time so far.  Rows that their window has not
fired for are counted per window and user; a row that comes after its window's end is kept by
itself; and the row that takes the watermark over a window's end leaves a mark for it.  The
second step keeps each window in the state store: its page views, its users in a map, and
whether it has fired.  A mark fires it, a late row fires it again, and a timer at the end of
the allowed lateness drops it.

The result is that of :func:`eventlab.operators.late.firings`, but for windows which the
input ends before: those have not fired yet.  ``seq`` numbers the rows in arrival order, rises
from batch to batch, and is not negative.  Rows without a time are in no window.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventlab.operators.eventtime import watermark_trace
from eventlab.operators.late import LatePolicy
from eventlab.sources.readers import stream_parquet
from eventlab.streaming.counters import schema_of
from eventlab.streaming.keyed import Members, named
from eventlab.streaming.live import watermarked
from eventlab.streaming.sinks import to_batches
from eventlab.streaming.tables import OutputTable, StateTable
from eventlab.times import MILLISECOND, micros

CELLS = "window_at bigint, kind int, at_seq bigint, user string, n bigint, mark timestamp"
FIRINGS = "window_at bigint, at_seq bigint, refired boolean, pv bigint, uv bigint"
IN_TIME, MARK, LATE = 0, 1, 2  # in this order within a batch


class Firing(StatefulProcessor):
    """One window: counts until its mark comes, then one firing, then one for each late row."""

    def __init__(self, close_ms: int, step_ms: int, offset_ms: int):
        self.close_ms, self.step_ms, self.offset_ms = close_ms, step_ms, offset_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "pv bigint, uv bigint")
        self.users = Members(handle, "users")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pv, uv = self.sums.get() if self.sums.exists() else (0, 0)
        before = pv
        self.users.open()
        for row in sorted(rows, key=lambda r: (r["kind"], r["at_seq"] or 0)):
            if row["kind"] != MARK:
                pv += row["n"]
                uv += self.users.add(row["user"])
            if row["kind"] == LATE or row["kind"] == MARK and pv:
                yield Row(window_at=key[0], at_seq=row["at_seq"], refired=row["kind"] == LATE, pv=pv, uv=uv)
        if pv != before:
            self.users.keep()
            self.sums.update((pv, uv))
            self.handle.registerTimer(key[0] * self.step_ms + self.offset_ms + self.close_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.sums.clear()
        self.users.clear()
        return iter(())

    def close(self) -> None:
        pass


class LiveRefire:
    """Both steps; ``policy`` says which windows, how much disorder and how much lateness."""

    def __init__(self, stream: DataFrame, ts: str, seq: str, user: str, policy: LatePolicy, folder: str):
        self.stream, self.ts, self.seq, self.user, self.policy = stream, ts, seq, user, policy
        self.newest = StateTable(f"{folder}/newest", schema_of(stream, ts))  # one row
        self.cells = OutputTable(f"{folder}/cells", CELLS)

    def writer(self, checkpoint: str) -> DataStreamWriter:
        """The first step."""
        return to_batches(self.stream, self._cells, checkpoint)

    def _cells(self, batch: DataFrame, batch_id: int) -> None:
        grid, policy = self.policy.windows, self.policy
        batch = batch.select(F.col(self.seq).cast("bigint").alias("at_seq"), named(self.user).alias("user"), F.col(self.ts).alias("ts")).persist()
        earlier = self.newest.before(batch.sparkSession, batch_id).select(F.lit(-1).cast("bigint").alias("at_seq"), F.col(self.ts).alias("ts"))
        both = batch.unionByName(earlier, allowMissingColumns=True)
        rows = watermark_trace(both, "ts", "at_seq", policy.delay).filter("at_seq >= 0").persist()

        last = F.col("window_end") - F.lit(MILLISECOND)
        met = F.col("watermark")
        placed = grid.assign(rows, "ts").withColumn("window_at", grid.index(F.col("window_start")))
        late = F.coalesce(last <= met, F.lit(False))
        open_ = ~F.coalesce(last + F.lit(policy.lateness) <= met, F.lit(False))
        taken = placed.filter(open_).withColumns({"kind": F.when(late, LATE).otherwise(IN_TIME), "at_seq": F.when(late, F.col("at_seq"))})
        taken = taken.groupBy("window_at", "kind", "at_seq", "user").agg(F.count(F.lit(1)).alias("n"), F.max("watermark").alias("mark"))
        # The windows whose last millisecond lies between the watermarks before and after a row.
        after = F.col("ts") - F.lit(policy.delay + MILLISECOND)
        low, high = (grid.index(c, grid.size - MILLISECOND) for c in (met, after))
        marks = rows.filter(after > met).select("at_seq", after.alias("mark"), F.when(high > low, F.sequence(low + 1, high)).alias("ends"))
        marks = marks.select(F.explode("ends").alias("window_at"), F.lit(MARK).alias("kind"), "at_seq", F.lit(None).cast("string").alias("user"), F.lit(0).cast("bigint").alias("n"), "mark")
        # All rows of a window lie in one file, so the next step meets them together.
        self.cells.write(taken.select(marks.columns).unionByName(marks).repartition("window_at"), batch_id)
        self.newest.write(both.agg(F.max("ts").alias(self.ts)), batch_id)
        rows.unpersist()
        batch.unpersist()

    def visits(self, spark: SparkSession) -> DataFrame:
        """Page views and unique visitors per window over all batches so far, from what the first step has written."""
        grid = self.policy.windows
        counts = self.cells.all(spark).filter(F.col("kind") != MARK).groupBy("window_at").agg(F.sum("n").alias("pv"), F.count_distinct(F.nullif("user", F.lit(""))).alias("uv"))
        start = grid.start(F.col("window_at"))
        return counts.select(start.alias("window_start"), (start + F.lit(grid.size)).alias("window_end"), "pv", "uv")

    def firings(self, spark: SparkSession, files_per_batch: int | None = None) -> DataFrame:
        """The second step, over what the first has written: ``window_start, window_end, at_seq, refired, pv, uv``."""
        grid, policy = self.policy.windows, self.policy
        cells = stream_parquet(spark, f"{self.cells.folder}/*", CELLS, files_per_batch)
        # Marks only rise; one that equals the newest is not late.  Where there is none yet, the first moment stands in.
        moment = F.greatest(F.coalesce("mark", F.lit(0).cast("timestamp")), F.timestamp_millis(F.lit(1)))
        cells = watermarked(cells.withColumn("_at", moment), "_at", MILLISECOND)
        close = grid.size - MILLISECOND + policy.lateness + MILLISECOND
        out = cells.groupBy("window_at").transformWithState(Firing(*(micros(t) // 1000 for t in (close, grid.step, grid.offset))), FIRINGS, "Append", "EventTime")
        start = grid.start(F.col("window_at"))
        return out.select(start.alias("window_start"), (start + F.lit(grid.size)).alias("window_end"), "at_seq", "refired", "pv", "uv")
