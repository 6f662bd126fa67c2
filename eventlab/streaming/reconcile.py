"""Pairing two live streams by key, with a timeout per waiting event."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventlab.operators.multistream import alone, pairing_steps, settled, status, still_waiting, tagged_union
from eventlab.sources.readers import with_arrival
from eventlab.streaming.counters import schema_of
from eventlab.streaming.sinks import to_batches
from eventlab.streaming.tables import OutputTable, StateTable
from eventlab.times import MILLISECOND, NONE

SIDES = ("left", "right")


class LiveReconcile:
    """Writes pairs and lone events of two streams, batch by batch.

    Waiting events enter the next batch as its first rows, and the rules are those of
    :func:`eventlab.operators.multistream.reconcile_in_order`; nothing depends on how many
    rows one key has.  An event that the watermark finds waiting ``timeout`` after its time
    is written as alone and kept, so that a partner that comes after all is reported as
    matched late, as in the table form; with a ``retention`` it is forgotten when the
    watermark has passed its time by that much.  Without a timeout events wait for ever.

    The watermark of both streams is that of the slower one.  Rows of one batch arrive in
    the order of ``seq``, unique and not negative within the batch; without one, in the
    order of reading.
    """

    def __init__(
        self,
        left: DataFrame,
        right: DataFrame,
        key: str,
        ts: str,
        folder: str,
        timeout: timedelta | None = None,
        delay: timedelta = NONE,
        seq: str | None = None,
        retention: timedelta | None = None,
    ):
        def events(df: DataFrame) -> DataFrame:
            return df.select(F.col(key).alias("key"), F.col(ts).alias("ts"), *([F.col(seq).alias("seq")] if seq else []))

        both = tagged_union(events(left), events(right))
        self.stream, self.numbered = both, seq is not None
        self.timeout, self.delay, self.retention = timeout, delay, retention
        kind = schema_of(self.stream, "key")
        self.waiting = StateTable(f"{folder}/waiting", f"{kind}, side string, ts timestamp, reported boolean")
        self.newest = StateTable(f"{folder}/newest", "left timestamp, right timestamp")
        self.out = OutputTable(f"{folder}/out", f"{kind}, left_ts timestamp, right_ts timestamp, status string")

    def writer(self, checkpoint: str) -> DataStreamWriter:
        return to_batches(self.stream, self._settle, checkpoint)

    def _watermark(self, batch: DataFrame, batch_id: int):
        """The watermark after this batch, null until both sides have delivered."""
        times = batch.select(*[F.when(F.col("side") == s, F.col("ts")).alias(s) for s in SIDES]).unionByName(
            self.newest.before(batch.sparkSession, batch_id))
        self.newest.write(times.agg(*[F.max(s).alias(s) for s in SIDES]), batch_id)
        both = F.when(F.col("left").isNotNull() & F.col("right").isNotNull(), F.least("left", "right"))
        micros = self.newest.before(batch.sparkSession, batch_id + 1).select(F.unix_micros(both)).first()[0]
        return F.timestamp_micros(F.lit(micros).cast("bigint")) - F.lit(self.delay + MILLISECOND)

    def _settle(self, batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        batch = (batch if self.numbered else with_arrival(batch)).persist()
        earlier = self.waiting.before(spark, batch_id).withColumn("seq", F.lit(-1).cast("bigint"))
        events = batch.withColumn("reported", F.lit(False)).unionByName(earlier)
        steps = pairing_steps(events).persist()

        waiting = still_waiting(steps)
        if self.timeout is None:
            expired = F.lit(False)
        else:
            mark = self._watermark(batch, batch_id)
            expired = F.coalesce(F.col("ts") + F.lit(self.timeout) <= mark, F.lit(False))
            if self.retention is not None:
                forgotten = F.col("reported") & F.coalesce(F.col("ts") + F.lit(self.retention) <= mark, F.lit(False))
                waiting = waiting.filter(~forgotten)
        given_up = F.col("prev.reported") & ~F.col("meets")
        out = settled(steps.filter(~F.coalesce(given_up, F.lit(False)))).unionByName(
            alone(waiting.filter(expired & ~F.col("reported"))))
        self.out.write(out.withColumn("status", status(F.col("left_ts"), F.col("right_ts"), self.timeout)), batch_id)
        self.waiting.write(waiting.select("key", "side", "ts", (F.col("reported") | expired).alias("reported")), batch_id)
        steps.unpersist()
        batch.unpersist()
