"""Allowed lateness and late rows of a stream, exact to the row.

The batch rules hold across micro-batches: which row fires or closes a window is a minimum
over rows, so the points seen so far are kept as a small table and merged with those of
each batch.  Windows closed for good leave that table; what remains is the span the
watermark and the allowed lateness still cover.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventlab.operators.late import (
    BROADCAST_WINDOWS, SALTS, LatePolicy, limit_points, limits_of, merge_points, settle, undated_rows, with_limits,
)
from eventlab.streaming.counters import schema_of
from eventlab.streaming.sinks import to_batches
from eventlab.streaming.tables import OutputTable, StateTable

POINTS = "window_at bigint, fire bigint, close bigint, held boolean"


class LiveLate:
    """Splits a stream into rows its windows accept, late rows, and rows without a time.

    ``seq`` numbers the rows in arrival order and rises from batch to batch.
    """

    def __init__(self, stream: DataFrame, ts: str, seq: str, user: str, policy: LatePolicy, folder: str):
        self.stream, self.ts, self.seq, self.user, self.policy = stream, ts, seq, user, policy
        self.points = StateTable(f"{folder}/points", POINTS)
        self.late = OutputTable(f"{folder}/late", schema_of(stream, *stream.columns))
        self.undated = OutputTable(f"{folder}/undated", schema_of(stream, *stream.columns))
        self.counts = OutputTable(
            f"{folder}/counts",
            f"window_start timestamp, window_end timestamp, {schema_of(stream, user)}, refired boolean, n bigint")

    def writer(self, checkpoint: str) -> DataStreamWriter:
        return to_batches(self.stream, self._split, checkpoint)

    def visits(self, spark: SparkSession) -> DataFrame:
        """Page views and unique visitors per window over all batches so far."""
        return (self.counts.all(spark).groupBy("window_start", "window_end")
                .agg(F.sum("n").alias("pv"), F.count_distinct(self.user).alias("uv")))

    def _split(self, batch: DataFrame, batch_id: int) -> None:
        spark, grid, seq = batch.sparkSession, self.policy.windows, self.seq
        batch = batch.persist()
        self.undated.write(undated_rows(batch, self.ts), batch_id)
        points = limit_points(batch, self.ts, seq, self.policy).unionByName(self.points.before(spark, batch_id))
        settled = settle(merge_points(points)).persist()
        limits = limits_of(settled)

        rows = grid.assign(batch, self.ts).withColumn("window_at", grid.index(F.col("window_start")))
        rows = with_limits(rows, limits, seq, BROADCAST_WINDOWS, SALTS)
        rejected = F.coalesce(F.col(seq) > F.col("close_seq"), F.lit(False))
        newest = F.col("window_at") == grid.index(F.col(self.ts))
        self.late.write(rows.filter(newest & rejected).select(*self.stream.columns), batch_id)
        refired = F.coalesce(F.col(seq) > F.col("fire_seq"), F.lit(False)).alias("refired")
        self.counts.write(rows.filter(~rejected).groupBy("window_start", "window_end", self.user, refired)
                          .agg(F.count(F.lit(1)).alias("n")), batch_id)

        # The newest closed window also closes every older one, so older points can go.
        self.points.write(settled.filter(F.col("closed_at").isNull() | (F.col("window_at") == F.col("closed_at")))
                          .select("window_at", "fire", "close", "held"), batch_id)
        settled.unpersist()
        batch.unpersist()
