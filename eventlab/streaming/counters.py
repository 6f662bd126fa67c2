"""The watermark of a stream, row by row."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventlab.operators.eventtime import watermark_trace
from eventlab.streaming.sinks import to_batches
from eventlab.streaming.tables import OutputTable, StateTable
from eventlab.times import NONE


def schema_of(df: DataFrame, *names: str) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def live_watermark_trace(
    stream: DataFrame, ts: str, seq: str, folder: str, checkpoint: str, delay: timedelta = NONE
) -> tuple[DataStreamWriter, OutputTable]:
    """Write each row with the watermark in force when it arrives; also return the table written.

    ``seq`` is the arrival number, unique and not negative within a batch.
    """
    rows = OutputTable(f"{folder}/rows", f"{schema_of(stream, *stream.columns)}, watermark timestamp")
    newest = StateTable(f"{folder}/newest", schema_of(stream, ts))

    def trace(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        earlier = newest.before(batch.sparkSession, batch_id).withColumn(seq, F.lit(-1).cast("bigint"))
        both = batch.unionByName(earlier, allowMissingColumns=True)
        rows.write(watermark_trace(both, ts, seq, delay).filter(F.col(seq) >= 0), batch_id)
        newest.write(both.agg(F.max(ts).alias(ts)), batch_id)
        batch.unpersist()

    return to_batches(stream, trace, checkpoint), rows
