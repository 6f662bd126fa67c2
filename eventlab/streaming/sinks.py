"""Where streams end: the console, rolling text files, and per-batch tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Fixed value: how the folder of an hour is named.
HOUR_FOLDER = "yyyy-MM-dd--HH"


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows with a first column that names their branch."""
    return df.select(F.lit(label).alias("label"), "*")


def to_console(stream: DataFrame, label: str | None = None, mode: str = "append") -> DataStreamWriter:
    """Print rows, each with a label when one is given."""
    if label is not None:
        stream = labelled(stream, label)
    return stream.writeStream.format("console").option("truncate", "false").outputMode(mode)


def to_text_files(
    stream: DataFrame,
    line: Column,
    path: str,
    checkpoint: str,
    *,
    hour_of: Column | None = None,
    roll_every: timedelta = timedelta(minutes=1),
    rows_per_file: int | None = None,
) -> DataStreamWriter:
    """Write one line per row into files that are final when they appear.

    Every trigger starts new files, so ``roll_every`` is their age; ``rows_per_file``
    bounds their size; ``hour_of`` names a time whose hour becomes the folder.
    """
    lines = stream.select(line.cast("string").alias("value"),
                          *([F.date_format(hour_of, HOUR_FOLDER).alias("bucket")] if hour_of is not None else []))
    writer = (lines.writeStream.format("text").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint)
              .trigger(processingTime=f"{int(roll_every.total_seconds())} seconds"))
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    return writer.partitionBy("bucket") if hour_of is not None else writer


def to_batches(
    stream: DataFrame, flush: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    """Hand each micro-batch to ``flush(rows, batch_id)``.

    How many rows make a batch is set at the source (files or offsets per trigger).  After
    a restart an unfinished batch comes again with the same number, and no row is lost.
    """
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(flush)


def overwrite_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Write the rows of one batch; a repeated batch replaces its own earlier output."""
    rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def run_available(writer: DataStreamWriter, timeout: float | None = None) -> StreamingQuery:
    """Run a stream over all data that is there now, then stop; with a ``timeout``, at most so many seconds."""
    running = writer.trigger(availableNow=True).start()
    try:
        if timeout is None:
            running.awaitTermination()
        elif not running.awaitTermination(timeout):
            raise TimeoutError("the stream did not finish in time")
    finally:
        running.stop()
    return running
