"""The streaming forms run over the given tables, cut into several micro-batches, then the table written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlab.plans import tables
from eventlab.session import checkpoint_dir, state_tasks, use_rocksdb, use_utc
from eventlab.sources import readers
from eventlab.streaming import sinks

# Micro-batches of a staged table.
FILES = 8
# Rows of a file of a staged table, about.
ROWS = 1 << 20


def folder(spark: SparkSession) -> str:
    """A new folder next to the checkpoints."""
    use_utc(spark)
    use_rocksdb(spark)
    return f"{checkpoint_dir(spark)}/live-{uuid.uuid4().hex}"


def staged(spark: SparkSession, df: DataFrame, seq: str, home: str, name: str, files: int = FILES, empty: int = 0, rows: int = ROWS) -> DataFrame:
    """A table as a stream of portions, one after another by ``seq`` and one per micro-batch; rows without a ``seq`` come last.

    A portion is as many files as the largest table part needs at about ``rows`` rows a file, so
    all cores read the table, write a portion and read it again.  ``empty`` portions without rows come first.
    """
    low, high, count = df.agg(F.min(seq), F.max(seq), F.count(F.lit(1))).first()
    nth = F.floor((F.col(seq) - F.lit(low)) * F.lit(files) / F.lit((high or 0) - (low or 0) + 1))
    nth = F.coalesce(nth, F.lit(files - 1))
    path, each = f"{home}/{name}", max(1, -(-count // (files * rows)))
    for i in range(-empty, files):  # in order, as the source takes files by their time
        if i >= 0:
            df.filter(nth == i).repartition(each).write.mode("append").parquet(path)
        have = len(spark.read.schema(df.schema).parquet(path).inputFiles()) if i > -empty or not empty else 0
        for _ in range((i + empty + 1) * each - have):  # a task without rows writes no file
            df.limit(0).coalesce(1).write.mode("append").parquet(path)
    return readers.stream_parquet(spark, path, df.schema, each)


def delayed(spark: SparkSession, df: DataFrame, seq: str, home: str, name: str, empty: int) -> DataFrame:
    """As :func:`staged`, but the first micro-batches of the stream are without rows."""
    return staged(spark, df, seq, home, name, empty=empty)


def whole(spark: SparkSession, df: DataFrame, home: str, name: str) -> DataFrame:
    """A table as a stream that delivers it in one micro-batch."""
    df.write.parquet(f"{home}/{name}")
    return readers.stream_parquet(spark, f"{home}/{name}", df.schema)


def events(spark: SparkSession, sf_dir: str, home: str) -> DataFrame:
    return staged(spark, tables.events(spark, sf_dir), "seq", home, "in")


def disordered_events(spark: SparkSession, sf_dir: str, home: str) -> DataFrame:
    return staged(spark, tables.disordered_events(spark, sf_dir), "seq", home, "in")


def event_files(spark: SparkSession, sf_dir: str, home: str) -> str:
    """A folder with the events as text, one file after another."""
    lines = tables.event_lines(spark, sf_dir)
    path = f"{home}/lines"
    lines.repartitionByRange(FILES, "seq").sortWithinPartitions("seq").select("value").write.text(path)
    return path


def written(stream: DataFrame, home: str) -> DataFrame:
    """Run a stream in append mode into a Parquet table and read that."""
    with state_tasks(stream.sparkSession):
        sinks.run_available(stream.writeStream.outputMode("append").format("parquet")
                            .option("path", f"{home}/out").option("checkpointLocation", f"{home}/checkpoint"))
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{home}/out")
