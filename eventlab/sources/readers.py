"""Where rows come from: text files, in-program rows, Kafka topics, sockets."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def text_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line, as ``value``."""
    return spark.read.text(path if isinstance(path, str) else list(path))


def replayed_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The lines of each file up to its first empty one, as ``value``, which ends that file's replay.

    A file's lines have a place: the split they are in and, inside it, their turn.  The place
    of the first empty line is a minimum per file, found before anything moves, and both
    passes read the same splits; no file is read by one task alone.  A file without an empty
    line is replayed whole.
    """
    lines = text_lines(spark, path).select(
        "*", F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("turn")).alias("_at"))
    ends = lines.filter(F.length("value") == 0).groupBy("_file").agg(F.min("_at").alias("_end"))
    return lines.join(ends, "_file", "left").filter(F.col("_end").isNull() | (F.col("_at") < F.col("_end"))).drop("_file", "_at", "_end")


def stream_text_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the files that appear in a folder, blank ones left out."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).filter(F.length("value") > 0)


def stream_parquet(spark: SparkSession, path: str, schema: str | StructType, files_per_batch: int | None = None) -> DataFrame:
    """Rows of the Parquet files that appear under a path."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def rows(spark: SparkSession, data: Iterable[Sequence], schema: str) -> DataFrame:
    """Rows written down in a program."""
    return spark.createDataFrame([tuple(r) for r in data], schema)


def with_arrival(df: DataFrame, name: str = "seq") -> DataFrame:
    """Add an arrival number: rising within each input partition, unique over all of them."""
    return df.withColumn(name, F.monotonically_increasing_id())


def kafka_options(brokers: str, topic: str, group: str | None = None, starting: str = "earliest") -> dict[str, str]:
    """Options of the Kafka source for one topic."""
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": starting}
    if group:
        options["kafka.group.id"] = group
    return options


def stream_kafka(spark: SparkSession, brokers: str, topic: str, group: str | None = None) -> DataFrame:
    """Values of a topic from its first offset, as text lines.  Needs the Kafka connector on the class path."""
    return decode_kafka(spark.readStream.format("kafka").options(**kafka_options(brokers, topic, group)).load())


def decode_kafka(records: DataFrame) -> DataFrame:
    """The text of Kafka records, as ``value``; other columns are kept."""
    return records.withColumn("value", F.col("value").cast("string"))


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines a socket sends, as ``value``.  Nothing is replayed after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
