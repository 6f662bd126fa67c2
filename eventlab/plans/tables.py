"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlab.functions import parse
from eventlab.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def naive(df: DataFrame) -> DataFrame:
    """Times without a zone, as in the given tables; all of them are UTC."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click-stream events in arrival order."""
    return as_events(table(spark, sf_dir, "events"))


def as_events(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("action"),
        F.col("ts").cast("timestamp").alias("ts"))


def disordered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events arriving up to 49 places late.

    A row is held back by ``event_id * 37 % 50`` places; rows that then share a place
    arrive by ``event_id``, which is by falling hold.
    """
    return disordered(events(spark, sf_dir))


def disordered(events: DataFrame) -> DataFrame:
    hold = (F.col("seq") * 37) % 50
    return events.withColumn("seq", (F.col("seq") + hold) * 50 + 49 - hold)


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ``user,action,time`` lines, next to their arrival number."""
    return events(spark, sf_dir).select("seq", parse.format_event().alias("value"))


def wide_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines of 21 fields: user, time and action are the 4th, 6th and 21st."""
    fields = [F.lit("x")] * 3 + [F.col("user_id"), F.lit("x"), parse.time_text(F.col("ts"))] + [F.lit("x")] * 14 + [F.col("action")]
    return events(spark, sf_dir).select("seq", F.concat_ws(",", *fields).alias("value"))


def book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows as lines, next to their arrival number."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("seq"),
        F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name", "p_brand", "p_type", "p_type").alias("value"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events of the shop."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("ts"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the other party: every line item of an order."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").cast("timestamp").alias("ts"))
