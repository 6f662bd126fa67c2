"""Counters that live per key, per window, or per key across windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlab.operators.running import BUCKET, numbered, running
from eventlab.operators.windows import window_counts
from eventlab.times import Windows


def running_count(
    df: DataFrame, keys: Sequence[str], seq: str, *, bucket: int = BUCKET
) -> DataFrame:
    """Each row with the number of rows of its key so far."""
    return numbered(df, keys, seq, "n", bucket=bucket)


def cross_window_count(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, windows: Windows, *, bucket: int = BUCKET
) -> DataFrame:
    """A count per key that goes on from window to window, rows listed as windows close."""
    rows = windows.assign(df, ts).withColumn("_window", windows.index(F.col("window_start")))
    return numbered(rows, keys, seq, "n", lead="_window", bucket=bucket).drop("_window")


def in_window_count(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, windows: Windows, *, bucket: int = BUCKET
) -> DataFrame:
    """A count per key that starts again in every window."""
    return numbered(windows.assign(df, ts), [*keys, "window_start", "window_end"], seq, "n",
                    bucket=bucket)


def window_and_cumulative(
    df: DataFrame, keys: Sequence[str], ts: str, windows: Windows, *, bucket: int = BUCKET
) -> DataFrame:
    """Per key and window the rows of the window and of all windows up to it."""
    counts = window_counts(df, ts, windows, keys).withColumn("_at", windows.index(F.col("window_start")))
    return running(counts, keys, "_at", {"cumulative": ("sum", F.col("n"))}, bucket=bucket).drop("_at")


def active_keys(df: DataFrame, key: str, ts: str, windows: Windows) -> DataFrame:
    """How many different keys each window saw."""
    return (window_counts(df, ts, windows, [key])
            .groupBy("window_end").agg(F.count(F.lit(1)).alias("active")))
