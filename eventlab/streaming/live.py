"""Windowed results over live streams.

Spark moves the watermark between micro-batches, so a live window closes once the
watermark of an earlier batch has passed its end; rows later than that are dropped.  Row
by row late handling is in :mod:`eventlab.streaming.late`.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlab.times import NONE, Windows, flatten, text


def watermarked(stream: DataFrame, ts: str, delay: timedelta = NONE) -> DataFrame:
    """Declare event time and how far rows may be out of order."""
    return stream.withWatermark(ts, text(delay))


def live_windows(
    stream: DataFrame, ts: str, windows: Windows, delay: timedelta, measures: Sequence[Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Aggregates per key and window; in append mode each window appears once, when it closes."""
    return flatten(watermarked(stream, ts, delay).groupBy(*keys, windows.of(ts)).agg(*measures))


def live_visits(
    stream: DataFrame, ts: str, user: str, windows: Windows, delay: timedelta, keys: Sequence[str] = ()
) -> DataFrame:
    """Page views and exact unique visitors per key and window, in append mode.

    Two aggregations in a row: the first keeps one number per (window, user), spread over
    all tasks; the second counts those of each window, so no state row grows with a window.
    """
    users = (watermarked(stream, ts, delay).groupBy(*dict.fromkeys([*keys, user]), windows.of(ts))
             .agg(F.count(F.lit(1)).alias("_n")))
    return flatten(users.groupBy(*keys, "window").agg(F.sum("_n").alias("pv"), F.count(F.lit(1)).alias("uv")))


def live_totals(stream: DataFrame, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Totals per key since the start; in update mode each batch emits the keys it changed."""
    return stream.groupBy(*keys).agg(*measures)
