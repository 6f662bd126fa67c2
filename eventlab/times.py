"""Durations and grids of event-time windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NONE = timedelta(0)
MILLISECOND = timedelta(milliseconds=1)


def micros(duration: timedelta) -> int:
    return duration // timedelta(microseconds=1)


def text(duration: timedelta) -> str:
    """The duration in the form ``window`` and ``withWatermark`` take."""
    return f"{micros(duration)} microseconds"


def floor_div(number: Column, by: int) -> Column:
    """Whole-number division that rounds down, also below zero."""
    return F.call_function("div", number - F.pmod(number, F.lit(by)), F.lit(by))


@dataclass(frozen=True)
class Windows:
    """``[start, end)`` windows aligned to the epoch plus ``offset``.

    Without ``slide`` they tumble; a ``slide`` shorter than ``size`` makes them overlap.
    """

    size: timedelta
    slide: timedelta | None = None
    offset: timedelta = NONE

    @property
    def step(self) -> timedelta:
        return self.slide or self.size

    @property
    def panes(self) -> Windows:
        """The tumbling grid of which every window is a whole number of cells."""
        return Windows(timedelta(microseconds=gcd(micros(self.size), micros(self.step))), offset=self.offset)

    def of(self, ts: str) -> Column:
        """The window column to group by; a sliding grid yields one row per window."""
        return F.window(ts, text(self.size), text(self.step), text(self.offset % self.step)).alias("window")

    def assign(self, df: DataFrame, ts: str) -> DataFrame:
        """``df`` with ``window_start`` and ``window_end``, once per window of the row."""
        return flatten(df.withColumn("window", self.of(ts)))

    def index(self, ts: Column, behind: timedelta = NONE) -> Column:
        """Number on the grid of the newest window starting at or before ``ts - behind``."""
        shifted = F.unix_micros(ts) - F.lit(micros(self.offset + behind))
        return floor_div(shifted, micros(self.step))

    def start(self, index: Column) -> Column:
        """Start time of the window with this number."""
        return F.timestamp_micros(index * F.lit(micros(self.step)) + F.lit(micros(self.offset)))


def flatten(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` and ``window_end``."""
    return df.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")
