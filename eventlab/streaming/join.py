"""Joining two live streams per key and window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame

from eventlab.streaming.live import watermarked
from eventlab.times import NONE, Windows, flatten


def live_window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    windows: Windows,
    left_measures: Sequence[Column],
    right_measures: Sequence[Column],
    delay: timedelta = NONE,
) -> DataFrame:
    """The two sides' aggregates for each key and window that both have, when the window closes.

    Each side is aggregated first, so that the join holds one row per key and window however
    many rows met there.  The watermark is that of the slower side.  Both aggregations drop a
    window when it passes the end, and so does the join, whose key is the window itself: what
    is in state are the open windows.
    """
    left, right = (watermarked(df, ts, delay).groupBy(*keys, windows.of(ts)).agg(*measures)
                   for df, measures in ((left, left_measures), (right, right_measures)))
    return flatten(left.join(right, [*keys, "window"]))
