"""Watermarks over a table with an arrival order.

The watermark is the largest event time seen so far, less the allowed disorder, less one
millisecond: rows up to it are complete.  It is unknown (null) before the first row.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlab.operators.running import BUCKET, running
from eventlab.times import MILLISECOND, NONE


def watermark_trace(
    df: DataFrame, ts: str, seq: str, delay: timedelta = NONE, *, bucket: int = BUCKET
) -> DataFrame:
    """Add ``watermark``: the one in force when the row arrives.  No delay means ascending times."""
    out = running(df, [], seq, {"_newest": ("max", F.col(ts))}, inclusive=False, bucket=bucket)
    return out.withColumn("watermark", F.col("_newest") - F.lit(delay + MILLISECOND)).drop("_newest")


def union_watermark(
    df: DataFrame,
    ts: str,
    seq: str,
    source: str,
    delays: Mapping[str, timedelta],
    *,
    bucket: int = BUCKET,
) -> DataFrame:
    """Add ``watermark`` for a union of sources: that of the slowest one.

    ``delays`` names every source and its allowed disorder; until each of them has
    delivered a row the watermark is unknown.
    """
    names = {s: f"_newest_{i}" for i, s in enumerate(delays)}
    out = running(df, [], seq, {name: ("max", F.when(F.col(source) == s, F.col(ts))) for s, name in names.items()},
                  inclusive=False, bucket=bucket)
    each = [F.col(names[s]) - F.lit(delay + MILLISECOND) for s, delay in delays.items()]
    known = F.lit(True)
    for mark in each:
        known = known & mark.isNotNull()
    slowest = F.least(*each) if len(each) > 1 else each[0]
    return out.withColumn("watermark", F.when(known, slowest)).drop(*names.values())
