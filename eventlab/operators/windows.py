"""Event-time windows over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlab.operators.aggregates import visits
from eventlab.operators.running import BUCKET, chunked, numbered
from eventlab.times import Windows, flatten, floor_div

# Registers of a visitor sketch, as a power of two: a standard error of 1.04 / 64, or 1.6 %.
SKETCH = 12


def window_aggregate(
    df: DataFrame, ts: str, windows: Windows, measures: Sequence[Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Aggregate per key and window, with the window's bounds next to the result.

    Without keys the window still runs on all tasks: rows are aggregated before they move.
    """
    return flatten(df.groupBy(*keys, windows.of(ts)).agg(*measures))


def window_counts(df: DataFrame, ts: str, windows: Windows, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per key and window.

    Overlapping windows add up the counts of their panes, so a row is counted once however
    many windows it belongs to.
    """
    counted = [F.count(F.lit(1)).alias("n")]
    if windows.step >= windows.size:
        return window_aggregate(df, ts, windows, counted, keys)
    panes = window_aggregate(df, ts, windows.panes, counted, keys).select(*keys, F.col("window_start").alias("_pane"), "n")
    return window_aggregate(panes, "_pane", windows, [F.sum("n").alias("n")], keys)


def window_visits(
    df: DataFrame, ts: str, user: str, windows: Windows, keys: Sequence[str] = (), approx: bool = False
) -> DataFrame:
    """Page views and unique visitors per key and window.

    The exact form shuffles by (window, user) first, so one window may hold most rows, and
    overlapping windows take one row per pane and user; ``approx`` needs one shuffle of sketches.
    """
    if approx and windows.step < windows.size:
        return window_sketches(df, ts, user, windows, keys).drop("sketch")
    if approx or windows.step >= windows.size:
        return window_aggregate(df, ts, windows, visits(user, approx), keys)
    panes = window_aggregate(df, ts, windows.panes, [F.count(F.lit(1)).alias("_n")], [*dict.fromkeys([*keys, user])])
    panes = panes.select(*dict.fromkeys([*keys, user]), F.col("window_start").alias("_pane"), "_n")
    return window_aggregate(panes, "_pane", windows, [F.sum("_n").alias("pv"), F.count_distinct(user).alias("uv")], keys)


def window_sketches(
    df: DataFrame, ts: str, user: str, windows: Windows, keys: Sequence[str] = (), *, lg_k: int = SKETCH
) -> DataFrame:
    """Page views and estimated unique visitors per key and window, with the ``sketch`` of the visitors.

    Each pane keeps one sketch of at most 2^``lg_k`` registers, filled before the shuffle, and
    a window merges those of its panes: what moves is a sketch per pane and task, however many
    rows or visitors there are, and no row is copied for a second window.  The sketches of
    windows can be merged further (``hll_union_agg``).  Null visitors are not counted.
    """
    counted = [F.count(F.lit(1)).alias("pv"), F.hll_sketch_agg(F.col(user).cast("string"), lg_k).alias("sketch")]
    panes = window_aggregate(df, ts, windows.panes, counted, keys).select(*keys, F.col("window_start").alias("_pane"), "pv", "sketch")
    merged = [F.sum("pv").alias("pv"), F.hll_union_agg("sketch").alias("sketch")]
    return window_aggregate(panes, "_pane", windows, merged, keys).withColumn("uv", F.hll_sketch_estimate("sketch"))


def window_contents(
    df: DataFrame,
    ts: str,
    seq: str,
    windows: Windows,
    keys: Sequence[str] = (),
    *,
    bucket: int = BUCKET,
) -> DataFrame:
    """All rows of each window in arrival order, as rows numbered by ``position``."""
    return numbered(windows.assign(df, ts), [*keys, "window_start", "window_end"], seq,
                    bucket=bucket)


def window_concat(
    df: DataFrame,
    ts: str,
    seq: str,
    column: str,
    windows: Windows,
    keys: Sequence[str] = (),
    *,
    rows_per_part: int,
    separator: str = " ",
    bucket: int = BUCKET,
) -> DataFrame:
    """Join ``column`` in arrival order per key and window; ``ts`` is the first row's.

    A text comes in parts of ``rows_per_part`` rows each, counted from the window's first
    row, so no task gathers an unbounded window; parts joined in order are the whole text.
    """
    group = [*keys, "window_start", "window_end"]
    rows = windows.assign(df.select(*dict.fromkeys([*keys, ts, seq, column])), ts)
    placed = numbered(rows, group, seq, "_position", bucket=bucket)
    items = F.array_compact(F.sort_array(F.collect_list(F.struct(seq, column)))[column])
    return (placed.groupBy(*group, floor_div(F.col("_position") - 1, rows_per_part).alias("part"))
            .agg(F.min_by(ts, seq).alias(ts), F.count(F.lit(1)).alias("n"), F.array_join(items, separator).alias(column)))


def chunk_summary(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    size: int,
    *,
    complete_only: bool = False,
    bucket: int = BUCKET,
) -> DataFrame:
    """Batches of ``size`` rows per key in arrival order: their number, rows and ends.

    ``complete_only`` gives count windows, where an unfinished group is never emitted.
    """
    out = (chunked(df.select(*keys, seq), keys, seq, size, bucket=bucket)
           .groupBy(*keys, "chunk")
           .agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq")))
    return out.filter(F.col("n") == size) if complete_only else out


def count_windows(
    df: DataFrame, keys: Sequence[str], seq: str, size: int, *, bucket: int = BUCKET
) -> DataFrame:
    """Windows of exactly ``size`` rows per key."""
    return chunk_summary(df, keys, seq, size, complete_only=True, bucket=bucket)
