"""Windows under disorder: first firing, allowed lateness, re-firing and late rows, exactly.

Rows arrive in the order of ``seq`` and each moves the watermark (largest time so far,
less ``delay``, less 1 ms).  A window fires when the watermark reaches its last
millisecond, fires again for every row accepted after that, and turns rows away once the
watermark is ``lateness`` past its end.  A row turned away by all its windows is late.

No row needs to know the watermark.  The watermark reaches a point in time when the first
row at or past that point (plus the delay) arrives, so each *window* has two arrival
numbers, found by one partial aggregation over the rows:

``fire_seq``    the first row that makes the window fire,
``close_seq``   the last row the window could still accept; null while it is open.

Everything else compares a row's ``seq`` with the numbers of its window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlab.operators.aggregates import visits
from eventlab.operators.running import BUCKET, running
from eventlab.operators.windows import window_counts
from eventlab.session import written
from eventlab.times import NONE, Windows

# A window table up to this many rows (24 bytes each) is sent to every executor.
BROADCAST_WINDOWS = 1_000_000
# Beyond it, the rows of one window are spread over this many tasks for the join.
SALTS = 64
# Stands for "at the end of the input" where an arrival number is needed.
END = (1 << 63) - 1


@dataclass(frozen=True)
class LatePolicy:
    """Which windows, how much disorder is expected, how long windows stay open."""

    windows: Windows
    delay: timedelta = NONE
    lateness: timedelta = NONE


def limit_points(df: DataFrame, ts: str, seq: str, policy: LatePolicy) -> DataFrame:
    """``(window_at, fire, close, held)``: which windows the rows fall in, fire and close.

    ``window_at`` is a window's number on the grid.  ``fire`` and ``close`` are the first
    rows for which this is the newest window that fires or closes; every older window then
    has, too.  Two such tables merge by the same aggregates.
    """
    grid, at = policy.windows, F.col(ts)
    due = policy.delay + grid.size
    # Rows of one cell touch the same windows; there are a few cells per window, so only
    # their first rows are spread over the windows.
    cells = df.groupBy(
        (grid.index(at, grid.size) + 1).alias("oldest"), grid.index(at).alias("newest"),
        grid.index(at, due).alias("fires"), grid.index(at, due + policy.lateness).alias("closes"),
    ).agg(F.min(F.col(seq).cast("bigint")).alias("first"))
    none = F.lit(None).cast("bigint")

    def point(window_at, fire, close, held):
        return F.struct(window_at.alias("window_at"), fire.alias("fire"), close.alias("close"),
                        F.lit(held).alias("held"))

    held = F.transform(F.sequence("oldest", "newest"), lambda w: point(w, none, none, True))
    points = F.concat(held, F.array(point(F.col("fires"), F.col("first"), none, False),
                                    point(F.col("closes"), none, F.col("first"), False)))
    return merge_points(cells.select(F.explode(points).alias("p")).select("p.*"))


def merge_points(points: DataFrame) -> DataFrame:
    return points.groupBy("window_at").agg(
        F.min("fire").alias("fire"), F.min("close").alias("close"), F.max("held").alias("held"))


def settle(points: DataFrame, *, bucket: int = BUCKET) -> DataFrame:
    """Points with ``fire_seq`` and ``close_seq``, and ``closed_at``, the newest closed window.

    A window fires and closes with the earliest row that makes it or a newer one do so.
    ``closed_at`` is null in the windows newer than it, which are still open.
    """
    newest_first = points.withColumn("_back", -F.col("window_at"))
    closes = F.when(F.col("close").isNotNull(), F.col("window_at"))
    return running(newest_first, [], "_back", {
        "fire_seq": ("min", F.col("fire")), "close_seq": ("min", F.col("close")), "closed_at": ("max", closes),
    }, bucket=bucket).drop("_back")


def limits_of(settled: DataFrame) -> DataFrame:
    """``(window_at, fire_seq, close_seq)`` of each window that holds a row."""
    return settled.filter("held").select("window_at", "fire_seq", "close_seq")


def window_limits(df: DataFrame, ts: str, seq: str, policy: LatePolicy, *, bucket: int = BUCKET) -> DataFrame:
    """``(window_at, fire_seq, close_seq)`` of each window of a whole table."""
    return limits_of(settle(limit_points(df, ts, seq, policy), bucket=bucket))


def with_limits(
    rows: DataFrame, limits: DataFrame, seq: str, broadcast_windows: int, salts: int
) -> DataFrame:
    """Join rows to their window's limits on ``window_at``; the limits are a written table.

    They are counted.  A small table goes to every executor and the rows stay where they
    are; a larger one is joined by shuffle, with the rows of each window spread over
    ``salts`` tasks.
    """
    if limits.count() <= broadcast_windows:
        return rows.join(F.broadcast(limits), "window_at")
    copies = limits.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(seq), F.lit(salts)))
    return salted.join(copies, ["window_at", "_salt"]).drop("_salt")


def late_rows(
    df: DataFrame,
    ts: str,
    seq: str,
    policy: LatePolicy,
    *,
    broadcast_windows: int = BROADCAST_WINDOWS,
    salts: int = SALTS,
) -> DataFrame:
    """The rows that come too late for all of their windows.

    Windows close in the order of their ends, so the row's newest window decides.
    """
    rows = df.withColumn("window_at", policy.windows.index(F.col(ts)))
    joined = with_limits(rows, written(window_limits(df, ts, seq, policy)), seq, broadcast_windows, salts)
    return joined.filter(F.col(seq) > F.col("close_seq")).select(*df.columns)


def undated_rows(df: DataFrame, ts: str) -> DataFrame:
    """The rows without a time: no window can take them and they are not late.

    Late, accepted and undated rows together are the input.
    """
    return df.filter(F.col(ts).isNull())


def accepted_rows(
    df: DataFrame,
    ts: str,
    seq: str,
    policy: LatePolicy,
    *,
    broadcast_windows: int = BROADCAST_WINDOWS,
    salts: int = SALTS,
) -> DataFrame:
    """Each row once per window that takes it (see :func:`undated_rows` for the others), with ``window_start``, ``window_end`` and ``fire_seq``."""
    rows = policy.windows.assign(df, ts).withColumn("window_at", policy.windows.index(F.col("window_start")))
    joined = with_limits(rows, written(window_limits(df, ts, seq, policy)), seq, broadcast_windows, salts)
    taken = joined.filter(F.col("close_seq").isNull() | (F.col(seq) <= F.col("close_seq")))
    return taken.select(*df.columns, "window_start", "window_end", "fire_seq")


def firings(
    df: DataFrame,
    ts: str,
    seq: str,
    user: str,
    policy: LatePolicy,
    *,
    bucket: int = BUCKET,
    broadcast_windows: int = BROADCAST_WINDOWS,
    salts: int = SALTS,
) -> DataFrame:
    """Every firing of every window with the page views and unique visitors it reports.

    ``at_seq`` is the arrival that caused the firing, null for the end of the input.
    Rows in time only enter as one number per window and user; just the rows after the
    first firing are numbered one by one.
    """
    rows = accepted_rows(df, ts, seq, policy, broadcast_windows=broadcast_windows, salts=salts)
    rows = written(rows.select(seq, user, "window_start", "window_end", F.coalesce("fire_seq", F.lit(END)).alias("_fire")))
    window = ["window_start", "window_end", "_fire"]
    # A user counts from the first firing, or from the first row after it.
    users = (rows.groupBy(*window, user)
             .agg(F.count_if(F.col(seq) <= F.col("_fire")).alias("pv"), F.min(seq).alias("_seen"))
             .select(*window, F.greatest("_seen", "_fire").alias("at_seq"), "pv", F.lit(1).alias("uv")))
    after = rows.filter(F.col(seq) > F.col("_fire")).select(
        *window, F.col(seq).alias("at_seq"), F.lit(1).alias("pv"), F.lit(0).alias("uv"))
    changes = written(users.unionByName(after).groupBy(*window, "at_seq")
                      .agg(F.sum("pv").alias("more_pv"), F.sum("uv").alias("more_uv")))
    totals = running(changes, window, "at_seq", {"pv": ("sum", F.col("more_pv")), "uv": ("sum", F.col("more_uv"))},
                     bucket=bucket)
    return totals.select(
        "window_start", "window_end", F.when(F.col("at_seq") < END, F.col("at_seq")).alias("at_seq"),
        (F.col("at_seq") > F.col("_fire")).alias("refired"), "pv", "uv")


def final_visits(
    df: DataFrame,
    ts: str,
    seq: str,
    user: str,
    policy: LatePolicy,
    keys: Sequence[str] = (),
    *,
    broadcast_windows: int = BROADCAST_WINDOWS,
    salts: int = SALTS,
) -> DataFrame:
    """Page views and unique visitors of each window once it has closed for good."""
    rows = accepted_rows(df, ts, seq, policy, broadcast_windows=broadcast_windows, salts=salts)
    return rows.groupBy(*keys, "window_start", "window_end").agg(*visits(user))


def late_counts(
    df: DataFrame, ts: str, seq: str, policy: LatePolicy, counted_over: Windows
) -> DataFrame:
    """How many rows were late, per (long) window of event time."""
    return window_counts(late_rows(df, ts, seq, policy), ts, counted_over)
