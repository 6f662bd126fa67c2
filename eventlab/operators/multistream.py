"""Operators on two inputs: union, routing, reconciliation, window join."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlab.operators.running import BUCKET, ranges_needed, running
from eventlab.times import Windows, flatten


def union_all(first: DataFrame, *more: DataFrame) -> DataFrame:
    """All rows of tables of one shape, duplicates kept, columns matched by name."""
    for df in more:
        first = first.unionByName(df)
    return first


def tagged_union(left: DataFrame, right: DataFrame, tag: str = "side") -> DataFrame:
    """Two tables as one, each row tagged ``left`` or ``right``."""
    return left.withColumn(tag, F.lit("left")).unionByName(
        right.withColumn(tag, F.lit("right")), allowMissingColumns=True)


def route(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """``(side, main)``: rows that meet the condition, and all others (also unknown ones)."""
    chosen = F.coalesce(condition, F.lit(False))
    return df.filter(chosen), df.filter(~chosen)


def status(left_ts: Column, right_ts: Column, timeout: timedelta | None) -> Column:
    """How the two sides of a key met."""
    out = F.when(right_ts.isNull(), "left_only").when(left_ts.isNull(), "right_only")
    if timeout is not None:
        out = out.when((left_ts > right_ts + F.lit(timeout)) | (right_ts > left_ts + F.lit(timeout)), "matched_late")
    return out.otherwise("matched")


def newest_per_side(
    left: DataFrame, right: DataFrame, key: str, ts: str, timeout: timedelta | None = None
) -> DataFrame:
    """Pair the newest event of each side per key and say how they met.

    One aggregation over both inputs: each task keeps one time per key and side before
    the single shuffle, so a key repeated without end costs no more than any other.  Older
    events are not listed; :func:`reconcile_in_order` pairs every event.
    """
    both = tagged_union(left.select(key, ts), right.select(key, ts))
    newest = {s: F.max(F.when(F.col("side") == s, F.col(ts))).alias(f"{s}_ts") for s in ("left", "right")}
    return (both.groupBy(key).agg(newest["left"], newest["right"])
            .withColumn("status", status(F.col("left_ts"), F.col("right_ts"), timeout)))


def reconcile_in_order(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    seq: str,
    timeout: timedelta | None = None,
    *,
    bucket: int = BUCKET,
) -> DataFrame:
    """Pair events one by one as they arrive; every event ends up in one pair or alone.

    An arriving event meets the one that waits on the other side, if any, and both are
    done; else it waits, and one already waiting on its own side is given up.  So only
    neighbours can pair, and whether an event is left waiting alternates from the last
    event that followed one of its own side.  ``seq`` numbers both inputs together.
    """
    def event(df: DataFrame) -> DataFrame:
        return df.select(F.col(key).alias("key"), F.col(seq).cast("bigint").alias("seq"), F.col(ts).alias("ts"))

    events = tagged_union(event(left), event(right))
    # A closing row per key, of no side, gives up whatever still waits.
    closing = events.groupBy("key").agg((F.max("seq") + 1).alias("seq"))
    steps = pairing_steps(events.unionByName(closing, allowMissingColumns=True), bucket=bucket)
    return (settled(steps).withColumn("status", status(F.col("left_ts"), F.col("right_ts"), timeout))
            .withColumnRenamed("key", key))


def pairing_steps(events: DataFrame, *, bucket: int = BUCKET) -> DataFrame:
    """Each of the events ``(key, side, seq, ts, ...)`` with the one before it and who waits.

    ``prev`` is the key's previous event, ``prev_waits`` whether that one is waiting when
    this one arrives, ``meets`` whether the two pair up, ``waits`` whether this one waits.
    """
    columns, ranges = events.columns, ranges_needed(events, ["key"], bucket)
    row = F.struct("seq", *[c for c in columns if c not in ("key", "seq")])
    seen = running(events, ["key"], "seq", {"_before": ("sum", F.lit(1).cast("bigint")), "prev": ("max", row)},
                   inclusive=False, ranges=ranges)
    # `_at` is the event's place within its key, `_from` the last place where waiting started over.
    placed = seen.withColumns({
        "_at": F.coalesce("_before", F.lit(0)),
        "_starts": F.col("prev").isNull() | F.col("prev.side").eqNullSafe(F.col("side"))})
    chains = running(placed, ["key"], "seq", {"_from": ("max", F.when(F.col("_starts"), F.col("_at")))},
                     inclusive=False, ranges=ranges)
    prev_waits = F.coalesce(F.pmod(F.col("_at") - 1 - F.col("_from"), F.lit(2)) == 0, F.lit(False))
    return chains.withColumn("prev_waits", prev_waits).select(
        *columns, "prev", "prev_waits", (F.col("prev_waits") & ~F.col("_starts") & F.col("side").isNotNull()).alias("meets"),
        (F.col("_starts") | ~F.col("prev_waits")).alias("waits"))


def settled(steps: DataFrame) -> DataFrame:
    """``(key, left_ts, right_ts)`` of the events that no longer wait: met, or given up."""
    def time_of(name: str) -> Column:
        return F.coalesce(F.when(F.col("prev.side") == name, F.col("prev.ts")),
                          F.when(F.col("meets") & (F.col("side") == name), F.col("ts"))).alias(f"{name}_ts")

    return steps.filter("prev_waits").select("key", time_of("left"), time_of("right"))


def still_waiting(steps: DataFrame) -> DataFrame:
    """The last event of each key, where it waits, in the columns of the events."""
    columns = [c for c in steps.columns if c not in ("prev", "prev_waits", "meets", "waits")]
    last = F.max(F.struct("seq", *[c for c in columns if c not in ("key", "seq")], "waits")).alias("_last")
    return (steps.groupBy("key").agg(last).filter("_last.waits")
            .select("key", *[F.col(f"_last.{c}").alias(c) for c in columns if c != "key"]))


def alone(waiting: DataFrame) -> DataFrame:
    """``(key, left_ts, right_ts)`` of events without a partner."""
    return waiting.select("key", *[F.when(F.col("side") == name, F.col("ts")).alias(f"{name}_ts")
                                   for name in ("left", "right")])


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    windows: Windows,
    left_measures: Sequence[Column],
    right_measures: Sequence[Column],
) -> DataFrame:
    """Join the two sides' aggregates for each key and window both sides have.

    Each side is reduced to one row per key and window first, so the work stays in
    proportion to the input however many rows share a key and window.
    """
    # Joined on the grouping columns themselves: both sides already lie where the join needs them.
    left, right = (df.groupBy(*keys, windows.of(ts)).agg(*measures)
                   for df, measures in ((left, left_measures), (right, right_measures)))
    return flatten(left.join(right, [*keys, "window"]))
