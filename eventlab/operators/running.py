"""Running aggregates in arrival order that no hot key can pin to one task.

A plain ``sum(...) OVER (PARTITION BY key ORDER BY seq)`` sorts all rows of a key in one
task, which is right for keys of up to ``bucket`` rows; then the input is read once and
shuffled once, by key.  If a key is larger, the rows are cut into ranges of (key, arrival
number) that are equal in rows however keys and numbers are spread, and written in that
order.  Windows then run inside a range.  A range can go on with only one key, that of the
range before, so what went before a range is one row per range at most, which is sent to all
tasks.  Where the cuts lie moves work between tasks but changes no result.

Whether a key is larger is counted when the operator is called; tables of up to ``bucket``
rows need no count per key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlab.session import written
from eventlab.times import floor_div

# The most rows of a key that one task sorts without need.
BUCKET = 1 << 18

# Aggregates that can be merged with themselves, and how two partial results meet; null is "none yet".
MERGEABLE = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
}


def ranges_needed(df: DataFrame, keys: Sequence[str], bucket: int = BUCKET) -> int:
    """How many ranges to cut the table into; 1 where no key has more than ``bucket`` rows."""
    rows = df.count()
    if rows <= bucket:
        return 1
    if keys and df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_count")).filter(F.col("_count") > bucket).isEmpty():
        return 1
    return math.ceil(rows / bucket) + 1


def running(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    totals: Mapping[str, tuple[str, Column]],
    *,
    lead: str | None = None,
    inclusive: bool = True,
    bucket: int = BUCKET,
    ranges: int | None = None,
) -> DataFrame:
    """Add one running total per entry of ``totals`` to every row.

    ``totals`` maps an output name to ``("sum" | "max" | "min", input column)``.  Rows
    are taken per ``keys`` in the order of ``lead``, if given, and then ``seq``; together
    they are unique within the keys.  ``inclusive=False`` leaves the row itself out.
    ``ranges`` is what :func:`ranges_needed` found, if the caller has asked already.
    """
    merges = {name: MERGEABLE[how] for name, (how, _) in totals.items()}
    order = [seq] if lead is None else [lead, seq]
    rows = df.withColumns({f"_in_{name}": column for name, (_, column) in totals.items()})
    if ranges is None:
        ranges = ranges_needed(df, keys, bucket)
    last = Window.currentRow if inclusive else -1

    def within(*group: str) -> dict[str, Column]:
        upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
        return {name: merge(f"_in_{name}").over(upto) for name, (merge, _) in merges.items()}

    if ranges == 1:
        return rows.select(*df.columns, *[total.alias(name) for name, total in within(*keys).items()])
    rows = in_ranges(rows, [*keys, *order], ranges)
    before = carried(rows, keys, merges)
    joined = rows.join(F.broadcast(before), reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in ["_range", *keys]]), "left")
    out = joined.withColumns({f"_out_{name}": total for name, total in within("_range", *keys).items()})
    return out.select(*df.columns, *[meet(F.col(f"_before_{name}"), F.col(f"_out_{name}")).alias(name) for name, (_, meet) in merges.items()])


def in_ranges(rows: DataFrame, order: Sequence[str], ranges: int) -> DataFrame:
    """The rows written in ``ranges`` parts of ascending ``order``, numbered by ``_range``."""
    return written(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))


def carried(rows: DataFrame, keys: Sequence[str], merges: Mapping[str, tuple[Callable, Callable]]) -> DataFrame:
    """What a key has in earlier ranges, where it has any: at most one row per range."""
    parts = rows.groupBy("_range", *keys).agg(*[merge(f"_in_{name}").alias(f"_in_{name}") for name, (merge, _) in merges.items()])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        *[F.col(c).alias(f"_of_{c}") for c in ["_range", *keys]],
        *[merge(f"_in_{name}").over(earlier).alias(f"_before_{name}") for name, (merge, _) in merges.items()])
    return before.filter(reduce(or_, [F.col(f"_before_{name}").isNotNull() for name in merges]))


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    name: str = "position",
    *,
    lead: str | None = None,
    bucket: int = BUCKET,
) -> DataFrame:
    """Add the 1-based position of every row within its key."""
    return running(df, keys, seq, {name: ("sum", F.lit(1).cast("bigint"))},
                   lead=lead, bucket=bucket)


def chunked(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    size: int,
    *,
    bucket: int = BUCKET,
) -> DataFrame:
    """Add ``chunk``: 0 for the first ``size`` rows of a key, 1 for the next, and so on."""
    placed = numbered(df, keys, seq, "_position", bucket=bucket)
    return placed.withColumn("chunk", floor_div(F.col("_position") - 1, size)).drop("_position")
