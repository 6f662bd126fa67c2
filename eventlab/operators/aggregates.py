"""Grouped aggregates over whole tables, in final and in running form."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlab.operators.running import BUCKET, numbered, running
from eventlab.session import written
from eventlab.times import floor_div

# Values of a key that `reduce_in_order` gathers in one task.
FOLD = 1 << 16
# Values that one row of `rolling_reduce` scans.
RUN = 128


def _others(df: DataFrame, *taken: str) -> list[str]:
    return [c for c in df.columns if c not in taken]


def word_counts(words: DataFrame, word: str = "word") -> DataFrame:
    """How often each word occurs."""
    return words.groupBy(word).agg(F.count(F.lit(1)).alias("n"))


def group_sum(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum of ``value`` per key."""
    return df.groupBy(*keys).agg(F.sum(value).alias(value))


def rolling_sum(
    df: DataFrame, keys: Sequence[str], seq: str, value: str, *, bucket: int = BUCKET
) -> DataFrame:
    """The change log of a keyed sum: for each row the total so far.

    Columns other than the keys, ``seq`` and ``value`` keep those of the key's first row.
    """
    others = _others(df, *keys, seq, value)
    out = running(df.select(*keys, seq, *others, value), keys, seq, {
        "_sum": ("sum", F.col(value)),
        "_first": ("min", F.struct(seq, *others)),
    }, bucket=bucket)
    return out.select(seq, *keys, *[F.col(f"_first.{c}").alias(c) for c in others], F.col("_sum").alias(value))


def arg_max(df: DataFrame, column: str, seq: str, keys: Sequence[str] = ()) -> DataFrame:
    """The whole row with the largest ``column`` per key; the earliest row wins a tie."""
    row = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*row), F.struct(F.col(column), -F.col(seq))).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in row])


def rolling_arg_max(
    df: DataFrame, column: str, seq: str, keys: Sequence[str] = (), *, bucket: int = BUCKET
) -> DataFrame:
    """For each row the best row so far, as in :func:`arg_max`; its own ``seq`` becomes ``best_seq``."""
    others = _others(df, *keys, seq, column)
    best = F.struct(F.col(column).alias("top"), (-F.col(seq)).alias("minus_seq"), *others)
    out = running(df.select(*keys, seq, column, *others), keys, seq, {"_best": ("max", best)},
                  bucket=bucket)
    return out.select(seq, *keys, F.col("_best.top").alias(column), (-F.col("_best.minus_seq")).alias("best_seq"),
                      *[F.col(f"_best.{c}").alias(c) for c in others])


def max_keep_first(df: DataFrame, column: str, seq: str, keys: Sequence[str] = ()) -> DataFrame:
    """The largest ``column`` per key next to the other columns of the key's first row."""
    others = _others(df, *keys, column)
    first = F.min_by(F.struct(*others), F.col(seq)).alias("_first")
    return (df.groupBy(*keys).agg(F.max(column).alias(column), first)
            .select(*keys, column, *[F.col(f"_first.{c}").alias(c) for c in others]))


def rolling_max(
    df: DataFrame, column: str, seq: str, keys: Sequence[str] = (), *, bucket: int = BUCKET
) -> DataFrame:
    """For each row the largest ``column`` so far and the other columns of the first row."""
    others = _others(df, *keys, seq, column)
    out = running(df.select(*keys, seq, column, *others), keys, seq, {
        "_top": ("max", F.col(column)),
        "_first": ("min", F.struct(seq, *others)),
    }, bucket=bucket)
    return out.select(seq, *keys, F.col("_top").alias(column), *[F.col(f"_first.{c}").alias(c) for c in others])


def reduce_in_order(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: Column,
    merge: Callable[[Column, Column], Column],
    name: str = "value",
    *,
    fold: int = FOLD,
) -> DataFrame:
    """Combine the values of each key in ``seq`` order with an associative ``merge``.

    ``seq`` is a unique whole number.  Rows fold in levels: first each run of ``fold``
    consecutive numbers, then twice each run of that many partial results, then the rest.
    No task gathers more than ``fold`` values of a key while ``seq`` is below ``fold ** 4``.
    Merges that need no order are cheaper by :func:`reduce_any_order`.
    """
    level = df.select(*keys, F.col(seq).cast("bigint").alias("_at"), value.alias("_value"))
    for unit in (True, True, True, False):
        at = floor_div(F.col("_at"), fold) if unit else F.lit(0).cast("bigint")
        ordered = F.sort_array(F.collect_list(F.struct("_at", "_value")))
        level = (level.groupBy(*keys, at.alias("_unit")).agg(ordered.alias("_run"))
                 .select(*keys, F.col("_unit").alias("_at"), F.reduce(
                     F.slice("_run", F.lit(2), F.size("_run")), F.col("_run")[0]["_value"],
                     lambda done, item: merge(done, item["_value"])).alias("_value")))
    return level.select(*keys, F.col("_value").alias(name))


def rolling_reduce(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: Column,
    merge: Callable[[Column, Column], Column],
    name: str = "value",
    *,
    run: int = RUN,
    bucket: int = BUCKET,
) -> DataFrame:
    """For each row the values of its key so far, combined in ``seq`` order by ``merge``.

    ``merge`` is any associative function of two columns; it need not commute.  This is a
    parallel prefix scan: runs of ``run`` consecutive rows are folded, the table of runs is
    scanned in the same way, and each run is folded again from what went before it.  No row
    of the plan holds more than ``run`` values, so a key may have any number of rows, and the
    levels grow with the logarithm of the largest key.  ``seq`` is unique within the keys.
    Null values are handed to ``merge`` like others.
    """
    rows = df.select(*keys, seq, value.alias("_value"))
    scanned = _scan(rows, keys, seq, merge, run, bucket)
    return scanned.select(*keys, seq, F.col("_sofar").alias(name))


def _scan(
    rows: DataFrame, keys: Sequence[str], at: str, merge: Callable[[Column, Column], Column], run: int, bucket: int
) -> DataFrame:
    """Rows ``(keys, at, _value)`` with ``_sofar``, the merge of all values up to the row's own."""
    placed = numbered(rows, keys, at, "_place", bucket=bucket).withColumn("_run", floor_div(F.col("_place") - 1, run))
    items = F.sort_array(F.collect_list(F.struct("_place", F.col(at).alias("_at"), "_value"))).alias("_items")
    runs = written(placed.groupBy(*keys, "_run").agg(items))  # at most `run` values each
    rest = F.slice("_items", F.lit(2), F.size("_items"))
    if runs.filter("_run > 0").isEmpty():
        runs = runs.withColumn("_first", F.col("_items")[0]["_value"])
    else:
        total = F.reduce(rest, F.col("_items")[0]["_value"], lambda done, item: merge(done, item["_value"]))
        above = _scan(runs.select(*keys, F.col("_run").alias("_unit"), total.alias("_value")), keys, "_unit", merge, run, bucket)
        before = above.select(*[F.col(k).alias(f"_of_{k}") for k in keys], (F.col("_unit") + 1).alias("_next"), F.struct("_sofar").alias("_before"))
        same = F.col("_run") == F.col("_next")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        head = F.col("_items")[0]["_value"]
        runs = runs.join(before, same, "left").withColumn("_first", F.when(F.col("_before").isNull(), head).otherwise(merge(F.col("_before._sofar"), head)))
    sofar = F.reduce(rest, F.array("_first"), lambda done, item: F.concat(done, F.array(merge(F.element_at(done, -1), item["_value"]))))
    each = F.explode(F.arrays_zip(F.col("_items._at").alias("_at"), F.col("_items._value").alias("_value"), sofar.alias("_sofar"))).alias("_row")
    return runs.select(*keys, each).select(*keys, F.col("_row._at").alias(at), F.col("_row._value").alias("_value"), F.col("_row._sofar").alias("_sofar"))


def reduce_any_order(
    df: DataFrame, keys: Sequence[str], seq: str, first: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """The same for merges that add ``sums`` and keep the first row's ``first`` columns.

    Such a merge needs no order, so rows are reduced before the single shuffle.
    """
    base = F.min_by(F.struct(*first), seq).alias("_base")
    out = df.groupBy(*keys).agg(base, *[F.sum(c).alias(c) for c in sums])
    return out.select(*keys, *[F.col(f"_base.{c}").alias(c) for c in first], *sums)


def visits(user: str, approx: bool = False) -> list[Column]:
    """Page views and unique visitors, to be used with any grouping."""
    unique = F.approx_count_distinct(user) if approx else F.count_distinct(user)
    return [F.count(F.lit(1)).alias("pv"), unique.alias("uv")]
