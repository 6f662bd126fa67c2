"""The busiest keys of each window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlab.operators.windows import window_counts
from eventlab.times import Windows

WINDOW = ["window_start", "window_end"]


def rank_counts(counts: DataFrame, key: str, k: int = 10, min_groups: int = 12) -> DataFrame:
    """Rank a table of counts per (key, window): the ``k`` largest of each window.

    Windows with fewer than ``min_groups`` keys are left out; equal counts rank by key.
    Ranking keeps at most ``k`` rows per window and task before rows are moved, and the
    size of a window is a separate count, so no task sees a whole window.
    """
    # `n > 0` always holds; asking for it makes both branches share the one shuffle of `counts`.
    large = (counts.groupBy(*WINDOW).agg(F.count_if(F.col("n") > 0).alias("_groups"))
             .filter(F.col("_groups") >= min_groups).select(*WINDOW))
    order = Window.partitionBy(*WINDOW).orderBy(F.desc("n"), F.asc(key))
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(large, WINDOW, "left_semi").withColumn("rank", F.col("rank").cast("bigint"))


def top_n(
    df: DataFrame, key: str, ts: str, windows: Windows, k: int = 10, min_groups: int = 12
) -> DataFrame:
    """The ``k`` keys with most rows in each window."""
    return rank_counts(window_counts(df, ts, windows, [key]), key, k, min_groups)
