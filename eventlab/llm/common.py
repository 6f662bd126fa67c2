"""Helpers shared by the operators: bytes of text columns, words, written tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlab.session import checkpoint_dir

U64 = np.uint64

# Letters, digits and all bytes beyond ASCII make words; A-Z is lower-cased.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LUT = np.frombuffer(LOWER_WORDS, np.uint8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """The same rows, computed once and kept in the shared checkpoint folder."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, for a function over Arrow batches: whole texts come a thousand at a time."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df


@contextmanager
def batches_of(spark: SparkSession, size: int = 16 << 20) -> Iterator[None]:
    """Bound the bytes of an Arrow batch while tables are written inside; the session's own setting comes back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column end to end, and the border of each row; null is empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, borders, data = column.buffers()
    at = np.frombuffer(borders, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return body, at - at[0]


def portions(borders: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, or of one longer row."""
    first, rows = 0, len(borders) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(borders, borders[first] + limit, "right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have) < count:
        have = np.ones(max(count, 1 << 16), U64)
        have[1:] = U64(base)
        _POWERS[base] = have = np.multiply.accumulate(have)
    return have[:count]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``p`` with one entry more than the bytes, from which :func:`span_hash` hashes any span."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_CODES[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans ``begin`` to ``end``; equal bytes give equal hashes."""
    raw = (prefix[end] - prefix[begin]) * powers(_INVERSE, len(prefix))[begin]
    return mix(raw + (end - begin).astype(U64) * U64(0xD6E8FEB86659FD93))


def words_of(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word, its first byte, and the border of each row's words."""
    low = _LUT[data]
    inside = low != 32
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = borders[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return span_hash(prefix_sums(low), begin, end), begin, np.searchsorted(begin, borders)


def shingles(words: np.ndarray, borders: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a row; fewer words make one run."""
    counts = np.diff(borders)
    each = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out = np.concatenate([[0], np.cumsum(each)])
    at = np.arange(out[-1]) - np.repeat(out[:-1], each) + np.repeat(borders[:-1], each)
    left = np.repeat(borders[1:], each) - at
    total = np.zeros(out[-1], U64)
    for k in range(size):
        here = k < left
        word = words[np.where(here, at + k, 0)] if len(words) else np.zeros(0, U64)
        total = mix(total * U64(0xC2B2AE3D27D4EB4F) + np.where(here, word, U64(k + 1)))
    return total, out


def components(edges: DataFrame, node: str = "node", label: str = "component") -> DataFrame:
    """The smallest node reachable from each node that has an edge (columns ``a``, ``b``).

    Alternates two steps until every node points at a root: every node hands its larger
    neighbours, then its smaller ones, to its smallest neighbour.  Each step is an
    aggregation and a join, so no node's neighbours meet in one task, and the number of steps
    grows with the logarithm of the nodes.  Each round is written to the shared folder.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.min("b").alias("m"))

    def stars(pairs: DataFrame) -> bool:
        ends = pairs.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("root"))
        ends = ends.unionByName(pairs.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("root")))
        return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("root").alias("root")).where("up > 1 OR up = 1 AND root = 1").isEmpty()

    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = smallest(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = smallest(large)
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "links")
    roots = now.select(F.col("b").alias("a")).distinct().withColumn("b", F.col("a"))
    return now.unionByName(roots).select(F.col("a").alias(node), F.col("b").alias(label))


def within(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Number the rows of each key from 0 in the given order, however large a key is.

    The table is cut into ranges of (key, order); rows are numbered inside a range and each
    range is moved on by what the key has in earlier ranges: one row per key and range.
    """
    from pyspark.sql import Window

    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_range", F.spark_partition_id())
    inside = written(ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order)) - 1), "ranked")
    before = inside.groupBy("_range", *keys).count()
    ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("_range", *keys, F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("_before"))
    same = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in ["_range", *keys]]
    joined = inside.alias("x").join(before.alias("y"), same)
    return joined.select(*[F.col(f"x.{c}") for c in df.columns], (F.col("_n") + F.col("_before")).alias(name))
