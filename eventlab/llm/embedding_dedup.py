"""Embedding near-duplicates: random-hyperplane signs in several tables, then exact cosines.

Equal vectors are one class, and only classes are compared.  In each table a class falls into
the bucket of its signs; a bucket with several classes is compared in tiles of bounded size,
by matrix product, in double precision.  A pair met in several tables counts in the first of
them.  Each tile returns sums per class and the few links that keep its groups connected, not
its pairs.  Components are found over these links.

The number of signs follows the number of classes, so that unrelated vectors rarely share a
bucket, and the number of tables follows from it: a pair at the threshold is missed in all
tables with probability ``miss`` at most.

Vectors that are null or zero, or hold null or non-finite components, are linked with nothing
and stand alone, as do vectors of another length than the other side of a comparison.  Rows
without an id are linked like others; they are never kept, and a component of such rows alone
has no id.  Rows that repeat an id are vectors of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlab.llm.common import components, table, written

#: Rows of a bucket that one side of a tile holds.
TILE = 1024
#: Larger groups are compared by matrix product, smaller ones pair by pair, so many at a time.
SMALL, PAIRS = 64, 1 << 16


def hyperplanes(size: int, tables: int, bits: int) -> np.ndarray:
    """The normals of all tables, the same in every task."""
    return np.random.default_rng([size, tables, bits]).standard_normal((size, tables * bits))


def signs(batches: Iterator[pa.RecordBatch], tables: int, bits: int) -> Iterator[pa.RecordBatch]:
    """The bucket of each class in each table, as 64-bit numbers."""
    weight = (1 << np.arange(bits, dtype=np.int64))
    for batch in batches:
        for size, rows in sized(batch["unit"].to_pylist()):
            side = np.array([r for _, r in rows]) @ hyperplanes(size, tables, bits) > 0
            codes = side.reshape(len(rows), tables, bits) @ weight
            at = [i for i, _ in rows]
            names = batch["class_id"].take(pa.array(at))
            yield pa.RecordBatch.from_arrays([names, pa.array(list(codes), pa.list_(pa.int64()))], names=["class_id", "codes"])


def normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length one beside the given ones, in time that follows their components."""
    for batch in batches:
        column = batch["v"]
        flat = column.flatten().to_numpy(zero_copy_only=False)
        counts = np.diff(column.offsets.to_numpy())
        begins = np.concatenate([[0], np.cumsum(counts)])[:-1]
        unit = flat / np.repeat(np.maximum.reduceat(np.abs(flat), begins), counts) if len(flat) else flat  # keeps squares finite
        unit = unit / np.repeat(np.sqrt(np.add.reduceat(unit * unit, begins)), counts) if len(flat) else unit
        offsets = pa.array(np.concatenate([begins, [len(flat)]]), pa.int32())
        yield pa.RecordBatch.from_arrays([batch["least"], batch["copies"], column, pa.ListArray.from_arrays(offsets, pa.array(unit))], names=["least", "copies", "v", "unit"])


def sized(vectors: list) -> list[tuple[int, list]]:
    by: dict[int, list] = {}
    for i, v in enumerate(vectors):
        by.setdefault(len(v), []).append((i, v))
    return sorted(by.items())


def near_pairs(unit: np.ndarray, group: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group, one from either side, whose product reaches the threshold."""
    border = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    sizes = np.diff(border)
    found = []
    for a, b in zip(border[:-1][sizes > SMALL], border[1:][sizes > SMALL]):
        i, j = np.nonzero(unit[a:b] @ unit[a:b].T >= threshold)
        found.append((i[i < j] + a, j[i < j] + a))
    later = np.repeat(border[1:], sizes) - np.arange(len(group)) - 1  # rows of the group behind each row
    later[np.repeat(sizes > SMALL, sizes)] = 0
    ends = np.cumsum(later)
    for low in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        nth = np.arange(low, min(low + PAIRS, ends[-1]))
        i = np.searchsorted(ends, nth, "right")
        j = i + 1 + nth - (ends[i] - later[i])
        near = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
        found.append((i[near], j[near]))
    i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    facing = left[i] & right[j] | left[j] & right[i]
    return i[facing], j[facing]


def spanning(rows: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each row the first row it is connected with."""
    label = np.arange(rows)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compared(rows: pa.Table, threshold: float) -> pa.RecordBatch:
    """Sums of links per class, and a spanning set of links, of whole groups."""
    out = []
    lengths = np.diff(rows["unit"].combine_chunks().offsets.to_numpy())
    for size in np.unique(lengths):
        part = rows.take(pa.array(np.flatnonzero(lengths == size))).combine_chunks()
        names, copies, t, group = (part[c].to_numpy() for c in ("class_id", "copies", "t", "_group"))
        left, right = (np.array(part[c].to_pylist(), bool) for c in ("left", "right"))
        unit = part["unit"].combine_chunks().flatten().to_numpy().reshape(len(names), size)
        codes = part["codes"].combine_chunks().flatten().to_numpy().reshape(len(names), -1)
        i, j = near_pairs(unit, group, left, right, threshold)
        fresh = [((codes[i[k:k + PAIRS]] == codes[j[k:k + PAIRS]]) & (np.arange(codes.shape[1]) < t[i[k:k + PAIRS], None])).any(axis=1) for k in range(0, len(i), PAIRS)]
        if fresh:
            new = ~np.concatenate(fresh)
            i, j = i[new], j[new]
        total = np.bincount(i, copies[j], len(names)) + np.bincount(j, copies[i], len(names))
        label = spanning(len(names), i, j)
        many, linked = np.flatnonzero(total), np.flatnonzero(label != np.arange(len(names)))
        out += [(names[many], names[many], total[many].astype(np.int64)), (names[linked], names[label[linked]], np.zeros(len(linked), np.int64))]
    columns = [np.concatenate(x) for x in zip(*out)]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["a", "b", "n"])


def tiles(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Tiles follow one another in order; the last one of a batch waits for the next batch."""
    rest: pa.Table | None = None
    number = 0
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        keys = [rows[c].to_numpy() for c in ("t", "code", "x", "y")]
        new = np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
        group = np.cumsum(new) + number
        if rest is not None:
            same = all(rest[c][0].as_py() == rows[c][0].as_py() for c in ("t", "code", "x", "y"))
            group -= same
            rows = pa.concat_tables([rest, rows.append_column("_group", pa.array(group))])
        else:
            rows = rows.append_column("_group", pa.array(group))
        number = int(group[-1])
        whole = int(np.searchsorted(rows["_group"].to_numpy(), number))
        for low in whole_groups(rows["_group"].to_numpy()[:whole]):
            yield compared(rows.slice(*low), threshold)
        rest = rows.slice(whole).combine_chunks()
    if rest is not None:
        yield compared(rest, threshold)


def whole_groups(group: np.ndarray, rows: int = 8192) -> Iterator[tuple[int, int]]:
    """Slices of whole groups, of about so many rows."""
    first = 0
    while first < len(group):
        last = len(group) if first + rows >= len(group) else int(np.searchsorted(group, group[first + rows], "right"))
        yield first, last - first
        first = last


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, miss: float = 0.002, spare_bits: int = 4) -> DataFrame:
    """One row per vector: ``key, n_links, component_id, kept``."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    usable = F.coalesce(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(usable, F.transform("v", lambda x: x + F.lit(0.0))))
    classes = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    # Not every class has an id, and two may share one: classes are numbered.
    classes = classes.select("least", "copies", "v").mapInArrow(normalised, "least long, copies long, v array<double>, unit array<double>")
    classes = written(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    count = classes.count()
    bits = max(8, math.ceil(math.log2(max(2, count))) + spare_bits)
    agree = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    tables = math.ceil(math.log(miss) / math.log(1 - agree))
    coded = written(classes.select("class_id", "unit").mapInArrow(partial(signs, tables=tables, bits=bits), "class_id long, codes array<long>"), "codes")

    placed = coded.select("class_id", F.posexplode("codes").alias("t", "code"))
    shared = placed.groupBy("t", "code").agg(F.count("*").alias("size")).where("size > 1")
    full = placed.join(shared, ["t", "code"])
    block, blocks = F.pmod(F.xxhash64("class_id"), F.col("blocks")).alias("block"), F.ceil(F.col("size") / TILE).alias("blocks")
    full = full.select("*", blocks).select("t", "code", "class_id", "blocks", block)
    # A row of block i takes part in the tiles (i, i), (i, j) for later j, and (j, i) for earlier j.
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    full = full.select("*", others).select("t", "code", "class_id", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"))
    carried = full.join(classes.select("class_id", "copies", "unit").join(coded, "class_id"), "class_id")
    order = ["t", "code", "x", "y"]
    found = carried.select(*order, "class_id", "left", "right", "copies", "unit", "codes").repartition(*order).sortWithinPartitions(*order)
    found = found.mapInArrow(partial(tiles, threshold=threshold), "a long, b long, n long")
    found = written(found, "found")

    links = found.where("a = b").groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("n"))
    groups = components(found.where("a <> b").select("a", "b"), "class_id", "component")
    # A component is named by its smallest id, among all rows of its classes.
    named = classes.select("class_id", "v", "copies", "least").join(links, "class_id", "left").join(groups, "class_id", "left")
    named = named.withColumn("component", F.coalesce("component", "class_id"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(names, "component").select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(named, "v", "left").select(F.col("vec_id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, linked from a cosine of 0.95 on."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
