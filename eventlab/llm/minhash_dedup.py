"""Near-duplicate texts by ProbMinHash over weighted word shingles.

Every shingle of five words with its count is the source of a Poisson process whose rate is
the count.  The signature keeps, in each of its places, the shingle that arrives there first;
two texts agree in a place with the probability Jaccard similarity of their counted shingles.
Arrivals are drawn up to a time bound, which is raised only while some place is still empty,
so that most shingles draw one number.

Texts with the same counted shingles are one class.  Classes that share a band of their
signatures are compared by the exact similarity: first each with one member of the bucket,
that with the most copies, which joins groups of near copies in a number of comparisons that
follows their size.  Buckets that still hold several groups are compared in tiles of bounded
size: products of weights and presences, over 16-bit marks of the shingles, bound from above
what two classes share and how similar they can be, and only pairs of different groups that
may reach 0.8 leave a tile, to be compared exactly.  No link is lost between classes that
share a band, and what moves are marks, not pairs.

Null texts and texts without words are linked with nothing.  Texts of fewer than five words
have one shingle.  Rows with equal ids and different texts are classed by id: the id's class
is the smallest.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlab.llm.common import U64, components, in_small_batches, mix, portions, shingles, table, utf8, words_of, written

PORTION = 1 << 19
#: Classes of a bucket that a block holds, and marks that one product takes.
TILE, COLUMNS = 1024, 1024
PAIRS = 1 << 16  # compared by their bands at a time


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hashes."""
    return ((x >> U64(11)).astype(np.float64) + 1.0) / float(1 << 53)


def prob_minhash(items: np.ndarray, weights: np.ndarray, places: int) -> np.ndarray:
    """The first shingle to arrive in each place; the time bound changes the work, not the result."""
    rate = weights.astype(np.float64)
    bound = places * (np.log(places) + 3.0) / rate.sum()
    width = max(1, 8 * places // len(items))  # arrivals drawn at a time
    gaps, goals = mix(items ^ U64(0xA0761D6478BD642F)), mix(items ^ U64(0xE7037ED1A0B428DB))
    while True:
        best, holder = np.full(places, np.inf), np.zeros(places, U64)
        live, clock, step = np.arange(len(items)), np.zeros(len(items)), 0
        while len(live):
            turns = np.arange(step + 1, step + width + 1, dtype=U64) * U64(0x8EBC6AF09C88C6E3)
            waits = -np.log(uniform(mix(gaps[live, None] + turns))) / rate[live, None]
            times = clock[live, None] + waits.cumsum(axis=1)
            due = times <= bound
            row, turn = np.nonzero(due)
            at, who = times[due], items[live][row]
            place = (mix(goals[live][row] + turns[turn]) % U64(places)).astype(np.int64)
            order = np.lexsort((who, at))[::-1]
            first = np.full(places, -1)
            first[place[order]] = order  # the earliest is written last
            hit = np.flatnonzero(first >= 0)
            hit = hit[at[first[hit]] < best[hit]]
            best[hit], holder[hit] = at[first[hit]], who[first[hit]]
            clock[live], step = times[:, -1], step + width
            live = live[times[:, -1] <= bound]
        if np.isfinite(best).all():
            return holder
        bound *= 2


def counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(hashes, return_counts=True)


def documents_of(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and shingles of each row that has words."""
    data, borders = utf8(batch["text"])
    for first, last in portions(borders, PORTION):
        part = borders[first:last + 1] - borders[first]
        words, _, ends = words_of(data[borders[first]:borders[last]], part)
        found, at = shingles(words, ends, size)
        for i in range(last - first):
            if at[i + 1] > at[i]:
                yield first + i, found[at[i]:at[i + 1]]


def features(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    spread = mix(np.arange(1, rows + 1, dtype=U64))
    for batch in batches:
        at, one, two, keys = [], [], [], []
        for i, found in documents_of(batch, size):
            items, counts = counted(found)
            marks = mix(items * U64(3) + counts.astype(U64))
            at.append(i)
            one.append(np.add.reduce(marks).astype(np.int64))
            two.append(np.add.reduce(mix(marks)).astype(np.int64))
            signature = prob_minhash(items, counts, bands * rows).reshape(bands, rows)
            keys.append(np.add.reduce(mix(signature * spread), axis=1).astype(np.int64))
        yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(at, pa.int64())), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "c1", "c2", "bands"])


def weighted(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, items, counts = [], [], []
        for i, found in documents_of(batch, size):
            each, number = counted(found)
            at.append(i)
            items.append(each.tobytes())
            counts.append(number.astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(at, pa.int64())), pa.array(items, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "items", "counts"])


def probability_jaccard(items_a: np.ndarray, counts_a: np.ndarray, items_b: np.ndarray, counts_b: np.ndarray) -> float:
    """Sum over common items of 1 / sum of max(x_j / x_i, y_j / y_i) over all items j."""
    common, ia, ib = np.intersect1d(items_a, items_b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = counts_a[ia].astype(float), counts_b[ib].astype(float)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    only_a, only_b = counts_a.sum() - x.sum(), counts_b.sum() - y.sum()
    above = only_a + x[::-1].cumsum()[::-1]  # x of items whose ratio is not smaller
    below = only_b + np.concatenate([[0.0], y.cumsum()[:-1]])
    first = np.searchsorted(ratio, ratio, "left")
    return float((1.0 / (above[first] / x + below[first] / y)).sum())


def verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for i, row in enumerate(batch.select(["ia", "ca", "ib", "cb"]).to_pylist()):
            sides = [np.frombuffer(row[c], k) for c, k in (("ia", "<u8"), ("ca", "<i4"), ("ib", "<u8"), ("cb", "<i4"))]
            if probability_jaccard(*sides) >= threshold:
                keep.append(i)
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text's shingles as sorted 16-bit marks, each as often as it occurs."""
    for batch in batches:
        marks = []
        for items, counts in zip(batch["items"], batch["counts"]):
            short = (mix(np.frombuffer(items.as_py(), "<u8")) >> U64(48)).astype("<u2")
            marks.append(np.sort(np.repeat(short, np.frombuffer(counts.as_py(), "<i4"))).tobytes())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(marks, pa.binary())], names=["class", "marks"])


def shared_weights(marks: list[bytes], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each left and right text, at most how much of either's weight the two share.

    Texts that share a shingle share its mark, so a product of weights and presences bounds
    what they share; marks that a single text has are left out.
    """
    each = [np.frombuffer(x, "<u2") for x in marks]
    sizes = np.array([len(x) for x in each])
    cell, times = np.unique(np.repeat(np.arange(len(each)), sizes) << 16 | np.concatenate(each).astype(np.int64), return_counts=True)
    row, mark = cell >> 16, cell & 0xFFFF
    column, held = np.unique(mark, return_inverse=True, return_counts=True)[1:]
    often = held[column] > 1
    row, column, weight = row[often], column[often], (times[often] / sizes[row[often]]).astype(np.float32)
    order = np.argsort(column, kind="stable")
    row, column, weight = row[order], column[order], weight[order]
    of_left, of_right = (np.zeros((len(left), len(right)), np.float32) for _ in range(2))
    places = np.full(len(each), -1), np.full(len(each), -1)
    places[0][left], places[1][right] = np.arange(len(left)), np.arange(len(right))
    cuts = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]])) if len(column) else np.zeros(0, np.int64)
    cuts = np.append(cuts[::COLUMNS], len(column))
    for low, high in zip(cuts[:-1], cuts[1:]):
        used, at = np.unique(column[low:high], return_inverse=True)
        dense = []
        for place, side in zip(places, (left, right)):
            here = place[row[low:high]]
            held_weight = np.zeros((len(side), len(used)), np.float32)
            held_weight[here[here >= 0], at[here >= 0]] = weight[low:high][here >= 0]
            dense.append(held_weight)
        of_left += dense[0] @ (dense[1] > 0).T.astype(np.float32)
        of_right += (dense[0] > 0).astype(np.float32) @ dense[1].T
    return of_left, of_right


def likely(rows: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile that may be similar: of different groups, and sharing enough of both weights.

    A pair that shares several bands is left to the first of them.

    With the parts A and B of their weights that two texts do not share, each term of the
    similarity is at most the mean of x / (1 + A) and y / (1 + B), so the similarity is at most
    the mean of (1 - A) / (1 + A) and (1 - B) / (1 + B).
    """
    classes, groups = rows["class"].to_numpy(), rows["component"].to_numpy()
    left, right = (np.flatnonzero(np.array(rows[c].to_pylist(), bool)) for c in ("left", "right"))
    apart = (groups[left][:, None] != groups[right][None, :]) & ~(np.isin(left, right)[:, None] & np.isin(right, left)[None, :] & (left[:, None] >= right[None, :]))
    if not apart.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    of_left, of_right = shared_weights(rows["marks"].to_pylist(), left, right)
    i, j = np.nonzero(apart & (of_left / (2 - of_left) + of_right / (2 - of_right) >= 2 * threshold - 1e-4))
    i, j = left[i], right[j]
    codes = rows["bands"].combine_chunks().flatten().to_numpy().reshape(len(classes), -1)[:, :rows["band"][0].as_py()]
    first = np.concatenate([~(codes[i[k:k + PAIRS]] == codes[j[k:k + PAIRS]]).any(axis=1) for k in range(0, len(i), PAIRS)] or [np.zeros(0, bool)])
    return classes[i[first]], classes[j[first]]


def likely_pairs(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """All tiles; their rows follow one another, and a tile may go on in the next batch."""
    keys = ("band", "key", "x", "y")
    rest: pa.Table | None = None

    def pairs(tile: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        a, b = likely(tile, threshold)
        return np.minimum(a, b), np.maximum(a, b)

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows]).combine_chunks()
        values = [rows[c].to_numpy() for c in keys]
        starts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([v[1:] != v[:-1] for v in values])]))
        found = [pairs(rows.slice(low, high - low)) for low, high in zip(starts[:-1], starts[1:])]
        rest = rows.slice(starts[-1]) if len(starts) else None
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    if rest is not None and rest.num_rows:
        a, b = pairs(rest)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def possible(buckets: DataFrame, sets: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs of classes in different components that share a bucket and may be similar.

    ``buckets`` holds ``band, key, class, component``.  A bucket is compared in tiles of two
    blocks of at most ``TILE`` classes or so; a class goes to the tiles of its block.
    """
    members = buckets.select("class").distinct()
    marks = written(sets.join(members, sets["doc_id"] == members["class"], "left_semi").mapInArrow(marked, "class long, marks binary"), "marks")
    marks = marks.join(classes.select("class", "bands"), "class")
    sizes = buckets.groupBy("band", "key").agg(F.ceil(F.count("*") / TILE).alias("blocks"))
    placed = buckets.join(sizes, ["band", "key"]).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    placed = placed.select("*", others).select("band", "key", "class", "component", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                                               (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"))
    order = ["band", "key", "x", "y"]
    rows = placed.join(marks, "class").select(*order, "class", "component", "left", "right", "marks", "bands").repartition(*order).sortWithinPartitions(*order)
    return rows.mapInArrow(partial(likely_pairs, threshold=threshold), "a long, b long")


def similar_classes(docs: DataFrame, size: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 4) -> DataFrame:
    """One row per document: ``doc_id, class_id, kept``; the class id is its smallest document."""
    docs = in_small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = written(docs.mapInArrow(partial(features, size=size, bands=bands, rows=rows), "doc_id long, c1 long, c2 long, bands array<long>"), "features")
    classes = written(found.groupBy("c1", "c2").agg(F.min("doc_id").alias("class"), F.count("*").alias("copies"), F.min("bands").alias("bands")), "classes")
    placed = classes.select("class", "copies", F.posexplode("bands").alias("band", "key"))
    centre = F.max_by("class", F.struct("copies", -F.col("class"))).alias("centre")
    shared = placed.groupBy("band", "key").agg(F.count("*").alias("n"), centre).where("n > 1").select("band", "key", "centre")
    buckets = written(placed.join(shared, ["band", "key"]), "buckets")
    members = written(buckets.select("class").distinct(), "members")
    sets = docs.join(members, docs["doc_id"] == members["class"], "left_semi").mapInArrow(partial(weighted, size=size), "doc_id long, items binary, counts binary")
    sets = written(sets, "sets")

    def links(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("ia"), F.col("counts").alias("ca"))
        two = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("ib"), F.col("counts").alias("cb"))
        return pairs.distinct().join(one, "a").join(two, "b").select("a", "b", "ia", "ca", "ib", "cb").mapInArrow(partial(verified, threshold=threshold), "a long, b long")

    def groups(edges: DataFrame) -> DataFrame:
        joined = members.join(components(edges, "class", "component"), "class", "left")
        return written(joined.select("class", F.coalesce("component", "class").alias("component")), "groups")

    edges = written(links(buckets.where("class <> centre").select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b"))), "edges")
    labels = groups(edges)
    inside = buckets.select("band", "key", "class").join(labels, "class")
    apart = inside.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("band", "key")
    apart = written(inside.join(apart, ["band", "key"]).select("band", "key", "class", "component"), "apart")
    if not apart.isEmpty():
        more = written(links(written(possible(apart, sets, classes, threshold), "possible")), "edges")
        labels = groups(edges.unionByName(more))
    members = found.select("doc_id", "c1", "c2").join(classes.select("c1", "c2", "class"), ["c1", "c2"]).join(labels, "class", "left")
    members = members.groupBy("doc_id").agg(F.min(F.coalesce("component", "class")).alias("class_id"))
    out = docs.select("doc_id").join(members, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, one of each class; documents without an id stay."""
    gone = similar_classes(docs).where("NOT kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return similar_classes(table(spark, sf_dir, "documents"))
