"""Exact top-k search by inner product: three phases with a uniform threshold.

The components are cut into slices, and each slice is a list of partial scores per query.

1. Every tile of a slice hands in its best partial scores for each query; what is among the
   best of a slice is scored in full.  The k-th best of these scores is a safe cutoff: no
   result can be below it.
2. The cutoff goes back to the tiles.  A sum that reaches it has a slice that holds at least
   its share, so each slice hands in all entries from the share on.  An entry seen in every
   slice is complete, and the k-th best complete one can only raise the cutoff.
3. What is still incomplete, and by its bound could reach the raised cutoff, is scored in full.

Equal vectors are one class with its smallest ids, so that copies of one vector are one entry
however many there are.  Queries and vectors meet in tiles of bounded size: the queries, a
stated part of the rows, go to every block of vectors, and no task holds more than two tiles.
What grows with the rows is joined by shuffles, as tables of vectors take far more room in the
driver than their files, by which Spark decides what to send to all tasks; one number per
query may go that way.

Vectors that are null, or hold null or non-finite components, take no part.  Shorter vectors
are filled up with zeros.  Components beyond 2^62 after scaling, and scores beyond 2^61, count
as these.  Ties go to the smaller ``key``, a null key last.  A row with a null key is no
query.  Rows that repeat a key are queries and candidates of their own.  An empty table gives
no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlab.llm.common import batches_of, table, written

#: Most vectors and bytes of a tile, and most queries that one product takes.
ROWS, BYTES, QUERIES = 1 << 14, 4 << 20, 128
LAST = (1 << 63) - 1  # stands for a null key among ties
TILE = "slice int, block long, ids binary, least binary, width int, body binary"
FOUND = "query long, class long, slice int, part long"


def quantised(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """The floor of each scaled component as 64-bit numbers, of the vectors that take part."""
    for batch in batches:
        column = batch["v"]
        keep, body = [], []
        for i, vector in enumerate(column):
            values = vector.values if vector.is_valid else None
            if values is None or values.null_count:
                continue
            numbers = values.to_numpy(zero_copy_only=False).astype(float)
            if np.isfinite(numbers).all():
                keep.append(i)
                with np.errstate(over="ignore"):
                    body.append(np.clip(np.floor(scale * numbers), -(2.0 ** 62), 2.0 ** 62).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([batch["key"].take(pa.array(keep, pa.int64())), pa.array(body, pa.binary())], names=["key", "code"])


def matrix(codes: list[bytes], size: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    return np.frombuffer(b"".join(x.ljust(8 * size, b"\0") for x in codes), "<i8").reshape(len(codes), size)


def narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold all of them."""
    most = max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)) - 1)
    return numbers.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def widened(body: bytes, rows: int, width: int) -> np.ndarray:
    """The numbers of :func:`narrow`, as rows."""
    return np.frombuffer(body, f"<i{len(body) // max(1, rows * width)}").reshape(rows, width).astype("<i8")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of one side with all of the other, exactly."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:  # every sum on the way is a whole number that a double holds
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return np.clip(a.astype(object) @ b.T.astype(object), -(1 << 61), 1 << 61).astype(np.int64)


def packed(rows: pa.Table, size: int, width: int) -> pa.Table:
    """One tile per slice from the rows of a block."""
    whole = matrix(rows["code"].to_pylist(), size)
    out = []
    for k, low in enumerate(range(0, size, width)):
        part = whole[:, low:low + width]
        out.append({"slice": k, "block": rows["block"][0].as_py(), "ids": rows["class"].to_numpy().astype("<i8").tobytes(), "least": rows["least"].to_numpy().astype("<i8").tobytes(),
                    "width": part.shape[1], "body": narrow(part)})
    return pa.Table.from_pylist(out, schema=pa.schema([("slice", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("least", pa.binary()), ("width", pa.int32()), ("body", pa.binary())]))


def tiles(classes: DataFrame, size: int, width: int) -> tuple[DataFrame, int]:
    """Blocks of classes as tiles, and the number of blocks."""
    most = max(16, min(ROWS, BYTES // (8 * size)))
    blocks = max(1, math.ceil(classes.count() / most))
    placed = classes.withColumn("block", F.pmod(F.xxhash64("class"), F.lit(blocks)))
    return written(placed.groupBy("block").applyInArrow(lambda rows: packed(rows, size, width), TILE), "tiles"), blocks


def best_of(scores: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` largest scores of each row, ties to the smaller ``least``."""
    if scores.shape[1] > k:
        bar = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        row, column = np.nonzero(scores >= bar[:, None])
    else:
        row, column = np.nonzero(np.ones(scores.shape, bool))
    order = np.lexsort((least[column], -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, row, "left")
    keep = np.arange(len(row)) - first < k
    return row[keep], column[keep]


def scored(batches: Iterator[pa.RecordBatch], k: int | None) -> Iterator[pa.RecordBatch]:
    """Entries of a slice: the ``k`` best per query, or all that hold their share of the query's cutoff."""
    for batch in batches:
        for pair in batch.to_pylist():
            width = pair["width"]
            names, least = (np.frombuffer(pair[c], "<i8") for c in ("ids", "least"))
            vectors = widened(pair["body"], len(names), width)
            asking, share = (np.frombuffer(pair[c], "<i8") for c in ("q_ids", "q_least"))
            queries = widened(pair["q_body"], len(asking), width)
            for low in range(0, len(asking), QUERIES):
                some = slice(low, low + QUERIES)
                scores = products(queries[some], vectors)
                row, column = best_of(scores, least, k) if k else np.nonzero(scores >= share[some, None])
                yield pa.RecordBatch.from_arrays([pa.array(asking[some][row]), pa.array(names[column]), pa.array(np.full(len(row), pair["slice"], np.int32)), pa.array(scores[row, column])],
                                                 names=["query", "class", "slice", "part"])


def whole_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        score = []
        for a, b in zip(batch["q_code"].to_pylist(), batch["code"].to_pylist()):
            size = max(len(a), len(b)) // 8
            score.append(int(products(matrix([a], size), matrix([b], size))[0, 0]))
        yield pa.RecordBatch.from_arrays([batch["query"], batch["class"], pa.array(score, pa.int64())], names=["query", "class", "score"])


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, for a join that sends neither side through the driver."""
    return df.hint("merge")


def met(queries: DataFrame, vectors: DataFrame, blocks: int, k: int | None) -> DataFrame:
    """Every block of queries against every block of vectors, slice by slice."""
    asking = queries.repartition(queries.sparkSession.sparkContext.defaultParallelism)  # each tile is copied once per block
    asking = asking.select("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
                            F.col("ids").alias("q_ids"), F.col("least").alias("q_least"), F.col("body").alias("q_body"))
    return asking.join(shuffled(vectors), ["slice", "block"]).mapInArrow(partial(scored, k=k), FOUND)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0, slices: int = 2) -> DataFrame:
    """``query_id, rank, <key>, score``: the ``k`` best rows for each row whose key ``every`` divides."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"))
    more = k + 1  # a query's own row may be among them
    with batches_of(spark):
        rows = written(rows.mapInArrow(partial(quantised, scale=scale), "key long, code binary"), "quantised")
        asks = F.coalesce(F.pmod("key", F.lit(every)) == 0, F.lit(False))
        classes = rows.groupBy("code").agg(F.min(F.coalesce("key", F.lit(LAST))).alias("least"), F.max(asks).alias("asks"))
        classes = written(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
        size = max(1, (classes.agg(F.max(F.length("code"))).first()[0] or 0) // 8)
        width = math.ceil(size / slices)
        lists = math.ceil(size / width)
        asking = classes.where("asks")
        data, blocks = tiles(classes, size, width)

        def resolved(pairs: DataFrame) -> DataFrame:
            """Scores in full."""
            q = classes.select(F.col("class").alias("query"), F.col("code").alias("q_code"))
            return pairs.join(shuffled(classes.select("class", "code")), "class").join(shuffled(q), "query").select("query", "class", "q_code", "code").mapInArrow(whole_scores, "query long, class long, score long")

        def nth(scores: DataFrame, name: str) -> DataFrame:
            """The ``more``-th best score of each query, or its lowest if it has fewer."""
            place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "class"))
            return scores.withColumn("_n", place).where(F.col("_n") <= more).groupBy("query").agg(F.min("score").alias(name), F.count("*").alias("_have"))

        # 1: the best of each list, and the cutoff
        first, _ = tiles(asking.select("class", "least", "code"), size, width)
        lists_of = met(first, data, blocks, more)
        place = F.row_number().over(Window.partitionBy("query", "slice").orderBy(F.desc("part"), "class"))
        gathered = lists_of.withColumn("_n", place).where(F.col("_n") <= more).select("query", "class").distinct()
        cutoff = written(nth(resolved(gathered), "cut").select("query", "cut"), "cutoff")

        # 2: all entries from the share on
        share = F.expr(f"cut div {lists} + IF(cut > 0 AND cut % {lists} <> 0, 1, 0)")  # the quotient, rounded up
        second, _ = tiles(asking.join(shuffled(cutoff), asking["class"] == cutoff["query"]).select("class", share.alias("least"), "code"), size, width)
        found = written(met(second, data, blocks, None).groupBy("query", "class").agg(F.sum("part").alias("score"), F.count("*").alias("_lists")), "found")
        complete = found.where(F.col("_lists") == lists).select("query", "class", "score")
        raised = written(nth(complete, "raised").where(F.col("_have") == more).select("query", "raised"), "raised")

        # 3: what could still reach the cutoff
        short = found.where(F.col("_lists") < lists).join(cutoff, "query").join(raised, "query", "left")
        open_ = short.where(F.col("score") + (F.lit(lists) - F.col("_lists")) * (share - 1) >= F.greatest("cut", F.coalesce("raised", "cut"))).select("query", "class")
        hopeful = complete.unionByName(resolved(open_)).join(raised, "query", "left").where(F.col("score") >= F.coalesce("raised", "score"))
        ranked = hopeful.join(shuffled(classes.select("class", "least")), "class")
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "least", "class"))
        best = written(ranked.withColumn("_n", place).where(F.col("_n") <= more).select("query", "class", "score"), "best")

    # from classes to rows: the smallest keys of a class are enough
    of_class = Window.partitionBy("code").orderBy(F.col("key").asc_nulls_last())
    members = rows.withColumn("_m", F.row_number().over(of_class)).where(F.col("_m") <= more)
    members = members.join(shuffled(classes.select("class", "code")), "code").select("class", "key", "_m")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("key").asc_nulls_last(), "class", "_m"))
    listed = best.join(shuffled(members), "class").withColumn("_n", place).where(F.col("_n") <= more)
    entry = F.struct("_n", "key", "score", (F.col("class") == F.col("query")).alias("same"))
    listed = listed.groupBy("query").agg(F.sort_array(F.collect_list(entry)).alias("list"))  # at most ``more`` entries
    asked = rows.where(asks).join(shuffled(asking.select("code", F.col("class").alias("query"))), "code").select(F.col("key").alias("query_id"), "query")
    own = F.coalesce(F.array_position(F.transform("list", lambda x: x["same"] & x["key"].eqNullSafe(F.col("query_id"))), True), F.lit(0))
    rest = F.filter("list", lambda x, i: i + 1 != F.col("own"))
    out = asked.join(shuffled(listed), "query").withColumn("own", own).select("query_id", F.posexplode(F.slice(rest, 1, k)).alias("rank", "hit"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.key").alias(key), F.col("hit.score").alias("score"))


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every embedding whose id 50 divides."""
    return top_k(table(spark, sf_dir, "embeddings"))
