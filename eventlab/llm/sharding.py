"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of cells.  Each shard has virtual nodes at hashed cells and owns
the cells up to the node before.  A shard may hold so many rows; this bound is split over its
nodes in proportion to the cells they own.  Rows take their node in order of their hash; what
goes beyond a node's bound moves on clockwise to the next nodes that have room.

All of this is sums: rows are counted per cell, and the moves follow from running sums over
the nodes, a table whose size depends only on the number of shards.  Rows are then numbered
within their cell and joined with the list of moves.

A repeated row (same id and text) counts as often as it occurs.  A null text is empty.  An
empty table gives no rows.  Other columns are not read.  Rows are placed one by one: equal
texts may lie in different shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlab.llm.common import table, written

CELLS = 1 << 16


def ring(spark: SparkSession, shards: int, nodes: int = 128) -> DataFrame:
    """The owner of each cell: ``cell, node, shard``; ``node`` counts clockwise."""
    points = spark.range(shards * nodes).select((F.col("id") % shards).cast("int").alias("shard"), F.pmod(F.xxhash64(F.lit("node"), "id"), F.lit(CELLS)).alias("cell"))
    points = points.groupBy("cell").agg(F.min("shard").alias("shard"))
    lonely = spark.range(shards).select(F.col("id").cast("int").alias("shard")).join(points, "shard", "left_anti")
    points = points.unionByName(lonely.select(F.pmod(F.xxhash64(F.lit("spare"), "shard"), F.lit(CELLS)).alias("cell"), "shard")).groupBy("cell").agg(F.max("shard").alias("shard"))
    points = points.withColumn("node", F.row_number().over(Window.orderBy("cell")) - 1)
    next_up = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    around = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = spark.range(CELLS).withColumnRenamed("id", "cell").join(points, "cell", "left")
    own = [F.coalesce(F.last(c, True).over(next_up), F.first(c, True).over(around)).alias(c) for c in ("node", "shard")]
    return cells.select("cell", *own)


def moves(counts: DataFrame, owners: DataFrame, shards: int, slack: float = 0.0) -> DataFrame:
    """Where rows go: ``node, low, high, shard, base``.

    Rows ``low`` to ``high`` (excluded) of a node, in hash order, go to ``shard`` at the
    places from ``base`` on.  Shard bounds add up to the rows times ``1 + slack``.
    """
    per_node = owners.join(counts, "cell", "left").groupBy("node", "shard").agg(F.count("*").alias("width"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    total = F.ceil(F.sum("n").over(Window.partitionBy()) * F.lit(1 + slack)).cast("long").alias("total")
    in_shard = Window.partitionBy("shard").orderBy("node")
    laps = Window.orderBy("lap", "node")
    per_node = per_node.select("*", total)
    bound = F.floor((F.col("total") + (F.lit(shards - 1) - F.col("shard"))) / shards).alias("bound")
    per_node = per_node.select("*", bound, F.sum("width").over(in_shard).alias("_up"), F.sum("width").over(Window.partitionBy("shard")).alias("_all"))
    whole = lambda x: F.floor(F.col("bound").cast("decimal(20,0)") * x / F.col("_all")).cast("long")
    room = (whole(F.col("_up")) - whole(F.col("_up") - F.col("width"))).alias("room")
    per_node = per_node.select("node", "shard", "n", room)

    laps_of = F.explode(F.array(F.lit(0), F.lit(1))).alias("lap")  # the queue is steady in the second round
    both = per_node.select("*", laps_of).withColumn("_s", F.sum(F.col("n") - F.col("room")).over(laps))
    both = both.withColumn("over", F.col("_s") - F.least(F.lit(0), F.min("_s").over(laps)))
    both = both.withColumn("arrived", F.coalesce(F.lag("over").over(laps), F.lit(0))).where("lap = 1")
    both = both.select("node", "shard", "n", "room", "over", F.least("arrived", F.greatest(F.lit(0), F.col("room") - F.col("n"))).alias("taken"), F.greatest(F.lit(0), F.col("n") - F.col("room")).alias("spilt"))
    cut = F.min(F.when(F.col("over") == 0, F.col("node"))).over(Window.partitionBy())  # behind it nobody waits
    clock = Window.orderBy("_at")
    turned = both.withColumn("cut", cut)
    turned = turned.withColumn("_at", F.when(F.col("node") > F.col("cut"), F.col("node") - F.col("cut")).otherwise(F.col("node") + F.lit(1 << 40)))
    turned = turned.select("*", F.sum("spilt").over(clock).alias("_out"), F.sum("taken").over(clock).alias("_in"), F.least("n", "room").alias("stay"))
    turned = turned.withColumn("offset", F.sum(F.col("stay") + F.col("taken")).over(Window.partitionBy("shard").orderBy("node")) - F.col("stay") - F.col("taken"))
    turned = turned.select("node", "shard", "stay", "spilt", "taken", "offset", (F.col("_out") - F.col("spilt")).alias("out0"), F.col("_out").alias("out1"), (F.col("_in") - F.col("taken")).alias("in0"), F.col("_in").alias("in1"))

    home = turned.where("stay > 0").select("node", F.lit(0).cast("long").alias("low"), F.col("stay").alias("high"), "shard", F.col("offset").alias("base"))
    leave = turned.where("spilt > 0").select(F.col("out1").alias("end"), F.struct("node", "stay", "out0").alias("source"), F.lit(None).cast("struct<shard:int,base:bigint,in0:bigint>").alias("goal"))
    enter = turned.where("taken > 0").select(F.col("in1").alias("end"), F.lit(None).cast("struct<node:bigint,stay:bigint,out0:bigint>").alias("source"), F.struct("shard", (F.col("offset") + F.col("stay")).alias("base"), "in0").alias("goal"))
    leave = leave.withColumn("source", F.col("source").cast("struct<node:bigint,stay:bigint,out0:bigint>"))
    enter = enter.withColumn("goal", F.col("goal").cast("struct<shard:int,base:bigint,in0:bigint>"))
    ends = leave.unionByName(enter).groupBy("end").agg(F.max("source").alias("source"), F.max("goal").alias("goal"))
    ahead = Window.orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    steps = ends.select("end", F.coalesce(F.lag("end").over(Window.orderBy("end")), F.lit(0)).alias("begin"), F.last("source", True).over(ahead).alias("source"), F.last("goal", True).over(ahead).alias("goal"))
    away = steps.select(F.col("source.node").alias("node"), (F.col("source.stay") + F.col("begin") - F.col("source.out0")).alias("low"), (F.col("source.stay") + F.col("end") - F.col("source.out0")).alias("high"), F.col("goal.shard").alias("shard"), (F.col("goal.base") + F.col("begin") - F.col("goal.in0")).alias("base"))
    return home.select(F.col("node").cast("long"), "low", "high", F.col("shard").cast("int"), "base").unionByName(away)


def assign(rows: DataFrame, keys: list[str], shards: int, slack: float = 0.0, nodes: int = 128) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``; equal ``keys`` are hashed alike.

    With ``slack`` 0 the shards' sizes differ by one row at most.  Equal rows are counted
    before they are numbered, so that no group of them meets in one task.
    """
    spark = rows.sparkSession
    columns = rows.columns
    grouped = rows.groupBy(*columns).agg(F.count("*").alias("_copies"))
    grouped = grouped.withColumn("_hash", F.xxhash64(*keys)).withColumn("cell", F.pmod("_hash", F.lit(CELLS)))
    grouped = written(grouped, "counted")
    owners = written(ring(spark, shards, nodes), "ring")
    counts = grouped.groupBy("cell").agg(F.sum("_copies").alias("n"))
    counts = written(counts, "cells")
    plan = written(moves(counts, owners, shards, slack), "moves")
    before = Window.partitionBy("node").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = owners.join(counts, "cell").select("cell", F.col("node").cast("long").alias("node"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    up_to = Window.partitionBy("cell").orderBy("_hash", *columns).rowsBetween(Window.unboundedPreceding, -1)
    ranked = grouped.withColumn("_rank", F.coalesce(F.sum("_copies").over(up_to), F.lit(0)))
    ranked = ranked.join(F.broadcast(cells), "cell")  # at most CELLS rows
    ranked = ranked.withColumn("_from", F.col("_before") + F.col("_rank")).withColumn("_to", F.col("_from") + F.col("_copies"))
    placed = ranked.join(F.broadcast(plan), "node").where("low < _to and high > _from")  # at most three rows per node
    first, last = F.greatest("low", "_from"), F.least("high", "_to")
    return placed.select(*columns, "shard", F.explode(F.sequence(F.col("base") + first - F.col("low"), F.col("base") + last - F.col("low") - 1)).alias("slot"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards whose row counts differ by one at most."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    placed = assign(rows, ["doc_id", "text_crc32"], 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
