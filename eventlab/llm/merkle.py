"""Merkle manifest of a table: leaves, subtree roots, a root, and a proof for every row.

A leaf is the digest of a row's columns.  The rows of each ``lang`` are numbered by id, and
every two consecutive nodes become the digest of their hex digests (an odd last one: of its
own), until one node is left, the subroot.  The subroots, in order of ``lang``, make the root
in the same way.

The built levels are stored as node rows that link to a node above, with the siblings on the
way there.  A row spans ``STRIDE`` levels, so a climb from a leaf to the root takes a join for
every ``STRIDE`` levels, and no more shuffles; with a stride of one every level has rows of its
own.  A recursive SQL query starts at the node rows of all leaves and climbs from link to link,
appending the siblings to the proof and folding the leaf's digest with them.  A node high up is
met by many leaves, so its row is stored once per 2^``RUN`` leaves below it, and the join key
holds the run.  Levels are built in blocks of 2^``STRIDE`` nodes, so that no task holds more.

Null columns count as ``-`` and a null ``lang`` is a tree of its own, the first one.  Rows
without an id come first in their tree, and rows with equal ids are ordered by their leaves.
Texts of any length are read whole.  An empty table gives no rows.  Other columns are neither
read nor covered by a leaf.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlab.llm.common import table, within, written

#: Levels that a node row spans, and leaves that share a copy of a node row, as powers of two.
STRIDE, RUN = 12, 8
STEP = pa.struct([("left", pa.binary()), ("right", pa.binary())])
#: What :func:`spanned` adds to the columns ``tree, pos, digest, lo, hi`` and others.
ADDED = "above binary, path array<struct<left:binary,right:binary>>, above_hi long"


def parent(parts: list[bytes]) -> bytes:
    """The digest of some digests' hex texts, end to end."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def spanned(rows: pa.Table, stride: int) -> pa.Table:
    """The node rows of one block: up to 2^stride consecutive nodes of a tree."""
    rows = rows.sort_by("pos")
    digests, tree, block = rows["digest"].to_pylist(), rows["tree"][0].as_py(), rows["pos"][0].as_py() >> stride
    # A first block that is not full is the whole tree, which ends where one node is left.
    levels = stride if block or len(digests) == 1 << stride else (len(digests) - 1).bit_length()
    paths: list[list[tuple[bytes, bytes]]] = [[] for _ in digests]
    now = digests
    for level in range(levels):
        for i, path in enumerate(paths):
            at = i >> level
            path.append((now[at - 1], b"") if at % 2 else (b"", now[at + 1] if at + 1 < len(now) else b""))
        now = [parent(now[i:i + 2]) for i in range(0, len(now), 2)]
    count, last = len(digests), max(rows["hi"].to_pylist())
    steps = [[{"left": a, "right": b} for a, b in path] for path in paths]
    added = {"above": pa.array(now * count, pa.binary()), "path": pa.array(steps, pa.list_(STEP)), "above_hi": pa.array([last] * count, pa.int64())}
    for name, values in added.items():
        rows = rows.append_column(name, values)
    return rows


def stored(column: str | Column) -> Column:
    """A value as it enters a leaf: its length in bytes and its text, or a dash."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, one_in: int) -> DataFrame:
    """``doc_id, tree, leaf, altered``: the digest of each row, and the one it has after tampering."""
    def digest(n_chars: Column) -> Column:
        return F.unhex(F.sha2(F.concat(stored("doc_id"), stored("source"), stored("lang"), stored(n_chars), stored("text")), 256))

    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % one_in == 0) & F.col("n_chars").isNotNull()
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return docs.select("doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), digest(F.col("n_chars")).alias("leaf"), F.when(hit, digest(more)).alias("altered"))


def tier_of(nodes: DataFrame, stride: int, number: int) -> DataFrame:
    """The node rows of one tier, from its nodes (``tree, pos, digest, lo, hi`` and others)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    rows = nodes.groupBy("tree", F.shiftright("pos", stride)).applyInArrow(lambda some: spanned(some, stride), f"{schema}, {ADDED}")
    return written(rows.withColumn("tier", F.lit(number)), "nodes")


def above(rows: DataFrame, stride: int) -> DataFrame:
    """The nodes that the rows of a tier link to."""
    first = rows.where(F.col("pos") % (1 << stride) == 0)
    return first.select("tree", F.shiftright("pos", stride).alias("pos"), F.col("above").alias("digest"), "lo", F.col("above_hi").alias("hi"))


def built(nodes: DataFrame, stride: int, number: int) -> tuple[list[DataFrame], DataFrame]:
    """All tiers from ``nodes`` on, numbered from ``number``, and the one node of each tree they end in."""
    tiers = []
    while True:
        tiers.append(tier_of(nodes, stride, number + len(tiers)))
        nodes = above(tiers[-1], stride)
        if nodes.where(F.col("pos") > 0).isEmpty():
            return tiers, nodes


def linked(rows: DataFrame, run: int) -> DataFrame:
    """Node rows with their links, one copy for each run of leaves below."""
    runs = F.sequence(F.shiftright("lo", run), F.shiftright("hi", run))
    return rows.select("tier", "tree", "pos", "digest", "path", "up_tree", "up_pos", F.explode(runs).alias("run"))


def climb_sql(leaves_of: str, nodes: str, stride: int, run: int, subroots: int, last: int) -> str:
    """The recursive query over two written tables; ``subroots`` is the tier whose nodes are subroots, ``last`` that beyond the root."""
    proof = "aggregate({0}.path, {1}, (s, x) -> concat(s, x.left, x.right))"
    fold = "aggregate({0}.path, {1}, (s, x) -> unhex(sha2(lower(hex(concat(x.left, s, x.right))), 256)))"
    return f"""WITH RECURSIVE climb(doc_id, leaf, run, tier, tree, pos, proof, folded, subroot) AS (
  SELECT doc_id, digest, shiftright(pos, {run}), 1, tree, shiftright(pos, {stride}), {proof.format('l', "CAST(X'' AS BINARY)")}, {fold.format('l', 'coalesce(altered, digest)')}, CAST(NULL AS BINARY)
  FROM {leaves_of} l
  UNION ALL
  SELECT c.doc_id, c.leaf, c.run, n.tier + 1, n.up_tree, n.up_pos, {proof.format('n', 'c.proof')}, {fold.format('n', 'c.folded')},
         CASE WHEN n.tier = {subroots} THEN n.digest ELSE c.subroot END
  FROM climb c JOIN {nodes} n ON c.tier = n.tier AND c.tree = n.tree AND c.pos = n.pos AND c.run = n.run WHERE c.tier < {last})"""


def manifest(docs: DataFrame, stride: int = STRIDE, run: int = RUN, one_in: int = 7) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Where ``one_in`` divides the checksum of an id, the climb starts from the digest of the row
    with one added to ``n_chars``, and ends at another root.
    """
    spark = docs.sparkSession
    numbered = within(leaves(docs, one_in), ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "pos")
    nodes = numbered.select("doc_id", "altered", "tree", "pos", F.col("leaf").alias("digest"), F.col("pos").alias("lo"), F.col("pos").alias("hi"))
    (of_leaves, *below), subroots = built(nodes, stride, 0)
    # The subroots are nodes of one more tree; its first tier keeps the names of their own trees for the links from below.
    first = 1 + len(below)
    named = written(within(subroots.drop("pos"), [], [F.col("tree")], "pos"), "subroots")
    (start, *rest), root = built(named.withColumns({"own": F.col("tree"), "tree": F.lit("")}), stride, first)
    last = first + 1 + len(rest)
    up = {"up_tree": F.col("tree"), "up_pos": F.shiftright("pos", stride)}
    rows = [x.withColumns(up) for x in (*below, *rest)] + [start.withColumns(up).withColumns({"tree": F.col("own"), "pos": F.lit(0).cast("long")})]
    links = written(reduce(DataFrame.unionByName, [linked(x, run) for x in rows]), "links")
    top = root.select(F.lower(F.hex("digest"))).first()  # one row, none if the table is empty
    of_leaves.createOrReplaceTempView("merkle_leaves")
    links.createOrReplaceTempView("merkle_links")
    limit = "spark.sql.cteRecursionRowLimit"  # a million rows unless it is lifted
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        ended = spark.sql(f"{climb_sql('merkle_leaves', 'merkle_links', stride, run, first, last)} SELECT doc_id, leaf, subroot, proof, folded FROM climb WHERE tier = {last}")
        hexed = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "folded")]
        ended = written(ended.select("doc_id", *hexed, F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256")), "climbed")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
        for view in ("merkle_leaves", "merkle_links"):
            spark.catalog.dropTempView(view)
    known = F.lit(top[0] if top else None).cast("string")
    return ended.select("doc_id", "leaf", "subroot", known.alias("root"), "proof_sha256", F.col("folded").alias("folded_root"), (F.col("folded") == known).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with the proof of each checked."""
    return manifest(table(spark, sf_dir, "documents"))
