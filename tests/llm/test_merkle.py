"""The Merkle manifest against a plain build and plain proofs."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from eventlab.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, leaf int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, text, lang, source, n_chars = row[:5]
    values = [doc_id, source, lang, None if n_chars is None else n_chars + more, text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(levels, at):
    """``(left, right)`` texts of each level below the last."""
    for level in levels[:-1]:
        run = level[at - at % 2:at - at % 2 + 2]
        yield ("".join(run[:at % 2]), "".join(run[at % 2 + 1:]))
        at //= 2


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    levels = {name: levels_of([leaf_of(r) for r in trees[name]]) for name in names}
    top = levels_of([levels[name][-1][0] for name in names])
    out = []
    for number, name in enumerate(names):
        for at, row in enumerate(trees[name]):
            path = [*siblings(levels[name], at), *siblings(top, number)]
            hit = row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf_of(row, int(hit))
            for left, right in path:
                folded = h(left, folded, right)
            out.append((row[0], leaf_of(row), levels[name][-1][0], top[-1][0], h(*(a + b for a, b in path)), folded, not hit))
    return sorted(out, key=str)


def found(spark, rows, **options):
    out = merkle.manifest(spark.createDataFrame(rows, SCHEMA), **options)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def rows_of(sizes):
    rows, doc = [], 0
    for lang, count in sizes.items():
        for _ in range(count):
            doc += 1
            rows.append((doc * 7919 % 10007, f"text {doc} é" * (doc % 3), lang, None if doc % 5 == 0 else "s", None if doc % 11 == 0 else doc, "x", 1))
    return rows


@pytest.mark.parametrize("stride,run", [(1, 0), (3, 1), (12, 8)])
def test_small_trees(spark, stride, run):
    rows = rows_of({None: 1, "de": 4, "é": 5, "": 3, "zz": 9, "z": 17})
    assert found(spark, rows, stride=stride, run=run) == brute(rows)


def test_more_trees_and_rows_than_a_block(spark):
    rows = rows_of({**{f"l{i}": 1 + i % 3 for i in range(11)}, "hot": 300, "en": 64})
    assert found(spark, rows, stride=3, run=4) == brute(rows)


def test_odd_rows(spark):
    long_text = "word " * 200_000
    rows = [(None, None, None, None, None, None, None), (None, "a", "en", None, 1, "t", 2), (None, "b", "en", None, 1, "t", 2), (5, "a", "en", "s", 3, "t", 2), (5, "a", "en", "s", 3, "t", 2),
            (5, "b", "en", "s", 3, "t", 2), (-14, "", "", "", (1 << 63) - 1, "t", 2), (21, long_text, "en", "s", 0, "t", 2)]
    rows += [(k, "x", "en", "s", (1 << 63) - 1, "t", 2) for k in range(100, 120)]
    got = found(spark, rows)
    assert got == brute(rows) and 0 < sum(not r[6] for r in got) < len(got)
    assert found(spark, []) == []
    assert found(spark, rows[3:4]) == brute(rows[3:4])


def test_stored_nodes_are_linked(spark):
    nodes = spark.range(70).select(F.lit("=en").alias("tree"), F.col("id").alias("pos"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.col("id").alias("lo"), F.col("id").alias("hi"))
    tiers, root = merkle.built(nodes, 2, 0)
    assert len(tiers) == 4 and root.count() == 1
    below = {(r.tier, r.pos): r for rows in tiers for r in rows.collect()}
    assert all((t + 1, p >> 2) in below for t, p in below if t < 3)
    assert all(below[t + 1, p >> 2].digest == r.above for (t, p), r in below.items() if t < 3)
    assert all(r.above == root.first().digest for (t, _), r in below.items() if t == 3)


def test_session_setting_comes_back(spark):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "123")
    try:
        found(spark, rows_of({"en": 3}))
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "123"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("merkle")]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) + ("x", 1) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert sorted((tuple(r) for r in merkle.op13_merkle_manifest(spark, folder).collect()), key=str) == brute(rows)
