"""Exact top-k search against all products."""

import math
import re

import numpy as np
import pytest

from eventlab.llm import exact_topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k, every, scale=256):
    """``rows``: ``(id, vector)``; the best rows of each query, a row being one place in the list."""
    kept = []
    for key, vector in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [math.floor(scale * float(np.float32(x))) for x in vector]))
    out = []
    for i, (query, a) in enumerate(kept):
        if query is None or query % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), key is None, key or 0, key) for j, (key, b) in enumerate(kept) if j != i]
        out += [(query, n + 1, key, -s) for n, (s, _, _, key) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(key, vector, "x") for key, vector in rows], SCHEMA)
    out = exact_topk.top_k(df, **options)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def vectors(rng, count, size):
    centres = rng.standard_normal((4, size))
    body = centres[rng.integers(0, 4, count)] + rng.standard_normal((count, size)) * rng.choice([0.05, 0.6], (count, 1))
    return (body / np.linalg.norm(body, axis=1, keepdims=True)).astype(np.float32).tolist()


@pytest.mark.parametrize("slices", [1, 2, 3])
def test_all_products(spark, slices, monkeypatch):
    monkeypatch.setattr(exact_topk, "BYTES", 8 * 9 * 40)  # several tiles
    rng = np.random.default_rng(slices)
    rows = list(enumerate(vectors(rng, 150, 9)))
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # a vector with many copies, three of them queries
    rows += [(2000 + i, (-np.array(rows[3][1])).tolist()) for i in range(8)]
    assert found(spark, rows, every=10, slices=slices) == brute(rows, 5, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (50, [0.5, 0.25]), (50, [0.5, 0.25]), (50, [-0.1, 0.9]), (None, [0.5, 0.25]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, []), (100, [0.0, 0.0]), (150, [1.0]), (-50, [0.7, -0.7]), (8, [0.3, 0.3])]
    same = [(key, v if v is None or len(v) == 2 or None in v else v + [0.0] * (2 - len(v))) for key, v in rows]
    assert found(spark, rows) == brute(same, 5, 50)
    assert found(spark, []) == [] and found(spark, [(50, [1.0])]) == [] and found(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert found(spark, [(0, [1.0]), (1, [-1.0])]) == [(0, 1, 1, -65536)]


def test_large_components(spark):
    rows = [(0, [3.0e4, -7.0e5, 1.5]), (1, [4.0e5, 1.0e6, 0.25]), (2, [1.0e6, -1.0e6, 2.5]), (50, [1.0, 1.0, 1.0])]
    assert found(spark, rows) == brute(rows, 5, 50)
    assert len(found(spark, [(0, [3.0e38]), (1, [3.0e38]), (2, [-3.0e38])])) == 2


def test_cutoff_spares_most_entries(spark, monkeypatch):
    seen = []
    real = exact_topk.met

    def spied(queries, data, blocks, k):
        out = real(queries, data, blocks, k)
        seen.append(out.count())
        return out

    monkeypatch.setattr(exact_topk, "met", spied)
    rng = np.random.default_rng(5)
    rows = list(enumerate(vectors(rng, 2000, 32)))
    assert found(spark, rows, every=100) == brute(rows, 5, 100)
    assert seen[1] < 0.6 * 20 * 2000 * 2


def test_tables_of_vectors_stay_out_of_the_driver(spark, monkeypatch):
    """All of them are small enough to be sent to all tasks; only a number per query is."""
    monkeypatch.setattr(exact_topk, "BYTES", 8 * 8 * 20)
    plans, real = [], exact_topk.written

    def spied(df, name):
        plans.append(df)
        return real(df, name)

    monkeypatch.setattr(exact_topk, "written", spied)
    rows = list(enumerate(vectors(np.random.default_rng(3), 90, 8)))
    df = spark.createDataFrame([(key, vector, "x") for key, vector in rows], SCHEMA)
    plans.append(exact_topk.top_k(df, every=5))
    sent = [line for x in plans for line in x._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin" in line]
    assert all(re.search(r"BroadcastHashJoin \[query#\d+L\], \[query#\d+L\], (Inner|LeftOuter)", x) for x in sent) and len(sent) <= 3
    joins = [x for x in plans if "SortMergeJoin" in x._jdf.queryExecution().executedPlan().toString()]
    assert len(joins) >= 4


def test_numbers_of_tiles():
    for least, most, size in ((-3, 90, 2), (-(1 << 15), (1 << 15) - 1, 2), (0, 1 << 15, 4), (-(1 << 31) - 1, 0, 8), (-(1 << 62), 1 << 62, 8)):
        numbers = np.array([[least, 0, most], [most, least, 1]], "<i8")
        assert len(exact_topk.narrow(numbers)) == 6 * size and (exact_topk.widened(exact_topk.narrow(numbers), 2, 3) == numbers).all()


def test_query(spark, tmp_path):
    rows = list(enumerate(vectors(np.random.default_rng(9), 120, 8)))
    spark.createDataFrame([(k, v, "x") for k, v in rows], SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert sorted((tuple(r) for r in exact_topk.op11_exact_topk(spark, str(tmp_path)).collect()), key=str) == brute(rows, 5, 50)


@pytest.mark.parametrize("name", ["op10_embedding_dedup", "op11_exact_topk", "op13_merkle_manifest"])
def test_same_rows_as_sql(spark, name):
    import check
    import duckdb

    from eventlab.llm.queries import QUERIES, SQL

    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    assert check.rows_of(QUERIES[name](spark, folder).toPandas()) == check.rows_of(duck.sql(SQL[name]).df())
