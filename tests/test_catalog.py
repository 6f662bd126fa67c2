"""Every registered query against its SQL twin on the smallest given tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import check
from __spark_entry__ import entry, oracle_sql, queries
from eventlab.plans import live
from eventlab.plans.catalog import CATALOG as QUERIES
from eventlab.plans.oracle import ORACLE
from eventlab.streaming import keyed, sinks

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.rows_of(got) == check.rows_of(want)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_staged_tables_come_in_many_batches(spark):
    home = live.folder(spark)
    stream = live.events(spark, SF_DIR, home)
    run = sinks.run_available(stream.writeStream.format("noop").option("checkpointLocation", f"{home}/checkpoint"))
    assert sum(p["numInputRows"] > 0 for p in run.recentProgress) == live.FILES


def test_a_portion_is_several_files(spark):
    """Portions of 4 files, the one without rows and the small ones, too; empty ones first; rows without a number last."""
    home = live.folder(spark)
    kept = F.when(F.col("id") < 397, F.when((F.col("id") < 100) | (F.col("id") >= 200), F.col("id")))
    df = spark.range(400).select(kept.alias("seq"), F.col("id").alias("x"))
    stream = live.staged(spark, df, "seq", home, "in", files=4, empty=2, rows=25)
    seen = []
    sinks.run_available(sinks.to_batches(stream, lambda batch, i: seen.append(sorted(r.x for r in batch.collect())), f"{home}/checkpoint"))
    low, high = df.agg(F.min("seq"), F.max("seq")).first()
    want = [[] for _ in range(6)]
    for seq, x in df.collect():
        want[2 + (3 if seq is None else (seq - low) * 4 // (high - low + 1))].append(x)
    assert seen == [sorted(x) for x in want]
    assert len(spark.read.parquet(f"{home}/in").inputFiles()) == 6 * 4


def test_a_stream_keeps_two_parts_of_state_a_core(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        home = live.folder(spark)
        out = live.written(keyed.live_running_count(live.events(spark, SF_DIR, home), ["action"], "seq"), home)
        assert out.count() == 1000 and spark.conf.get("spark.sql.shuffle.partitions") == "64"
        parts = spark.read.format("state-metadata").load(f"{home}/checkpoint").select("numPartitions").first()[0]
        assert parts == 2 * spark.sparkContext.defaultParallelism == 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_entry(spark):
    assert entry(spark).columns == ["action", "pv", "uv", "window_start", "window_end"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("live_", "text_"))])
def test_no_python_and_no_cross_join_in_table_queries(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for part in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert part not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["filter_action"](spark, SF_DIR))
    assert "EqualTo(event_type,view)" in plan and "props" not in plan and "value" not in plan
    plan = plan_of(QUERIES["window_all_counts"](spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_top_n_ranks_before_the_shuffle_and_counts_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(QUERIES["topn_two_stage"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "row_number(), 10, Partial" in plan and "ReusedExchange" in plan
    assert plan.count("FileScan") == 1
