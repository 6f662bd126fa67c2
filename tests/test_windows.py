from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from eventlab.operators import topn, windows
from eventlab.times import Windows
from helpers import at, numbers, utc

SECONDS = lambda n: timedelta(seconds=n)


def contents(df, grid, bucket=1 << 18):
    out = windows.window_contents(df, "ts", "seq", grid, bucket=bucket)
    found = {}
    for start, end, position, time in sorted(utc(out.select("window_start", "window_end", "position", "ts"))):
        found.setdefault((start, end), []).append(time)
        assert position == len(found[start, end])
    return found


@pytest.mark.parametrize("bucket", [2, 1 << 18])
def test_tumbling_windows_with_offset(spark, bucket):
    df = numbers(spark, [i * 1000 for i in range(1, 8)])
    assert contents(df, Windows(SECONDS(3), offset=SECONDS(1)), bucket) == {
        (1000, 4000): [1000, 2000, 3000], (4000, 7000): [4000, 5000, 6000], (7000, 10000): [7000]}
    assert contents(df, Windows(SECONDS(3)), bucket) == {
        (0, 3000): [1000, 2000], (3000, 6000): [3000, 4000, 5000], (6000, 9000): [6000, 7000]}


def test_sliding_windows_share_rows(spark):
    df = numbers(spark, [i * 1000 for i in range(1, 8)])
    assert contents(df, Windows(SECONDS(3), slide=SECONDS(2))) == {
        (0, 3000): [1000, 2000], (2000, 5000): [2000, 3000, 4000], (4000, 7000): [4000, 5000, 6000],
        (6000, 9000): [6000, 7000]}


def test_border_time_opens_the_next_window(spark):
    df = numbers(spark, [2999, 3000])
    assert contents(df, Windows(SECONDS(3))) == {(0, 3000): [2999], (3000, 6000): [3000]}


def test_grid_numbers_match_window_starts(spark):
    grid = Windows(timedelta(hours=1), offset=timedelta(minutes=30))
    df = numbers(spark, [-5_400_000, -1, 0, 1_799_999, 1_800_000, 10**12])
    out = grid.assign(df, "ts").withColumn("same", grid.start(grid.index(F.col("ts"))) == F.col("window_start"))
    assert out.filter("same").count() == 6


def actions(spark):
    rows = [("huawei", a, at(10001 + i), i) for i, a in enumerate(["show", "click", "begin", "read", "close"])]
    return spark.createDataFrame(rows, "user_id string, action string, ts timestamp, seq bigint")


def test_concat_in_arrival_order(spark):
    out = windows.window_concat(actions(spark), "ts", "seq", "action", Windows(SECONDS(4)), ["user_id"], rows_per_part=100)
    assert utc(out.select("user_id", "window_start", "window_end", "ts", "part", "action")) == [
        ("huawei", 8000, 12000, 10001, 0, "show click begin read close")]


def test_long_concat_goes_on_in_parts(spark):
    out = windows.window_concat(actions(spark), "ts", "seq", "action", Windows(SECONDS(4)), ["user_id"], rows_per_part=2)
    assert sorted((r.part, r.n, r.action) for r in out.collect()) == [
        (0, 2, "show click"), (1, 2, "begin read"), (2, 1, "close")]


def test_a_very_long_window_keeps_its_order(spark):
    df = spark.range(2000).selectExpr("id AS seq", "timestamp_millis(id) AS ts", "CAST(id AS STRING) AS action").repartition(4)
    out = windows.window_concat(df, "ts", "seq", "action", Windows(SECONDS(4)), rows_per_part=10)
    found = sorted((r.part, r.n, r.action) for r in out.collect())
    assert [n for _, n, _ in found] == [10] * 200
    assert " ".join(text for _, _, text in found) == " ".join(map(str, range(2000)))


def test_pieces_of_a_short_window_are_joined(spark):
    # Parts are counted from the window's first row, whatever its number; nulls leave no gap.
    rows = [("u", None if i == 12 else f"a{i}", at(i), i) for i in range(7, 13)]
    df = spark.createDataFrame(rows, "user_id string, action string, ts timestamp, seq bigint").repartition(3)
    out = windows.window_concat(df, "ts", "seq", "action", Windows(SECONDS(4)), ["user_id"], rows_per_part=10)
    assert utc(out.select("part", "n", "ts", "action")) == [(0, 6, 7, "a7 a8 a9 a10 a11")]


def test_visits(spark):
    rows = [("a", "x", 0), ("a", "x", 1), ("b", "x", 2), ("a", "y", 3), ("a", "x", 5000)]
    df = spark.createDataFrame([(u, a, at(t)) for u, a, t in rows], "user_id string, action string, ts timestamp")
    grid = Windows(SECONDS(4))
    assert sorted(utc(windows.window_visits(df, "ts", "user_id", grid).select("window_start", "pv", "uv"))) == [
        (0, 4, 2), (4000, 1, 1)]
    keyed = windows.window_visits(df, "ts", "user_id", grid, ["action"])
    assert sorted(utc(keyed.select("action", "window_start", "pv", "uv"))) == [
        ("x", 0, 3, 2), ("x", 4000, 1, 1), ("y", 0, 1, 1)]
    approx = windows.window_visits(df, "ts", "user_id", grid, approx=True)
    assert sorted(utc(approx.select("window_start", "uv"))) == [(0, 2), (4000, 1)]


def crowd(spark, users, window=0):
    rows = [(f"u{i:02d}", at(window * 3_600_000 + j)) for i in range(users) for j in range(1 + i % 4)]
    return spark.createDataFrame(rows, "user_id string, ts timestamp")


@pytest.mark.parametrize("users, rows", [(11, 0), (12, 10), (30, 10)])
def test_top_n_needs_enough_users(spark, users, rows):
    assert topn.top_n(crowd(spark, users), "user_id", "ts", Windows(timedelta(hours=1))).count() == rows


def test_top_n_order_and_ties(spark):
    df = crowd(spark, 12).unionByName(crowd(spark, 5, window=1))
    out = topn.top_n(df, "user_id", "ts", Windows(timedelta(hours=1)), k=4)
    assert [(r["rank"], r.user_id, r.n) for r in out.orderBy("rank").collect()] == [
        (1, "u03", 4), (2, "u07", 4), (3, "u11", 4), (4, "u02", 3)]
    assert topn.top_n(df, "user_id", "ts", Windows(timedelta(hours=1)), k=4, min_groups=1).count() == 8


def test_sketches_stay_near_the_exact_count(spark):
    df = spark.range(60_000).select((F.col("id") % 7919).cast("string").alias("user_id"), F.timestamp_millis(F.col("id") * 1000).alias("ts"), (F.col("id") % 2).alias("k"))
    grid = Windows(timedelta(hours=3), slide=timedelta(hours=2))
    exact = {(r.k, r.window_start): (r.pv, r.uv) for r in windows.window_visits(df, "ts", "user_id", grid, ["k"]).collect()}
    sketches = windows.window_sketches(df, "ts", "user_id", grid, ["k"])
    got = {(r.k, r.window_start): (r.pv, r.uv) for r in sketches.collect()}
    assert got.keys() == exact.keys() and all(got[w][0] == exact[w][0] and abs(got[w][1] - exact[w][1]) <= 0.05 * exact[w][1] for w in exact)
    approx = {(r.k, r.window_start): (r.pv, r.uv) for r in windows.window_visits(df, "ts", "user_id", grid, ["k"], approx=True).collect()}
    assert approx == got
    whole = sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch"))).first()[0]
    assert abs(whole - 7919) <= 0.05 * 7919
    assert windows.window_sketches(df.limit(0), "ts", "user_id", grid).count() == 0
    nobody = windows.window_sketches(df.limit(5).withColumn("user_id", F.lit(None).cast("string")), "ts", "user_id", Windows(timedelta(hours=1))).first()
    assert (nobody.pv, nobody.uv) == (5, 0)
