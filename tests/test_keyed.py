"""State per key in the state store: what it gives, what it writes, and when it lets go."""

import os
import time
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventlab.operators import late, multistream, state, windows
from eventlab.operators.late import LatePolicy
from eventlab.session import use_rocksdb
from eventlab.sources import readers
from eventlab.streaming import keyed, sinks
from eventlab.streaming.join import live_window_join
from eventlab.streaming.refire import LiveRefire
from eventlab.streaming.timers import reconcile_with_timers
from eventlab.times import Windows
from helpers import at, ms, pair_up, utc
from test_streaming import EVENT, HOUR, events, finish, stream  # noqa: F401


@pytest.fixture(autouse=True)
def store(spark):
    use_rocksdb(spark)


def plain(df, *columns):
    return sorted(utc(df.select(*columns) if columns else df), key=str)


def test_running_count(stream, tmp_path):  # noqa: F811
    df, opened = stream
    got = finish(keyed.live_running_count(opened(), ["action"], "seq"), tmp_path)
    assert plain(got) == plain(state.running_count(df, ["action"], "seq"))


def test_running_count_of_null_keys_and_numbers(spark, files, tmp_path):
    tables = [spark.createDataFrame(rows, "seq string, k string") for rows in ([("1", None), (None, None), ("2", "a")], [("3", None), ("4", "a"), ("5", "b")])]
    got = finish(keyed.live_running_count(readers.stream_parquet(spark, files("in", tables), "seq string, k string", 1), ["k"], "seq"), tmp_path)
    assert plain(got) == sorted([(None, None, 1), ("1", None, 2), ("3", None, 3), ("2", "a", 1), ("4", "a", 2), ("5", "b", 1)], key=str)


def test_an_old_count_is_forgotten(spark, files, tmp_path):
    """A store that looks at the clock has something to do in every trigger, so such a stream does not end by itself."""
    rows = [spark.createDataFrame([(i, "k")], "seq bigint, k string") for i in range(2)]
    folder = files("in", rows[:1])
    counted = keyed.live_running_count(readers.stream_parquet(spark, folder, "seq bigint, k string", 1), ["k"], "seq", timedelta(milliseconds=1))
    out = str(tmp_path / "out")
    run = counted.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="500 milliseconds").start()
    try:
        for n in (1, 2):
            until = time.time() + 60
            while sum(p["numInputRows"] for p in run.recentProgress) < n and time.time() < until:
                time.sleep(0.2)
            rows[1].toPandas().to_parquet(f"{folder}/later.parquet")
    finally:
        run.stop()
    assert plain(spark.read.parquet(out)) == [(0, "k", 1), (1, "k", 1)]


@pytest.mark.parametrize("size", [1, 4, 100])
def test_groups(spark, files, tmp_path, size):
    df = spark.range(157).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 != 0, (F.col("id") % 3).cast("string")).alias("k"))
    folder = files("in", [df.filter((F.col("seq") >= a) & (F.col("seq") < b)) for a, b in ((0, 5), (5, 6), (6, 120), (120, 157))])
    got = finish(keyed.live_row_groups(readers.stream_parquet(spark, folder, "seq bigint, k string", 1), ["k"], "seq", size), tmp_path)
    full = windows.count_windows(df, ["k"], "seq", size)
    summed = got.groupBy("k", F.col("group").alias("chunk")).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    assert plain(summed) == plain(full)


@pytest.mark.parametrize("grid", [Windows(HOUR), Windows(HOUR, slide=timedelta(minutes=20))])
def test_count_across_windows(stream, tmp_path, grid):  # noqa: F811
    df, opened = stream
    got = finish(keyed.live_cross_window_count(opened(), ["action"], "ts", "seq", grid, HOUR), tmp_path)
    if grid.slide is None:
        want = state.cross_window_count(df, ["action"], "ts", "seq", grid).filter("action != 'end'")
        assert plain(got.select(want.columns)) == plain(want)
    else:  # windows that end together are numbered as they start
        assert got.groupBy("action").agg(F.max("n").alias("n"), F.count_distinct("n").alias("d"), F.count("*").alias("c")).filter("n <> d OR n <> c").isEmpty()


def test_active_users_and_an_empty_store(spark, stream, tmp_path):  # noqa: F811
    df, opened = stream
    grid = Windows(HOUR, offset=timedelta(minutes=30))
    got = finish(keyed.live_active_keys(opened(), "user_id", "ts", grid, HOUR), tmp_path)
    want = state.active_keys(df.filter("user_id <> 'end'"), "user_id", "ts", grid)
    assert plain(got) == plain(want.select("window_end", "active"))
    left = spark.read.format("statestore").option("stateVarName", "users").load(str(tmp_path / "checkpoint"))
    assert left.count() == 1  # the last row's window, which is still open


def test_many_users_take_few_entries(spark, files, tmp_path):
    """3,000 users of one window in two batches, half of them in both: a bounded number of entries, each user counted once."""
    tables = [spark.range(a, a + 2000).select(F.concat(F.lit("u"), "id").alias("user_id"), F.lit(at(1000)).alias("ts")) for a in (0, 1000)]
    end = spark.createDataFrame([("end", at(10**9))], "user_id string, ts timestamp")
    for name, batches in (("open", tables), ("closed", [*tables, end])):
        (tmp_path / name).mkdir()
        source = readers.stream_parquet(spark, files(f"{name}-in", batches), "user_id string, ts timestamp", 1)
        got = plain(finish(keyed.live_active_keys(source, "user_id", "ts", Windows(HOUR)), tmp_path / name))
        assert got == ([] if name == "open" else [(3_600_000, 3000)])
    left = spark.read.format("statestore").option("stateVarName", "users").load(str(tmp_path / "open" / "checkpoint"))
    assert left.count() <= keyed.BUCKETS


def test_refiring_windows_keep_few_entries(spark, files, tmp_path):
    """A user who comes in time, in the next batch and late is one user; 3,000 users are a bounded number of entries."""
    rows = [(i, f"u{i % 3000}", at(1000)) for i in range(4000)]
    tables = [spark.createDataFrame(x, "seq bigint, user_id string, ts timestamp") for x in (rows[:2500], rows[2500:], [(4000, "u9", at(3_600_000)), (4001, "u1", at(2000)), (4002, "new", at(2000))])]
    policy = LatePolicy(Windows(HOUR), timedelta(0), timedelta(minutes=20))
    live = LiveRefire(readers.stream_parquet(spark, files("in", tables), "seq bigint, user_id string, ts timestamp", 1), "ts", "seq", "user_id", policy, str(tmp_path / "t"))
    sinks.run_available(live.writer(str(tmp_path / "cells")))
    got = finish(live.firings(spark, files_per_batch=1), tmp_path)
    assert plain(got, "at_seq", "refired", "pv", "uv") == [(4000, False, 4000, 3000), (4001, True, 4001, 3000), (4002, True, 4002, 3001)]
    left = spark.read.format("statestore").option("stateVarName", "users").load(str(tmp_path / "checkpoint"))
    assert 0 < left.count() <= 2 * keyed.BUCKETS


def typed(spark, folder, tables, schema):
    """Rows of any type as a stream, one file and micro-batch per table."""
    for rows in tables:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return readers.stream_parquet(spark, str(folder), schema, 1)


def test_rows_of_open_windows_wait_as_tables(spark, tmp_path):
    """Numbers beyond 2^53, nulls and other types come back as they were; a window's rows wait in one entry."""
    schema = "seq bigint, action string, ts timestamp, x double, y decimal(20,3), z array<int>"
    big = 2**53
    rows = [(big + 3, "a", at(3000), 0.1, None, [1, None]), (None, "a", at(1000), None, Decimal("1.250"), None), (big + 1, None, at(2000), 1.5, None, [2]), (big + 2, "a", at(1000), None, None, [])]
    last = [(big + 9, "a", at(10**9), None, None, None), (big + 8, None, at(10**9), None, None, None)]
    source = typed(spark, tmp_path / "in", (rows[:2], rows[2:], last), schema)
    got = finish(keyed.live_cross_window_count(source, ["action"], "ts", "seq", Windows(HOUR)), tmp_path)
    assert got.columns == [*source.columns, "window_start", "window_end", "n"]
    assert [t for _, t in got.dtypes[:6]] == [f.dataType.simpleString() for f in source.schema]
    numbers = {1: rows[1], 2: rows[3], 3: rows[0]}
    assert plain(got, "action", "n", "seq", "ts", "x", "y", "z") == sorted([(None, 1, big + 1, 2000, 1.5, None, [2])] + [("a", n, r[0], ms(r[2]), r[3], r[4], r[5]) for n, r in numbers.items()], key=str)
    left = spark.read.format("statestore").option("stateVarName", "open").load(str(tmp_path / "checkpoint"))
    assert left.count() == 2 and "tables:array<binary>" in left.select("user_map_value").schema.simpleString()


def test_union_of_rows_without_a_number(spark, tmp_path):
    """Numbers beyond 2^53 and nulls in one batch: the nulls count, the smallest and largest are of the others."""
    schema, big = "seq bigint, ts timestamp", 2**53
    source = typed(spark, tmp_path / "in", ([(big + 1, at(1000)), (None, at(1000)), (big + 3, at(2000))], [(None, at(3000))]), schema)
    got = finish(keyed.live_union_watermark({"one": (source, timedelta(0))}, "ts", "seq"), tmp_path)
    assert plain(got) == sorted([("one", 3, big + 1, big + 3, None), ("one", 1, None, None, 2000)], key=str)


def test_watermark_of_a_union_with_a_late_starter(spark, files, tmp_path):
    def source(name, batches):
        return readers.stream_parquet(spark, files(name, [spark.createDataFrame([(s, at(t)) for s, t in rows], "seq bigint, ts timestamp") for rows in batches]), "seq bigint, ts timestamp", 1)

    quick = source("quick", [[(0, 1000), (1, 5000)], [(2, 6000)], [(3, 9000)], [(4, 20000)]])
    slow = source("slow", [[], [(10, 7000)], [(11, 9500)], [(12, 9600)]])
    got = finish(keyed.live_union_watermark({"quick": (quick, timedelta(0)), "slow": (slow, timedelta(seconds=2))}, "ts", "seq"), tmp_path)
    assert plain(got) == sorted([("quick", 2, 0, 1, None), ("quick", 1, 2, 2, None), ("quick", 1, 3, 3, 5000), ("quick", 1, 4, 4, 7500),
                                 ("slow", 1, 10, 10, None), ("slow", 1, 11, 11, 5000), ("slow", 1, 12, 12, 7500)], key=str)


def test_window_join_keeps_open_windows_only(spark, files, tmp_path):
    rows = [(i, f"u{i % 3}", "click" if i * 7 % 5 < 3 else "purchase", at(i * 600_000)) for i in range(300)]
    df = spark.createDataFrame([*rows, (998, "end", "click", at(10**9)), (999, "end", "purchase", at(10**9))], EVENT)
    folder = files("in", [df.filter((F.col("seq") >= a) & (F.col("seq") < a + 50)) for a in range(0, 300, 50)] + [df.filter("seq >= 998")])
    grid = Windows(HOUR)
    measures = [[F.count(F.lit(1)).alias(f"{n}s"), F.max("ts").alias(f"last_{n}")] for n in ("click", "purchase")]

    def sides(source):
        return [source.filter(F.col("action") == name) for name in ("click", "purchase")]

    opened = readers.stream_parquet(spark, folder, EVENT, 1)
    query = live_window_join(*sides(opened), ["user_id"], "ts", grid, *measures, timedelta(minutes=5))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    run = sinks.run_available(query.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint))
    got = spark.read.parquet(out)
    want = multistream.window_join(*sides(df), ["user_id"], "ts", grid, *measures).filter("user_id <> 'end'")
    assert want.count() > 50 and plain(got.select(want.columns)) == plain(want)
    rows_kept = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in run.recentProgress]
    assert rows_kept[-1] <= 4 and max(rows_kept) < 150  # three sums of a batch's windows, not all of them


@pytest.mark.parametrize("grid", [Windows(HOUR), Windows(HOUR, slide=timedelta(minutes=50))])
@pytest.mark.parametrize("lateness", [timedelta(0), timedelta(minutes=20)])
def test_refire_agrees_with_the_table_form(spark, stream, tmp_path, grid, lateness):  # noqa: F811
    df, opened = stream
    policy = LatePolicy(grid, timedelta(minutes=2), lateness)
    live = LiveRefire(opened(), "ts", "seq", "user_id", policy, str(tmp_path / "t"))
    sinks.run_available(live.writer(str(tmp_path / "cells")))
    got = finish(live.firings(spark), tmp_path)
    want = late.firings(df, "ts", "seq", "user_id", policy).filter("at_seq IS NOT NULL")
    assert want.filter("refired").count() > 0 or not lateness
    assert plain(got.select(want.columns)) == plain(want)
    visits = late.final_visits(df, "ts", "seq", "user_id", policy)
    assert plain(live.visits(spark).select(visits.columns)) == plain(visits)


def test_refire_over_batches_of_its_own_and_after_a_restart(spark, stream, tmp_path):  # noqa: F811
    df, opened = stream
    policy = LatePolicy(Windows(HOUR), timedelta(minutes=2), timedelta(minutes=20))
    live = LiveRefire(opened(), "ts", "seq", "user_id", policy, str(tmp_path / "t"))
    sinks.run_available(live.writer(str(tmp_path / "cells")))
    first = finish(live.firings(spark, files_per_batch=1), tmp_path)
    want = late.firings(df, "ts", "seq", "user_id", policy).filter("at_seq IS NOT NULL")
    assert plain(first.select(want.columns)) == plain(want)
    assert plain(finish(live.firings(spark, files_per_batch=1), tmp_path).select(want.columns)) == plain(want)  # nothing new, nothing twice


def written_by_batch(checkpoint):
    """Bytes of state files by the version they belong to."""
    sizes = {}
    for folder, _, names in os.walk(f"{checkpoint}/state"):
        for name in names:
            if name.endswith(".changelog"):
                version = int(name.split(".")[0].split("_")[0])
                sizes[version] = sizes.get(version, 0) + os.path.getsize(f"{folder}/{name}")
    return [sizes[v] for v in sorted(sizes)]


def test_a_batch_writes_what_it_touches(spark, files, tmp_path):
    """Every batch brings 400 new keys: the last one writes no more than the second."""
    tables = [spark.createDataFrame([(b * 400 + i, f"key{b * 400 + i:06d}") for i in range(400)], "seq bigint, k string") for b in range(6)]
    counted = keyed.live_running_count(readers.stream_parquet(spark, files("in", tables), "seq bigint, k string", 1), ["k"], "seq")
    finish(counted, tmp_path)
    sizes = written_by_batch(tmp_path / "checkpoint")
    assert len(sizes) >= 6 and max(sizes[1:6]) <= 1.2 * min(sizes[1:6])


def test_pairs_in_arrival_order_over_batches(spark, files, tmp_path):
    """Repeated keys: as the table form, but for the events that still wait."""
    rows = [(i, "hot" if i % 3 else "abc"[i % 7 % 3], "left" if i * 5 % 7 < 4 else "right", 1_000_000 - i * 1000) for i in range(90)]

    def side(name):
        tables = [spark.createDataFrame([(k, at(t), q) for q, k, s, t in rows if s == name and a <= q < a + 30], "order_id string, ts timestamp, seq bigint") for a in (0, 30, 60)]
        return readers.stream_parquet(spark, files(name, tables), "order_id string, ts timestamp, seq bigint", 1)

    got = utc(finish(reconcile_with_timers(side("left"), side("right"), "order_id", "ts", seq="seq"), tmp_path).select("key", "left_ts", "right_ts"))
    want = pair_up(rows)
    missing = sorted(set(want) - set(got), key=str)
    assert set(got) <= set(want) and all(None in pair for pair in missing) and len(missing) <= 4  # one waiting event per key at most


def waits_and_pairs(batches, timeout, retention):
    """What each micro-batch emits, key by key and event by event; ``batches``: lists of ``(seq, key, side, ms)``."""
    waiting, out, marks, newest = {}, [], [0, 0], {}
    for batch in [*batches, [], []]:
        emitted = []
        for seq, key, side, ms in sorted(batch, key=lambda event: event[0]):
            if timeout is not None and ms <= marks[-2]:
                continue  # behind the watermark of the batch before
            held = waiting.pop(key, None)
            if held is not None and held[0] != side:
                times = {side: ms, held[0]: held[1]}
                late = timeout is not None and abs(ms - held[1]) > timeout
                emitted.append((key, times["left"], times["right"], "matched_late" if late else "matched"))
                continue
            if held is not None and not held[2]:
                emitted.append((key, *((held[1], None) if held[0] == "left" else (None, held[1])), f"{held[0]}_only"))
            waiting[key] = (side, ms, False)
        for key, (side, ms, reported) in list(waiting.items()) if timeout is not None else ():
            if not reported and ms + timeout < marks[-1]:
                emitted.append((key, *((ms, None) if side == "left" else (None, ms)), f"{side}_only"))
                waiting[key] = (side, ms, True)
            elif reported and retention is not None and ms + retention < marks[-1]:
                del waiting[key]
        out.append(emitted)
        for _, _, side, ms in batch:
            newest[side] = max(newest.get(side, 0), ms)
        marks.append(max(marks[-1], min(newest.values())) if len(newest) == 2 else marks[-1])
    return sorted((x for emitted in out for x in emitted), key=str)


@pytest.mark.parametrize("timeout, retention", [(None, None), (4000, None), (4000, 9000)])
def test_timers_over_many_batches(spark, files, tmp_path, monkeypatch, timeout, retention):
    """Late events, repeated and null keys, events without a partner; entries of the store fill up and double."""
    from eventlab.streaming import timers

    monkeypatch.setattr(timers, "PARTS", 4)
    monkeypatch.setattr(timers, "HELD", 3)
    schema, batches = "k string, ts timestamp, seq bigint", []
    for b in range(5):
        rows = [(b * 100 + i, None if i == 77 else f"k{(i * 31 + b * 17) % 83}", "left" if i * 7 % 11 < 6 else "right", b * 3000 + i * 613 % 5000 + 10_000) for i in range(78)]
        batches.append([*rows, (b * 100 + 90, f"old{b}", "left", 9000), (b * 100 + 91, f"old{b}", "right", 9500)])

    def side(name):
        tables = [spark.createDataFrame([(k, at(ms), seq) for seq, k, s, ms in batch if s == name], schema).coalesce(1) for batch in batches]
        return readers.stream_parquet(spark, files(name, tables), schema, 1)

    span = [None if x is None else timedelta(milliseconds=x) for x in (timeout, retention)]
    got = utc(finish(reconcile_with_timers(side("left"), side("right"), "k", "ts", span[0], retention=span[1], seq="seq"), tmp_path).select("key", "left_ts", "right_ts", "status"))
    want = waits_and_pairs(batches, timeout, retention)
    assert sorted(got, key=str) == want and len(want) > 100


def test_keys_share_calls_and_state(spark, tmp_path, monkeypatch):
    """900 keys of which a third waits: a call takes many of them, and so does an entry of the store; times may be far away or missing."""
    from eventlab.streaming import timers

    monkeypatch.setattr(timers, "PARTS", 8)
    schema = "k string, ts timestamp"

    def side(name, rows):  # pandas can't write times so far away
        df = spark.createDataFrame(rows, "k string, day bigint")
        df.select("k", F.timestamp_millis(F.col("day") * 86_400_000).alias("ts")).coalesce(1).write.parquet(str(tmp_path / name))
        return readers.stream_parquet(spark, str(tmp_path / name), schema)

    sides = (side("left", [*((f"k{i}", 1) for i in range(900)), ("far", 2_900_000), ("none", None)]),
             side("right", [*((f"k{i}", 2) for i in range(600)), ("end", 2_900_000), ("none", 1)]))
    out = finish(reconcile_with_timers(*sides, "k", "ts", timedelta(days=30)), tmp_path)
    counts = {r["status"]: r["count"] for r in out.groupBy("status").count().collect()}
    assert counts == {"matched": 600, "left_only": 300, "right_only": 1}
    state = spark.read.format("statestore").option("stateVarName", "waiting").option("batchId", 0).load(str(tmp_path / "checkpoint"))
    assert 0 < state.count() <= 32  # entries, for 303 waiting events
