from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from eventlab.functions import parse
from eventlab.operators import late, multistream, topn, windows
from eventlab.operators.eventtime import watermark_trace
from eventlab.operators.late import LatePolicy
from eventlab.sources import readers
from eventlab.streaming import counters, live, sinks
from eventlab.streaming.late import LiveLate
from eventlab.streaming.reconcile import LiveReconcile
from eventlab.streaming.tables import StateTable
from eventlab.streaming.timers import reconcile_with_timers
from eventlab.streaming.topn import live_top_n
from eventlab.times import Windows
from helpers import at, pair_up, utc
from test_multistream import LEFT, RIGHT, STATUS, TIMEOUT

EVENT = "seq bigint, user_id string, action string, ts timestamp"
HOUR = timedelta(hours=1)


def events(spark, n=240):
    """Events up to half an hour out of order over some hours, then one far in the future."""
    rows = [(i, f"u{i * 7 % 17:02d}", "abc"[i % 3 if i % 5 else 0], at(120_000 * i - 600_000 * (i * 7 % 4) + 3_600_000))
            for i in range(n)]
    return spark.createDataFrame([*rows, (n, "end", "end", at(10**9))], EVENT)


@pytest.fixture
def stream(spark, files):
    """The events as four files, one per micro-batch."""
    df = events(spark)
    folder = files("events", [df.filter((F.col("seq") >= a) & (F.col("seq") < b))
                              for a, b in ((0, 60), (60, 120), (120, 240), (240, 999))])
    return df, lambda: readers.stream_parquet(spark, folder, EVENT, files_per_batch=1)


def finish(query, tmp_path, mode="append"):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    sinks.run_available(query.writeStream.outputMode(mode).format("parquet").option("path", out)
                        .option("checkpointLocation", checkpoint))
    return query.sparkSession.read.parquet(out)


def test_live_visits_agree_with_the_table_form(stream, tmp_path):
    df, opened = stream
    grid = Windows(HOUR)
    got = finish(live.live_visits(opened(), "ts", "user_id", grid, HOUR, ["action"]), tmp_path)
    want = windows.window_visits(df, "ts", "user_id", grid, ["action"]).filter("action != 'end'")
    columns = ["action", "window_start", "window_end", "pv", "uv"]
    assert sorted(utc(got.select(columns))) == sorted(utc(want.select(columns)))


def test_live_windows_with_offset(stream, tmp_path):
    df, opened = stream
    grid = Windows(HOUR, offset=timedelta(minutes=30))
    got = finish(live.live_windows(opened(), "ts", grid, HOUR, [F.count(F.lit(1)).alias("n")], ["user_id"]), tmp_path)
    want = windows.window_counts(df, "ts", grid, ["user_id"]).filter("user_id != 'end'")
    assert sorted(utc(got.select(want.columns))) == sorted(utc(want))


def test_live_top_n_agrees_with_the_table_form(spark, stream, tmp_path):
    df, opened = stream
    grid = Windows(HOUR, offset=timedelta(minutes=30))
    folder = str(tmp_path / "top")
    sinks.run_available(live_top_n(opened(), "user_id", "ts", grid, HOUR, folder, str(tmp_path / "c"), k=3, min_groups=12))
    got = spark.read.parquet(f"{folder}/batch=*")
    want = topn.top_n(df, "user_id", "ts", grid, 3, 12)
    assert want.count() > 0
    assert sorted(utc(got.select(want.columns))) == sorted(utc(want))


def test_live_totals_end_at_the_table_totals(spark, stream, tmp_path):
    df, opened = stream
    last = {}

    def take(rows, batch):
        last.update({r.action: r.n for r in rows.collect()})

    totals = live.live_totals(opened(), ["action"], [F.count(F.lit(1)).alias("n")])
    sinks.run_available(sinks.to_batches(totals, take, str(tmp_path / "c"), mode="update"))
    assert last == {r.action: r["count"] for r in df.groupBy("action").count().collect()}


def test_live_watermark_goes_on_between_batches(spark, stream, tmp_path):
    df, opened = stream
    writer, out = counters.live_watermark_trace(opened(), "ts", "seq", str(tmp_path / "t"), str(tmp_path / "c"), HOUR)
    sinks.run_available(writer)
    assert sorted(utc(out.all(spark)), key=str) == sorted(utc(watermark_trace(df, "ts", "seq", HOUR)), key=str)


def test_routes_and_unions_work_on_streams(stream, tmp_path):
    df, opened = stream
    side, main = multistream.route(opened(), F.col("action") == "a")
    assert side.isStreaming and main.isStreaming
    got = finish(multistream.union_all(side, main, side), tmp_path)
    assert got.count() == df.count() + df.filter("action = 'a'").count()


@pytest.mark.parametrize("grid", [Windows(HOUR), Windows(HOUR, slide=timedelta(minutes=50))])
def test_live_late_rows_agree_row_by_row(spark, stream, tmp_path, grid):
    df, opened = stream
    policy = LatePolicy(grid, timedelta(minutes=2), timedelta(minutes=5))
    split = LiveLate(opened(), "ts", "seq", "user_id", policy, str(tmp_path / "t"))
    sinks.run_available(split.writer(str(tmp_path / "c")))
    want = late.late_rows(df, "ts", "seq", policy)
    assert want.count() > 0
    assert sorted(utc(split.late.all(spark))) == sorted(utc(want))
    visits = late.final_visits(df, "ts", "seq", "user_id", policy)
    assert sorted(utc(split.visits(spark))) == sorted(utc(visits))
    again = late.accepted_rows(df, "ts", "seq", policy).filter("seq > fire_seq").count()
    assert split.counts.all(spark).filter("refired").agg(F.sum("n")).first()[0] == again
    assert split.points.before(spark, 4).count() < 12  # closed windows have left the state


def test_a_repeated_batch_changes_nothing(spark, stream, tmp_path):
    df, opened = stream
    policy = LatePolicy(Windows(HOUR), timedelta(minutes=2), timedelta(minutes=5))
    split = LiveLate(opened(), "ts", "seq", "user_id", policy, str(tmp_path / "t"))
    first, second = df.filter("seq < 60"), df.filter("seq >= 60 AND seq < 120")
    split._split(first, 0)
    split._split(second, 1)
    once = sorted(utc(split.counts.all(spark))), sorted(utc(split.points.before(spark, 2)))
    split._split(second, 1)
    assert once == (sorted(utc(split.counts.all(spark))), sorted(utc(split.points.before(spark, 2))))


def test_state_slots_take_turns(spark, tmp_path):
    table = StateTable(str(tmp_path), "n bigint")
    assert table.before(spark, 0).count() == 0
    for batch in range(4):
        table.write(spark.range(batch).selectExpr("id AS n"), batch)
        assert table.before(spark, batch + 1).count() == batch


def order_files(spark, rows):
    end = [("end", 10**8)]
    return [spark.createDataFrame([(k, at(t))], "order_id string, ts timestamp") for k, t in [*rows, *end, ("tail", 10**8)]]


ORDER = "order_id string, ts timestamp"


@pytest.fixture
def order_streams(spark, files):
    return [readers.stream_parquet(spark, files(name, order_files(spark, rows)), ORDER, 1)
            for name, rows in (("left", LEFT), ("right", RIGHT))]


def last_status(out):
    """What is known in the end: a pair, if there is one, counts more than an earlier lone event."""
    found = {}
    for key, left, right, status in utc(out.select("key", "left_ts", "right_ts", "status")):
        if key not in ("end", "tail"):
            found.setdefault(key, []).append((left is not None and right is not None, status))
    return {key: max(statuses)[1] for key, statuses in found.items()}


@pytest.mark.parametrize("timeout", [TIMEOUT, None])
@pytest.mark.parametrize("timers", [True, False])
def test_live_reconcile(spark, order_streams, tmp_path, timeout, timers):
    left, right = order_streams
    if timers:
        out = finish(reconcile_with_timers(left, right, "order_id", "ts", timeout), tmp_path)
    else:
        pairs = LiveReconcile(left, right, "order_id", "ts", str(tmp_path / "t"), timeout)
        sinks.run_available(pairs.writer(str(tmp_path / "c")))
        out = pairs.out.all(spark)
    matched = {k: "matched" for k, s in STATUS.items() if s.startswith("matched")}
    assert last_status(out) == (matched if timeout is None else STATUS)


def test_live_reconcile_reports_each_event_once(spark, files, tmp_path):
    """Repeated keys over several batches: as the table form, but for those still waiting."""
    rows = [(i, "hot" if i % 3 else "abc"[i % 7 % 3], "left" if i * 5 % 7 < 4 else "right", i * 1000) for i in range(90)]

    def side(name):
        tables = [spark.createDataFrame([(k, at(t), q) for q, k, s, t in rows if s == name and a <= q < a + 30],
                                        "order_id string, ts timestamp, seq bigint") for a in (0, 30, 60)]
        return readers.stream_parquet(spark, files(name, tables), "order_id string, ts timestamp, seq bigint", 1)

    pairs = LiveReconcile(side("left"), side("right"), "order_id", "ts", str(tmp_path / "t"), seq="seq")
    sinks.run_available(pairs.writer(str(tmp_path / "c")))
    got = utc(pairs.out.all(spark).select("key", "left_ts", "right_ts"))
    waiting = utc(pairs.waiting.before(spark, 3).select("key", "side", "ts"))
    got += [(k, *((t, None) if s == "left" else (None, t))) for k, s, t in waiting]
    assert sorted(got, key=str) == sorted(pair_up(rows), key=str)


def test_live_reconcile_forgets_after_its_retention(spark, tmp_path):
    folder = str(tmp_path / "t")
    none = spark.createDataFrame([], ORDER)
    pairs = LiveReconcile(none, none, "order_id", "ts", folder, timedelta(seconds=10), retention=timedelta(seconds=20))

    def batch(number, *events):
        pairs._settle(spark.createDataFrame([(k, at(t * 1000), s, i) for i, (k, s, t) in enumerate(events)],
                                            "key string, ts timestamp, side string, seq bigint"), number)
        return sorted(utc(pairs.out.batch(spark, number)))

    assert batch(0, ("o", "left", 0), ("p", "left", 0), ("x", "left", 5), ("x", "right", 5)) == [("x", 5000, 5000, "matched")]
    assert batch(1, ("y", "left", 15), ("y", "right", 15)) == [
        ("o", 0, None, "left_only"), ("p", 0, None, "left_only"), ("y", 15000, 15000, "matched")]
    assert batch(2, ("o", "right", 16)) == [("o", 0, 16000, "matched_late")]
    assert batch(3, ("z", "left", 30), ("z", "right", 30)) == [("z", 30000, 30000, "matched")]
    assert pairs.waiting.before(spark, 4).count() == 0


def test_text_lines_to_events_in_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("u,show,2021-09-13 00:30:00.0\n\nv,click,2021-09-13 01:30:00\n")
    parsed = parse.parse_event(readers.stream_text_lines(spark, str(tmp_path / "in"), 1))
    assert parsed.isStreaming
    got = finish(parsed, tmp_path)
    assert sorted(utc(got.select("user_id", "ts"))) == [("u", 1631493000000), ("v", 1631496600000)]


def test_text_files_by_hour(spark, stream, tmp_path):
    df, opened = stream
    out = str(tmp_path / "files")
    writer = sinks.to_text_files(opened(), parse.format_event(), out, str(tmp_path / "c"), hour_of=F.col("ts"), rows_per_file=10)
    sinks.run_available(writer)
    back = spark.read.text(out)
    assert back.count() == df.count()
    folders = {r.bucket for r in back.select("bucket").distinct().collect()}
    assert "1970-01-01--01" in folders and len(folders) == df.select(F.date_trunc("hour", "ts")).distinct().count()
    events_again = parse.parse_event(back.select("value"))
    assert sorted(utc(events_again.select("user_id", "action", "ts"))) == sorted(utc(df.select("user_id", "action", "ts")))


def test_plain_text_files_and_restart(spark, files, tmp_path):
    df = events(spark, 20)
    folder = files("in", [df])
    write = lambda: sinks.run_available(sinks.to_text_files(
        readers.stream_parquet(spark, folder, EVENT), parse.format_tuple("user_id", "action"), str(tmp_path / "o"), str(tmp_path / "c")))
    write()
    write()  # nothing new: the checkpoint remembers what was written
    assert spark.read.text(str(tmp_path / "o")).count() == 21


def test_batches_lose_no_row(stream, tmp_path):
    df, opened = stream
    sizes = []
    sinks.run_available(sinks.to_batches(opened(), lambda rows, batch: sizes.append(rows.count()), str(tmp_path / "c")))
    assert sizes == [60, 60, 120, 1] and sum(sizes) == df.count()


def test_console_takes_labelled_rows(stream, tmp_path):
    df, opened = stream
    assert sinks.labelled(df.select("seq"), "late").first().asDict() == {"label": "late", "seq": 0}
    run = sinks.run_available(
        sinks.to_console(opened().select("seq"), "late").option("checkpointLocation", str(tmp_path / "c")))
    assert run.exception() is None and run.lastProgress["batchId"] == 3


def test_watermark_of_a_stream(stream, tmp_path):
    _, opened = stream
    query = live.live_windows(opened(), "ts", Windows(HOUR), timedelta(0), [F.count(F.lit(1)).alias("n")])
    run = sinks.run_available(query.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")))
    assert run.lastProgress["eventTime"]["watermark"] == "1970-01-12T13:46:40.000Z"


def test_sources_that_need_a_peer_are_wired(spark):
    lines = readers.stream_socket(spark, "localhost", 9)  # declared only, never started
    assert lines.isStreaming and lines.columns == ["value"]
    assert parse.parse_book(lines).columns == ["bid", "title", "writer", "gender"]
