"""Every operator applied to the given tables, by query name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlab.functions import parse
from eventlab.operators import aggregates, eventtime, late, multistream, state, topn, windows
from eventlab.plans import live, tables
from eventlab.session import state_tasks
from eventlab.sources import readers
from eventlab.streaming import counters, keyed, sinks
from eventlab.streaming.groups import RowGroups
from eventlab.streaming.join import live_window_join as join_windows
from eventlab.streaming.late import LiveLate
from eventlab.streaming.live import live_totals as totals_of
from eventlab.streaming.live import live_visits
from eventlab.streaming.reconcile import LiveReconcile
from eventlab.streaming.refire import LiveRefire
from eventlab.streaming.tables import OutputTable
from eventlab.streaming.timers import reconcile_with_timers
from eventlab.streaming.topn import live_top_n, live_top_n_chained
from eventlab.times import Windows

Query = Callable[[SparkSession, str], DataFrame]

MONTH = Windows(timedelta(hours=720))
DAY = Windows(timedelta(hours=24))
TEN_HOURS = Windows(timedelta(hours=10))
HOUR = Windows(timedelta(hours=1))
HALF_PAST = Windows(timedelta(hours=1), offset=timedelta(minutes=30))
THREE_EVERY_TWO = Windows(timedelta(hours=3), slide=timedelta(hours=2))
LATE = late.LatePolicy(HOUR, delay=timedelta(hours=2), lateness=timedelta(minutes=30))
LATE_SLIDING = late.LatePolicy(THREE_EVERY_TWO, delay=timedelta(hours=2), lateness=timedelta(minutes=30))
SOURCE_DELAYS = {"reader": timedelta(0), "other": timedelta(minutes=15)}

CATALOG: dict[str, Query] = {}


def query(function: Query) -> Query:
    CATALOG[function.__name__] = lambda spark, sf_dir: tables.naive(function(spark, sf_dir))
    return function


# Text, parsing, filters


@query
def word_count(spark, d):
    return aggregates.word_counts(parse.words_of(parse.lines_of(tables.table(spark, d, "documents"), "text")))


@query
def parse_event(spark, d):
    return parse.parse_event(tables.event_lines(spark, d))


@query
def parse_wide_event(spark, d):
    return parse.parse_wide_event(tables.wide_event_lines(spark, d))


@query
def parse_book(spark, d):
    return parse.parse_book(tables.book_lines(spark, d)).drop("seq")


@query
def parse_number(spark, d):
    text = tables.table(spark, d, "events").select("event_id", F.concat_ws("", F.col("user_id"), "event_type").alias("a"),
                                                   F.col("user_id").cast("string").alias("b"))
    return text.select("event_id", parse.parse_number(F.col("a")).alias("no_number"),
                       parse.parse_number(F.col("b")).alias("number"))


@query
def kafka_decode(spark, d):
    records = tables.book_lines(spark, d).select(F.lit(None).cast("binary").alias("key"),
                                                 F.col("value").cast("binary").alias("value"),
                                                 F.col("seq").alias("offset"))
    return parse.parse_book(readers.decode_kafka(records)).select("offset", "bid", "title", "writer", "gender")


@query
def format_event(spark, d):
    return tables.events(spark, d).select("seq", parse.format_event().alias("line"))


@query
def format_user_count(spark, d):
    counts = windows.window_counts(tables.events(spark, d), "ts", DAY, ["user_id"])
    return counts.select(parse.format_user_count().alias("line"))


@query
def filter_action(spark, d):
    return tables.events(spark, d).filter(F.col("action") == "view")


# Grouped aggregates


def books(spark, d):
    return parse.parse_book(tables.book_lines(spark, d), count=True)


@query
def group_sum(spark, d):
    return aggregates.group_sum(books(spark, d), ["gender"], "n")


@query
def rolling_sum(spark, d):
    return aggregates.rolling_sum(books(spark, d), ["gender"], "seq", "n")


@query
def arg_max(spark, d):
    return aggregates.arg_max(books(spark, d), "bid", "seq")


@query
def rolling_arg_max(spark, d):
    return aggregates.rolling_arg_max(books(spark, d).drop("n"), "bid", "seq")


@query
def max_keep_first(spark, d):
    return aggregates.max_keep_first(books(spark, d), "bid", "seq")


@query
def rolling_max(spark, d):
    return aggregates.rolling_max(books(spark, d).drop("n"), "bid", "seq")


@query
def keyed_reduce(spark, d):
    value = F.struct("bid", "title", "writer", "n")
    out = aggregates.reduce_in_order(
        books(spark, d), ["gender"], "seq", value,
        lambda base, item: F.struct(base["bid"].alias("bid"), base["title"].alias("title"),
                                    base["writer"].alias("writer"), (base["n"] + item["n"]).alias("n")))
    return out.select("gender", "value.*")


@query
def rolling_reduce(spark, d):
    """Each event is a map x -> a x + b modulo 1009; the user's maps so far, one after another."""
    a, b = F.pmod("seq", F.lit(1008)) + 1, F.pmod(F.length("action") * F.col("seq"), F.lit(1009))
    out = aggregates.rolling_reduce(
        tables.events(spark, d), ["user_id"], "seq", F.struct(a.alias("a"), b.alias("b")),
        lambda first, then: F.struct((first["a"] * then["a"] % 1009).alias("a"), ((then["a"] * first["b"] + then["b"]) % 1009).alias("b")), "map", run=8)
    return out.select("user_id", "seq", "map.a", "map.b")


@query
def keyed_sum(spark, d):
    return aggregates.reduce_any_order(books(spark, d), ["gender"], "seq", ["bid", "title", "writer"], ["n"])


# Windows


@query
def uv_pv(spark, d):
    return windows.window_visits(tables.events(spark, d), "ts", "user_id", MONTH)


@query
def uv_pv_by_action(spark, d):
    return windows.window_visits(tables.events(spark, d), "ts", "user_id", MONTH, ["action"])


@query
def user_window_counts(spark, d):
    return windows.window_counts(tables.events(spark, d), "ts", DAY, ["user_id"])


@query
def offset_window_counts(spark, d):
    return windows.window_counts(tables.events(spark, d), "ts", HALF_PAST, ["user_id"])


@query
def window_all_counts(spark, d):
    return windows.window_counts(tables.events(spark, d), "ts", HOUR)


@query
def sliding_counts(spark, d):
    return windows.window_counts(tables.events(spark, d), "ts", THREE_EVERY_TWO)


@query
def sliding_sketches(spark, d):
    """Estimated visitors of overlapping windows, held against the exact count: within three standard errors, and at most one off below 20."""
    events = tables.events(spark, d)
    estimated = windows.window_sketches(events, "ts", "user_id", THREE_EVERY_TWO).select("window_start", F.col("uv").alias("estimate"))
    exact = windows.window_visits(events, "ts", "user_id", THREE_EVERY_TWO)
    close = F.abs(F.col("estimate") - F.col("uv")) <= F.greatest(F.lit(1), F.lit(3 * 1.04 / 64) * F.col("uv"))
    return exact.join(estimated, "window_start").select("window_start", "window_end", "pv", "uv", close.alias("close"))


@query
def window_concat(spark, d):
    return windows.window_concat(tables.events(spark, d), "ts", "seq", "action", DAY, ["user_id"], rows_per_part=3)


@query
def window_contents(spark, d):
    return windows.window_contents(tables.events(spark, d), "ts", "seq", THREE_EVERY_TWO)


@query
def count_window(spark, d):
    return windows.count_windows(tables.events(spark, d), ["action"], "seq", 2)


@query
def batch_chunks(spark, d):
    return windows.chunk_summary(tables.events(spark, d), ["user_id"], "seq", 2)


# Counters


@query
def running_count(spark, d):
    return state.running_count(tables.events(spark, d), ["action"], "seq")


@query
def cross_window_count(spark, d):
    return state.cross_window_count(tables.events(spark, d), ["action"], "ts", "seq", HOUR)


@query
def in_window_count(spark, d):
    return state.in_window_count(tables.events(spark, d), ["action"], "ts", "seq", HOUR)


@query
def window_and_cumulative(spark, d):
    return state.window_and_cumulative(tables.events(spark, d), ["action"], "ts", HOUR)


@query
def active_users_per_window(spark, d):
    return state.active_keys(tables.events(spark, d), "user_id", "ts", HALF_PAST)


@query
def topn_window_all(spark, d):
    return topn.top_n(tables.events(spark, d), "user_id", "ts", TEN_HOURS)


@query
def topn_two_stage(spark, d):
    return topn.top_n(tables.events(spark, d), "user_id", "ts", HALF_PAST)


# Watermarks and late rows


@query
def watermark_trace(spark, d):
    return eventtime.watermark_trace(tables.disordered_events(spark, d), "ts", "seq", timedelta(minutes=15)) \
        .select("seq", "ts", "watermark")


@query
def monotonic_watermark(spark, d):
    return eventtime.watermark_trace(tables.events(spark, d), "ts", "seq").select("seq", "ts", "watermark")


@query
def union_watermark(spark, d):
    both = tables.disordered_events(spark, d).withColumn(
        "source", F.when(F.col("action").isin("view", "click"), "reader").otherwise("other"))
    return eventtime.union_watermark(both, "ts", "seq", "source", SOURCE_DELAYS).select("seq", "source", "watermark")


@query
def late_rows(spark, d):
    return late.late_rows(tables.disordered_events(spark, d), "ts", "seq", LATE)


@query
def late_rows_sliding(spark, d):
    return late.late_rows(tables.disordered_events(spark, d), "ts", "seq", LATE_SLIDING)


@query
def late_outcome(spark, d):
    """Each event once: late, accepted, or without a time (every 97th, made so here)."""
    events = tables.disordered_events(spark, d).withColumn("ts", F.when(F.col("seq") % 97 != 0, F.col("ts")))
    parts = {"late": late.late_rows(events, "ts", "seq", LATE), "undated": late.undated_rows(events, "ts"),
             "accepted": late.accepted_rows(events, "ts", "seq", LATE)}
    late_, undated, accepted = (rows.select("seq", F.lit(name).alias("outcome")) for name, rows in parts.items())
    return multistream.union_all(late_, undated, accepted)


@query
def late_count(spark, d):
    return late.late_counts(tables.disordered_events(spark, d), "ts", "seq", LATE, Windows(timedelta(hours=24_000)))


@query
def late_refire(spark, d):
    return late.firings(tables.disordered_events(spark, d), "ts", "seq", "user_id", LATE)


@query
def late_refire_sliding(spark, d):
    return late.firings(tables.disordered_events(spark, d), "ts", "seq", "user_id", LATE_SLIDING)


@query
def late_final_visits(spark, d):
    return late.final_visits(tables.disordered_events(spark, d), "ts", "seq", "user_id", LATE, ["action"])


# Several inputs


@query
def reconcile(spark, d):
    return multistream.newest_per_side(tables.orders(spark, d), tables.shipments(spark, d), "order_id", "ts",
                                 timedelta(days=30))


@query
def reconcile_no_timeout(spark, d):
    return multistream.newest_per_side(tables.orders(spark, d), tables.shipments(spark, d), "order_id", "ts")


def orders_and_shipments(spark, d):
    """All events of both parties; they arrive by day, an order before the shipments of its day."""
    day = lambda c: F.unix_date(F.col(c).cast("date")).cast("bigint") * 16
    placed = tables.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("ts"), day("o_orderdate").alias("seq"))
    sent = tables.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").cast("timestamp").alias("ts"),
        (day("l_shipdate") + F.col("l_linenumber")).alias("seq"))
    return placed, sent


@query
def pair_shipments(spark, d):
    return multistream.reconcile_in_order(*orders_and_shipments(spark, d), "order_id", "ts", "seq", timedelta(days=30))


@query
def pair_shipments_no_timeout(spark, d):
    return multistream.reconcile_in_order(*orders_and_shipments(spark, d), "order_id", "ts", "seq")


@query
def reconcile_in_order(spark, d):
    events = tables.events(spark, d)
    clicks, purchases = (events.filter(F.col("action") == action) for action in ("click", "purchase"))
    return multistream.reconcile_in_order(clicks, purchases, "user_id", "ts", "seq", timedelta(days=1))


@query
def union_all(spark, d):
    reads, rest = multistream.route(tables.events(spark, d), F.col("action").isin("view", "click"))
    return multistream.union_all(reads, rest, reads)


@query
def split_side(spark, d):
    return multistream.route(books(spark, d), F.col("gender") == "ECONOMY")[0]


@query
def split_main(spark, d):
    return multistream.route(books(spark, d), F.col("gender") == "ECONOMY")[1]


def click_sides(events):
    """Clicks and purchases with what is measured of each."""
    def side(action, name):
        measures = [F.count(F.lit(1)).alias(f"{name}s"), F.min("ts").alias(f"first_{name}"),
                    F.max("ts").alias(f"last_{name}")]
        return events.filter(F.col("action") == action), measures

    return side("click", "click"), side("purchase", "purchase")


@query
def window_join(spark, d):
    (clicks, of_clicks), (purchases, of_purchases) = click_sides(tables.events(spark, d))
    return multistream.window_join(clicks, purchases, ["user_id"], "ts", DAY, of_clicks, of_purchases)


# Streaming forms; each runs over all data there is now and gives the table it wrote


@query
def text_scan(spark, d):
    return parse.parse_event(readers.text_lines(spark, live.event_files(spark, d, live.folder(spark))))


@query
def text_replay(spark, d):
    """Event lines in eight files, some lines made empty; each file is replayed up to its first one."""
    home = live.folder(spark)
    lines = tables.event_lines(spark, d).withColumn("value", F.when(F.col("seq") % 61 != 60, F.col("value")).otherwise(""))
    lines = lines.withColumn("part", F.pmod(F.shiftright("seq", 4), F.lit(8)))
    lines.repartition(8, "part").sortWithinPartitions("part", "seq").select("part", "value").write.partitionBy("part").text(f"{home}/lines")
    return parse.parse_event(readers.replayed_lines(spark, f"{home}/lines").select("value"))


@query
def live_text(spark, d):
    home = live.folder(spark)
    lines = readers.stream_text_lines(spark, live.event_files(spark, d, home), files_per_batch=1)
    return live.written(parse.parse_event(lines), home)


@query
def live_text_sink(spark, d):
    home = live.folder(spark)
    sinks.run_available(sinks.to_text_files(live.events(spark, d, home), parse.format_event(), f"{home}/out", f"{home}/checkpoint"))
    return readers.text_lines(spark, f"{home}/out").withColumnRenamed("value", "line")


@query
def live_uv_pv(spark, d):
    home = live.folder(spark)
    stream = live.events(spark, d, home)
    return live.written(live_visits(stream, "ts", "user_id", HALF_PAST, SOURCE_DELAYS["other"], ["action"]), home)


@query
def live_topn(spark, d):
    home = live.folder(spark)
    writer = live_top_n(live.events(spark, d, home), "user_id", "ts", HALF_PAST, SOURCE_DELAYS["other"], f"{home}/out", f"{home}/checkpoint")
    with state_tasks(spark):
        sinks.run_available(writer)
    return spark.read.parquet(f"{home}/out/batch=*")


@query
def live_topn_chained(spark, d):
    home = live.folder(spark)
    return live.written(live_top_n_chained(live.events(spark, d, home), "user_id", "ts", HALF_PAST, SOURCE_DELAYS["other"]), home)


@query
def live_totals(spark, d):
    home = live.folder(spark)
    changed = totals_of(live.events(spark, d, home), ["action"], [F.count(F.lit(1)).alias("n")])
    out = OutputTable(f"{home}/out", "action string, n bigint")
    with state_tasks(spark):
        sinks.run_available(sinks.to_batches(changed, out.write, f"{home}/checkpoint", "update"))
    return out.all(spark).groupBy("action").agg(F.max("n").alias("n"))


@query
def live_groups(spark, d):
    home = live.folder(spark)
    groups = RowGroups(live.events(spark, d, home), "seq", 1000, home)
    sinks.run_available(groups.writer(f"{home}/checkpoint"))
    return groups.all(spark).groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


@query
def live_running_count(spark, d):
    home = live.folder(spark)
    return live.written(keyed.live_running_count(live.events(spark, d, home), ["action"], "seq"), home)


@query
def live_slot_groups(spark, d):
    """Rows dealt over slots; each slot hands over its rows fifty at a time."""
    home = live.folder(spark)
    rows = live.events(spark, d, home).withColumn("slot", F.pmod("seq", F.lit(7)))
    groups = live.written(keyed.live_row_groups(rows, ["slot"], "seq", 50), home)
    return groups.groupBy("slot", "group").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
                                               F.count_distinct("user_id").alias("users"))


@query
def live_count_window(spark, d):
    home = live.folder(spark)
    pairs = live.written(keyed.live_row_groups(live.events(spark, d, home), ["action"], "seq", 2), home)
    return pairs.groupBy("action", F.col("group").alias("chunk")).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


@query
def live_cross_window_count(spark, d):
    home = live.folder(spark)
    stream = live.events(spark, d, home)
    return live.written(keyed.live_cross_window_count(stream, ["action"], "ts", "seq", HOUR, SOURCE_DELAYS["other"]), home)


@query
def live_active_users(spark, d):
    home = live.folder(spark)
    return live.written(keyed.live_active_keys(live.events(spark, d, home), "user_id", "ts", HALF_PAST, SOURCE_DELAYS["other"]), home)


@query
def live_union_watermark(spark, d):
    """Readers deliver at once, the others two micro-batches later."""
    home = live.folder(spark)
    reads, rest = multistream.route(tables.events(spark, d), F.col("action").isin("view", "click"))
    sources = {"reader": live.staged(spark, reads, "seq", home, "reader"), "other": live.delayed(spark, rest, "seq", home, "other", 2)}
    return live.written(keyed.live_union_watermark({name: (stream, SOURCE_DELAYS[name]) for name, stream in sources.items()}, "ts", "seq"), home)


@query
def live_window_join(spark, d):
    home = live.folder(spark)
    (clicks, of_clicks), (purchases, of_purchases) = click_sides(live.events(spark, d, home))
    return live.written(join_windows(clicks, purchases, ["user_id"], "ts", DAY, of_clicks, of_purchases, SOURCE_DELAYS["other"]), home)


@query
def live_refire(spark, d):
    home = live.folder(spark)
    windows_ = LiveRefire(live.disordered_events(spark, d, home), "ts", "seq", "user_id", LATE, home)
    sinks.run_available(windows_.writer(f"{home}/checkpoint-cells"))
    return live.written(windows_.firings(spark), home)


@query
def live_watermark(spark, d):
    home = live.folder(spark)
    writer, out = counters.live_watermark_trace(live.disordered_events(spark, d, home), "ts", "seq", home,
                                                f"{home}/checkpoint", timedelta(minutes=15))
    sinks.run_available(writer)
    return out.all(spark).select("seq", "ts", "watermark")


@query
def live_late_rows(spark, d):
    home = live.folder(spark)
    split = LiveLate(live.disordered_events(spark, d, home), "ts", "seq", "user_id", LATE, home)
    sinks.run_available(split.writer(f"{home}/checkpoint"))
    return split.late.all(spark)


@query
def live_late_visits(spark, d):
    home = live.folder(spark)
    windows_ = LiveRefire(live.disordered_events(spark, d, home), "ts", "seq", "user_id", LATE_SLIDING, home)
    sinks.run_available(windows_.writer(f"{home}/checkpoint"))
    return windows_.visits(spark)


@query
def live_pair_shipments(spark, d):
    """All events of both parties, in several micro-batches."""
    home = live.folder(spark)
    both = live.staged(spark, multistream.tagged_union(*orders_and_shipments(spark, d)), "seq", home, "in")
    placed, sent = (both.filter(F.col("side") == side) for side in ("left", "right"))
    pairs = LiveReconcile(placed, sent, "order_id", "ts", home, seq="seq")
    sinks.run_available(pairs.writer(f"{home}/checkpoint"))
    return pairs.out.all(spark)


def orders_and_first_shipments(spark, d, home):
    """Both as streams of one micro-batch: an event given up in one would be paired late in the next."""
    first = tables.shipments(spark, d).groupBy("order_id").agg(F.min("ts").alias("ts"))
    return live.whole(spark, tables.orders(spark, d), home, "orders"), live.whole(spark, first, home, "first")


@query
def live_reconcile(spark, d):
    home = live.folder(spark)
    pairs = LiveReconcile(*orders_and_first_shipments(spark, d, home), "order_id", "ts", home, timedelta(days=30))
    sinks.run_available(pairs.writer(f"{home}/checkpoint"))
    return pairs.out.all(spark)


@query
def live_timers(spark, d):
    home = live.folder(spark)
    return live.written(reconcile_with_timers(*orders_and_first_shipments(spark, d, home), "order_id", "ts", timedelta(days=30)), home)
