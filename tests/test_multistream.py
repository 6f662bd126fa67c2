import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from eventlab.operators import multistream
from eventlab.times import Windows
from helpers import at, pair_up, utc

# Golden case: times in milliseconds, a timeout of 500 s.
LEFT = [("order-1", 100000), ("order-2", 200000), ("order-3", 300000), ("order-4", 400000), ("order-5", 500000)]
RIGHT = [("order-1", 100000), ("order-10", 200000), ("order-2", 1200000), ("order-3", 1300000)]
TIMEOUT = timedelta(seconds=500)
STATUS = {"order-1": "matched", "order-2": "matched_late", "order-3": "matched_late", "order-4": "left_only",
          "order-5": "left_only", "order-10": "right_only"}


def orders(spark, rows, first=0):
    return spark.createDataFrame([(k, at(t), first + i) for i, (k, t) in enumerate(rows)],
                                 "order_id string, ts timestamp, seq bigint")


def test_reconcile(spark):
    out = multistream.newest_per_side(orders(spark, LEFT), orders(spark, RIGHT), "order_id", "ts", TIMEOUT)
    assert {r.order_id: r.status for r in out.collect()} == STATUS
    assert ("order-2", 200000, 1200000, "matched_late") in utc(out)


def test_reconcile_without_timeout_never_is_late(spark):
    out = multistream.newest_per_side(orders(spark, LEFT), orders(spark, RIGHT), "order_id", "ts")
    assert {r.order_id: r.status for r in out.collect()} == {k: s.replace("_late", "") for k, s in STATUS.items()}


def test_the_newest_event_of_a_side_counts(spark):
    left = orders(spark, [("o", 5000), ("o", 1000)])
    out = multistream.newest_per_side(left, orders(spark, [("o", 5000)]), "order_id", "ts", timedelta(seconds=1))
    assert utc(out) == [("o", 5000, 5000, "matched")]


def test_timeout_itself_is_in_time(spark):
    out = multistream.newest_per_side(orders(spark, [("o", 0)]), orders(spark, [("o", 500000)]), "order_id", "ts", TIMEOUT)
    assert out.first().status == "matched"


def test_reconcile_in_order_agrees_on_single_events(spark):
    out = multistream.reconcile_in_order(orders(spark, LEFT), orders(spark, RIGHT, 100), "order_id", "ts", "seq", TIMEOUT)
    assert {r.order_id: r.status for r in out.collect()} == STATUS


@pytest.mark.parametrize("bucket", [2, 5, 1 << 18])
def test_reconcile_in_order_of_repeated_keys(spark, bucket):
    dice = random.Random(bucket)
    rows = [(i, "hot" if dice.random() < .4 else dice.choice("abc"), dice.choice(["left", "right"]), 1000 * i)
            for i in range(150)]
    left, right = (spark.createDataFrame([(k, at(t), q) for q, k, s, t in rows if s == side],
                                         "order_id string, ts timestamp, seq bigint") for side in ("left", "right"))
    out = multistream.reconcile_in_order(left, right, "order_id", "ts", "seq", timedelta(seconds=20), bucket=bucket)
    got = utc(out)
    assert sorted((r[:3] for r in got), key=str) == sorted(pair_up(rows), key=str)
    for _, l, r, status in got:
        assert status == ("left_only" if r is None else "right_only" if l is None
                          else "matched_late" if abs(l - r) > 20000 else "matched")


def test_route_sends_unknown_to_main(spark):
    df = spark.createDataFrame([("boy",), ("girl",), (None,)], "gender string")
    side, main = multistream.route(df, F.col("gender") == "boy")
    assert [r.gender for r in side.collect()] == ["boy"]
    assert [r.gender for r in main.collect()] == ["girl", None]


def test_union_keeps_duplicates_and_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "n bigint, s string")
    assert multistream.union_all(a, a.select("s", "n"), a).count() == 3


def test_window_join_is_linear(spark):
    grid = Windows(timedelta(seconds=10))
    side = lambda rows: spark.createDataFrame([(u, at(t)) for u, t in rows], "u string, ts timestamp")
    left = side([("a", i) for i in range(100)] + [("b", 1), ("c", 20000)])
    right = side([("a", i) for i in range(50)] + [("b", 15000), ("c", 21000)])
    out = multistream.window_join(left, right, ["u"], "ts", grid, [F.count(F.lit(1)).alias("l")], [F.count(F.lit(1)).alias("r")])
    assert sorted(utc(out.select("u", "window_start", "l", "r"))) == [("a", 0, 100, 50), ("c", 20000, 1, 1)]
