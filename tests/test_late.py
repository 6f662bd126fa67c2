from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventlab.operators.late import LatePolicy, accepted_rows, final_visits, firings, late_counts, late_rows
from eventlab.times import Windows
from helpers import numbers, replay, utc

ONE_TO_SEVEN = [1, 2, 3, 2, 2, 2, 2, 4, 5, 6, 7]
SECONDS = lambda n: timedelta(seconds=n)
SLIDING = Windows(SECONDS(3), slide=SECONDS(2))


def contents(df, policy):
    """Each firing with the times it lists, put together from accepted rows."""
    rows = sorted(utc(accepted_rows(df, "ts", "seq", policy).select("window_start", "seq", "ts")))
    fired = utc(firings(df, "ts", "seq", "user_id", policy).select("window_start", "at_seq", "pv"))
    out = []
    for start, seq, pv in sorted(fired, key=lambda f: (f[1] is None, f[1] or 0, f[0])):
        out.append((start, [t for s, q, t in rows if s == start and (seq is None or q <= seq)]))
        assert len(out[-1][1]) == pv
    return out


def test_sliding_without_lateness(spark):
    df, policy = numbers(spark, [v * 1000 for v in ONE_TO_SEVEN]), LatePolicy(SLIDING)
    assert contents(df, policy) == [
        (0, [1000, 2000]), (2000, [2000, 3000, 2000, 2000, 2000, 2000, 4000]), (4000, [4000, 5000, 6000]),
        (6000, [6000, 7000])]
    assert late_rows(df, "ts", "seq", policy).count() == 0


def test_sliding_with_lateness_fires_again(spark):
    df, policy = numbers(spark, [v * 1000 for v in ONE_TO_SEVEN]), LatePolicy(SLIDING, lateness=SECONDS(2))
    assert contents(df, policy) == [
        (0, [1000, 2000]), (0, [1000] + [2000] * 2), (0, [1000] + [2000] * 3), (0, [1000] + [2000] * 4),
        (0, [1000] + [2000] * 5), (2000, [2000, 3000, 2000, 2000, 2000, 2000, 4000]), (4000, [4000, 5000, 6000]),
        (6000, [6000, 7000])]
    assert late_rows(df, "ts", "seq", policy).count() == 0


def test_tumbling_without_lateness_has_late_rows(spark):
    df, policy = numbers(spark, [v * 1000 for v in ONE_TO_SEVEN]), LatePolicy(Windows(SECONDS(3)))
    assert contents(df, policy) == [(0, [1000, 2000]), (3000, [3000, 4000, 5000]), (6000, [6000, 7000])]
    assert utc(late_rows(df, "ts", "seq", policy).select("ts")) == [(2000,)] * 4
    counts = late_counts(df, "ts", "seq", policy, Windows(timedelta(hours=24_000)))
    assert utc(counts.select("window_start", "n")) == [(0, 4)]


DAY = 1631491200000
FIVE = [DAY + (m * 60 + s) * 1000 for m, s in ((30, 0), (3, 59), (6, 32), (8, 21), (38, 30))]


@pytest.mark.parametrize("minutes, late, fired", [
    (5, 3, [(30, 2, 2)]),
    (6, 0, [(0, 1, 1), (0, 2, 2), (0, 3, 3), (30, 2, 2)]),
])
def test_lateness_of_five_and_six_minutes(spark, minutes, late, fired):
    policy = LatePolicy(Windows(timedelta(minutes=10)), timedelta(minutes=15), timedelta(minutes=minutes))
    df = numbers(spark, FIVE)
    assert late_rows(df, "ts", "seq", policy).count() == late
    out = utc(firings(df, "ts", "seq", "user_id", policy).select("window_start", "pv", "uv"))
    assert sorted(((start - DAY) // 60000, pv, uv) for start, pv, uv in out) == fired


def compare(spark, rows, size, slide, offset, delay, lateness, **scale):
    """The table form against the row-by-row one, all in milliseconds."""
    df = spark.createDataFrame(rows, "seq bigint, ms bigint, user_id string").repartition(3) \
        .selectExpr("seq", "timestamp_millis(ms) AS ts", "user_id")
    span = lambda n: timedelta(milliseconds=n)
    policy = LatePolicy(Windows(span(size), span(slide), span(offset)), span(delay), span(lateness))
    want_firings, want_late = replay(rows, size, slide, offset, delay, lateness)
    joins = {k: v for k, v in scale.items() if k != "bucket"}
    late = sorted(r.seq for r in late_rows(df, "ts", "seq", policy, **joins).collect())
    assert late == want_late
    got = utc(firings(df, "ts", "seq", "user_id", policy, **scale).select("window_start", "at_seq", "pv", "uv"))
    assert sorted(got, key=str) == sorted(
        ((start, seq, len(held), len({u for _, _, u in held})) for start, seq, held in want_firings), key=str)
    last = {start: held for start, _, held in want_firings}
    got = utc(final_visits(df, "ts", "seq", "user_id", policy, **joins).select("window_start", "pv", "uv"))
    assert sorted(got) == sorted((start, len(held), len({u for _, _, u in held})) for start, held in last.items())
    kept = {r.seq for r in accepted_rows(df, "ts", "seq", policy, **joins).collect()}
    assert kept.isdisjoint(late) and len(kept) + len(late) == len(rows)


STREAMS = st.lists(st.tuples(st.integers(0, 40), st.sampled_from("abc")), min_size=1, max_size=25)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(STREAMS, st.sampled_from([(4, 4), (3, 2), (6, 2)]), st.integers(0, 3), st.integers(0, 6), st.integers(0, 5))
def test_any_disorder(spark, stream, grid, offset, delay, lateness):
    rows = [(i * 3, t, u) for i, (t, u) in enumerate(stream)]
    compare(spark, rows, *grid, offset, delay, lateness, bucket=4)


def test_large_window_tables_are_joined_by_shuffle(spark):
    rows = [(i, (i * 7) % 30 + i // 2, "abc"[i % 3]) for i in range(60)]
    compare(spark, rows, 3, 2, 0, 4, 2, bucket=8, broadcast_windows=0, salts=3)


def test_all_rows_in_one_window(spark):
    rows = [(i, i % 4, f"u{i % 5}") for i in range(40)] + [(40, 100, "z"), (41, 1, "z")]
    compare(spark, rows, 4, 4, 0, 0, 200, bucket=4)


def test_empty_input(spark):
    df = numbers(spark, [])
    assert late_rows(df, "ts", "seq", LatePolicy(SLIDING)).count() == 0
    assert firings(df, "ts", "seq", "user_id", LatePolicy(SLIDING)).count() == 0
