"""Small inputs and plain Python versions of the order-dependent operators."""

from datetime import datetime, timedelta

EPOCH = datetime(1970, 1, 1)


def at(ms):
    return EPOCH + timedelta(milliseconds=ms)


def ms(time):
    return None if time is None else round((time - EPOCH) / timedelta(milliseconds=1))


def utc(df):
    """Rows as tuples with times as milliseconds."""
    kinds = dict(df.dtypes)
    out = df.selectExpr(*[f"unix_millis(`{c}`) AS `{c}`" if kinds[c] == "timestamp" else f"`{c}`" for c in df.columns])
    return [tuple(r) for r in out.collect()]


def numbers(spark, values):
    """A stream of times in milliseconds, in arrival order, each from a user of its own."""
    return spark.createDataFrame([(i, v, f"u{i}") for i, v in enumerate(values)], "seq bigint, ms bigint, user_id string") \
        .selectExpr("seq", "timestamp_millis(ms) AS ts", "user_id")


def replay(rows, size, slide, offset, delay, lateness):
    """Row-by-row windows: rows are ``(seq, ms, user)``; gives the firings and the late rows.

    A firing is ``(window start, seq or None, members)``.
    """
    newest, content, fired, firings, late = None, {}, set(), [], []

    def fire(start, seq):
        firings.append((start, seq, list(content[start])))

    for seq, time, user in sorted(rows):
        mark = None if newest is None else newest - delay - 1
        first = (time - offset) // slide * slide + offset
        starts = [s for s in range(first, first - size, -slide) if s <= time < s + size]
        open_ = [s for s in starts if mark is None or s + size - 1 + lateness > mark]
        if not open_:
            late.append(seq)
        for start in open_:
            content.setdefault(start, []).append((seq, time, user))
            if start in fired or (mark is not None and start + size - 1 <= mark):
                fired.add(start)
                fire(start, seq)
        newest = time if newest is None else max(newest, time)
        for start in sorted(content):
            if start not in fired and start + size - 1 <= newest - delay - 1:
                fired.add(start)
                fire(start, seq)
    for start in sorted(set(content) - fired):
        fire(start, None)
    return firings, late


def pair_up(rows):
    """Sequential pairing of ``(seq, key, side, ms)`` rows: ``(key, left, right)`` per pair or lone event."""
    waiting, out = {}, []
    for _, key, side, time in sorted(rows):
        held = waiting.get(key)
        if held and held[0] != side:
            met = {side: time, held[0]: held[1]}
            out.append((key, met["left"], met["right"]))
            waiting[key] = None
            continue
        if held:
            out.append((key, *((held[1], None) if side == "left" else (None, held[1]))))
        waiting[key] = (side, time)
    for key, held in waiting.items():
        if held:
            out.append((key, *((held[1], None) if held[0] == "left" else (None, held[1]))))
    return out
