"""The same results in plain SQL over the same tables, by query name."""

from __future__ import annotations

EVENTS = """e AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS user_id, event_type AS action, ts FROM events)"""

DISORDERED = """e AS (
  SELECT (event_id + hold) * 50 + 49 - hold AS seq, CAST(user_id AS VARCHAR) AS user_id, event_type AS action, ts
  FROM (SELECT *, (event_id * 37) % 50 AS hold FROM events))"""

DATED = DISORDERED.replace("e AS", "every AS", 1) + ", e AS (SELECT * FROM every WHERE seq % 97 <> 0)"

BOOKS = """b AS (
  SELECT p_partkey AS seq, CAST(p_partkey AS VARCHAR) AS bid, p_name AS title, p_brand AS writer,
         p_type AS gender, CAST(1 AS BIGINT) AS n FROM part)"""


def bucket(size: str, shift: str = "0 minutes") -> str:
    return f"time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01' + INTERVAL '{shift}')"


def assigned(size: str, shift: str = "0 minutes", source: str = EVENTS) -> str:
    """Rows with the bounds of their tumbling window."""
    return f"""{source}, w AS (
  SELECT *, {bucket(size, shift)} AS window_start, {bucket(size, shift)} + INTERVAL '{size}' AS window_end FROM e)"""


def sliding(source: str = EVENTS) -> str:
    """Rows with the bounds of each of their 3 h windows that start every 2 h."""
    newest = bucket("2 hours")
    return f"""{source}, w AS (
  SELECT *, window_start + INTERVAL '3 hours' AS window_end FROM (
    SELECT *, {newest} AS window_start FROM e
    UNION ALL
    SELECT *, {newest} - INTERVAL '2 hours' AS window_start FROM e)
  WHERE ts < window_start + INTERVAL '3 hours')"""


def counts(size: str, shift: str = "0 minutes", keys: str = "") -> str:
    return f"""WITH {assigned(size, shift)}
SELECT {keys} window_start, window_end, count(*) AS n FROM w GROUP BY {keys} window_start, window_end"""


def visits(size: str, keys: str = "") -> str:
    return f"""WITH {assigned(size)}
SELECT {keys} window_start, window_end, count(*) AS pv, count(DISTINCT user_id) AS uv
FROM w GROUP BY {keys} window_start, window_end"""


def top(size: str, shift: str = "0 minutes") -> str:
    return f"""WITH {assigned(size, shift)}, c AS (
  SELECT user_id, window_start, window_end, count(*) AS n FROM w GROUP BY user_id, window_start, window_end),
r AS (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, user_id) AS rank,
         count(*) OVER (PARTITION BY window_start) AS users FROM c)
SELECT user_id, window_start, window_end, n, rank FROM r WHERE rank <= 10 AND users >= 12"""


def replay(windowed: str) -> str:
    """Rows per window with the watermark before and after them: 2 h disorder, 30 min lateness."""
    return f"""{windowed}, m AS (
  SELECT *,
    (max(ts) OVER (ORDER BY seq RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      - INTERVAL '2 hours' - INTERVAL '1 millisecond' AS wm_before,
    (max(ts) OVER (ORDER BY seq RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
      - INTERVAL '2 hours' - INTERVAL '1 millisecond' AS wm_after FROM w),
a AS (
  SELECT *, coalesce(window_end - INTERVAL '1 millisecond' + INTERVAL '30 minutes' <= wm_before, false) AS rejected
  FROM m),
marks AS (SELECT DISTINCT seq, wm_after FROM m),
rises AS (SELECT wm_after, min(seq) AS seq FROM marks GROUP BY wm_after),
ends AS (SELECT DISTINCT window_end, window_end - INTERVAL '1 millisecond' AS last FROM w),
fires AS (SELECT ends.window_end, rises.seq AS fire_seq FROM ends ASOF LEFT JOIN rises ON ends.last <= rises.wm_after)"""


# Windows a live stream with 15 min of disorder has closed at the end of the table.
CLOSED = "window_end <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '15 minutes' FROM events)"

LATE = "SELECT seq, any_value(user_id) AS user_id, any_value(action) AS action, any_value(ts) AS ts " \
       "FROM a GROUP BY seq HAVING bool_and(rejected)"

REFIRE = """, taken AS (
  SELECT a.*, coalesce(fire_seq, 9223372036854775807) AS fire FROM a JOIN fires USING (window_end) WHERE NOT rejected),
firsts AS (SELECT *, row_number() OVER (PARTITION BY window_end, user_id ORDER BY seq) = 1 AS is_first FROM taken),
run AS (
  SELECT *, count(*) OVER upto AS pv, count(*) FILTER (WHERE is_first) OVER upto AS uv,
         max(CASE WHEN seq <= fire THEN seq END) OVER (PARTITION BY window_end) AS last_in_time
  FROM firsts WINDOW upto AS (PARTITION BY window_end ORDER BY seq))
SELECT window_start, window_end, CASE WHEN seq > fire THEN seq WHEN fire < 9223372036854775807 THEN fire END AS at_seq,
       seq > fire AS refired, pv, uv
FROM run WHERE seq > fire OR seq = last_in_time"""

RECONCILED = """WITH l AS (SELECT o_orderkey AS order_id, max(o_orderdate) AS left_ts FROM orders GROUP BY o_orderkey),
r AS (SELECT l_orderkey AS order_id, max(l_shipdate) AS right_ts FROM lineitem GROUP BY l_orderkey)
SELECT order_id, left_ts, right_ts,
       CASE WHEN right_ts IS NULL THEN 'left_only' WHEN left_ts IS NULL THEN 'right_only' {late} ELSE 'matched' END AS status
FROM l FULL JOIN r USING (order_id)"""

# One event after another: who waits, and what the event does to it; at last, if asked for, who still waits.
STEPPED = """WITH RECURSIVE both_sides AS (
  SELECT o_orderkey AS order_id, 'left' AS side, CAST(o_orderdate AS TIMESTAMP) AS ts, 0 AS part FROM orders
  UNION ALL SELECT l_orderkey, 'right', CAST(l_shipdate AS TIMESTAMP), l_linenumber FROM lineitem),
e AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY CAST(ts AS DATE), part) AS place FROM both_sides),
steps AS (
  SELECT order_id, place, side AS waits, ts AS waits_ts, CAST(NULL AS VARCHAR) AS done, CAST(NULL AS VARCHAR) AS held,
         CAST(NULL AS TIMESTAMP) AS held_ts, ts FROM e WHERE place = 1
  UNION ALL
  SELECT e.order_id, e.place, CASE WHEN s.waits IS NULL OR s.waits = e.side THEN e.side END,
         CASE WHEN s.waits IS NULL OR s.waits = e.side THEN e.ts END,
         CASE WHEN s.waits = e.side THEN 'alone' WHEN s.waits IS NOT NULL THEN 'pair' END, s.waits, s.waits_ts, e.ts
  FROM steps AS s JOIN e ON e.order_id = s.order_id AND e.place = s.place + 1),
ended AS (
  SELECT order_id, done, held, held_ts, ts FROM steps WHERE done IS NOT NULL
  UNION ALL
  SELECT order_id, 'alone', waits, waits_ts, NULL FROM steps JOIN (SELECT order_id, max(place) AS place FROM e GROUP BY order_id)
  USING (order_id, place) WHERE waits IS NOT NULL AND {at_end}),
sides AS (
  SELECT order_id, CASE WHEN held = 'left' THEN held_ts WHEN done = 'pair' THEN ts END AS left_ts,
         CASE WHEN held = 'right' THEN held_ts WHEN done = 'pair' THEN ts END AS right_ts FROM ended)
SELECT order_id AS {key}, left_ts, right_ts,
       CASE WHEN right_ts IS NULL THEN 'left_only' WHEN left_ts IS NULL THEN 'right_only' {late} ELSE 'matched' END AS status
FROM sides"""

FIRST_SHIPMENTS = """WITH l AS (SELECT o_orderkey AS order_id, o_orderdate AS left_ts FROM orders),
r AS (SELECT l_orderkey AS order_id, min(l_shipdate) AS right_ts FROM lineitem GROUP BY l_orderkey),
w AS (SELECT least((SELECT max(left_ts) FROM l), (SELECT max(right_ts) FROM r)) - INTERVAL '1 millisecond' AS watermark)
SELECT {key} AS key, left_ts, right_ts,
       CASE WHEN right_ts IS NULL THEN 'left_only' WHEN left_ts IS NULL THEN 'right_only'
            WHEN abs(date_diff('day', left_ts, right_ts)) > 30 THEN 'matched_late' ELSE 'matched' END AS status
FROM l FULL JOIN r USING (order_id), w
WHERE (left_ts IS NOT NULL AND right_ts IS NOT NULL)
   OR coalesce(left_ts, right_ts) + INTERVAL '30 days' <= watermark"""

ORACLE: dict[str, str] = {
    "pair_shipments": STEPPED.format(key="order_id", at_end=True, late="WHEN abs(date_diff('day', left_ts, right_ts)) > 30 THEN 'matched_late'"),
    "pair_shipments_no_timeout": STEPPED.format(key="order_id", at_end=True, late=""),
    "word_count": """WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
words AS (
  SELECT unnest(CASE WHEN line = '' THEN [''] ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines WHERE line = '' OR rtrim(line, ' ') <> '')
SELECT word, count(*) AS n FROM words GROUP BY word""",
    "parse_event": f"WITH {EVENTS} SELECT seq, user_id, action, ts FROM e",
    "parse_wide_event": f"WITH {EVENTS} SELECT seq, user_id, action, ts FROM e",
    "parse_book": f"WITH {BOOKS} SELECT bid, title, writer, gender FROM b",
    "parse_number": """SELECT event_id, TRY_CAST(concat(user_id, event_type) AS BIGINT) AS no_number,
       TRY_CAST(CAST(user_id AS VARCHAR) AS BIGINT) AS number FROM events""",
    "kafka_decode": f"WITH {BOOKS} SELECT seq AS \"offset\", bid, title, writer, gender FROM b",
    "format_event": f"""WITH {EVENTS}, t AS (SELECT *, CAST(ts AS VARCHAR) AS plain FROM e)
SELECT seq, concat(user_id, ',', action, ',', plain, CASE WHEN contains(plain, '.') THEN '' ELSE '.0' END) AS line FROM t""",
    "format_user_count": f"""WITH {assigned('24 hours')}, c AS (
  SELECT user_id, window_start, window_end, count(*) AS n FROM w GROUP BY user_id, window_start, window_end)
SELECT concat(user_id, ',', n, ',', CAST(window_start AS VARCHAR), '.0,', CAST(window_end AS VARCHAR), '.0') AS line FROM c""",
    "filter_action": f"WITH {EVENTS} SELECT * FROM e WHERE action = 'view'",
    "group_sum": f"WITH {BOOKS} SELECT gender, CAST(sum(n) AS BIGINT) AS n FROM b GROUP BY gender",
    "rolling_sum": f"""WITH {BOOKS}
SELECT seq, gender, first_value(bid) OVER k AS bid, first_value(title) OVER k AS title,
       first_value(writer) OVER k AS writer, CAST(sum(n) OVER k AS BIGINT) AS n
FROM b WINDOW k AS (PARTITION BY gender ORDER BY seq)""",
    "arg_max": f"WITH {BOOKS} SELECT * FROM b ORDER BY bid DESC, seq LIMIT 1",
    "rolling_arg_max": f"""WITH {BOOKS}, t AS (SELECT seq, max(bid) OVER (ORDER BY seq) AS top FROM b)
SELECT t.seq, best.bid, best.seq AS best_seq, best.title, best.writer, best.gender
FROM t JOIN b AS best ON best.bid = t.top""",
    "max_keep_first": f"""WITH {BOOKS}
SELECT (SELECT max(bid) FROM b) AS bid, seq, title, writer, gender, n FROM b ORDER BY seq LIMIT 1""",
    "rolling_max": f"""WITH {BOOKS}
SELECT seq, max(bid) OVER k AS bid, first_value(title) OVER k AS title, first_value(writer) OVER k AS writer,
       first_value(gender) OVER k AS gender FROM b WINDOW k AS (ORDER BY seq)""",
    "keyed_reduce": f"""WITH {BOOKS}
SELECT gender, arg_min(bid, seq) AS bid, arg_min(title, seq) AS title, arg_min(writer, seq) AS writer, count(*) AS n
FROM b GROUP BY gender""",
    "keyed_sum": f"""WITH {BOOKS}
SELECT gender, arg_min(bid, seq) AS bid, arg_min(title, seq) AS title, arg_min(writer, seq) AS writer, CAST(sum(n) AS BIGINT) AS n
FROM b GROUP BY gender""",
    "rolling_reduce": f"""WITH RECURSIVE {EVENTS}, p AS (
  SELECT user_id, seq, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS place, seq % 1008 + 1 AS a, length(action) * seq % 1009 AS b FROM e),
r AS (
  SELECT user_id, seq, place, a, b FROM p WHERE place = 1
  UNION ALL
  SELECT p.user_id, p.seq, p.place, r.a * p.a % 1009, (p.a * r.b + p.b) % 1009
  FROM r JOIN p ON p.user_id = r.user_id AND p.place = r.place + 1)
SELECT user_id, seq, a, b FROM r""",
    "uv_pv": visits("720 hours"),
    "uv_pv_by_action": visits("720 hours", "action,"),
    "user_window_counts": counts("24 hours", keys="user_id,"),
    "offset_window_counts": counts("1 hour", "30 minutes", "user_id,"),
    "window_all_counts": counts("1 hour"),
    "sliding_counts": f"""WITH {sliding()}
SELECT window_start, window_end, count(*) AS n FROM w GROUP BY window_start, window_end""",
    "sliding_sketches": f"""WITH {sliding()}
SELECT window_start, window_end, count(*) AS pv, count(DISTINCT user_id) AS uv, TRUE AS close FROM w GROUP BY window_start, window_end""",
    "text_replay": f"""WITH {EVENTS}, p AS (SELECT *, (seq >> 4) % 8 AS part FROM e),
b AS (SELECT part, min(seq) AS last FROM p WHERE seq % 61 = 60 GROUP BY part)
SELECT user_id, action, ts FROM p LEFT JOIN b USING (part) WHERE last IS NULL OR seq < last""",
    "live_topn_chained": f"{top('1 hour', '30 minutes')} AND {CLOSED}",
    "window_concat": f"""WITH {assigned('24 hours')}, r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, window_start ORDER BY seq) - 1 AS place FROM w),
p AS (SELECT *, place // 3 AS part FROM r)
SELECT user_id, window_start, window_end, part, min(ts) AS ts, count(*) AS n,
       string_agg(action, ' ' ORDER BY seq) AS action
FROM p GROUP BY user_id, window_start, window_end, part""",
    "window_contents": f"""WITH {sliding()}
SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY seq) AS position FROM w""",
    "count_window": f"""WITH {EVENTS}, p AS (
  SELECT *, (row_number() OVER (PARTITION BY action ORDER BY seq) - 1) // 2 AS chunk FROM e)
SELECT action, chunk, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq
FROM p GROUP BY action, chunk HAVING count(*) = 2""",
    "batch_chunks": f"""WITH {EVENTS}, p AS (
  SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY seq) - 1) // 2 AS chunk FROM e)
SELECT user_id, chunk, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq FROM p GROUP BY user_id, chunk""",
    "running_count": f"WITH {EVENTS} SELECT *, row_number() OVER (PARTITION BY action ORDER BY seq) AS n FROM e",
    "cross_window_count": f"""WITH {assigned('1 hour')}
SELECT *, row_number() OVER (PARTITION BY action ORDER BY window_start, seq) AS n FROM w""",
    "in_window_count": f"""WITH {assigned('1 hour')}
SELECT *, row_number() OVER (PARTITION BY action, window_start ORDER BY seq) AS n FROM w""",
    "window_and_cumulative": f"""WITH {assigned('1 hour')}, c AS (
  SELECT action, window_start, window_end, count(*) AS n FROM w GROUP BY action, window_start, window_end)
SELECT *, CAST(sum(n) OVER (PARTITION BY action ORDER BY window_start) AS BIGINT) AS cumulative FROM c""",
    "active_users_per_window": f"""WITH {assigned('1 hour', '30 minutes')}
SELECT window_end, count(DISTINCT user_id) AS active FROM w GROUP BY window_end""",
    "topn_window_all": top("10 hours"),
    "topn_two_stage": top("1 hour", "30 minutes"),
    "watermark_trace": f"""WITH {DISORDERED}
SELECT seq, ts, (max(ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       - INTERVAL '15 minutes' - INTERVAL '1 millisecond' AS watermark FROM e""",
    "monotonic_watermark": f"""WITH {EVENTS}
SELECT seq, ts, (max(ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       - INTERVAL '1 millisecond' AS watermark FROM e""",
    "union_watermark": f"""WITH {DISORDERED}, s AS (
  SELECT *, CASE WHEN action IN ('view', 'click') THEN 'reader' ELSE 'other' END AS source FROM e),
m AS (
  SELECT seq, source,
    max(CASE WHEN source = 'reader' THEN ts END) OVER before - INTERVAL '1 millisecond' AS a,
    max(CASE WHEN source = 'other' THEN ts END) OVER before - INTERVAL '15 minutes' - INTERVAL '1 millisecond' AS b
  FROM s WINDOW before AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT seq, source, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b) END AS watermark FROM m""",
    "late_rows": f"WITH {replay(assigned('1 hour', source=DISORDERED))} {LATE}",
    "late_rows_sliding": f"WITH {replay(sliding(DISORDERED))} {LATE}",
    "late_outcome": f"""WITH {replay(assigned('1 hour', source=DATED))}
SELECT seq, CASE WHEN bool_and(rejected) THEN 'late' ELSE 'accepted' END AS outcome FROM a GROUP BY seq
UNION ALL SELECT seq, 'undated' FROM every WHERE seq % 97 = 0""",
    "late_count": f"""WITH {replay(assigned('1 hour', source=DISORDERED))}, late AS ({LATE})
SELECT {bucket('24000 hours')} AS window_start, {bucket('24000 hours')} + INTERVAL '24000 hours' AS window_end,
       count(*) AS n FROM late GROUP BY 1, 2""",
    "late_refire": f"WITH {replay(assigned('1 hour', source=DISORDERED))} {REFIRE}",
    "late_refire_sliding": f"WITH {replay(sliding(DISORDERED))} {REFIRE}",
    "late_final_visits": f"""WITH {replay(assigned('1 hour', source=DISORDERED))}
SELECT action, window_start, window_end, count(*) AS pv, count(DISTINCT user_id) AS uv
FROM a WHERE NOT rejected GROUP BY action, window_start, window_end""",
    "reconcile": RECONCILED.format(late="WHEN abs(date_diff('day', left_ts, right_ts)) > 30 THEN 'matched_late'"),
    "reconcile_no_timeout": RECONCILED.format(late=""),
    "reconcile_in_order": f"""WITH {EVENTS}, p AS (
  SELECT *, row_number() OVER k AS place, lag(action) OVER k AS prev_action, lag(ts) OVER k AS prev_ts,
         lead(seq) OVER k IS NULL AS is_last
  FROM e WHERE action IN ('click', 'purchase') WINDOW k AS (PARTITION BY user_id ORDER BY seq)),
c AS (
  SELECT *, max(CASE WHEN action IS NOT DISTINCT FROM coalesce(prev_action, action) THEN place END) OVER (
    PARTITION BY user_id ORDER BY seq) AS start FROM p),
s AS (
  SELECT *, (place - start) % 2 = 0 AS waits FROM c),
t AS (SELECT *, coalesce(lag(waits) OVER (PARTITION BY user_id ORDER BY seq), false) AS prev_waits FROM s),
o AS (
  SELECT user_id, prev_action AS a, prev_ts AS a_ts,
         CASE WHEN action <> prev_action THEN action END AS b, ts AS b_ts FROM t WHERE prev_waits
  UNION ALL
  SELECT user_id, action, ts, NULL, NULL FROM t WHERE is_last AND waits),
m AS (
  SELECT user_id, CASE WHEN a = 'click' THEN a_ts WHEN b = 'click' THEN b_ts END AS left_ts,
         CASE WHEN a = 'purchase' THEN a_ts WHEN b = 'purchase' THEN b_ts END AS right_ts FROM o)
SELECT *, CASE WHEN right_ts IS NULL THEN 'left_only' WHEN left_ts IS NULL THEN 'right_only'
               WHEN abs(epoch_us(left_ts) - epoch_us(right_ts)) > 86400000000 THEN 'matched_late'
               ELSE 'matched' END AS status FROM m""",
    "live_uv_pv": f"""WITH {assigned('1 hour', '30 minutes')}
SELECT action, window_start, window_end, count(*) AS pv, count(DISTINCT user_id) AS uv FROM w
WHERE {CLOSED} GROUP BY action, window_start, window_end""",
    "live_topn": f"{top('1 hour', '30 minutes')} AND {CLOSED}",
    "live_running_count": f"WITH {EVENTS} SELECT *, row_number() OVER (PARTITION BY action ORDER BY seq) AS n FROM e",
    "live_slot_groups": f"""WITH {EVENTS}, p AS (
  SELECT *, seq % 7 AS slot, (row_number() OVER (PARTITION BY seq % 7 ORDER BY seq) - 1) // 50 AS "group" FROM e)
SELECT slot, "group", count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq, count(DISTINCT user_id) AS users
FROM p GROUP BY slot, "group" HAVING count(*) = 50""",
    "live_count_window": f"""WITH {EVENTS}, p AS (
  SELECT *, (row_number() OVER (PARTITION BY action ORDER BY seq) - 1) // 2 AS chunk FROM e)
SELECT action, chunk, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq
FROM p GROUP BY action, chunk HAVING count(*) = 2""",
    "live_cross_window_count": f"""WITH {assigned('1 hour')}
SELECT *, row_number() OVER (PARTITION BY action ORDER BY window_start, seq) AS n FROM w WHERE {CLOSED}""",
    "live_active_users": f"""WITH {assigned('1 hour', '30 minutes')}
SELECT window_end, count(DISTINCT user_id) AS active FROM w WHERE {CLOSED} GROUP BY window_end""",
    "live_union_watermark": f"""WITH {EVENTS}, s AS (
  SELECT *, CASE WHEN action IN ('view', 'click') THEN 'reader' ELSE 'other' END AS source FROM e),
b AS (
  SELECT *, (seq - min(seq) OVER k) * 8 // (max(seq) OVER k - min(seq) OVER k + 1) + CASE source WHEN 'other' THEN 2 ELSE 0 END AS batch
  FROM s WINDOW k AS (PARTITION BY source)),
c AS (
  SELECT source, batch, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq FROM b GROUP BY source, batch),
m AS (
  SELECT c.*,
    (SELECT max(ts) FROM b WHERE b.source = 'reader' AND b.batch < c.batch) AS reader,
    (SELECT max(ts) FROM b WHERE b.source = 'other' AND b.batch < c.batch) - INTERVAL '15 minutes' AS other FROM c)
SELECT source, n, first_seq, last_seq,
       CASE WHEN reader IS NOT NULL AND other IS NOT NULL THEN date_trunc('milliseconds', least(reader, other)) END AS watermark FROM m""",
    "live_window_join": f"""WITH {assigned('24 hours')},
c AS (SELECT user_id, window_start, window_end, count(*) AS clicks, min(ts) AS first_click, max(ts) AS last_click
      FROM w WHERE action = 'click' GROUP BY user_id, window_start, window_end),
p AS (SELECT user_id, window_start, window_end, count(*) AS purchases, min(ts) AS first_purchase, max(ts) AS last_purchase
      FROM w WHERE action = 'purchase' GROUP BY user_id, window_start, window_end)
SELECT * FROM c JOIN p USING (user_id, window_start, window_end)
WHERE window_end <= (SELECT least(max(ts) FILTER (WHERE action = 'click'), max(ts) FILTER (WHERE action = 'purchase')) - INTERVAL '15 minutes' FROM e)""",
    "live_refire": f"""SELECT * FROM (WITH {replay(assigned('1 hour', source=DISORDERED))} {REFIRE}) WHERE at_seq IS NOT NULL""",
    "live_watermark": f"""WITH {DISORDERED}
SELECT seq, ts, (max(ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       - INTERVAL '15 minutes' - INTERVAL '1 millisecond' AS watermark FROM e""",
    "live_late_rows": f"WITH {replay(assigned('1 hour', source=DISORDERED))} {LATE}",
    "live_late_visits": f"""WITH {replay(sliding(DISORDERED))}
SELECT window_start, window_end, count(*) AS pv, count(DISTINCT user_id) AS uv
FROM a WHERE NOT rejected GROUP BY window_start, window_end""",
    "live_reconcile": FIRST_SHIPMENTS.format(key="order_id"),
    "live_timers": FIRST_SHIPMENTS.format(key="CAST(order_id AS VARCHAR)"),
    "live_pair_shipments": STEPPED.format(key="key", at_end=False, late=""),
    "live_totals": "SELECT event_type AS action, count(*) AS n FROM events GROUP BY event_type",
    "live_groups": f"""WITH {EVENTS}, p AS (SELECT seq, (row_number() OVER (ORDER BY seq) - 1) // 1000 AS "group" FROM e)
SELECT "group", count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq FROM p GROUP BY ALL""",
    "text_scan": f"WITH {EVENTS} SELECT user_id, action, ts FROM e",
    "live_text": f"WITH {EVENTS} SELECT user_id, action, ts FROM e",
    "live_text_sink": f"""WITH {EVENTS}, t AS (SELECT *, CAST(ts AS VARCHAR) AS plain FROM e)
SELECT concat(user_id, ',', action, ',', plain, CASE WHEN contains(plain, '.') THEN '' ELSE '.0' END) AS line FROM t""",
    "union_all": f"""WITH {EVENTS} SELECT * FROM e
UNION ALL SELECT * FROM e WHERE action IN ('view', 'click')""",
    "split_side": f"WITH {BOOKS} SELECT * FROM b WHERE gender = 'ECONOMY'",
    "split_main": f"WITH {BOOKS} SELECT * FROM b WHERE gender IS DISTINCT FROM 'ECONOMY'",
    "window_join": f"""WITH {assigned('24 hours')},
c AS (SELECT user_id, window_start, window_end, count(*) AS clicks, min(ts) AS first_click, max(ts) AS last_click
      FROM w WHERE action = 'click' GROUP BY user_id, window_start, window_end),
p AS (SELECT user_id, window_start, window_end, count(*) AS purchases, min(ts) AS first_purchase, max(ts) AS last_purchase
      FROM w WHERE action = 'purchase' GROUP BY user_id, window_start, window_end)
SELECT * FROM c JOIN p USING (user_id, window_start, window_end)""",
}
