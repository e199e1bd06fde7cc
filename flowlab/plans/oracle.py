"""DuckDB oracle SQL for the query catalogue (independent of Spark).

Column names and types match the Spark side: sums of bigint are cast back
to BIGINT (DuckDB widens them to HUGEINT), bounds are TIMESTAMP.
"""

from __future__ import annotations

_EV = "(SELECT event_id, ts, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS c FROM events)"
_ROWS = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_W_USER = f"(PARTITION BY user_id ORDER BY event_id {_ROWS})"


def _outer(how: str) -> str:
    cust = ("SELECT c_nationkey AS nationkey, count(*) AS cust_n FROM customer "
            "WHERE c_acctbal > 0 AND c_nationkey < 15 GROUP BY c_nationkey")
    supp = ("SELECT s_nationkey AS nationkey, count(*) AS supp_n FROM supplier "
            "WHERE s_nationkey >= 5 GROUP BY s_nationkey")
    fill_c = "CASE WHEN c.nationkey IS NULL THEN 'NULL' ELSE CAST(c.cust_n AS VARCHAR) END"
    fill_s = "CASE WHEN s.nationkey IS NULL THEN 'NULL' ELSE CAST(s.supp_n AS VARCHAR) END"
    if how == "left":
        sel, j = f"c.nationkey AS nationkey, c.cust_n AS cust_n, {fill_s} AS supp_n", "LEFT JOIN"
    elif how == "right":
        sel, j = f"s.nationkey AS nationkey, {fill_c} AS cust_n, s.supp_n AS supp_n", "RIGHT JOIN"
    else:
        sel, j = f"coalesce(c.nationkey, s.nationkey) AS nationkey, {fill_c} AS cust_n, {fill_s} AS supp_n", \
            "FULL OUTER JOIN"
    return f"SELECT {sel} FROM ({cust}) c {j} ({supp}) s ON c.nationkey = s.nationkey"


def _raw_outer(how: str) -> str:
    cust, line = "o.o_custkey", "l.l_linenumber"
    if how != "LEFT":
        cust = f"CASE WHEN o.orderkey IS NULL THEN 'NULL' ELSE CAST({cust} AS VARCHAR) END"
    if how != "RIGHT":
        line = f"CASE WHEN l.orderkey IS NULL THEN 'NULL' ELSE CAST({line} AS VARCHAR) END"
    return f"""
SELECT coalesce(o.orderkey, l.orderkey) AS orderkey, {cust} AS o_custkey, {line} AS l_linenumber
FROM (SELECT o_orderkey AS orderkey, o_custkey FROM orders WHERE o_totalprice > 100000) o
{how} JOIN (SELECT l_orderkey AS orderkey, l_linenumber FROM lineitem WHERE l_quantity > 25) l
ON o.orderkey = l.orderkey"""


def _sessions(gap_us: int, keyed: bool, key: str = "user_id", src: str | None = None) -> str:
    part = f"PARTITION BY {key} " if keyed else ""
    key_sel = f"{key}, " if keyed else ""
    src = src or _EV
    return f"""
WITH f AS (
  SELECT *, CASE WHEN lag(ts) OVER ({part}ORDER BY ts, event_id) IS NULL
                   OR epoch_us(ts) - epoch_us(lag(ts) OVER ({part}ORDER BY ts, event_id)) > {gap_us}
              THEN 1 ELSE 0 END AS new_session
  FROM {src}),
g AS (SELECT *, sum(new_session) OVER ({part}ORDER BY ts, event_id {_ROWS}) AS sid FROM f)
SELECT {key_sel}min(ts) AS session_start, make_timestamp(epoch_us(max(ts)) + {gap_us}) AS session_end,
       count(*) AS n, CAST(sum(c) AS BIGINT) AS sum_c
FROM g GROUP BY {key_sel}sid"""


def _sliding(size_us: int, slide_us: int, keyed: bool, more: str = "") -> str:
    k = size_us // slide_us
    key_sel = "event_type, " if keyed else ""
    return f"""
SELECT {key_sel}make_timestamp(s) AS window_start, make_timestamp(s + {size_us}) AS window_end,
       count(*) AS n, CAST(sum(c) AS BIGINT) AS sum_c{more}
FROM (SELECT e.*, (floor(epoch_us(ts) / {slide_us})::BIGINT - o.k) * {slide_us} AS s
      FROM {_EV} e, range(0, {k}) o(k))
GROUP BY {key_sel}s"""


ORACLE_SQL: dict[str, str] = {
    "filter_project": """
SELECT p_partkey, p_name, CAST(p_retailprice AS DOUBLE) / p_size AS price_per_size
FROM part WHERE starts_with(p_name, 's')""",
    "parse_lines": """
SELECT o_orderstatus AS status_tag, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders""",
    "group_sum": """
SELECT event_type, count(*) AS n FROM events
WHERE starts_with(event_type, 'c') OR starts_with(event_type, 'p') GROUP BY event_type""",
    "split_even_odd": """
SELECT 'main' AS branch, event_id FROM events
UNION ALL
SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS branch, event_id FROM events""",
    "join_inner": """
SELECT c.c_nationkey AS nationkey, c.c_custkey, c.c_name, n.n_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_nationkey < 15""",
    "join_left_fill": _outer("left"),
    "join_right_fill": _outer("right"),
    "join_full_fill": _outer("full"),
    "join_left_raw": _raw_outer("LEFT"),
    "join_right_raw": _raw_outer("RIGHT"),
    "join_full_raw": _raw_outer("FULL"),
    "anti_broadcast_count": f"""
SELECT event_id, user_id, event_type,
       count(*) OVER (PARTITION BY event_type ORDER BY event_id {_ROWS}) AS n
FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.value > 250)""",
    "rolling_sum": f"""
SELECT event_id, user_id, c, CAST(sum(c) OVER w AS BIGINT) AS sum_c, first_value(event_type) OVER w AS first_event_type
FROM {_EV} WINDOW w AS {_W_USER}""",
    "rolling_min": f"""
SELECT event_id, user_id, c, min(c) OVER w AS min_c, first_value(event_type) OVER w AS first_event_type
FROM {_EV} WINDOW w AS {_W_USER}""",
    "rolling_max": f"""
SELECT event_id, user_id, c, max(c) OVER w AS max_c, first_value(event_type) OVER w AS first_event_type
FROM {_EV} WINDOW w AS {_W_USER}""",
    "rolling_argmin": f"""
SELECT event_id, user_id, c, m.v AS argmin_c, m.o AS argmin_event_id, m.et AS argmin_event_type
FROM (SELECT *, min(struct_pack(v := c, t := event_id, o := event_id, et := event_type)) OVER w AS m
      FROM {_EV} WINDOW w AS {_W_USER})""",
    "rolling_argmax": f"""
SELECT event_id, user_id, c, m.v AS argmax_c, m.o AS argmax_event_id, m.et AS argmax_event_type
FROM (SELECT *, max(struct_pack(v := c, t := -event_id, o := event_id, et := event_type)) OVER w AS m
      FROM {_EV} WINDOW w AS {_W_USER})""",
    "rolling_reduce": f"""
SELECT event_id, user_id, c, CAST(sum(c) OVER w AS BIGINT) AS sum_c, count(*) OVER w AS cnt,
       first_value(event_type) OVER w AS first_event_type
FROM {_EV} WINDOW w AS {_W_USER}""",
    "rolling_reduce_kinds": f"""
SELECT event_id, user_id, c, min(c) OVER w AS min_c, max(c) OVER w AS max_c, count(c) OVER w AS cnt, first_value(c) OVER w AS first_c
FROM {_EV} WINDOW w AS {_W_USER}""",
    "rolling_avg": f"""
SELECT event_id, user_id, c, CAST(sum(c) OVER w AS DOUBLE) / count(*) OVER w AS avg_c
FROM {_EV} WINDOW w AS {_W_USER}""",
    "final_aggregates": f"""
SELECT event_type, count(*) AS n, CAST(sum(c) AS BIGINT) AS sum_c, min(c) AS min_c, max(c) AS max_c,
       min(struct_pack(v := c, t := event_id)).t AS argmin_event_id,
       max(struct_pack(v := c, t := -event_id, o := event_id)).o AS argmax_event_id,
       CAST(sum(c) AS DOUBLE) / count(*) AS avg_c,
       min(struct_pack(v := c, t := event_id, u := user_id)).u AS argmin_user_id,
       max(struct_pack(v := c, t := -event_id, u := user_id)).u AS argmax_user_id,
       min(struct_pack(t := event_id, u := user_id)).u AS first_user_id
FROM {_EV} GROUP BY event_type""",
    "tumbling": _sliding(3_600_000_000, 3_600_000_000, keyed=True),
    "sliding_keyed": _sliding(7_200_000_000, 3_600_000_000, keyed=True),
    "sliding_global": _sliding(14_400_000_000, 7_200_000_000, keyed=False),
    "sliding_day_by_minute": _sliding(86_400_000_000, 60_000_000, keyed=True, more=", min(c) AS min_c, max(c) AS max_c"),
    "session_keyed": _sessions(6 * 3_600_000_000, keyed=True),
    "session_global": _sessions(5 * 60_000_000, keyed=False),
    "late_report": """
SELECT event_id, ts, wm AS watermark, coalesce(ts + INTERVAL 5 MINUTE <= wm, false) AS late
FROM (SELECT event_id, ts,
             max(ts) OVER (ORDER BY CASE WHEN event_id % 7 = 0 THEN event_id + 2 ELSE event_id END, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 3500 MILLISECOND AS wm
      FROM events)""",
    "count_trigger_5": f"""
SELECT user_id, event_id, n, total, first_event_type FROM (
  SELECT user_id, event_id, count(*) OVER w AS n, CAST(sum(c) OVER w AS BIGINT) AS total,
         first_value(event_type) OVER w AS first_event_type
  FROM {_EV} WINDOW w AS {_W_USER})
WHERE n % 5 = 0""",
    "count_window_10": f"""
SELECT user_id, (rn - 1) // 10 AS window_no, CAST(sum(c) AS BIGINT) AS total
FROM (SELECT user_id, c, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM {_EV})
GROUP BY user_id, (rn - 1) // 10 HAVING count(*) = 10""",
    "count_window_10_list": f"""
SELECT user_id, (rn - 1) // 10 AS window_no,
       ' ' || string_agg(CAST(c AS VARCHAR), ' ' ORDER BY event_id) AS "values",
       CAST(sum(c) AS BIGINT) AS total
FROM (SELECT user_id, event_id, c, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM {_EV})
GROUP BY user_id, (rn - 1) // 10 HAVING count(*) = 10""",
    "batched_sink": f"""
SELECT shard, (rn - 1) // 100 AS batch_no, count(*) AS "rows", min(event_id) AS first_event_id,
       max(event_id) AS last_event_id, CAST(sum(c) AS BIGINT) AS total
FROM (SELECT event_id % 4 AS shard, event_id, c,
             row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) AS rn FROM {_EV})
GROUP BY shard, (rn - 1) // 100 HAVING count(*) = 100""",
    "iterate_until": """
WITH RECURSIVE it(l_orderkey, l_linenumber, n, steps) AS (
  SELECT l_orderkey, l_linenumber, l_linenumber, 0 FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_linenumber, CASE WHEN n = 10 THEN n ELSE n + 1 END,
         CASE WHEN n = 10 THEN steps ELSE steps + 1 END
  FROM it WHERE n <> 10)
SELECT l_orderkey, l_linenumber, n, steps FROM it WHERE n = 10""",
}

ORACLE_SQL.update({
    "group_sum_stream": ORACLE_SQL["group_sum"],
    "anti_broadcast_stream": """
SELECT event_id, user_id, event_type FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.value > 250)""",
    "tumbling_stream": ORACLE_SQL["tumbling"],
    "sliding_global_stream": ORACLE_SQL["sliding_global"],
    "session_global_stream": ORACLE_SQL["session_global"],
    "session_watermark_stream": ORACLE_SQL["session_global"],
    "count_window_10_stream": ORACLE_SQL["count_window_10"],
    "state_snapshot": """
SELECT user_id, count(*) % 10 AS leftover FROM events GROUP BY user_id HAVING count(*) % 10 <> 0""",
    "recovered_stream": ORACLE_SQL["count_window_10"],
    "batched_sink_stream": ORACLE_SQL["batched_sink"],
})

_HOT = ("(SELECT event_id, ts, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS hot_user, event_type, "
        "CAST(round(value * 100) AS BIGINT) AS c FROM events)")

ORACLE_SQL.update({
    "rolling_sum_stream": ORACLE_SQL["rolling_sum"],
    "count_trigger_5_stream": ORACLE_SQL["count_trigger_5"],
    "count_window_10_list_stream": ORACLE_SQL["count_window_10_list"],
    "sliding_keyed_stream": ORACLE_SQL["sliding_keyed"],
    "session_keyed_stream": ORACLE_SQL["session_keyed"],
    "rolling_sum_hot_key": f"""
SELECT event_id, hot_user, c,
       CAST(sum(c) OVER (PARTITION BY hot_user ORDER BY event_id {_ROWS}) AS BIGINT) AS sum_c,
       first_value(event_type) OVER (PARTITION BY hot_user ORDER BY event_id {_ROWS}) AS first_event_type
FROM {_HOT}""",
    "count_window_10_hot_key": f"""
SELECT hot_user, (rn - 1) // 10 AS window_no, CAST(sum(c) AS BIGINT) AS total
FROM (SELECT hot_user, c, row_number() OVER (PARTITION BY hot_user ORDER BY event_id) AS rn FROM {_HOT})
GROUP BY hot_user, (rn - 1) // 10 HAVING count(*) = 10""",
})

ORACLE_SQL.update({
    "rolling_argmax_hot_key": f"""
SELECT event_id, hot_user, c, m.v AS argmax_c, m.o AS argmax_event_id, m.et AS argmax_event_type
FROM (SELECT *, max(struct_pack(v := c, t := -event_id, o := event_id, et := event_type))
                OVER (PARTITION BY hot_user ORDER BY event_id {_ROWS}) AS m
      FROM {_HOT})""",
    "session_keyed_hot_key": _sessions(6 * 3_600_000_000, keyed=True, key="hot_user", src=_HOT),
})

ORACLE_SQL.update({
    "rolling_max_hot_key_by_time": f"""
SELECT event_id, ts, hot_user, c,
       max(c) OVER (PARTITION BY hot_user ORDER BY ts {_ROWS}) AS max_c,
       first_value(event_type) OVER (PARTITION BY hot_user ORDER BY ts {_ROWS}) AS first_event_type
FROM {_HOT}""",
})

ORACLE_SQL["rolling_argmin_stream"] = ORACLE_SQL["rolling_argmin"]

ORACLE_SQL["batched_sink_rows"] = f"""
SELECT event_id, c, shard, batch_no FROM (
  SELECT event_id, c, event_id % 4 AS shard,
         (row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) - 1) // 100 AS batch_no,
         count(*) OVER (PARTITION BY event_id % 4) AS shard_rows
  FROM {_EV})
WHERE (batch_no + 1) * 100 <= shard_rows"""

ORACLE_SQL["batched_sink_rows_stream"] = ORACLE_SQL["batched_sink_rows"]
