"""DuckDB SQL oracles, one per registered query, over the shared test tables.

They are written independently of the Spark plans: straight from the domain
rules (``sources.domain``) and the operator semantics (SURVEY 2), with plain
joins and window functions. Times are compared in epoch microseconds, never
as DuckDB intervals (which equate 30 days with a month).
"""

from __future__ import annotations

from ..functions import duration
from .presets import FIXTURE as P

AREA_DIM = """area_dim AS (
  SELECT CAST(c.c_custkey AS BIGINT) * 10 + 3 AS areaid, c.c_name AS aname,
         CAST(n.n_nationkey AS BIGINT) * 10 + 2 AS cid, n.n_name AS city,
         CAST(r.r_regionkey AS BIGINT) * 10 + 1 AS proid, r.r_name AS province
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

AD_CLICKS = """ad_clicks AS (
  SELECT e.event_id AS "offset", n.n_name AS area, CAST(e.user_id AS VARCHAR) AS uid,
         CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 5 AS VARCHAR) AS product_id,
         date_trunc('second', e.ts) AS ts
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE e.event_type = 'click'
    AND json_extract_string(e.props, '$.k') IS NOT NULL)"""

STATUS_LINES = """lines AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS order_id,
         CASE event_type WHEN 'click' THEN '1' WHEN 'purchase' THEN '2' WHEN 'view' THEN '3'
                         WHEN 'signup' THEN '4' WHEN 'error' THEN '5' END AS status,
         date_trunc('second', ts) AS ts, value AS money
  FROM events)"""

# Every 97th order names customer -1, who has no area.
ORDERS = """(SELECT * REPLACE (CASE WHEN o_orderkey % 97 = 0 THEN -1 ELSE o_custkey END AS o_custkey)
   FROM orders)"""

# Accepted changes of the ingested database, one row per changed row; cells a message
# does not carry are NULL.
CHANGES = f"""last_ship AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey),
o AS (
  SELECT x.*, s.last_ship, CAST(o_orderkey AS VARCHAR) AS k, epoch_ms(o_orderdate) AS created,
         epoch_ms(greatest(o_orderdate, s.last_ship)) + 3600000 AS updated
  FROM {ORDERS} x LEFT JOIN last_ship s ON s.l_orderkey = o_orderkey),
changes AS (
  SELECT 'dwshow' AS database, 'orders' AS tbl, k AS row_key, 'INSERT' AS type, created AS es,
         CAST(1 AS BIGINT) AS change_id, 0 AS pos, CAST(o_orderkey AS BIGINT) AS o_orderkey,
         CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus AS status, o_totalprice, o_orderdate,
         o_orderpriority FROM o
  UNION ALL
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'DWSHOW' ELSE 'dwshow' END, 'orders', k, 'UPDATE', updated,
         2, 0, o_orderkey, o_custkey, 'F', o_totalprice, o_orderdate, o_orderpriority
  FROM o WHERE last_ship IS NOT NULL
  UNION ALL
  SELECT 'dwshow', 'orders', k, 'DELETE', created + CAST(30 AS BIGINT) * 86400000, 3, 0, o_orderkey,
         o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM o WHERE last_ship IS NULL
  UNION ALL
  SELECT 'dwshow', 'orders', k, 'UPDATE', updated + 3600000, 4, 0, o_orderkey, NULL, NULL, NULL, NULL,
         'PATCHED' FROM o WHERE last_ship IS NOT NULL AND o_orderkey % 5 = 0
  UNION ALL
  SELECT 'dwshow', 'order_notes', k || '_' || (p + 1), 'INSERT', created + 1000, 5, p, o_orderkey,
         NULL, NULL, NULL, NULL, NULL
  FROM (SELECT *, unnest([0, 1]) AS p FROM o WHERE o_orderkey % 4 = 0)
  UNION ALL
  SELECT 'dwshow', 'orders', NULL, 'DELETE', created + 1000, 6, 0, o_orderkey, o_custkey,
         o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM o WHERE o_orderkey % 89 = 0
  UNION ALL
  SELECT 'dwshow', 'order_flags', k, 'INSERT', created + CAST(400 AS BIGINT) * 86400000, 7, 0,
         o_orderkey, NULL, 'X', NULL, NULL, NULL FROM o WHERE o_orderkey % 4 = 0)"""


def _us(d) -> int:
    return duration.micros(d)


def _floor(ts: str, width_us: int) -> str:
    return f"(epoch_us({ts}) // {width_us}) * {width_us}"


def _ts(us_expr: str) -> str:
    return f"make_timestamp({us_expr})"


def _sliding(source: str, keys: str, ts: str, width, slide, measures: str) -> str:
    w, s = _us(width), _us(slide)
    n = w // s
    return f"""
  SELECT {keys}, {_ts('start_us')} AS window_start, {_ts(f'start_us + {w}')} AS window_end,
         {measures}
  FROM (SELECT *, {_floor(ts, s)} - i * {s} AS start_us
        FROM (SELECT *, unnest(range(0, {n})) AS i FROM {source}))
  GROUP BY ALL"""


def _tumbling(source: str, keys: str, ts: str, width, measures: str) -> str:
    w = _us(width)
    return f"""
  SELECT {keys}, {_ts('start_us')} AS window_start, {_ts(f'start_us + {w}')} AS window_end,
         {measures}
  FROM (SELECT *, {_floor(ts, w)} AS start_us FROM {source})
  GROUP BY ALL"""


TEXT_TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"

ORDER_WIDTH, ORDER_SLIDE = P["order_window"]
AD_WIDTH, AD_SLIDE = P["ad_window"]
K = P["repeat_times"]
REPEAT_US = _us(P["repeat_within"])
PAY_US = _us(P["pay_within"])
LOWER_US, UPPER_US = (_us(x) for x in P["interval_bounds"])
JOIN_WIDTH_US = _us(P["window_join_width"])
TOL_US = _us(P["match_tolerance"])

CITY_SLIDING = f"""WITH {AREA_DIM},
t AS (SELECT d.city, d.province, o.o_orderdate AS ts,
             CAST(o.o_totalprice AS DECIMAL(18,2)) AS m
      FROM {ORDERS} o JOIN area_dim d ON CAST(o.o_custkey AS BIGINT) * 10 + 3 = d.areaid)
{_sliding('t', 'city, province', 'ts', ORDER_WIDTH, ORDER_SLIDE,
          'CAST(sum(m) AS DOUBLE) AS total_money, count(*) AS order_count')}"""

AD_SLIDING = f"""WITH {AD_CLICKS},
w AS ({_sliding('ad_clicks', 'product_id', 'ts', AD_WIDTH, AD_SLIDE,
                'count(*) AS click_count')})
SELECT product_id, window_start, window_end, {TEXT_TS.format('window_end')} AS end_time,
       click_count FROM w"""

RANKED_CLICKS = f"""{AD_CLICKS},
r AS (SELECT *, row_number() OVER (PARTITION BY uid, product_id ORDER BY ts, "offset") AS rn
      FROM ad_clicks)"""

PAIRS = f"""{STATUS_LINES},
s AS (SELECT * FROM lines WHERE status = '1'),
e AS (SELECT * FROM lines WHERE status = '2'),
firsts AS (
  SELECT s.order_id, s.seq AS start_seq, s.ts AS start_ts, s.money, e.seq AS end_seq,
         e.ts AS end_ts,
         row_number() OVER (PARTITION BY s.seq ORDER BY e.ts, e.seq) AS k
  FROM s JOIN e ON s.order_id = e.order_id
   AND (e.ts > s.ts OR (e.ts = s.ts AND e.seq > s.seq))
   AND epoch_us(e.ts) - epoch_us(s.ts) < {PAY_US})"""

CLICKS_BROWSES = """c AS (SELECT user_id, event_id AS click_id, ts AS click_ts FROM events
      WHERE event_type = 'click'),
b AS (SELECT user_id AS b_user_id, event_id AS browse_id, ts AS browse_ts FROM events
      WHERE event_type = 'view')"""

# The stored dimension: the current areas, and retired ones that stayed from before.
DIM_TEXT = f"""WITH {AREA_DIM},
kept AS (SELECT * FROM area_dim UNION ALL
         SELECT * REPLACE (-areaid AS areaid, 'retired' AS aname) FROM area_dim
         WHERE areaid % 100 = 3),
store AS (SELECT CAST(areaid AS VARCHAR) AS row_key, aname, CAST(areaid AS VARCHAR) AS areaid,
                 CAST(cid AS VARCHAR) AS cid, city, CAST(proid AS VARCHAR) AS proid, province
          FROM kept)"""

ORDER_TYPED = """row_key, o_orderkey, o_custkey, status AS o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority"""

ORDER_PAY = f"""WITH ord AS (SELECT o_orderkey AS ok, min(o_orderdate) AS order_ts
             FROM orders GROUP BY o_orderkey),
pay AS (SELECT l_orderkey AS pk, min(l_shipdate) AS pay_ts FROM lineitem GROUP BY l_orderkey)
SELECT coalesce(ok, pk) AS order_id, order_ts, pay_ts,
       CASE WHEN ok IS NOT NULL AND pk IS NOT NULL THEN 'matched'
            WHEN ok IS NOT NULL THEN 'unmatched_order' ELSE 'unmatched_pay' END AS outcome
FROM ord FULL OUTER JOIN pay ON ok = pk
 AND epoch_us(pay_ts) >= epoch_us(order_ts) - {TOL_US}
 AND epoch_us(pay_ts) <= epoch_us(order_ts) + {TOL_US}"""

ORACLES: dict[str, str] = {
    "city_order_total": f"""WITH {AREA_DIM}
SELECT d.city, d.province,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_money,
       count(*) AS order_count
FROM {ORDERS} o JOIN area_dim d ON CAST(o.o_custkey AS BIGINT) * 10 + 3 = d.areaid
GROUP BY d.city, d.province""",

    "city_order_running": f"""WITH {AREA_DIM}
SELECT d.city, d.province, o.o_orderkey AS order_id,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS running_money,
       count(*) OVER w AS running_count
FROM {ORDERS} o JOIN area_dim d ON CAST(o.o_custkey AS BIGINT) * 10 + 3 = d.areaid
WINDOW w AS (PARTITION BY d.city, d.province ORDER BY o.o_orderkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",

    "area_flatten": f"""WITH {AREA_DIM}
SELECT areaid, aname, cid, city, proid, province FROM area_dim""",

    "order_area_lookup": f"""WITH {AREA_DIM}
SELECT o.o_orderkey AS order_id, CAST(o.o_custkey AS BIGINT) * 10 + 3 AS area_id, d.city,
       d.province, o.o_totalprice AS total_money
FROM {ORDERS} o JOIN area_dim d ON CAST(o.o_custkey AS BIGINT) * 10 + 3 = d.areaid""",

    "order_area_missing": f"""WITH {AREA_DIM}
SELECT o.o_orderkey AS order_id, CAST(o.o_custkey AS BIGINT) * 10 + 3 AS area_id,
       o.o_totalprice AS total_money
FROM {ORDERS} o
WHERE NOT EXISTS (SELECT 1 FROM area_dim d WHERE d.areaid = CAST(o.o_custkey AS BIGINT) * 10 + 3)""",

    "city_order_sliding": CITY_SLIDING,

    "city_serving_state": f"""WITH sliding AS ({CITY_SLIDING})
SELECT province || city AS redis_key, total_money, order_count, epoch_ms(window_end) AS time
FROM sliding
QUALIFY row_number() OVER (PARTITION BY province, city ORDER BY window_end DESC) = 1""",

    "ad_events": f"""WITH {AD_CLICKS}
SELECT "offset", area, uid, product_id, ts FROM ad_clicks""",

    "ad_click_sliding": AD_SLIDING,
    "ad_click_sliding_panes": AD_SLIDING,

    "blacklist_tumbling": f"""WITH {AD_CLICKS},
w AS ({_tumbling('ad_clicks', 'uid, product_id', 'ts', P['blacklist_window'],
                 'count(*) AS click_count')})
SELECT uid, product_id, window_start, window_end, {TEXT_TS.format('window_end')} AS end_time,
       click_count
FROM w WHERE click_count >= {P['blacklist_threshold']}""",

    "blacklist_repeat_all": f"""WITH {RANKED_CLICKS},
longest AS (
  SELECT j.uid, j.product_id, j.ts AS end_ts, j.rn, min(s.rn) AS first
  FROM r j JOIN r s ON s.uid = j.uid AND s.product_id = j.product_id AND s.rn <= j.rn
   AND epoch_us(j.ts) - epoch_us(s.ts) < {REPEAT_US}
  GROUP BY ALL)
SELECT l.uid, l.product_id, l.rn - l.first + 1 AS click_count, s2.area, s1.ts AS start_ts,
       sk.ts AS shortest_start_ts, l.end_ts
FROM longest l
JOIN r s1 ON s1.uid = l.uid AND s1.product_id = l.product_id AND s1.rn = l.first
JOIN r s2 ON s2.uid = l.uid AND s2.product_id = l.product_id AND s2.rn = l.first + 1
JOIN r sk ON sk.uid = l.uid AND sk.product_id = l.product_id AND sk.rn = l.rn - {K - 1}
WHERE l.rn - l.first + 1 >= {K}""",

    "blacklist_repeat_skip": f"""WITH RECURSIVE {RANKED_CLICKS},
cand AS (
  SELECT j.uid, j.product_id, j.rn FROM r j
  JOIN r s ON s.uid = j.uid AND s.product_id = j.product_id AND s.rn = j.rn - {K - 1}
  WHERE epoch_us(j.ts) - epoch_us(s.ts) < {REPEAT_US}),
picks(uid, product_id, rn) AS (
  SELECT uid, product_id, min(rn) FROM cand GROUP BY uid, product_id
  UNION ALL
  SELECT p.uid, p.product_id,
         (SELECT min(c.rn) FROM cand c
          WHERE c.uid = p.uid AND c.product_id = p.product_id AND c.rn >= p.rn + {K})
  FROM picks p WHERE p.rn IS NOT NULL)
SELECT j.uid, j.product_id, CAST({K} AS BIGINT) AS click_count, s2.area, s.ts AS start_ts,
       j.ts AS end_ts
FROM picks p
JOIN r j ON j.uid = p.uid AND j.product_id = p.product_id AND j.rn = p.rn
JOIN r s ON s.uid = p.uid AND s.product_id = p.product_id AND s.rn = p.rn - {K - 1}
JOIN r s2 ON s2.uid = p.uid AND s2.product_id = p.product_id AND s2.rn = p.rn - {K - 2}""",

    "channel_events": """SELECT e.event_id AS "offset", c.c_mktsegment AS channel,
       CAST(e.user_id AS VARCHAR) AS uid, date_trunc('millisecond', e.ts) AS ts
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey""",

    "channel_users": f"""WITH ch AS (
  SELECT c.c_mktsegment AS channel, CAST(e.user_id AS VARCHAR) AS uid,
         date_trunc('millisecond', e.ts) AS ts
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey)
{_tumbling('ch', 'channel', 'ts', P['channel_window'], 'count(DISTINCT uid) AS user_count')}""",

    "channel_message": f"""WITH ch AS (
  SELECT c.c_mktsegment AS channel, CAST(e.user_id AS VARCHAR) AS uid,
         date_trunc('millisecond', e.ts) AS ts
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey),
u AS ({_tumbling('ch', 'channel', 'ts', P['channel_window'], 'count(DISTINCT uid) AS user_count')})
SELECT channel, window_start,
       'channel: ' || channel || ', user count: ' || CAST(user_count AS VARCHAR) AS message
FROM u""",

    "csv_orders": f"""WITH {STATUS_LINES}
SELECT seq AS "offset", order_id, status, ts, money FROM lines""",

    "order_paid": f"""WITH {PAIRS}
SELECT order_id, start_seq, start_ts, money, end_seq, end_ts FROM firsts WHERE k = 1""",

    "order_timeout": f"""WITH {PAIRS}
SELECT s.order_id, s.seq AS start_seq, s.ts AS start_ts, s.money FROM s
WHERE NOT EXISTS (SELECT 1 FROM firsts f WHERE f.start_seq = s.seq)""",

    "click_browse_interval": f"""WITH {CLICKS_BROWSES}
SELECT c.user_id, c.click_id, c.click_ts, b.browse_id, b.browse_ts
FROM c JOIN b ON c.user_id = b.b_user_id
 AND epoch_us(b.browse_ts) >= epoch_us(c.click_ts) + ({LOWER_US})
 AND epoch_us(b.browse_ts) <= epoch_us(c.click_ts) + ({UPPER_US})""",

    "click_browse_window": f"""WITH {CLICKS_BROWSES}
SELECT c.user_id, c.click_id, c.click_ts, b.browse_id, b.browse_ts,
       {_ts(_floor('c.click_ts', JOIN_WIDTH_US))} AS window_start,
       {_ts(_floor('c.click_ts', JOIN_WIDTH_US) + f' + {JOIN_WIDTH_US}')} AS window_end
FROM c JOIN b ON c.user_id = b.b_user_id
 AND epoch_us(c.click_ts) // {JOIN_WIDTH_US} = epoch_us(b.browse_ts) // {JOIN_WIDTH_US}""",

    "order_pay_match": ORDER_PAY,

    "order_pay_message": f"""WITH m AS ({ORDER_PAY})
SELECT order_id, outcome,
       CASE WHEN outcome = 'matched' AND coalesce(order_ts <= pay_ts, true)
                 THEN 'order id: ' || CAST(order_id AS VARCHAR) || ' matched'
            WHEN outcome = 'matched' THEN 'order id:' || CAST(order_id AS VARCHAR) || ' matched'
            ELSE 'order id: ' || CAST(order_id AS VARCHAR) || ' fail to match' END AS message
FROM m""",

    "changelog_rows": f"""WITH {CHANGES}
SELECT row_key, database, tbl AS "table", type, es, change_id, pos, status AS o_orderstatus,
       o_totalprice
FROM changes WHERE tbl = 'orders'""",

    "changelog_state": f"""WITH {CHANGES},
latest AS (SELECT * FROM changes WHERE row_key IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY tbl, row_key
                                      ORDER BY es DESC, change_id DESC, pos DESC) = 1)
SELECT tbl AS "table", es, {ORDER_TYPED} FROM latest WHERE type <> 'DELETE'""",

    # cell by cell: the latest put that carries it, after the key's last deletion
    "changelog_partial": f"""WITH {CHANGES},
c AS (SELECT *, es * 100 + change_id AS ord FROM changes WHERE row_key IS NOT NULL),
d AS (SELECT tbl, row_key, max(ord) AS gone FROM c WHERE type = 'DELETE' GROUP BY ALL),
puts AS (SELECT c.* FROM c LEFT JOIN d USING (tbl, row_key)
         WHERE type <> 'DELETE' AND (gone IS NULL OR ord > gone))
SELECT tbl AS "table", row_key, max(es) AS es,
       max_by(o_orderkey, ord) FILTER (WHERE o_orderkey IS NOT NULL) AS o_orderkey,
       max_by(o_custkey, ord) FILTER (WHERE o_custkey IS NOT NULL) AS o_custkey,
       max_by(status, ord) FILTER (WHERE status IS NOT NULL) AS o_orderstatus,
       max_by(o_totalprice, ord) FILTER (WHERE o_totalprice IS NOT NULL) AS o_totalprice,
       max_by(o_orderdate, ord) FILTER (WHERE o_orderdate IS NOT NULL) AS o_orderdate,
       max_by(o_orderpriority, ord) FILTER (WHERE o_orderpriority IS NOT NULL) AS o_orderpriority
FROM puts GROUP BY tbl, row_key""",

    "typed_orders": f"""WITH {CHANGES}
SELECT {ORDER_TYPED} FROM changes WHERE type = 'INSERT' AND tbl = 'orders'""",

    "row_upsert": f"""{DIM_TEXT}
SELECT * FROM store""",

    "row_as_json": f"""{DIM_TEXT}
SELECT row_key,
       CAST(json_object('aname', aname, 'areaid', areaid, 'cid', cid, 'city', city,
                        'proid', proid, 'province', province) AS VARCHAR) AS json
FROM store""",

    "row_as_dashed": f"""{DIM_TEXT}
SELECT row_key, concat_ws('-', aname, areaid, cid, city, proid, province) AS text
FROM store""",
}


# The stored orders are those the change log leaves: every order with line items.
ORACLES["city_order_total_stored"] = f"""WITH {AREA_DIM}
SELECT d.city, d.province,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_money,
       count(*) AS order_count
FROM {ORDERS} o JOIN area_dim d ON CAST(o.o_custkey AS BIGINT) * 10 + 3 = d.areaid
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
GROUP BY d.city, d.province"""

ORACLES["city_order_total_maintained"] = ORACLES["city_order_total_stored"]

# What every change takes back and adds, the running totals of each city, both sides of each step.
ORACLES["city_order_retractions"] = f"""WITH {AREA_DIM}, {CHANGES},
img AS (
  SELECT row_key, es, change_id, pos, type <> 'DELETE' AS alive,
         last_value(o_custkey IGNORE NULLS) OVER w AS cust, last_value(o_totalprice IGNORE NULLS) OVER w AS price
  FROM changes WHERE tbl = 'orders' AND row_key IS NOT NULL
  WINDOW w AS (PARTITION BY row_key ORDER BY es, change_id, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
was AS (SELECT *, lag(alive) OVER w AS alive0, lag(cust) OVER w AS cust0, lag(price) OVER w AS price0
        FROM img WINDOW w AS (PARTITION BY row_key ORDER BY es, change_id, pos)),
signed AS (SELECT row_key, es, change_id, pos, -1 AS sign, cust0 AS cust, price0 AS price FROM was WHERE alive0
           UNION ALL SELECT row_key, es, change_id, pos, 1, cust, price FROM was WHERE alive),
net AS (SELECT d.city, d.province, es, change_id, pos, row_key, sum(sign * CAST(price AS DECIMAL(18,2))) AS m,
               sum(sign) AS n
        FROM signed JOIN area_dim d ON cust * 10 + 3 = d.areaid GROUP BY ALL HAVING m <> 0 OR n <> 0),
run AS (SELECT *, sum(m) OVER w AS tm, sum(n) OVER w AS tn FROM net
        WINDOW w AS (PARTITION BY city, province ORDER BY es, change_id, pos, row_key
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT city, province, es, change_id, pos, row_key, false AS is_add, CAST(tm - m AS DOUBLE) AS total_money,
       CAST(tn - n AS BIGINT) AS order_count FROM run WHERE tn - n > 0
UNION ALL
SELECT city, province, es, change_id, pos, row_key, true, CAST(tm AS DOUBLE), CAST(tn AS BIGINT)
FROM run WHERE tn > 0"""

CHANNELS = """ch AS (
  SELECT c.c_mktsegment AS channel, CAST(e.user_id AS VARCHAR) AS uid,
         date_trunc('millisecond', e.ts) AS ts
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey)"""

ORACLES["channel_users_sliding"] = f"""WITH {CHANNELS}
{_sliding('ch', 'channel', 'ts', *P['channel_sliding'], 'count(DISTINCT uid) AS user_count')}"""

# The two slots row by row: what a fired timer flushes, then what the arrival does.
ORACLES["order_pay_arrival"] = f"""WITH RECURSIVE ev AS (
  SELECT o_orderkey AS k, 0 AS side, epoch_us(o_orderdate) AS t, 0 AS ln FROM orders
  UNION ALL SELECT o_orderkey, 0, epoch_us(o_orderdate) + 2 * CAST(86400000000 AS BIGINT), 8
  FROM orders WHERE o_orderkey % 10 = 0
  UNION ALL SELECT l_orderkey, 1, epoch_us(l_shipdate::TIMESTAMP), l_linenumber FROM lineitem),
a AS (SELECT *, (t // 86400000000 + (CAST(k AS BIGINT) * 7 + ln) % 3) AS day FROM ev),
w AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY day, ln) AS rn, count(*) OVER (PARTITION BY k) AS n,
             max(CASE WHEN side = 0 THEN t END) OVER p AS top0, max(CASE WHEN side = 1 THEN t END) OVER p AS top1
      FROM a WINDOW p AS (ORDER BY day, k, ln ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT *, CASE WHEN top0 IS NOT NULL AND top1 IS NOT NULL THEN least(top0, top1) - 1000 END AS wm FROM w),
m AS (
  SELECT DISTINCT k, CAST(0 AS BIGINT) AS rn, CAST(NULL AS INTEGER) AS slot, CAST(NULL AS BIGINT) AS st,
         CAST([] AS BIGINT[]) AS dues, CAST([] AS STRUCT(o BIGINT, p BIGINT, outcome VARCHAR)[]) AS outs FROM r
  UNION ALL
  SELECT k, rn, CASE WHEN met THEN NULL ELSE side END, CASE WHEN met THEN NULL ELSE t END,
         CASE WHEN met THEN d1 ELSE list_append(d1, t + {TOL_US}) END,
         CASE WHEN met THEN list_append(o1, {{'o': CASE WHEN side = 0 THEN t ELSE s1t END,
                                             'p': CASE WHEN side = 1 THEN t ELSE s1t END, 'outcome': 'matched'}})
              ELSE o1 END
  FROM (SELECT *, s1 IS NOT NULL AND s1 <> side AS met FROM (
    SELECT k, next AS rn, side, t, CASE WHEN fired THEN NULL ELSE slot END AS s1, st AS s1t,
           CASE WHEN fired THEN list_filter(dues, lambda d: d > wm) ELSE dues END AS d1,
           CASE WHEN fired AND slot = 0 THEN list_append(outs, {{'o': st, 'p': NULL, 'outcome': 'unmatched_order'}})
                WHEN fired AND slot = 1 THEN list_append(outs, {{'o': NULL, 'p': st, 'outcome': 'unmatched_pay'}})
                ELSE outs END AS o1
    FROM (SELECT m.k, m.slot, m.st, m.dues, m.outs, r.wm, r.side, r.t, r.rn AS next,
                 coalesce(len(list_filter(m.dues, lambda d: d <= r.wm)) > 0, false) AS fired
          FROM m JOIN r ON r.k = m.k AND r.rn = m.rn + 1)))),
x AS (SELECT m.k, CASE WHEN slot = 0 THEN list_append(outs, {{'o': st, 'p': NULL, 'outcome': 'unmatched_order'}})
                       WHEN slot = 1 THEN list_append(outs, {{'o': NULL, 'p': st, 'outcome': 'unmatched_pay'}})
                       ELSE outs END AS outs
      FROM m JOIN (SELECT DISTINCT k, n FROM r) c ON c.k = m.k AND c.n = m.rn),
y AS (SELECT k, unnest(outs) AS e FROM x)
SELECT k AS order_id, make_timestamp(e.o) AS order_ts, make_timestamp(e.p) AS pay_ts, e.outcome AS outcome FROM y"""

ORACLES["area_paths"] = f"""WITH RECURSIVE tree AS (
  SELECT CAST(r_regionkey AS BIGINT) * 10 + 1 AS id, r_name AS name, CAST(0 AS BIGINT) AS pid FROM region
  UNION ALL SELECT CAST(n_nationkey AS BIGINT) * 10 + 2, n_name, CAST(n_regionkey AS BIGINT) * 10 + 1 FROM nation
  UNION ALL SELECT CAST(c_custkey AS BIGINT) * 10 + 3, c_name, CAST(c_nationkey AS BIGINT) * 10 + 2 FROM customer
  UNION ALL SELECT CAST(o_orderkey AS BIGINT) * 10 + 4, 'order ' || o_orderkey, CAST(o_custkey AS BIGINT) * 10 + 3
  FROM {ORDERS}
  UNION ALL SELECT (CAST(l_orderkey AS BIGINT) * 8 + l_linenumber) * 10 + 5, 'item ' || l_linenumber,
                   CAST(l_orderkey AS BIGINT) * 10 + 4 FROM lineitem),
down AS (
  SELECT id, 1 AS depth, name AS root, name AS path FROM tree WHERE pid NOT IN (SELECT id FROM tree)
  UNION ALL SELECT t.id, depth + 1, root, path || '/' || t.name FROM tree t JOIN down ON t.pid = down.id)
SELECT id, depth, root, path FROM down"""

ORACLES["event_scalars"] = f"""WITH {STATUS_LINES}
SELECT seq AS "offset", len(string_split(v, ',')) AS n_parts, string_split(v, ',')[2] AS status, ts,
       sha256('{{"line":"' || v || '"}}') AS row_key
FROM (SELECT seq, ts, order_id || ',' || status || ',' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ','
             || CAST(money AS VARCHAR) AS v FROM lines)"""

# The aggregate interface gives what the built-ins give.
for _name, _builtin in (("user_city_orders", "city_order_total"), ("user_ad_clicks", "ad_click_sliding"),
                        ("user_blacklist", "blacklist_tumbling"), ("user_channel_users", "channel_users")):
    ORACLES[_name] = ORACLES[_builtin]

# ---------------------------------------------------------------- streamed twins
# A replayed log ends with a marker that closes everything, so each streamed query
# gives all rows of its batch query (late rows in the feed are dropped).

for _name in ("ad_click_sliding", "ad_click_sliding_panes", "blacklist_tumbling", "channel_users",
              "click_browse_interval", "click_browse_window", "order_timeout", "order_paid",
              "order_pay_match", "city_order_sliding", "city_serving_state", "city_order_total",
              "city_order_total_stored", "city_order_total_maintained", "order_area_missing", "changelog_state",
              "changelog_partial", "blacklist_repeat_skip", "blacklist_repeat_all"):
    ORACLES[f"stream_{_name}"] = ORACLES[_name]

# The stream numbers orders as the log brings them, by order date.
ORACLES["stream_city_order_running"] = f"""WITH {AREA_DIM},
t AS (SELECT d.city, d.province, o.o_orderkey AS order_id, o.o_orderdate AS od,
             CAST(o.o_totalprice AS DECIMAL(18,2)) AS m
      FROM {ORDERS} o JOIN area_dim d ON CAST(o.o_custkey AS BIGINT) * 10 + 3 = d.areaid)
SELECT city, province, order_id, CAST(sum(m) OVER w AS DOUBLE) AS running_money,
       count(*) OVER w AS running_count
FROM t
WINDOW w AS (PARTITION BY city, province ORDER BY od, order_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

# By processing time: the fed clock says when a message was processed.
ORACLES["stream_channel_users_processing"] = f"""WITH ch AS (
  SELECT c.c_mktsegment AS channel, CAST(e.user_id AS VARCHAR) AS uid,
         date_trunc('second', e.ts) + to_hours(CAST(e.event_id * 7919 % 7 AS INTEGER)) AS ts
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey)
{_tumbling('ch', 'channel', 'ts', P['channel_window'], 'count(DISTINCT uid) AS user_count')}"""

ORACLES["stream_city_order_processing"] = f"""WITH {AREA_DIM},
t AS (SELECT d.city, d.province, o.o_orderdate + to_hours(CAST(o.o_orderkey * 7919 % 5 AS INTEGER)) AS ts,
             CAST(o.o_totalprice AS DECIMAL(18,2)) AS m
      FROM {ORDERS} o JOIN area_dim d ON CAST(o.o_custkey AS BIGINT) * 10 + 3 = d.areaid)
{_sliding('t', 'city, province', 'ts', ORDER_WIDTH, ORDER_SLIDE,
          'CAST(sum(m) AS DOUBLE) AS total_money, count(*) AS order_count')}"""

ORACLES["stream_csv_orders"] = f"""WITH {STATUS_LINES}
SELECT order_id, status, ts, money FROM lines"""
