"""SQL for the feeds of ``sources.tables``, as common table expressions for the oracles."""

from __future__ import annotations

CTES = {
    "ev": """
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events""",
    "logs": """
  SELECT event_id, event_type AS kind, k, user_id, value, props,
         'm' || user_id AS mid,
         CASE WHEN k % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
         's' || user_id AS sid,
         CAST(user_id % 6 AS VARCHAR) AS sc,
         CAST(k % 30 AS VARCHAR) AS ar,
         'c' || (k % 4) AS ch,
         'v' || (k % 3) AS vc,
         'b' || (user_id % 7) AS ba,
         'd' || (user_id % 11) AS md,
         CASE WHEN k % 2 = 0 THEN 'ios' ELSE 'android' END AS os,
         CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
         CASE k % 5 WHEN 0 THEN 'home' WHEN 1 THEN 'course_list' WHEN 2 THEN 'course_detail'
                    WHEN 3 THEN 'order' ELSE 'search' END AS page_id,
         CASE WHEN k % 3 <> 0 THEN 'home' END AS last_page_id,
         CASE WHEN k % 5 = 4 THEN event_type || ' Course ' || (k % 10) ELSE CAST(k AS VARCHAR) END AS item,
         CASE WHEN k % 5 = 4 THEN 'keyword' ELSE 'course_id' END AS item_type,
         CASE WHEN k % 7 <> 0 THEN CAST(k * 100 AS BIGINT) END AS during_time,
         epoch_us(ts) // 1000 AS ts,
         make_timestamp(epoch_us(ts) // 1000 * 1000) AS t
  FROM ev""",
    "pages": "SELECT * FROM logs WHERE kind IN ('view', 'click', 'error')",
    "plays": """
  SELECT *, CAST(k AS VARCHAR) AS video_id, k % 30 + 1 AS play_sec, CAST(trunc(value) AS INTEGER) AS position_sec
  FROM logs WHERE kind = 'purchase'""",
    "visitors": """
  SELECT * FROM pages WHERE last_page_id IS NULL
  QUALIFY row_number() OVER (PARTITION BY mid, CAST(t AS DATE) ORDER BY ts, page_id) = 1""",
    "jumps": """
  SELECT * FROM (
    SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id) OVER w AS next_last
    FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, page_id))
  WHERE last_page_id IS NULL AND (next_ts IS NULL OR next_last IS NULL OR next_ts - ts >= 600000)""",
    "lines": """
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS course_id,
         l_orderkey, l_partkey, l_suppkey,
         strftime(l_shipdate, '%Y-%m-%d') AS date_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS origin,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS coupon,
         CAST(epoch(l_shipdate) AS BIGINT) + l_orderkey % 86400 AS ts
  FROM lineitem""",
    "infos": """
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(o_custkey % 30 AS VARCHAR) AS province_id, 'T' || o_orderkey AS out_trade_no,
         's' || (o_orderkey % 200) AS session_id, o_orderpriority AS trade_body,
         CAST(o_totalprice AS DECIMAL(16,2)) AS final_amount, o_orderstatus, o_orderdate,
         CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS ts
  FROM orders""",
    "order_sources": """
  SELECT sid, sc AS source_id FROM pages WHERE page_id = 'order'
  QUALIFY row_number() OVER (PARTITION BY sid ORDER BY ts DESC, sc DESC) = 1""",
    "details": """
  SELECT l.*, i.province_id, i.session_id, s.source_id, i.out_trade_no, i.trade_body,
         l.origin - l.coupon AS final_amount
  FROM lines l JOIN infos i ON l.order_id = i.id LEFT JOIN order_sources s ON i.session_id = s.sid""",
    "pays": """
  SELECT d.id, d.order_id, d.user_id, d.course_id, d.province_id, d.date_id, 'A' || i.id AS alipay_trade_no,
         i.trade_body, '1101' AS payment_type, '1602' AS payment_status,
         strftime(i.o_orderdate, '%Y-%m-%d %H:%M:%S') AS callback_time, i.o_orderstatus AS callback_content,
         d.origin, d.coupon, d.final_amount, CAST(epoch(i.o_orderdate) AS BIGINT) + 600 AS ts, d.ts AS op_ts
  FROM details d JOIN infos i ON d.order_id = i.id WHERE i.o_orderstatus = 'F'""",
    "registers": """
  SELECT u.user_id, u.register_time, u.register_date, d.ch AS channel, d.ar AS province_id, d.vc AS version_code,
         d.sc AS source_id, d.mid AS mid_id, d.ba AS brand, d.md AS model, d.os AS operate_system, u.ts
  FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS register_time,
               strftime(ts, '%Y-%m-%d') AS register_date, CAST(floor(epoch(ts)) AS BIGINT) AS ts
        FROM ev WHERE event_type = 'signup'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) u
  LEFT JOIN (SELECT * FROM pages WHERE uid IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts DESC, ch DESC, ar DESC) = 1) d
  ON u.user_id = d.uid""",
    "exams": """
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(k % 20 AS VARCHAR) AS paper_id, CAST(user_id AS VARCHAR) AS user_id,
         CAST(CAST(least(value, 100.0) AS DECIMAL(16,2)) AS VARCHAR) AS score,
         CAST(trunc(CAST(CAST(least(value, 100.0) AS DECIMAL(16,2)) AS DOUBLE)) AS BIGINT) AS points,
         CAST(k * 30 AS BIGINT) AS duration_sec, strftime(ts, '%Y-%m-%d') AS date_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         date_trunc('second', ts) AS t
  FROM ev WHERE event_type = 'click'""",
    "logins": """
  SELECT * FROM pages WHERE uid IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY sid ORDER BY ts, page_id) = 1""",
    "play_sessions": """
  SELECT arg_min(sc, o) AS source_id, arg_min(ar, o) AS province_id, arg_min(coalesce(uid, ''), o) AS uid0,
         arg_min(os, o) AS operating_system, arg_min(ch, o) AS channel, arg_min(is_new, o) AS is_new,
         arg_min(md, o) AS model, arg_min(mid, o) AS machine_id, arg_min(vc, o) AS version_code,
         arg_min(ba, o) AS brand, sid AS session_id, CAST(sum(play_sec) AS BIGINT) AS play_sec,
         arg_max(position_sec, o) AS position_sec, arg_min(video_id, o) AS video_id, min(ts) AS ts
  FROM (SELECT *, ts * 1000 + event_id % 1000 AS o,
               sum(opens) OVER (PARTITION BY sid ORDER BY ts, event_id) AS session_no
        FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY sid ORDER BY ts, event_id) <= 86400000
                             THEN 0 ELSE 1 END AS opens FROM plays))
  GROUP BY sid, session_no""",
}

_NEEDS = {
    "logs": ["ev"], "pages": ["logs"], "plays": ["logs"], "visitors": ["pages"], "jumps": ["pages"],
    "order_sources": ["pages"], "details": ["lines", "infos", "order_sources"],
    "pays": ["details", "infos"],
    "registers": ["ev", "pages"], "exams": ["ev"], "logins": ["pages"], "play_sessions": ["plays"],
}


def sql(body: str, *ctes: str) -> str:
    """``body`` with the named expressions, and those they build on, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in ctes:
        add(name)
    listed = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in ordered)
    return f"WITH {listed}\n{body.strip()}" if listed else body.strip()


def newest(source: str, version: str, *ties: str) -> str:
    """The newest version per ``id``; equal versions are told apart by ``ties``, compared as text."""
    order = ", ".join(f"CAST({c} AS VARCHAR) DESC NULLS LAST" for c in ties)
    return f"""(SELECT *, make_timestamp(ts * 1000000) AS t FROM {source}
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY {version} DESC, {order}) = 1)"""


def bounds(size: str, t: str = "t") -> str:
    """``stt`` and ``edt`` of the window that holds ``t``."""
    start = f"time_bucket(INTERVAL '{size}', {t})"
    fmt = "'%Y-%m-%d %H:%M:%S'"
    return f"strftime({start}, {fmt}) AS stt, strftime({start} + INTERVAL '{size}', {fmt}) AS edt"
