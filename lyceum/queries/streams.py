"""Streaming forms, replayed over the whole tables until no data is left.

What waits for a watermark replays the rows in pieces, restarting from the checkpoint for each, and then late
closing rows, so that every window, session and hold is written.  The others read one file.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lyceum.functions.times import from_epoch_seconds
from lyceum.operators import firsts, routing
from lyceum.operators.sessions import session_rollup
from lyceum.operators.windows import tumble, watermark
from lyceum.plans import details, dimensions, logs, summaries
from lyceum.queries.oracle import bounds, sql
from lyceum.queries.registry import query
from lyceum.session import scratch_path
from lyceum.sources import sinks, tables
from lyceum.sources.feeds import table_stream
from lyceum.streaming import jobs, state
from lyceum.streaming.joins import join_within

HOUR = "1 hour"


def stream_of(spark, sf_dir, name):
    """One supplied table as a file stream."""
    return tables.zoned(table_stream(spark, sf_dir, tables.SCHEMAS[name], f"{name}.parquet"), name)


def events_stream(spark, sf_dir):
    return stream_of(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def pages_of(events):
    return routing.page_log(tables.log_of(events))


def event_pieces(spark, sf_dir, pieces=3):
    """The events cut by time into pieces, and a closing piece: rows of each kind, 40 days after the last."""
    events = tables.table(spark, sf_dir, "events")
    micros = F.unix_micros("ts")
    shares = [k / pieces for k in range(1, pieces)]
    # One row to the driver: where to cut, and the last time.
    found = events.agg(F.percentile_approx(micros, shares, 1000).alias("cuts"), F.max(micros).alias("last")).first()
    ends = [None, *(found["cuts"] or []), None]
    for low, high in zip(ends, ends[1:], strict=False):
        piece = events if low is None else events.where(micros > low)
        yield piece if high is None else piece.where(micros <= high)
    newest = events.groupBy("event_type").agg(F.max_by(F.struct(*events.columns), "ts").alias("r")).select("r.*")
    yield closing_rows(newest, F.timestamp_micros(F.lit(found["last"])) + F.expr("INTERVAL 40 DAYS"))


def closing_rows(newest, at):
    """Rows at ``at`` that reach every stage: of each kind one for each page, source and claim that ``tables.log_of``
    reads from ``k``, as a stage whose filter leaves no closing row would never end.  Each has a visitor of its own."""
    rows = newest.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(14))))
    return rows.withColumns({
        "ts": at, "user_id": -(F.col("event_id") * 15 + F.col("_k") + 1),
        "props": F.to_json(F.struct(F.col("_k").alias("k")))}).drop("_k")


def replayed(spark, sf_dir, name, build):
    """The table that the stream ``build(events)`` writes in one run per piece, from one checkpoint."""
    def with_key(stream):
        return build(stream.withColumn("k", F.get_json_object("props", "$.k").cast("int")))

    return jobs.replay(spark, event_pieces(spark, sf_dir), with_key, name)


@query(sql(f"""
SELECT {bounds(HOUR, 'ts')}, event_type, count(*) AS events, round(sum(value), 4) AS total FROM ev GROUP BY 1, 2, 3""", "ev"))
def stream_window_totals(spark, sf_dir):
    def totals(events):
        rows = watermark(events, "ts")
        return tumble(rows, ["event_type"], [F.count(F.lit(1)).alias("events"), F.sum("value").alias("total")], HOUR)

    return replayed(spark, sf_dir, "window-totals", totals).withColumn("total", F.round("total", 4))


@query(sql(f"""
SELECT {bounds(HOUR)}, count(*) AS cart_add_uv_count
FROM (SELECT min(ts) AS t FROM ev WHERE event_type = 'purchase' GROUP BY user_id, CAST(ts AS DATE))
GROUP BY 1, 2""", "ev"))
def stream_cart_add_window(spark, sf_dir):
    """The same summary function as the batch job, on a stream."""
    def summary(events):
        purchases = events.where("event_type = 'purchase'")
        carts = purchases.select(F.col("user_id").cast("string"), F.unix_timestamp("ts").alias("ts"))
        return summaries.dws_trade_cart_add_window(carts, HOUR)

    return replayed(spark, sf_dir, "cart-add", summary)


@query(sql(f"""
  SELECT {bounds(HOUR)}, CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_count,
         CAST(sum(CASE WHEN page_id = 'course_list' THEN 1 ELSE 0 END) AS BIGINT) AS list_uv_count,
         CAST(sum(CASE WHEN page_id = 'course_detail' THEN 1 ELSE 0 END) AS BIGINT) AS detail_uv_count
  FROM (SELECT page_id, min(t) AS t FROM pages WHERE page_id IN ('home', 'course_list', 'course_detail')
        GROUP BY mid, page_id, CAST(t AS DATE)) GROUP BY 1, 2""", "pages"))
def stream_page_view_window(spark, sf_dir):
    return replayed(spark, sf_dir, "page-view", lambda events: summaries.dws_traffic_page_view_window(pages_of(events), HOUR))


@query(sql(f"""
  SELECT {bounds(HOUR)}, 'SEARCH' AS source, keyword, count(*) AS keyword_count
  FROM (SELECT date_trunc('second', t) AS t, unnest(string_split_regex(lower(item), '[^\\p{{L}}\\p{{N}}]+')) AS keyword
        FROM pages WHERE item IS NOT NULL AND item_type = 'keyword')
  WHERE keyword <> '' GROUP BY 1, 2, 4""", "pages"))
def stream_keyword_window(spark, sf_dir):
    return replayed(spark, sf_dir, "keywords",
                    lambda events: summaries.dws_traffic_source_keyword_page_view_window(pages_of(events), HOUR))


@query(sql("""
SELECT user_id, strftime(day, '%Y-%m-%d') AS day
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM ev WHERE event_type = 'view')""", "ev"))
def stream_visitors_of_day(spark, sf_dir):
    views = watermark(events_stream(spark, sf_dir).where("event_type = 'view'"), "ts")
    first = firsts.first_rows_of_day(views, ["user_id"])
    return jobs.materialise(first.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")), "visitors")


@query(sql("""
SELECT user_id, events, total, last_type FROM (
  SELECT user_id, max(ts) AS last_ts, count(*) AS events, round(sum(value), 4) AS total,
         arg_max(event_type, ts) AS last_type
  FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS n
        FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE
                             THEN 0 ELSE 1 END AS opens FROM ev))
  GROUP BY user_id, n)""", "ev"))
def stream_sessions(spark, sf_dir):
    def rolled(events):
        return session_rollup(watermark(events, "ts"), ["user_id"], 1800, {"total": "value"}, [], ["event_type"], "ts", ["event_id"])

    out = replayed(spark, sf_dir, "sessions", rolled)
    return out.select("user_id", "events", F.round("total", 4).alias("total"), F.col("event_type").alias("last_type"))


@query(sql("""
SELECT mid, ts, CASE WHEN is_new = '1' AND CAST(t AS DATE) <> first_date THEN '0' ELSE is_new END AS is_new
FROM (SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(t AS DATE) ELSE CAST(t AS DATE) - 1 END)
                OVER (PARTITION BY mid ORDER BY ts, is_new) AS first_date FROM logs)""", "logs"))
def stream_repaired_logs(spark, sf_dir):
    fixed = jobs.repaired_logs(tables.log_of(events_stream(spark, sf_dir)))
    return jobs.materialise(fixed, "repaired").select("common.mid", "ts", "common.is_new")


@query(sql("""
SELECT topic, count(*) AS records FROM (
  SELECT CASE kind WHEN 'signup' THEN 'dwd_traffic_start_log' WHEN 'purchase' THEN 'dwd_traffic_play_pre_process'
                   ELSE 'dwd_traffic_page_log' END AS topic FROM logs
  UNION ALL SELECT 'dwd_traffic_error_log' FROM logs WHERE kind = 'error'
  UNION ALL SELECT 'dwd_traffic_action_log' FROM logs WHERE kind = 'click'
  UNION ALL SELECT 'dwd_traffic_display_log' FROM logs, (SELECT unnest([1, 2])) WHERE kind = 'view')
GROUP BY topic""", "logs"))
def stream_routed_logs(spark, sf_dir):
    """One streaming query writes all six logs, one folder per topic."""
    records = jobs.base_log_records(tables.log_of(events_stream(spark, sf_dir)))
    return jobs.materialise(records, "routed", ["topic"]).groupBy("topic").agg(F.count(F.lit(1)).alias("records"))


@query(sql("""
SELECT user_id, event_type, event_id FROM (
  SELECT *, min(ts) OVER (PARTITION BY user_id, event_type) AS first_ts FROM ev)
WHERE ts <= first_ts + INTERVAL 1 DAY
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""", "ev"))
def stream_latest_versions(spark, sf_dir):
    """The newest version within a day of a key's first row; those after the hold are lost."""
    def held(events):
        return state.hold_latest(watermark(events, "ts"), ["user_id", "event_type"], "ts", hold_ms=state.DAY_MS,
                                 keep_ms=100 * state.DAY_MS, event_time=True)

    return replayed(spark, sf_dir, "latest", held).select("user_id", "event_type", "event_id")


@query(sql("""
SELECT user_id, login_time, mid_id, ts FROM (
  SELECT uid AS user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS login_time, mid AS mid_id, ts, t FROM logins)""", "logins"))
def stream_first_logins(spark, sf_dir):
    out = replayed(spark, sf_dir, "logins", lambda events: jobs.user_login(pages_of(events), 100 * state.DAY_MS))
    return out.select("user_id", "login_time", "mid_id", "ts")


@query(sql("""
SELECT mid, page_id, ts FROM jumps""", "jumps"))
def stream_bounces(spark, sf_dir):
    out = replayed(spark, sf_dir, "bounces", lambda events: jobs.user_jump_detail(pages_of(events), 600))
    return out.select("common.mid", "page.page_id", "ts")


@query(sql("""
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, CAST(1 AS BIGINT) AS uv_count,
       CAST(CASE WHEN day - lag(day) OVER (PARTITION BY user_id ORDER BY day) >= 8 THEN 1 ELSE 0 END AS BIGINT) AS back_count
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM ev WHERE event_type = 'signup')""", "ev"))
def stream_returning_users(spark, sf_dir):
    signups = events_stream(spark, sf_dir).where("event_type = 'signup'")
    out = jobs.materialise(state.returning_users(signups, "user_id"), "returning")
    return out.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "uv_count", "back_count")


@query("""
SELECT o_orderkey || '-' || l_linenumber AS id, CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(o_custkey % 30 AS VARCHAR) AS province_id, CAST(l_partkey AS VARCHAR) AS course_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 AND l_shipdate BETWEEN o_orderdate - INTERVAL 60 DAY AND o_orderdate + INTERVAL 60 DAY""")
def stream_order_lines(spark, sf_dir):
    """Stream-stream inner join within a time limit (both sides as change records)."""
    changes = _order_changes(spark, sf_dir)
    lines = watermark(details.rows_of(changes, "order_detail").select(
        *[details.field(c) for c in ("id", "order_id", "course_id")], from_epoch_seconds("ts").alias("line_time")),
        "line_time")
    orders = watermark(details.rows_of(changes, "order_info").select(
        F.col("data")["id"].alias("info_id"), details.field("province_id"),
        from_epoch_seconds("ts").alias("order_time")), "order_time")
    joined = join_within(lines, orders, "order_id", "info_id", "line_time", "order_time", 60 * 86400)
    return jobs.materialise(joined.select("id", "order_id", "province_id", "course_id"), "order-lines")


def _order_changes(spark, sf_dir):
    orders, lines = stream_of(spark, sf_dir, "orders"), stream_of(spark, sf_dir, "lineitem")
    return tables.order_info_of(orders).unionByName(tables.order_detail_of(lines))


@query("""
SELECT o_custkey AS user_id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS order_id FROM orders GROUP BY o_custkey""")
def stream_keyed_upsert(spark, sf_dir):
    """``foreachBatch`` into a keyed table, read back as its newest versions."""
    rows = stream_of(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("version"))
    path, checkpoint = scratch_path(spark, "keyed"), scratch_path(spark, "keyed-checkpoint")
    order = ["version", "order_id"]
    jobs.for_each_batch(rows, sinks.keyed_writer(path, ["user_id"], order), checkpoint)
    return sinks.read_keyed(spark, path, rows.schema, ["user_id"], order).select("user_id", "order_id")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS course_name, CAST(p_partkey % 30 AS VARCHAR) AS subject_id FROM part""")
def stream_dimension_upsert(spark, sf_dir):
    """The dimension loader: change records, configuration, columns cut, upserted per micro-batch."""
    raw = tables.json_feed(tables.course_info_of(stream_of(spark, sf_dir, "part")))
    root, checkpoint = scratch_path(spark, "dims"), scratch_path(spark, "dims-checkpoint")
    jobs.for_each_batch(raw, dimensions.dim_writer(root, tables.config_feed), checkpoint)
    schema = sinks.dimension_schema("id,course_name,subject_id")
    return sinks.read_dimension(spark, root, "dim_course_info", schema)


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(p_partkey % 30 AS VARCHAR) AS subject_id FROM part
UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, NULL FROM nation""", name="dim_tables")
def dim_tables(spark, sf_dir):
    """The dimension loader in batch, from raw text and the configuration's change log."""
    raw = tables.json_feed(tables.course_info_of(tables.table(spark, sf_dir, "part")).unionByName(
        tables.nation_records(spark, sf_dir)))
    dims = dimensions.dim_tables(raw, tables.config_feed(spark), {
        "dim_course_info": ["id", "course_name", "subject_id"], "dim_base_province": ["id", "name"]})
    courses = dims["dim_course_info"].withColumnRenamed("course_name", "name")
    return courses.unionByName(dims["dim_base_province"], allowMissingColumns=True)


@query(sql("""
SELECT source_id, nullif(uid0, '') AS user_id, session_id, play_sec, position_sec, video_id, ts FROM (
  SELECT *, last_ts FROM play_sessions JOIN (
    SELECT sid, max(ts) AS last_ts, min(ts) AS first_ts FROM (
      SELECT *, sum(opens) OVER (PARTITION BY sid ORDER BY ts, event_id) AS n
      FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY sid ORDER BY ts, event_id) <= 86400000
                           THEN 0 ELSE 1 END AS opens FROM plays)) GROUP BY sid, n) e
  ON e.sid = session_id AND e.first_ts = ts)""", "plays", "play_sessions"))
def stream_learn_play(spark, sf_dir):
    out = replayed(spark, sf_dir, "plays", lambda events: logs.dwd_learn_play(routing.play_log(tables.log_of(events)), 86400))
    return out.select("source_id", "user_id", "session_id", "play_sec", "position_sec", "video_id", "ts")


@query(sql(f"""
  SELECT {bounds(HOUR, 'ts')}, CAST(sum(back) AS BIGINT) AS back_count, count(*) AS uv_count
  FROM (SELECT ts, CASE WHEN CAST(ts AS DATE) - lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts) >= 8
                        THEN 1 ELSE 0 END AS back
        FROM (SELECT user_id, min(ts) AS ts FROM ev GROUP BY user_id, CAST(ts AS DATE)))
  GROUP BY 1, 2""", "ev"))
def stream_login_window(spark, sf_dir):
    """Two stages with a detail table between them: users of the day, then windows."""
    days_path, out_path, made = scratch_path(spark, "login-days"), scratch_path(spark, "login-window"), []

    def run(feed):
        days = jobs.append(state.returning_users(feed["events"].select("user_id", "ts"), "user_id"), days_path)
        made.append(jobs.append(summaries.dws_user_login_window(days, HOUR), out_path))

    jobs.replay_feeds(spark, ({"events": piece} for piece in event_pieces(spark, sf_dir)), run, "login-window")
    return spark.read.schema(made[-1].schema).parquet(out_path)


@query(sql(f"""
  SELECT {bounds(HOUR)}, province_id, count(*) AS order_count,
         CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS order_uu_count,
         CAST(sum(final_amount) AS DOUBLE) AS order_total_amount
  FROM (SELECT *, make_timestamp(ts * 1000000) AS t,
               row_number() OVER (PARTITION BY province_id, user_id, CAST(make_timestamp(ts * 1000000) AS DATE)
                                  ORDER BY ts) AS rn FROM infos)
  GROUP BY 1, 2, 3""", "infos"))
def stream_province_orders(spark, sf_dir):
    """Plain measures and users of the day meet in one window aggregate; static lookup at the end."""
    out_path, made = scratch_path(spark, "province-orders"), []

    def run(feed):
        made.append(jobs.append(summaries.dws_trade_province_order_window(
            tables.order_info_of(feed["orders"]), tables.dimensions(spark, sf_dir), HOUR), out_path))

    orders = tables.table(spark, sf_dir, "orders")
    day, cuts = F.col("o_orderdate"), [F.lit(d).cast("timestamp") for d in ("1997-03-01", "1999-07-01")]
    closing = orders.limit(1).withColumn("o_orderdate", F.lit("2030-01-01").cast("timestamp").cast(orders.schema["o_orderdate"].dataType))
    pieces = [orders.where(day < cuts[0]), orders.where((day >= cuts[0]) & (day < cuts[1])), orders.where(day >= cuts[1]), closing]
    jobs.replay_feeds(spark, ({"orders": piece} for piece in pieces), run, "province-orders")
    out = spark.read.schema(made[-1].schema).parquet(out_path)
    out = out.withColumn("order_total_amount", F.col("order_total_amount").cast("double"))
    return out.drop("province_name")
