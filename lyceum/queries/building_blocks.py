"""Single operators on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lyceum import schemas
from lyceum.functions import keywords, times, values
from lyceum.operators import cleaning, firsts, joins, latest, lookup, routing, sessions, windows
from lyceum.operators.skew import skew_join
from lyceum.plans import details
from lyceum.queries.oracle import bounds, sql
from lyceum.queries.registry import query
from lyceum.session import scratch_path
from lyceum.sources import feeds, sinks, tables

HOUR, DAY = "1 hour", "1 day"


def events(spark, sf_dir):
    return tables.events(spark, sf_dir)


# --- sources, sinks, cleaning ------------------------------------------------------------------
@query(sql("""
SELECT id, user_id, province_id, session_id, CAST(final_amount AS VARCHAR) AS final_amount,
       CAST(ts AS VARCHAR) AS ts FROM infos""", "infos"))
def source_change_records(spark, sf_dir):
    """JSON text of the whole order table -> typed change records -> fields."""
    raw = tables.json_feed(tables.change_feed(spark, sf_dir, "order_info"))
    rows = details.rows_of(feeds.change_records(raw), "order_info")
    names = ("id", "user_id", "province_id", "session_id", "final_amount")
    return rows.select(*[details.field(n) for n in names], "ts")


@query(sql("SELECT sid, sc, page_id, last_page_id, ts FROM pages WHERE uid IS NOT NULL", "pages"))
def source_page_log_maps(spark, sf_dir):
    raw = tables.json_feed(routing.page_log(tables.behaviour_log(spark, sf_dir)).select("common", "page", "ts"))
    rows = feeds.page_log_maps(raw).where(F.col("common")["uid"].isNotNull())
    return rows.select(*[F.col("common")[c].alias(c) for c in ("sid", "sc")],
                       *[F.col("page")[c].alias(c) for c in ("page_id", "last_page_id")], "ts")


@query(sql("""
SELECT id, order_id, CAST(origin - coupon AS VARCHAR) AS final_amount, CAST(ts AS VARCHAR) AS ts
FROM lines WHERE l_partkey % 10 <> 0""", "lines"))
def source_keyed_detail_with_tombstones(spark, sf_dir):
    """A keyed detail topic read back; deletions are null values."""
    rows = details.rows_of(tables.change_feed(spark, sf_dir, "order_detail"), "order_detail").select(
        *[details.field(c) for c in ("id", "order_id", "course_id", "final_amount")], "ts")
    deleted = F.col("course_id").cast("int") % 10 == 0
    topic = rows.select(F.when(~deleted, F.to_json(F.struct(*rows.columns))).alias("value"))
    return feeds.order_details(topic).select("id", "order_id", "final_amount", "ts")


def _dirty_feed(spark, sf_dir):
    """Behaviour log as text, every 97th record cut short."""
    rows = events(spark, sf_dir)
    log = tables.log_of(rows).withColumn("_n", F.lit(0))
    value = F.to_json(F.struct(*[c for c in log.columns if c != "_n"]))
    cut = (F.col("ts") % 97) == 0
    return log.select(F.when(cut, F.substring(value, 1, 40)).otherwise(value).alias("value"))


@query(sql("SELECT mid, kind = 'error' AS has_error, ts FROM logs WHERE ts % 97 <> 0", "logs").replace(
    "kind = 'error' AS has_error", "CASE WHEN kind = 'error' THEN 1 ELSE 0 END AS has_error"))
def clean_log_records(spark, sf_dir):
    clean, _ = cleaning.clean_logs(_dirty_feed(spark, sf_dir), schemas.BEHAVIOUR_LOG)
    return clean.select("common.mid", F.col("err").isNotNull().cast("int").alias("has_error"), "ts")


@query(sql("SELECT mid, ts FROM logs", "logs"))
def clean_log_text_numbers(spark, sf_dir):
    """Logs that write their time as text are as clean as others."""
    log = tables.log_of(events(spark, sf_dir))
    fields = [F.col(c).cast("string").alias(c) if c == "ts" else F.col(c) for c in log.columns]
    clean, dirty = cleaning.clean_logs(log.select(F.to_json(F.struct(*fields)).alias("value")), schemas.BEHAVIOUR_LOG)
    return clean.select("common.mid", "ts").unionByName(dirty.select(F.col("value").alias("mid"), F.lit(0).cast("long").alias("ts")))


@query(sql("""
SELECT CASE WHEN uid IS NULL THEN substr('{"common":{"mid":"' || mid || '","sid":"' || sid || '","sc":"' || sc || '","ar', 1, 40)
            ELSE substr('{"common":{"mid":"' || mid || '","uid":"' || uid || '","sid":"' || sid || '"', 1, 40) END AS value
FROM logs WHERE ts % 97 = 0""", "logs"))
def clean_log_dirty(spark, sf_dir):
    """Text that is not a whole JSON record."""
    _, dirty = cleaning.clean_logs(_dirty_feed(spark, sf_dir), schemas.BEHAVIOUR_LOG)
    return dirty


@query("""
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'dirty' ELSE 'clean' END AS kind, count(*) AS records
FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1""")
def clean_change_records(spark, sf_dir):
    """Change records: without a type they are dirty, snapshot markers are dropped."""
    feed = tables.change_feed(spark, sf_dir, "order_info")
    kind = F.col("data")["trade_body"]
    feed = feed.withColumn("type", F.when(kind == "5-LOW", F.lit("bootstrap-start"))
                           .when(kind == "1-URGENT", F.lit(None)).otherwise(F.lit("insert")))
    clean, dirty = cleaning.clean_changes(tables.json_feed(feed), schemas.CHANGE_RECORD)
    both = clean.select(F.lit("clean").alias("kind")).unionByName(dirty.select(F.lit("dirty").alias("kind")))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("records"))


@query("""
SELECT '{"user_id":' || user_id || ',"event_type":"' || event_type || '","props":' || to_json(props) || '}' AS value,
       '{"event_id":' || event_id || '}' AS key FROM events""")
def sink_json_values(spark, sf_dir):
    """Rows as the key and value text a topic takes."""
    rows = events(spark, sf_dir).select("event_id", "user_id", "event_type", "props")
    return sinks.json_values(rows, ["event_id"]).select(
        "key", F.regexp_replace("value", r'"event_id":\d+,', "").alias("value"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def sink_keyed_upsert(spark, sf_dir):
    """Two batches into a keyed table, the second one replayed; read back as newest versions."""
    rows = tables.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    path, order = scratch_path(spark, "keyed-lines"), ["l_shipdate", "l_partkey", "l_suppkey"]
    write = sinks.keyed_writer(path, ["l_orderkey"], order)
    early = F.col("l_shipdate") < "1998-01-01"
    write(rows.where(early), 0)
    write(rows.where(~early), 1)
    write(rows.where(~early), 1)
    return sinks.read_keyed(spark, path, rows.schema, ["l_orderkey"], order).drop("l_shipdate")


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation""")
def sink_dimension(spark, sf_dir):
    """Dimension table created from its configuration, then upserted."""
    root = scratch_path(spark, "nation-dim")
    schema = sinks.ensure_dimension(spark, root, "dim_base_province", "id,name")
    sinks.dimension_writer(root, tables.dimension_config)(tables.nation_records(spark, sf_dir), 0)
    return sinks.read_dimension(spark, root, "dim_base_province", schema)


# --- projection and filters --------------------------------------------------------------------
@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, 'id,course_name,subject_id' AS kept, p_name AS course_name FROM part""")
def project_configured_columns(spark, sf_dir):
    """Only whole listed names stay: ``price`` goes, ``id`` is kept for being listed."""
    changes = tables.course_info_of(tables.table(spark, sf_dir, "part"))
    kept = lookup.keep_columns("data", F.lit("id,course_name,subject_id"))
    return changes.select(kept.alias("d")).select(
        F.col("d")["id"].alias("id"), F.array_join(F.map_keys("d"), ",").alias("kept"),
        F.col("d")["course_name"].alias("course_name"))


@query("""
SELECT o_orderkey AS order_id, '1602' AS payment_status FROM orders WHERE o_orderstatus = 'F'""")
def filter_paid(spark, sf_dir):
    paid = details.rows_of(tables.change_feed(spark, sf_dir, "payment_info"), "payment_info", None)
    paid = paid.where(F.col("data")["payment_status"] == details.PAID)
    return paid.select(F.col("data")["order_id"].cast("long").alias("order_id"), details.field("payment_status"))


@query(sql("""
SELECT mid, page_id, uid, ts FROM pages
WHERE last_page_id IS NULL AND uid IS NOT NULL AND page_id IN ('home', 'course_list', 'course_detail')""", "pages"))
def filter_first_pages(spark, sf_dir):
    pages = routing.page_log(tables.behaviour_log(spark, sf_dir))
    wanted = pages.where(F.col("page.last_page_id").isNull() & F.col("common.uid").isNotNull()
                         & F.col("page.page_id").isin("home", "course_list", "course_detail"))
    return wanted.select("common.mid", "page.page_id", "common.uid", "ts")


# --- splitting ---------------------------------------------------------------------------------
@query(sql("""
SELECT topic, count(*) AS records FROM (
  SELECT CASE kind WHEN 'signup' THEN 'dwd_traffic_start_log' WHEN 'purchase' THEN 'dwd_traffic_play_pre_process'
                   ELSE 'dwd_traffic_page_log' END AS topic FROM logs
  UNION ALL SELECT 'dwd_traffic_error_log' FROM logs WHERE kind = 'error'
  UNION ALL SELECT 'dwd_traffic_action_log' FROM logs WHERE kind = 'click'
  UNION ALL SELECT 'dwd_traffic_display_log' FROM logs, (SELECT unnest([1, 2])) WHERE kind = 'view')
GROUP BY topic""", "logs"))
def split_topic_records(spark, sf_dir):
    records = routing.as_topic_records(tables.behaviour_log(spark, sf_dir))
    return records.groupBy("topic").agg(F.count(F.lit(1)).alias("records"))


@query("""
SELECT conv_id, turn, word FROM (
  SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations)""")
def split_exploded_words(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", F.explode(F.split("text", " ")).alias("word"))


# --- joins ---------------------------------------------------------------------------------------
@query("""
SELECT o_orderpriority AS priority, count(*) AS lines, round(sum(l_extendedprice), 2) AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def join_lines_with_orders(spark, sf_dir):
    """Inner join with hot keys salted."""
    lines = tables.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_extendedprice", "l_linenumber")
    orders = tables.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), "o_orderpriority")
    joined = skew_join(lines, orders, ["order_id"], "inner", salted=True, share=1e-4, slice_rows=3)
    return joined.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("""
SELECT o_orderkey AS order_id, o_custkey AS user_id, e.event_id FROM orders
LEFT JOIN (SELECT user_id, event_id FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) e
ON o_custkey = e.user_id""")
def join_orders_with_last_event(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    last = latest.latest_per_key(events(spark, sf_dir), "user_id", ["ts", "event_id"]).select(
        F.col("user_id").alias("event_user"), "event_id")
    return joins.join_feeds(orders, last, "user_id", "event_user", "left")


@query("""
SELECT l_orderkey AS order_id, l_partkey AS course_id, o_custkey AS user_id FROM lineitem JOIN orders
ON l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 30 DAY""")
def join_within_time(spark, sf_dir):
    lines = tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("course_id"), F.col("l_shipdate").alias("line_time"))
    orders = tables.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("info_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("order_time"))
    joined = joins.join_feeds(lines, orders, "order_id", "info_id", "inner", "line_time", "order_time", "30 days")
    return joined.select("order_id", "course_id", "user_id")


@query("""
SELECT o_orderkey AS order_id, l_partkey AS course_id, l_suppkey AS user_id FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC) AS rn
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
   AND l_shipdate BETWEEN o_orderdate - INTERVAL 60 DAY AND o_orderdate + INTERVAL 60 DAY)
WHERE rn = 1""")
def join_latest_within_time(spark, sf_dir):
    """Each order with the newest of its lines at most 60 days away, if any."""
    orders = tables.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_time"))
    lines = tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("line_order"), F.col("l_partkey").alias("course_id"),
        F.col("l_suppkey").alias("user_id"), F.col("l_shipdate").alias("line_time"))
    out = joins.latest_within(orders, lines, "order_id", "line_order", "order_time", "line_time", "60 days")
    return out.select("order_id", "course_id", "user_id")


@query("""
SELECT c_mktsegment AS segment, n_name AS nation, r_name AS region, customers FROM (
  SELECT c_mktsegment, c_nationkey, count(*) AS customers FROM customer GROUP BY 1, 2)
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def lookup_chain(spark, sf_dir):
    """Aggregate first, then look up one dimension by what the other says."""
    counted = tables.table(spark, sf_dir, "customer").groupBy(
        F.col("c_mktsegment").alias("segment"), "c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    region = tables.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("region"))
    nations = tables.table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "id")
    out = lookup.lookups(counted, (nations, "c_nationkey", {"n_name": "nation", "n_regionkey": "n_regionkey"}),
                         (region, "n_regionkey", {"region": "region"}))
    return out.select("segment", "nation", "region", "customers")


@query("""
SELECT l_suppkey AS supplier, nation, lines, s_name AS name FROM (
  SELECT l_suppkey, l_linenumber % 25 AS nation, count(*) AS lines FROM lineitem GROUP BY 1, 2)
LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = nation""")
def lookup_several_keys(spark, sf_dir):
    counted = tables.table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("supplier"), (F.col("l_linenumber") % 25).alias("nation")
    ).agg(F.count(F.lit(1)).alias("lines"))
    return lookup.lookup(counted, tables.table(spark, sf_dir, "supplier"),
                         {"supplier": "s_suppkey", "nation": "s_nationkey"}, {"s_name": "name"})


def _config_changes(spark, sf_dir):
    """Suppliers as configuration changes of 25 source tables: some delete, some lack an operation."""
    row = F.struct(
        F.concat(F.lit("t"), F.col("s_nationkey").cast("string")).alias("source_table"),
        F.concat(F.lit("dim_"), F.col("s_name")).alias("sink_table"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("id,c_name")).otherwise(F.lit("id,c_mktsegment")).alias("sink_columns"),
        F.lit(None).cast("string").alias("sink_pk"), F.lit(None).cast("string").alias("sink_extend"))
    deletes = F.col("s_suppkey") % 7 == 0
    changes = tables.table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_suppkey") % 11 == 0, F.lit(None)).when(deletes, F.lit("d")).otherwise(F.lit("u")).alias("op"),
        F.when(deletes, row).alias("before"), F.when(~deletes, row).alias("after"),
        F.col("s_suppkey").alias("ts_ms"))
    return feeds.config_changes(tables.json_feed(changes))


CONFIG_SQL = """
SELECT 't' || s_nationkey AS source_table, 'dim_' || s_name AS sink_table,
       CASE WHEN s_suppkey % 2 = 0 THEN 'id,c_name' ELSE 'id,c_mktsegment' END AS sink_columns
FROM (SELECT * FROM supplier WHERE s_suppkey % 11 <> 0
      QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1)
WHERE s_suppkey % 7 <> 0"""


@query(CONFIG_SQL)
def config_fold(spark, sf_dir):
    config = lookup.fold_config(_config_changes(spark, sf_dir), ["ts_ms"])
    return config.select("source_table", "sink_table", "sink_columns")


@query(f"""
SELECT sink_table, 'id' AS sink_pk, CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN sink_columns = 'id,c_name' THEN c_name END AS c_name,
       CASE WHEN sink_columns = 'id,c_mktsegment' THEN c_mktsegment END AS c_mktsegment
FROM customer JOIN ({CONFIG_SQL}) ON source_table = 't' || c_nationkey""")
def config_routing(spark, sf_dir):
    """Change records of 25 source tables, cut and sent where the configuration says."""
    customers = tables.table(spark, sf_dir, "customer")
    changes = customers.select(
        F.concat(F.lit("t"), F.col("c_nationkey").cast("string")).alias("table"), F.lit("insert").alias("type"),
        F.create_map(F.lit("id"), F.col("c_custkey").cast("string"), F.lit("c_name"), F.col("c_name"),
                     F.lit("c_mktsegment"), F.col("c_mktsegment")).alias("data"), F.lit("0").alias("ts"))
    config = lookup.fold_config(_config_changes(spark, sf_dir), ["ts_ms"])
    routed = lookup.dimension_changes(changes, config)
    return routed.select("sink_table", "sink_pk", *[F.col("data")[c].alias(c) for c in ("id", "c_name", "c_mktsegment")])


# --- keyed operators -----------------------------------------------------------------------------
@query("""
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def keyed_latest_version(spark, sf_dir):
    rows = latest.latest_per_key(events(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"])
    return rows.select("user_id", "event_type", "event_id", "value")


@query("""
SELECT event_id, user_id, CAST(CASE WHEN row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1
                               THEN 1 ELSE 0 END AS BIGINT) AS is_first FROM events""")
def keyed_first_of_day_flag(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts")
    return firsts.flag_first_of_day(rows, ["user_id"], ["event_id"]).select("event_id", "user_id", "is_first")


@query("""
SELECT event_id, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""")
def keyed_first_rows_of_day(spark, sf_dir):
    return firsts.first_rows_of_day(events(spark, sf_dir), ["user_id"], "ts", ["event_id"]).select(
        "event_id", "user_id", "event_type")


@query("""
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS buyers, CAST(sum(CASE WHEN day = first_day THEN 1 ELSE 0 END) AS BIGINT) AS new_buyers
FROM (SELECT day, min(day) OVER (PARTITION BY o_custkey) AS first_day
      FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders))
GROUP BY 1""")
def keyed_first_ever(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").alias("ts"))
    days = firsts.first_sightings(orders, ["o_custkey"])
    ever = firsts.first_ever(days, ["o_custkey"])
    one = F.lit(1).cast("long")
    out = windows.tumble_measures([days.withColumn("buyers", one), ever.withColumn("new_buyers", one)], [],
                                  ["buyers", "new_buyers"], DAY)
    return out.select(F.substring("stt", 1, 10).alias("day"), "buyers", "new_buyers")


@query("""
SELECT o_custkey AS user_id, strftime(day, '%Y-%m-%d') AS day, CAST(1 AS BIGINT) AS uv_count,
       CAST(CASE WHEN day - lag(day) OVER (PARTITION BY o_custkey ORDER BY day) >= 8 THEN 1 ELSE 0 END AS BIGINT) AS back_count
FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)""")
def keyed_returning_users(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("ts"))
    out = firsts.returning_users(orders, "user_id")
    return out.select("user_id", times.date_text("ts").alias("day"), "uv_count", "back_count")


@query(sql("""
SELECT event_id, user_id, CASE WHEN is_new = '1' AND CAST(ts AS DATE) <> first_date THEN '0' ELSE is_new END AS is_new
FROM (SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END)
                OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_date
      FROM (SELECT *, CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new FROM ev))""", "ev"))
def keyed_new_visitor_repair(spark, sf_dir):
    """With the salted join forced."""
    rows = events(spark, sf_dir).withColumn("is_new", F.when(F.col("event_type") == "signup", "1").otherwise("0"))
    fixed = firsts.repair_new_visitor(rows, "user_id", ties=["event_id"], salted=True, slice_rows=10, share=1e-3)
    return fixed.select("event_id", "user_id", "is_new")


@query("""
SELECT user_id, events, total, last_type FROM (
  SELECT user_id, count(*) AS events, round(sum(value), 4) AS total, arg_max(event_type, (ts, event_id)) AS last_type
  FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
        FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE
                             THEN 0 ELSE 1 END AS opens FROM events))
  GROUP BY user_id, n)""")
def keyed_sessions(spark, sf_dir):
    out = sessions.session_rollup(events(spark, sf_dir), ["user_id"], 1800, {"total": "value"}, [],
                                  ["event_type"], "ts", ["event_id"])
    return out.select("user_id", "events", F.round("total", 4).alias("total"), F.col("event_type").alias("last_type"))


@query("""
SELECT conv_id, turn, role FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""")
def keyed_session_first_row(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "conversations").withColumn("user", F.col("role"))
    return sessions.first_login(rows, "conv_id", "user", "turn").select("conv_id", "turn", "role")


@query("""
SELECT event_id, user_id FROM (
  SELECT *, lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE event_type = 'view' AND (next_ts IS NULL OR next_type = 'view' OR next_ts - ts >= INTERVAL 10 MINUTE)""")
def keyed_bounces(spark, sf_dir):
    rows = events(spark, sf_dir)
    out = sessions.bounces(rows, "user_id", F.col("event_type") == "view", 600, "ts", ["event_id"], 900)
    return out.select("event_id", "user_id")


# --- windows and aggregates ----------------------------------------------------------------------
@query(f"""
SELECT {bounds(HOUR, 'ts')}, event_type, count(*) AS events, round(sum(value), 4) AS total,
       CAST(sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS BIGINT) AS large FROM events GROUP BY 1, 2, 3""")
def window_by_key(spark, sf_dir):
    rows = windows.watermark(events(spark, sf_dir))
    out = windows.tumble(rows, ["event_type"], [
        F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"),
        F.sum(values.one_if(F.col("value") > 100)).alias("large")], HOUR)
    return out.withColumn("total", F.round("total", 4))


@query(f"""
SELECT {bounds('10 seconds', 'ts')}, count(*) AS events FROM events GROUP BY 1, 2""")
def window_global(spark, sf_dir):
    """The default 10 s window, without a key."""
    return windows.tumble(events(spark, sf_dir), [], [F.count(F.lit(1)).alias("events")])


@query(f"""
SELECT {bounds(DAY, 'l_shipdate')}, l_returnflag AS flag, CAST(sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS DOUBLE) AS price,
       CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY 1, 2, 3""")
def window_decimal_sums(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("ts"), F.col("l_returnflag").alias("flag"),
        values.money("l_extendedprice").alias("price"),
        values.truncated(F.col("l_quantity").cast("string")).alias("quantity"))
    out = windows.tumble(rows, ["flag"], windows.sums(["price", "quantity"]), DAY)
    return out.withColumn("price", F.col("price").cast("double"))


@query(f"""
SELECT {bounds(DAY, 'ts')}, CASE WHEN v < 60 THEN '[0, 60)' WHEN v < 80 THEN '[60, 80)' WHEN v < 90 THEN '[80, 90)'
       WHEN v < 95 THEN '[90, 95)' ELSE '[95, 100]' END AS band, count(*) AS events
FROM (SELECT ts, CAST(trunc(value) AS BIGINT) AS v FROM events) GROUP BY 1, 2, 3""")
def aggregate_bands(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("band", values.score_band(values.truncated("value")))
    return windows.tumble(rows, ["band"], [F.count(F.lit(1)).alias("events")], DAY)


@query(f"""
SELECT {bounds(DAY, 'ts')}, CASE WHEN event_id % 3 = 0 THEN NULL WHEN v < 60 THEN '[0, 60)' WHEN v < 80 THEN '[60, 80)'
       WHEN v < 90 THEN '[80, 90)' WHEN v < 95 THEN '[90, 95)' ELSE '[95, 100]' END AS band, count(*) AS events
FROM (SELECT ts, event_id, CAST(trunc(value) AS BIGINT) AS v FROM events) GROUP BY 1, 2, 3""")
def aggregate_bands_with_nulls(spark, sf_dir):
    """Scores that are no numbers have no band."""
    score = F.when(F.col("event_id") % 3 == 0, F.lit("12,5")).otherwise(F.col("value").cast("string"))
    rows = events(spark, sf_dir).withColumn("band", values.score_band(values.truncated(score)))
    return windows.tumble(rows, ["band"], [F.count(F.lit(1)).alias("events")], DAY)


@query(f"""
SELECT {bounds(DAY, 'ts')}, p_type AS type, count(*) AS orders FROM (
  SELECT p_type, l_orderkey, min(l_shipdate) AS ts FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
GROUP BY 1, 2, 3""")
def aggregate_distinct_orders(spark, sf_dir):
    """Orders per part type, each counted once at its first line."""
    types = tables.table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("type"))
    lines = tables.table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", F.col("l_shipdate").alias("ts"))
    typed = lookup.lookup(lines, types, {"l_partkey": "p_partkey"}, {"type": "type"})
    first = firsts.first_ever(typed, ["type", "l_orderkey"])
    return windows.tumble(first, ["type"], [F.count(F.lit(1)).alias("orders")], DAY)


@query(f"""
SELECT {bounds(HOUR, 'ts')}, event_type, CAST(sum(pv) AS BIGINT) AS pv, CAST(sum(uv) AS BIGINT) AS uv FROM (
  SELECT ts, event_type, 1 AS pv, 0 AS uv FROM events
  UNION ALL SELECT min(ts), event_type, 0, 1 FROM events GROUP BY user_id, event_type, CAST(ts AS DATE))
GROUP BY 1, 2, 3""")
def aggregate_union_of_measures(spark, sf_dir):
    rows = events(spark, sf_dir).select("ts", "user_id", "event_type")
    views = rows.withColumn("pv", F.lit(1).cast("long"))
    unique = firsts.first_sightings(rows, ["user_id", "event_type"]).withColumn("uv", F.lit(1).cast("long"))
    return windows.tumble_measures([views, unique], ["event_type"], ["pv", "uv"], HOUR)


# --- functions -----------------------------------------------------------------------------------
@query("""
SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S') AS at,
       strftime(ts, '%Y-%m-%d') AS day, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS second,
       CAST(epoch_us(date_trunc('second', ts)) // 1000 AS BIGINT) AS millis,
       CAST(DATE '2024-02-01' - CAST(ts AS DATE) AS INTEGER) AS days_left
FROM events""")
def function_times(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("ms", F.unix_millis("ts")).withColumn("s", F.unix_timestamp("ts").cast("string"))
    at = times.datetime_text(times.from_epoch_millis("ms"))
    return rows.select(
        "event_id", at.alias("at"), times.date_id(at).alias("day"),
        times.datetime_text(times.from_epoch_seconds("s")).alias("second"),
        times.to_epoch_millis(at).alias("millis"),
        F.datediff(F.lit("2024-02-01").cast("date"), times.millis_to_second("ms")).alias("days_left"))


@query("""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'later' ELSE 'earlier' END AS versions FROM events""")
def function_version_times(spark, sf_dir):
    """Versions with and without trailing zeros compare as times."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    one, other = F.concat(text, F.lit(".1Z")), F.concat(text, F.when(F.col("event_id") % 2 == 0, ".200Z").otherwise(".050Z"))
    order = F.when(times.version_time(other) > times.version_time(one), "later").otherwise("earlier")
    return events(spark, sf_dir).select("event_id", order.alias("versions"))


@query("""
SELECT event_id, CAST(trunc(value) AS BIGINT) AS whole, upper(event_type) || '-' || user_id AS tag,
       substr(event_type, 1, 3) AS head, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       string_split(event_type, 'i')[1] AS part FROM events""")
def function_values(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", values.truncated(F.col("value").cast("string")).alias("whole"),
        F.concat(F.upper("event_type"), F.lit("-"), F.col("user_id")).alias("tag"),
        F.substring("event_type", 1, 3).alias("head"),
        F.from_json("props", "k int")["k"].alias("k"), F.split("event_type", "i")[0].alias("part"))


@query(r"""
SELECT keyword, count(*) AS keyword_count, count(DISTINCT doc_id) AS documents FROM (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS keyword FROM documents)
WHERE keyword <> '' GROUP BY keyword""")
def function_keywords(spark, sf_dir):
    """Keywords of the whole texts."""
    rows = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
    per_document = keywords.explode_keywords(rows, "text").groupBy("keyword", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_document.groupBy("keyword").agg(
        F.sum("n").alias("keyword_count"), F.count(F.lit(1)).alias("documents"))
