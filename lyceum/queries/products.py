"""Every detail table and summary, run on feeds derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lyceum import schemas
from lyceum.operators import routing
from lyceum.plans import details, logs, summaries
from lyceum.queries.oracle import bounds, newest, sql
from lyceum.queries.registry import query
from lyceum.sources import tables

HOUR, DAY = "1 hour", "1 day"
# The events are minutes apart, so bounces and plays use wider limits than the defaults.
BOUNCE_SECONDS = 600
PLAY_GAP_SECONDS = 86400


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.page_log(tables.behaviour_log(spark, sf_dir))


def order_details(spark: SparkSession, sf_dir: str, with_source: bool = True) -> DataFrame:
    return details.dwd_trade_order_detail(
        tables.change_feed(spark, sf_dir, "order_info", "order_detail"), pages(spark, sf_dir), with_source=with_source)


def pay_details(spark: SparkSession, sf_dir: str, with_source: bool = True) -> DataFrame:
    return details.dwd_trade_pay_suc_detail(
        tables.change_feed(spark, sf_dir, "payment_info", "order_detail"), order_details(spark, sf_dir, with_source))


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return details.dwd_user_user_register(
        tables.change_feed(spark, sf_dir, "user_info"), pages(spark, sf_dir))


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.dwd_learn_play(routing.play_log(tables.behaviour_log(spark, sf_dir)), PLAY_GAP_SECONDS)


def simple(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, _ = schemas.SIMPLE_DETAILS[name]
    return details.simple_detail(tables.change_feed(spark, sf_dir, source), name)


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# --- simple details --------------------------------------------------------------------------
_EVENT_COLUMNS = {
    "event_id": "CAST(event_id AS VARCHAR)", "user": "CAST(user_id AS VARCHAR)", "k": "CAST(k AS VARCHAR)",
    "date": "strftime(ts, '%Y-%m-%d')", "time": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "sec": "CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)",
}


@query(sql("""
SELECT id, paper_id, user_id, score, CAST(duration_sec AS VARCHAR) AS duration_sec, date_id, create_time,
       create_time AS submit_time, CAST(NULL AS VARCHAR) AS update_time, CAST(ts AS VARCHAR) AS ts
FROM exams""", "exams"))
def dwd_examination_test_paper(spark, sf_dir):
    return simple(spark, sf_dir, "dwd_examination_test_paper")


@query(sql("""
SELECT {event_id} AS id, {user} AS user_id, CAST(k % 20 AS VARCHAR) AS paper_id, {k} AS question_id,
       event_type AS answer, CAST(event_id % 2 AS VARCHAR) AS is_correct, CAST(k % 10 AS VARCHAR) AS score,
       {date} AS date_id, {time} AS create_time, {time} AS update_time, {sec} AS ts
FROM ev WHERE event_type = 'error'""".format(**_EVENT_COLUMNS), "ev"))
def dwd_examination_test_question(spark, sf_dir):
    return simple(spark, sf_dir, "dwd_examination_test_question")


@query("""
SELECT conv_id || '-' || turn AS id, CAST(conv_id AS VARCHAR) AS user_id, CAST(turn AS VARCHAR) AS chapter_id,
       CAST(conv_id % 100 AS VARCHAR) AS course_id,
       strftime(make_timestamp((1704067200 + conv_id * 60 + turn) * 1000000), '%Y-%m-%d') AS date_id,
       strftime(make_timestamp((1704067200 + conv_id * 60 + turn) * 1000000), '%Y-%m-%d %H:%M:%S') AS create_time,
       text AS comment_txt, CAST(1704067200 + conv_id * 60 + turn AS VARCHAR) AS ts
FROM conversations""")
def dwd_interaction_comment(spark, sf_dir):
    return simple(spark, sf_dir, "dwd_interaction_comment")


@query(sql("""
SELECT {event_id} AS id, {user} AS user_id, {k} AS course_id, {date} AS date_id, {time} AS create_time, {sec} AS ts
FROM ev WHERE event_type = 'signup'""".format(**_EVENT_COLUMNS), "ev"))
def dwd_interaction_favor_add(spark, sf_dir):
    return simple(spark, sf_dir, "dwd_interaction_favor_add")


@query(sql("""
SELECT {event_id} AS id, {user} AS user_id, {k} AS course_id, {date} AS date_id, {time} AS create_time,
       props AS review_txt, CAST(event_id % 5 + 1 AS VARCHAR) AS review_stars, {sec} AS ts
FROM ev WHERE event_type = 'view'""".format(**_EVENT_COLUMNS), "ev"))
def dwd_interaction_review(spark, sf_dir):
    return simple(spark, sf_dir, "dwd_interaction_review")


@query(sql("""
SELECT {event_id} AS id, {user} AS user_id, {k} AS course_id, {date} AS date_id, 's' || user_id AS session_id,
       {time} AS create_time, CAST(CAST(value AS DECIMAL(16,2)) AS VARCHAR) AS cart_price, {sec} AS ts
FROM ev WHERE event_type = 'purchase'""".format(**_EVENT_COLUMNS), "ev"))
def dwd_trade_cart_add(spark, sf_dir):
    return simple(spark, sf_dir, "dwd_trade_cart_add")


# --- joined details --------------------------------------------------------------------------
@query(sql("""
SELECT id, order_id, user_id, course_id, province_id, date_id, session_id, source_id, create_time,
       CAST(origin AS VARCHAR) AS origin_amount, CAST(coupon AS VARCHAR) AS coupon_reduce_amount,
       CAST(final_amount AS VARCHAR) AS final_amount, out_trade_no, trade_body, CAST(ts AS VARCHAR) AS ts
FROM details""", "details"))
def dwd_trade_order_detail(spark, sf_dir):
    return order_details(spark, sf_dir).drop("row_op_ts")


@query(sql("""
SELECT id, order_id, user_id, course_id, province_id, date_id, alipay_trade_no, trade_body, payment_type,
       payment_status, callback_time, callback_content, CAST(origin AS VARCHAR) AS original_amount,
       CAST(coupon AS VARCHAR) AS coupon_reduce_amount, CAST(final_amount AS VARCHAR) AS final_amount,
       CAST(ts AS VARCHAR) AS ts
FROM pays""", "pays"))
def dwd_trade_pay_suc_detail(spark, sf_dir):
    return pay_details(spark, sf_dir).drop("row_op_ts")


@query(sql("""
SELECT user_id, register_time, register_date, channel, province_id, version_code, source_id, mid_id, brand,
       model, operate_system, CAST(ts AS VARCHAR) AS ts
FROM registers""", "registers"))
def dwd_user_user_register(spark, sf_dir):
    return registrations(spark, sf_dir).drop("row_op_ts")


# --- log details -----------------------------------------------------------------------------
FIXED = """
SELECT *, CASE WHEN is_new = '1' AND CAST(t AS DATE) <> first_date THEN '0' ELSE is_new END AS fixed
FROM (SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(t AS DATE) ELSE CAST(t AS DATE) - 1 END)
                OVER (PARTITION BY mid ORDER BY ts, is_new) AS first_date FROM logs)"""

COMMON = ["mid", "uid", "sid", "sc", "ar", "ch", "vc", "ba", "md", "os", "is_new"]
COMMON_SQL = "mid, uid, sid, sc, ar, ch, vc, ba, md, os, fixed AS is_new"


def base(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return logs.base_logs(tables.behaviour_log(spark, sf_dir))[kind]


def common() -> list:
    return [F.col(f"common.{c}").alias(c) for c in COMMON]


@query(sql(f"""
SELECT {COMMON_SQL}, page_id, last_page_id, item, item_type, during_time, ts
FROM ({FIXED}) WHERE kind IN ('view', 'click', 'error')""", "logs"))
def dwd_traffic_page_log(spark, sf_dir):
    return base(spark, sf_dir, "page").select(*common(), "page.*", "ts")


@query(sql(f"""
SELECT {COMMON_SQL}, 'icon' AS entry, CAST(k * 10 AS BIGINT) AS loading_time, ts
FROM ({FIXED}) WHERE kind = 'signup'""", "logs"))
def dwd_traffic_start_log(spark, sf_dir):
    return base(spark, sf_dir, "start").select(*common(), "start.*", "ts")


@query(sql(f"""
SELECT {COMMON_SQL}, page_id, ts, d.display_type, d.item, d.item_type, d.pos_id
FROM ({FIXED}), (SELECT unnest([0, 1]) AS n) u,
LATERAL (SELECT CASE WHEN n = 0 THEN 'query' ELSE 'promotion' END AS display_type, CAST(k + n AS VARCHAR) AS item,
                'course_id' AS item_type, CAST(n + 1 AS VARCHAR) AS pos_id) d
WHERE kind = 'view'""".replace("page_id, ts, d.display_type, d.item, d.item_type",
                               "page_id, ts, d.display_type AS display_type, d.item AS display_item, "
                               "d.item_type AS display_item_type"), "logs"))
def dwd_traffic_display_log(spark, sf_dir):
    return base(spark, sf_dir, "display").select(
        *common(), "page.page_id", "ts", "display.display_type", F.col("display.item").alias("display_item"),
        F.col("display.item_type").alias("display_item_type"), "display.pos_id")


@query(sql(f"""
SELECT {COMMON_SQL}, page_id, 'favor_add' AS action_id, CAST(k AS VARCHAR) AS action_item
FROM ({FIXED}) WHERE kind = 'click'""", "logs"))
def dwd_traffic_action_log(spark, sf_dir):
    return base(spark, sf_dir, "action").select(
        *common(), "page.page_id", "action.action_id", F.col("action.item").alias("action_item"))


@query(sql(f"""
SELECT {COMMON_SQL}, k AS error_code, props AS msg, page_id, ts FROM ({FIXED}) WHERE kind = 'error'""", "logs"))
def dwd_traffic_error_log(spark, sf_dir):
    return base(spark, sf_dir, "error").select(*common(), "err.error_code", "err.msg", "page.page_id", "ts")


@query(sql(f"""
SELECT {COMMON_SQL}, CAST(k AS VARCHAR) AS video_id, k % 30 + 1 AS play_sec,
       CAST(trunc(value) AS INTEGER) AS position_sec, ts
FROM ({FIXED}) WHERE kind = 'purchase'""", "logs"))
def dwd_traffic_play_pre_process(spark, sf_dir):
    return base(spark, sf_dir, "play").select(*common(), "appVideo.*", "ts")


@query(sql("""
SELECT source_id, province_id, nullif(uid0, '') AS user_id, operating_system, channel, is_new, model, machine_id,
       version_code, brand, session_id, play_sec, position_sec, video_id, ts
FROM play_sessions""", "play_sessions"))
def dwd_learn_play(spark, sf_dir):
    return plays(spark, sf_dir)


@query(sql("SELECT mid, uid, sid, page_id, ts FROM visitors", "visitors"))
def dwd_traffic_unique_visitor_detail(spark, sf_dir):
    found = logs.dwd_traffic_unique_visitor_detail(pages(spark, sf_dir))
    return found.select("common.mid", "common.uid", "common.sid", "page.page_id", "ts")


@query(sql("SELECT mid, uid, sid, page_id, ts FROM jumps", "jumps"))
def dwd_traffic_user_jump_detail(spark, sf_dir):
    found = logs.dwd_traffic_user_jump_detail(pages(spark, sf_dir), BOUNCE_SECONDS)
    return found.select("common.mid", "common.uid", "common.sid", "page.page_id", "ts")


@query(sql("""
SELECT uid AS user_id, strftime(t, '%Y-%m-%d') AS date_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS login_time,
       ch AS channel, ar AS province_id, vc AS version_code, mid AS mid_id, ba AS brand, md AS model,
       sc AS source_id, os AS operating_system, ts
FROM logins""", "logins"))
def dwd_user_user_login(spark, sf_dir):
    return logs.dwd_user_user_login(pages(spark, sf_dir))


# --- summaries -------------------------------------------------------------------------------
@query(sql(f"""
SELECT a.*, s_name AS paper_title, CAST(s_suppkey * 3 AS VARCHAR) AS course_id, p_name AS course_name
FROM (SELECT {bounds(HOUR)}, paper_id, count(*) AS exam_taken_count, CAST(sum(points) AS BIGINT) AS exam_total_score,
             CAST(sum(duration_sec) AS BIGINT) AS exam_total_during_sec
      FROM exams GROUP BY 1, 2, 3) a
LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = paper_id LEFT JOIN part ON p_partkey = s_suppkey * 3""", "exams"))
def dws_examination_paper_exam_window(spark, sf_dir):
    return summaries.dws_examination_paper_exam_window(
        simple(spark, sf_dir, "dwd_examination_test_paper"), tables.dimensions(spark, sf_dir), HOUR)


@query(sql(f"""
SELECT a.*, s_name AS paper_title
FROM (SELECT {bounds(HOUR)}, paper_id,
             CASE WHEN points < 60 THEN '[0, 60)' WHEN points < 80 THEN '[60, 80)' WHEN points < 90 THEN '[80, 90)'
                  WHEN points < 95 THEN '[90, 95)' ELSE '[95, 100]' END AS score_duration, count(*) AS user_count
      FROM exams GROUP BY 1, 2, 3, 4) a
LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = paper_id""", "exams"))
def dws_examination_paper_score_duration_exam_window(spark, sf_dir):
    return summaries.dws_examination_paper_score_duration_exam_window(
        simple(spark, sf_dir, "dwd_examination_test_paper"), tables.dimensions(spark, sf_dir), HOUR)


@query(sql(f"""
SELECT a.*, c_name AS question_txt
FROM (SELECT {bounds(HOUR, 'ts')}, CAST(k AS VARCHAR) AS question_id,
             CAST(sum(event_id % 2) AS BIGINT) AS correct_answer_count, count(*) AS answer_count
      FROM ev WHERE event_type = 'error' GROUP BY 1, 2, 3) a
LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = question_id""", "ev"))
def dws_examination_question_answer_window(spark, sf_dir):
    return summaries.dws_examination_question_answer_window(
        simple(spark, sf_dir, "dwd_examination_test_question"), tables.dimensions(spark, sf_dir), HOUR)


@query(sql(f"""
SELECT a.*, p_name AS course_name
FROM (SELECT {bounds(HOUR, 'ts')}, CAST(k AS VARCHAR) AS course_id,
             CAST(sum(event_id % 5 + 1) AS BIGINT) AS review_total_stars, count(*) AS review_user_count,
             CAST(sum(CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END) AS BIGINT) AS good_review_user_count
      FROM ev WHERE event_type = 'view' GROUP BY 1, 2, 3) a
LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = course_id""", "ev"))
def dws_interaction_course_review_window(spark, sf_dir):
    return summaries.dws_interaction_course_review_window(
        simple(spark, sf_dir, "dwd_interaction_review"), tables.dimensions(spark, sf_dir), HOUR)


@query(sql(f"""
SELECT stt, edt, CAST(p_size AS VARCHAR) AS chapter_id, s_name AS chapter_name, play_count, play_total_sec, play_uu_count
FROM (SELECT {bounds(HOUR)}, video_id, count(*) AS play_count, CAST(sum(play_sec) AS BIGINT) AS play_total_sec,
             CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS play_uu_count
      FROM (SELECT video_id, play_sec, make_timestamp(ts * 1000) AS t,
                   row_number() OVER (PARTITION BY uid0, CAST(make_timestamp(ts * 1000) AS DATE)
                                      ORDER BY ts, video_id) AS rn FROM play_sessions)
      GROUP BY 1, 2, 3) a
LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = video_id LEFT JOIN supplier ON s_suppkey = p_size""", "play_sessions"))
def dws_learn_chapter_play_window(spark, sf_dir):
    return summaries.dws_learn_chapter_play_window(plays(spark, sf_dir), tables.dimensions(spark, sf_dir), HOUR)


@query(sql(f"""
SELECT {bounds(HOUR)}, count(*) AS cart_add_uv_count
FROM (SELECT min(ts) AS t FROM ev WHERE event_type = 'purchase' GROUP BY user_id, CAST(ts AS DATE))
GROUP BY 1, 2""", "ev"))
def dws_trade_cart_add_window(spark, sf_dir):
    return summaries.dws_trade_cart_add_window(simple(spark, sf_dir, "dwd_trade_cart_add"), HOUR)


@query(sql("SELECT id, '0' AS course_id, CAST(max(ts) + 5 AS VARCHAR) AS ts FROM details GROUP BY id", "details"))
def details_default_version(spark, sf_dir):
    """Two versions of every line, five seconds apart: the later one counts, whatever its columns say."""
    feed = tables.change_feed(spark, sf_dir, "order_info", "order_detail")
    later = details.rows_of(feed, "order_detail", None).withColumns({
        "data": F.map_concat(F.map_filter("data", lambda k, _: k != "course_id"), F.create_map(F.lit("course_id"), F.lit("0"))),
        "ts": (F.col("ts").cast("long") + 5).cast("string")})
    lines = details.dwd_trade_order_detail(feed.unionByName(later), pages(spark, sf_dir), with_source=False)
    return summaries.newest(lines, "id", ["course_id", "ts"])


COURSE_DIMS = """
LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = course_id LEFT JOIN nation ON n_nationkey = p_partkey % 30
LEFT JOIN region ON r_regionkey = n_regionkey"""


@query(sql(f"""
SELECT stt, edt, course_id, p_name AS course_name, CAST(p_partkey % 30 AS VARCHAR) AS subject_id,
       n_name AS subject_name, CAST(n_regionkey AS VARCHAR) AS category_id, r_name AS category_name, order_total_amount
FROM (SELECT {bounds(DAY)}, course_id, CAST(sum(final_amount) AS DOUBLE) AS order_total_amount
      FROM {newest("details", "ts", "course_id", "final_amount")} GROUP BY 1, 2, 3) a {COURSE_DIMS}""", "details"))
def dws_trade_course_order_window(spark, sf_dir):
    out = summaries.dws_trade_course_order_window(
        order_details(spark, sf_dir, with_source=False), tables.dimensions(spark, sf_dir), DAY)
    return as_double(out, "order_total_amount")


def _users_sql(source: str, version: str, uv: str, new: str) -> str:
    return sql(f"""
SELECT stt, edt, CAST(sum(uv) AS BIGINT) AS {uv}, CAST(sum(new) AS BIGINT) AS {new}
FROM (SELECT {bounds(HOUR)}, 1 AS uv, CASE WHEN t = min(t) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END AS new
      FROM (SELECT user_id, min(t) AS t FROM {newest(source, version, "user_id", "ts")}
            GROUP BY user_id, CAST(t AS DATE)))
GROUP BY 1, 2""", source)


@query(_users_sql("details", "ts", "order_uv_count", "new_order_user_count"))
def dws_trade_order_window(spark, sf_dir):
    return summaries.dws_trade_order_window(order_details(spark, sf_dir, with_source=False), HOUR)


@query(_users_sql("pays", "op_ts", "pay_suc_uv_count", "pay_suc_new_user_count"))
def dws_trade_pay_suc_window(spark, sf_dir):
    return summaries.dws_trade_pay_suc_window(pay_details(spark, sf_dir, with_source=False), HOUR)


@query(sql(f"""
SELECT a.*, n_name AS province_name
FROM (SELECT {bounds(HOUR)}, province_id, CAST(sum(final_amount) AS DOUBLE) AS order_total_amount,
             CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS order_uu_count, count(*) AS order_count
      FROM (SELECT *, make_timestamp(ts * 1000000) AS t,
                   row_number() OVER (PARTITION BY province_id, user_id, CAST(make_timestamp(ts * 1000000) AS DATE)
                                      ORDER BY ts) AS rn FROM infos)
      GROUP BY 1, 2, 3) a
LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = province_id""", "infos"))
def dws_trade_province_order_window(spark, sf_dir):
    out = summaries.dws_trade_province_order_window(
        tables.change_feed(spark, sf_dir, "order_info"), tables.dimensions(spark, sf_dir), HOUR)
    return as_double(out, "order_total_amount")


@query(sql(f"""
SELECT a.*, r_name AS source_name
FROM (SELECT {bounds(DAY)}, source_id, CAST(sum(final_amount) AS DOUBLE) AS order_total_amount,
             CAST(sum(CASE WHEN user_rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS order_uu_count,
             CAST(sum(CASE WHEN order_rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS order_count
      FROM (SELECT *, row_number() OVER (PARTITION BY source_id, user_id, CAST(t AS DATE) ORDER BY ts) AS user_rn,
                   row_number() OVER (PARTITION BY order_id ORDER BY ts, source_id) AS order_rn
            FROM {newest("(SELECT * FROM details WHERE source_id IS NOT NULL)", "ts", "source_id", "user_id", "order_id",
                         "final_amount")})
      GROUP BY 1, 2, 3) a
LEFT JOIN region ON CAST(r_regionkey AS VARCHAR) = source_id""", "details"))
def dws_trade_source_order_window(spark, sf_dir):
    out = summaries.dws_trade_source_order_window(
        order_details(spark, sf_dir), tables.dimensions(spark, sf_dir), DAY)
    return as_double(out, "order_total_amount")


@query(sql(f"""
SELECT stt, edt, subject_id, n_name AS subject_name, CAST(n_regionkey AS VARCHAR) AS category_id,
       r_name AS category_name, user_id, order_count, order_total_amount
FROM (SELECT {bounds(DAY)}, subject_id, user_id, CAST(sum(final_amount) AS DOUBLE) AS order_total_amount,
             CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS order_count
      FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, order_id ORDER BY ts, user_id) AS rn
            FROM (SELECT d.*, CAST(p_partkey % 30 AS VARCHAR) AS subject_id
                  FROM {newest("details", "ts", "course_id", "user_id", "order_id", "final_amount")} d
                  LEFT JOIN part ON p_partkey = l_partkey))
      GROUP BY 1, 2, 3, 4) a
LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = subject_id LEFT JOIN region ON r_regionkey = n_regionkey""",
           "details"))
def dws_trade_subject_user_order_window(spark, sf_dir):
    out = summaries.dws_trade_subject_user_order_window(
        order_details(spark, sf_dir, with_source=False), tables.dimensions(spark, sf_dir), DAY)
    return as_double(out, "order_total_amount")


@query(sql(f"""
SELECT {bounds(HOUR)}, CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_count,
       CAST(sum(CASE WHEN page_id = 'course_list' THEN 1 ELSE 0 END) AS BIGINT) AS list_uv_count,
       CAST(sum(CASE WHEN page_id = 'course_detail' THEN 1 ELSE 0 END) AS BIGINT) AS detail_uv_count
FROM (SELECT page_id, min(t) AS t FROM pages WHERE page_id IN ('home', 'course_list', 'course_detail')
      GROUP BY mid, page_id, CAST(t AS DATE))
GROUP BY 1, 2""", "pages"))
def dws_traffic_page_view_window(spark, sf_dir):
    return summaries.dws_traffic_page_view_window(pages(spark, sf_dir), HOUR)


@query(sql(f"""
SELECT {bounds(HOUR)}, 'SEARCH' AS source, keyword, count(*) AS keyword_count
FROM (SELECT t, unnest(string_split_regex(lower(item), '[^\\p{{L}}\\p{{N}}]+')) AS keyword
      FROM pages WHERE item IS NOT NULL AND item_type = 'keyword')
WHERE keyword <> '' GROUP BY 1, 2, 4""", "pages"))
def dws_traffic_source_keyword_page_view_window(spark, sf_dir):
    return summaries.dws_traffic_source_keyword_page_view_window(pages(spark, sf_dir), HOUR)


@query(sql(f"""
SELECT a.*, r_name AS source_name
FROM (SELECT {bounds(HOUR)}, source_id, count(*) AS uv_ct
      FROM (SELECT sc AS source_id, min(t) AS t FROM pages GROUP BY mid, sc, CAST(t AS DATE)) GROUP BY 1, 2, 3) a
LEFT JOIN region ON CAST(r_regionkey AS VARCHAR) = source_id""", "pages"))
def dws_traffic_source_page_view_window(spark, sf_dir):
    return summaries.dws_traffic_source_page_view_window(
        pages(spark, sf_dir), tables.dimensions(spark, sf_dir), HOUR)


@query(sql(f"""
SELECT a.*, r_name AS source_name, n_name AS province_name
FROM (SELECT {bounds(HOUR)}, vc AS version_code, sc AS source_id, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_count,
             CAST(sum(ses) AS BIGINT) AS total_session_count, CAST(sum(pv) AS BIGINT) AS page_view_count,
             CAST(sum(dur) AS BIGINT) AS total_during_time, CAST(sum(jump) AS BIGINT) AS jump_session_count
      FROM (SELECT t, vc, sc, ar, is_new, 0 AS uv, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS ses, 1 AS pv,
                   coalesce(during_time, 0) AS dur, 0 AS jump FROM pages
            UNION ALL SELECT t, vc, sc, ar, is_new, 1, 0, 0, 0, 0 FROM visitors
            UNION ALL SELECT t, vc, sc, ar, is_new, 0, 0, 0, 0, 1 FROM jumps)
      GROUP BY 1, 2, 3, 4, 5, 6) a
LEFT JOIN region ON CAST(r_regionkey AS VARCHAR) = source_id LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = ar""",
           "pages", "visitors", "jumps"))
def dws_traffic_vc_source_ar_is_new_page_view_window(spark, sf_dir):
    page_rows = pages(spark, sf_dir)
    return summaries.dws_traffic_vc_source_ar_is_new_page_view_window(
        page_rows, logs.dwd_traffic_unique_visitor_detail(page_rows),
        logs.dwd_traffic_user_jump_detail(page_rows, BOUNCE_SECONDS), tables.dimensions(spark, sf_dir), HOUR)


@query(sql(f"""
SELECT {bounds(HOUR)}, CAST(sum(back) AS BIGINT) AS back_count, count(*) AS uv_count
FROM (SELECT t, CASE WHEN CAST(t AS DATE) - lag(CAST(t AS DATE)) OVER (PARTITION BY uid ORDER BY t) >= 8
                     THEN 1 ELSE 0 END AS back
      FROM (SELECT uid, min(t) AS t FROM logins GROUP BY uid, CAST(t AS DATE)))
GROUP BY 1, 2""", "logins"))
def dws_user_login_window(spark, sf_dir):
    return summaries.dws_user_login_window(logs.dwd_user_user_login(pages(spark, sf_dir)), HOUR)


@query(sql(f"""
SELECT {bounds(HOUR)}, count(*) AS register_count
FROM (SELECT make_timestamp(ts * 1000000) AS t FROM registers) GROUP BY 1, 2""", "registers"))
def dws_user_register_window(spark, sf_dir):
    return summaries.dws_user_register_window(registrations(spark, sf_dir), HOUR)
