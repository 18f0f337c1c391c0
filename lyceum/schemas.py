"""Schemas of the raw feeds, the detail tables and the dimensions.

Change-record values and detail columns are text, as they arrive; the summaries cast them.
"""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType()}


def columns(listing: str) -> T.StructType:
    """``"a string, b int"`` as a schema, without needing a session."""
    pairs = (column.split() for column in listing.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


def text_columns(names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names.split()])


TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# --- raw feeds ------------------------------------------------------------------------------
CHANGE_RECORD = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("data", TEXT_MAP),
    T.StructField("ts", T.StringType()),
])

COMMON = text_columns("mid uid sid sc ar ch vc ba md os is_new")
PAGE = columns(
    "page_id string, last_page_id string, item string, item_type string, during_time bigint"
)
START = columns("entry string, loading_time bigint")
DISPLAY = columns("display_type string, item string, item_type string, pos_id string")
ACTION = columns("action_id string, item string, item_type string")
APP_VIDEO = columns("video_id string, play_sec int, position_sec int")
ERROR = columns("error_code int, msg string")

BEHAVIOUR_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("start", START),
    T.StructField("page", PAGE),
    T.StructField("displays", T.ArrayType(DISPLAY)),
    T.StructField("actions", T.ArrayType(ACTION)),
    T.StructField("appVideo", APP_VIDEO),
    T.StructField("err", ERROR),
    T.StructField("ts", T.LongType()),
])

# The page log read as maps, for jobs that look single entries up by name.
PAGE_LOG_MAPS = T.StructType([
    T.StructField("common", TEXT_MAP),
    T.StructField("page", TEXT_MAP),
    T.StructField("ts", T.LongType()),
])

CONFIG_ROW = text_columns("source_table sink_table sink_columns sink_pk sink_extend")
CONFIG_CHANGE = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("before", CONFIG_ROW),
    T.StructField("after", CONFIG_ROW),
    T.StructField("ts_ms", T.LongType()),
])

# --- detail tables --------------------------------------------------------------------------
# Simple details: source table of the change feed, and output columns.  ``date_id`` is computed,
# ``ts`` is the change time, everything else is read from the record's data map.
SIMPLE_DETAILS = {
    "dwd_examination_test_paper": (
        "test_exam",
        "id paper_id user_id score duration_sec date_id create_time submit_time update_time ts",
    ),
    "dwd_examination_test_question": (
        "test_exam_question",
        "id user_id paper_id question_id answer is_correct score date_id create_time update_time ts",
    ),
    "dwd_interaction_comment": (
        "comment_info",
        "id user_id chapter_id course_id date_id create_time comment_txt ts",
    ),
    "dwd_interaction_favor_add": (
        "favor_info",
        "id user_id course_id date_id create_time ts",
    ),
    "dwd_interaction_review": (
        "review_info",
        "id user_id course_id date_id create_time review_txt review_stars ts",
    ),
    "dwd_trade_cart_add": (
        "cart_info",
        "id user_id course_id date_id session_id create_time cart_price ts",
    ),
}

ORDER_DETAIL = T.StructType(
    text_columns(
        "id order_id user_id course_id province_id date_id session_id source_id create_time "
        "origin_amount coupon_reduce_amount final_amount out_trade_no trade_body ts"
    ).fields
    + [T.StructField("row_op_ts", T.TimestampType())]
)
PAY_SUC_DETAIL = T.StructType(
    text_columns(
        "id order_id user_id course_id province_id date_id alipay_trade_no trade_body payment_type "
        "payment_status callback_time callback_content original_amount coupon_reduce_amount "
        "final_amount ts"
    ).fields
    + [T.StructField("row_op_ts", T.TimestampType())]
)
USER_REGISTER = T.StructType(
    text_columns(
        "user_id register_time register_date channel province_id version_code source_id mid_id "
        "brand model operate_system ts"
    ).fields
    + [T.StructField("row_op_ts", T.TimestampType())]
)

# --- dimensions (all text, key ``id``) --------------------------------------------------------
DIMENSIONS = {
    "dim_test_paper": text_columns("id paper_title course_id"),
    "dim_course_info": text_columns("id course_name subject_id"),
    "dim_test_question_info": text_columns("id question_txt"),
    "dim_video_info": text_columns("id chapter_id"),
    "dim_chapter_info": text_columns("id chapter_name"),
    "dim_base_subject_info": text_columns("id subject_name category_id"),
    "dim_base_category_info": text_columns("id category_name"),
    "dim_base_province": text_columns("id name"),
    "dim_base_source": text_columns("id source_site"),
}
