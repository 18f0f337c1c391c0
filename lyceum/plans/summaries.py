"""Windowed summaries.

Each function takes detail rows (batch or stream) and returns one row per window and key, enriched
with dimension names after aggregation.  Distinct users and orders are counted by turning "first
sighting" rows into a measure of their own and adding them to the plain measures in one window
aggregate, so each input is reduced by hash aggregation before it is shuffled.

Details that are keyed upsert tables (orders, payments, registrations) are reduced to the newest
version per key first.  A stream must do that in a stage before (``streaming.state.hold_latest``).
The emit time is not part of the result; ``windows.stamped`` adds it before writing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lyceum.functions.keywords import explode_keywords
from lyceum.functions.times import from_epoch_millis, from_epoch_seconds, millis_to_second
from lyceum.functions.values import money, one_if, score_band, truncated
from lyceum.operators import firsts
from lyceum.operators.latest import latest_per_key
from lyceum.operators.lookup import lookup, lookups
from lyceum.operators.windows import WINDOW, sums, tumble, tumble_measures, watermark
from lyceum.streaming import state

Dims = dict[str, DataFrame]
LOGIN_DELAY = "3 seconds"
ARRIVAL = "arrival"
KEYWORD_DELAY = "3 seconds"
# A bounce is known 10 s after it happened; the joint watermark has to wait for it.
TRAFFIC_DELAY = "15 seconds"
# Fixed value: where keyword rows come from.
KEYWORD_SOURCE = "SEARCH"
# Pages whose visitors are counted, and their measures.
PAGE_MEASURES = {"home": "home_uv_count", "course_list": "list_uv_count", "course_detail": "detail_uv_count"}


def _one(name: str):
    return F.lit(1).cast("long").alias(name)


def newest(details: DataFrame, key: str, take: list[str]) -> DataFrame:
    """Newest version per key, cut to the columns a summary needs before anything is shuffled.

    The version is the change time and, where the source tells it, the ``arrival`` (place in the topic).
    Only versions alike in both are told apart by their columns, so that a run gives what the last gave."""
    if details.isStreaming:
        return details.select(key, *take)
    version = ["row_op_ts", *([ARRIVAL] if ARRIVAL in details.columns else [])]
    return latest_per_key(details.select(*version, key, *take), key, [*version, *take]).drop(*version)


def _timed(details: DataFrame, *columns, delay: str | None = None) -> DataFrame:
    """Columns plus event time ``ts`` from change seconds."""
    rows = details.select(*columns, from_epoch_seconds("ts").alias("ts"))
    return watermark(rows, "ts", delay) if delay else watermark(rows, "ts")


def with_subject(rows: DataFrame, dims: Dims) -> DataFrame:
    """Name and category of ``subject_id``."""
    return lookups(
        rows,
        (dims["dim_base_subject_info"], "subject_id", {"subject_name": "subject_name", "category_id": "category_id"}),
        (dims["dim_base_category_info"], "category_id", {"category_name": "category_name"}))


# --- examinations, reviews, plays -----------------------------------------------------------
def dws_examination_paper_exam_window(papers: DataFrame, dims: Dims, window: str = WINDOW) -> DataFrame:
    rows = _timed(papers, "paper_id", truncated("score").alias("exam_total_score"),
                  F.col("duration_sec").cast("long").alias("exam_total_during_sec"))
    out = tumble(rows, ["paper_id"], [F.count(F.lit(1)).alias("exam_taken_count"),
                                      *sums(["exam_total_score", "exam_total_during_sec"])], window)
    return lookups(
        out, (dims["dim_test_paper"], "paper_id", {"paper_title": "paper_title", "course_id": "course_id"}),
        (dims["dim_course_info"], "course_id", {"course_name": "course_name"}),
    ).select("stt", "edt", "paper_id", "paper_title", "course_id", "course_name",
              "exam_taken_count", "exam_total_score", "exam_total_during_sec")


def dws_examination_paper_score_duration_exam_window(
    papers: DataFrame, dims: Dims, window: str = WINDOW
) -> DataFrame:
    rows = _timed(papers, "paper_id", score_band(truncated("score")).alias("score_duration"))
    out = tumble(rows, ["paper_id", "score_duration"], [F.count(F.lit(1)).alias("user_count")], window)
    return lookup(out, dims["dim_test_paper"], {"paper_id": "id"}, {"paper_title": "paper_title"}).select(
        "stt", "edt", "paper_id", "paper_title", "score_duration", "user_count")


def dws_examination_question_answer_window(questions: DataFrame, dims: Dims, window: str = WINDOW) -> DataFrame:
    rows = _timed(questions, "question_id", one_if(F.col("is_correct") == "1").alias("correct_answer_count"))
    out = tumble(rows, ["question_id"], [*sums(["correct_answer_count"]),
                                         F.count(F.lit(1)).alias("answer_count")], window)
    return lookup(out, dims["dim_test_question_info"], {"question_id": "id"},
                  {"question_txt": "question_txt"}).select(
        "stt", "edt", "question_id", "question_txt", "correct_answer_count", "answer_count")


def dws_interaction_course_review_window(reviews: DataFrame, dims: Dims, window: str = WINDOW) -> DataFrame:
    stars = F.col("review_stars").cast("long")
    rows = _timed(reviews, "course_id", stars.alias("review_total_stars"),
                  one_if(stars == 5).alias("good_review_user_count"))
    out = tumble(rows, ["course_id"], [*sums(["review_total_stars"]),
                                       F.count(F.lit(1)).alias("review_user_count"),
                                       *sums(["good_review_user_count"])], window)
    return lookup(out, dims["dim_course_info"], {"course_id": "id"}, {"course_name": "course_name"}).select(
        "stt", "edt", "course_id", "course_name", "review_total_stars", "review_user_count",
        "good_review_user_count")


def dws_learn_chapter_play_window(plays: DataFrame, dims: Dims, window: str = WINDOW,
                                  by_chapter: bool = False) -> DataFrame:
    """One row per window and video, labelled with the video's chapter; ``by_chapter`` adds the
    videos of a chapter up.  A user counts once a day, at the first play."""
    rows = watermark(plays.select("video_id", "user_id", F.col("play_sec").cast("long").alias("play_total_sec"),
                                  from_epoch_millis("ts").alias("ts")))
    # The first play's video matters, so the first sighting carries it along.
    first = _first_play_of_day(rows)
    counted = rows.withColumn("play_count", F.lit(1).cast("long"))
    out = tumble_measures([counted, first], ["video_id"],
                          ["play_count", "play_total_sec", "play_uu_count"], window)
    named = lookups(out, (dims["dim_video_info"], "video_id", {"chapter_id": "chapter_id"}),
                    (dims["dim_chapter_info"], "chapter_id", {"chapter_name": "chapter_name"}))
    measures = ["play_count", "play_total_sec", "play_uu_count"]
    if by_chapter:
        named = named.groupBy("stt", "edt", "chapter_id", "chapter_name").agg(*sums(measures))
    return named.select("stt", "edt", "chapter_id", "chapter_name", *measures)


def _first_play_of_day(rows: DataFrame) -> DataFrame:
    if rows.isStreaming:
        picked = state.first_of_day(rows.select("user_id", "video_id", "ts"), ["user_id"], forget=True)
    else:
        earliest = F.min(F.struct("ts", "video_id")).alias("_first")
        picked = rows.groupBy("user_id", F.to_date("ts").alias("_day")).agg(earliest).select("_first.*")
    return picked.select("ts", "video_id", _one("play_uu_count"))


# --- trade ------------------------------------------------------------------------------------
def dws_trade_cart_add_window(carts: DataFrame, window: str = WINDOW) -> DataFrame:
    first = firsts.first_sightings(_timed(carts, "user_id"), ["user_id"])
    return tumble_measures([first.select("ts", _one("cart_add_uv_count"))], [], ["cart_add_uv_count"], window)


def dws_trade_course_order_window(details: DataFrame, dims: Dims, window: str = WINDOW) -> DataFrame:
    rows = _timed(newest(details, "id", ["course_id", "final_amount", "ts"]), "course_id", money("final_amount").alias("order_total_amount"))
    out = tumble(rows, ["course_id"], sums(["order_total_amount"]), window)
    named = lookup(out, dims["dim_course_info"], {"course_id": "id"}, {"course_name": "course_name", "subject_id": "subject_id"})
    return with_subject(named, dims).select("stt", "edt", "course_id", "course_name", "subject_id", "subject_name", "category_id",
              "category_name", "order_total_amount")


def _users_of_day(details: DataFrame, uv: str, new: str, window: str, delay: str | None = None) -> DataFrame:
    """Users of the day, and among them users never seen before."""
    rows = _timed(newest(details, "id", ["user_id", "ts"]), "user_id", delay=delay)
    if rows.isStreaming:
        days = state.first_of_day(rows, ["user_id"])
        return tumble_measures([days.select("ts", _one(uv), F.col("is_new").alias(new))], [], [uv, new], window)
    days = firsts.first_sightings(rows, ["user_id"])
    ever = firsts.first_ever(days, ["user_id"])
    return tumble_measures([days.select("ts", _one(uv)), ever.select("ts", _one(new))], [], [uv, new], window)


def dws_trade_order_window(details: DataFrame, window: str = WINDOW, delay: str | None = None) -> DataFrame:
    """A stream passes lines that ``streaming.state.hold_latest`` has let go, and the hold as more ``delay``."""
    return _users_of_day(details, "order_uv_count", "new_order_user_count", window, delay)


def dws_trade_pay_suc_window(details: DataFrame, window: str = WINDOW, delay: str | None = None) -> DataFrame:
    """As ``dws_trade_order_window``, for paid lines."""
    return _users_of_day(details, "pay_suc_uv_count", "pay_suc_new_user_count", window, delay)


def dws_trade_province_order_window(changes: DataFrame, dims: Dims, window: str = WINDOW) -> DataFrame:
    """Straight from the change feed: order inserts by province."""
    data = F.col("data")
    orders = changes.where((F.col("table") == "order_info") & (F.col("type") == "insert"))
    rows = _timed(orders, data["province_id"].alias("province_id"), data["user_id"].alias("user_id"),
                  money(data["final_amount"]).alias("order_total_amount"))
    counted = rows.withColumn("order_count", F.lit(1).cast("long"))
    first = firsts.first_sightings(rows, ["province_id", "user_id"])
    measures = ["order_total_amount", "order_uu_count", "order_count"]
    out = tumble_measures([counted, first.select("ts", "province_id", _one("order_uu_count"))],
                          ["province_id"], measures, window)
    return lookup(out, dims["dim_base_province"], {"province_id": "id"}, {"name": "province_name"}).select(
        "stt", "edt", "province_id", "province_name", *measures)


def dws_trade_source_order_window(details: DataFrame, dims: Dims, window: str = WINDOW) -> DataFrame:
    """An order counts once, for the source of its first line."""
    known = details.where(F.col("source_id").isNotNull())
    rows = _timed(newest(known, "id", ["source_id", "user_id", "order_id", "final_amount", "ts"]), "source_id", "user_id", "order_id",
                  money("final_amount").alias("order_total_amount"))
    first_user = firsts.first_sightings(rows, ["source_id", "user_id"])
    measures = ["order_total_amount", "order_uu_count", "order_count"]
    out = tumble_measures(
        [rows, first_user.select("ts", "source_id", _one("order_uu_count")),
         _first_lines(rows, ["order_id"], ["source_id"], forget=True)],
        ["source_id"], measures, window)
    return lookup(out, dims["dim_base_source"], {"source_id": "id"}, {"source_site": "source_name"}).select(
        "stt", "edt", "source_id", "source_name", *measures)


def dws_trade_subject_user_order_window(details: DataFrame, dims: Dims, window: str = WINDOW) -> DataFrame:
    """Orders and amounts per subject and user; an order counts once per subject."""
    lines = newest(details, "id", ["course_id", "user_id", "order_id", "final_amount", "ts"])
    lines = lookup(lines, dims["dim_course_info"], {"course_id": "id"}, {"subject_id": "subject_id"})
    rows = _timed(lines, "subject_id", "user_id", "order_id", money("final_amount").alias("order_total_amount"))
    measures = ["order_count", "order_total_amount"]
    out = tumble_measures([rows, _first_lines(rows, ["subject_id", "order_id"], ["subject_id", "user_id"])],
                          ["subject_id", "user_id"], measures, window)
    return with_subject(out, dims).select("stt", "edt", "subject_id", "subject_name", "category_id", "category_name", "user_id", *measures)


def _first_lines(rows: DataFrame, keys: list[str], take: list[str], forget: bool = False) -> DataFrame:
    """(ts, take, order_count = 1) of the first line of each key.  ``forget`` lets a stream drop an
    order's state once the watermark has passed it."""
    if rows.isStreaming:
        picked = rows.dropDuplicatesWithinWatermark(keys) if forget else rows.dropDuplicates(keys)
    else:
        extra = [c for c in take if c not in keys]
        first = F.min(F.struct("ts", *extra)).alias("_first")
        picked = rows.groupBy(*keys).agg(first).select(*keys, "_first.*")
    return picked.select("ts", *take, _one("order_count"))


# --- traffic ------------------------------------------------------------------------------------
def _page_rows(pages: DataFrame, *columns, delay: str | None = None) -> DataFrame:
    rows = pages.select(*columns, from_epoch_millis("ts").alias("ts"))
    return watermark(rows, "ts", delay) if delay else watermark(rows, "ts")


def dws_traffic_page_view_window(pages: DataFrame, window: str = WINDOW) -> DataFrame:
    page_id = F.col("page.page_id")
    rows = _page_rows(pages.where(page_id.isin(list(PAGE_MEASURES))),
                      F.col("common.mid").alias("mid"), page_id.alias("page_id"))
    first = firsts.first_sightings(rows, ["mid", "page_id"])
    flags = [one_if(F.col("page_id") == page).alias(name) for page, name in PAGE_MEASURES.items()]
    names = list(PAGE_MEASURES.values())
    return tumble_measures([first.select("ts", *flags)], [], names, window)


def dws_traffic_source_keyword_page_view_window(pages: DataFrame, window: str = WINDOW) -> DataFrame:
    searches = pages.where(F.col("page")["item"].isNotNull() & (F.col("page")["item_type"] == "keyword"))
    rows = watermark(searches.select(F.col("page")["item"].alias("full_word"), millis_to_second("ts").alias("ts")),
                     "ts", KEYWORD_DELAY)
    out = tumble(explode_keywords(rows, "full_word"), ["keyword"],
                 [F.count(F.lit(1)).alias("keyword_count")], window)
    return out.select("stt", "edt", F.lit(KEYWORD_SOURCE).alias("source"), "keyword", "keyword_count")


def dws_traffic_source_page_view_window(pages: DataFrame, dims: Dims, window: str = WINDOW) -> DataFrame:
    """Visitors of the day per source, by event time."""
    rows = _page_rows(pages, F.col("common.mid").alias("mid"), F.col("common.sc").alias("source_id"))
    first = firsts.first_sightings(rows, ["mid", "source_id"])
    out = tumble_measures([first.select("ts", "source_id", _one("uv_ct"))], ["source_id"], ["uv_ct"], window)
    return lookup(out, dims["dim_base_source"], {"source_id": "id"}, {"source_site": "source_name"}).select(
        "stt", "edt", "source_id", "source_name", "uv_ct")


def dws_traffic_vc_source_ar_is_new_page_view_window(
    pages: DataFrame, visitors: DataFrame, jumps: DataFrame, dims: Dims, window: str = WINDOW
) -> DataFrame:
    """Page views, sessions and duration from the page log; visitors and bounces from their details."""
    keys = {"vc": "version_code", "sc": "source_id", "ar": "ar", "is_new": "is_new"}
    by = [F.col(f"common.{k}").alias(name) for k, name in keys.items()]
    main = _page_rows(
        pages, *by,
        one_if(F.col("page.last_page_id").isNull()).alias("total_session_count"),
        _one("page_view_count"),
        F.coalesce(F.col("page.during_time").cast("long"), F.lit(0)).alias("total_during_time"),
        delay=TRAFFIC_DELAY,
    )
    unique = _page_rows(visitors, *by, _one("uv_count"), delay=TRAFFIC_DELAY)
    jumped = _page_rows(jumps, *by, _one("jump_session_count"), delay=TRAFFIC_DELAY)
    measures = ["uv_count", "total_session_count", "page_view_count", "total_during_time", "jump_session_count"]
    out = tumble_measures([main, unique, jumped], list(keys.values()), measures, window)
    out = lookup(out, dims["dim_base_province"], {"ar": "id"}, {"name": "province_name"})
    out = lookup(out, dims["dim_base_source"], {"source_id": "id"}, {"source_site": "source_name"})
    return out.select("stt", "edt", "version_code", "source_id", "source_name", "ar", "province_name",
                      "is_new", *measures)


# --- users --------------------------------------------------------------------------------------
def dws_user_login_window(logins: DataFrame, window: str = WINDOW) -> DataFrame:
    """``logins`` are login rows in batch.  A stream passes the output of
    ``streaming.state.returning_users`` (user, ts, uv_count, back_count) instead."""
    if logins.isStreaming:
        days = watermark(logins, "ts", LOGIN_DELAY)
    else:
        days = firsts.returning_users(logins.select("user_id", from_epoch_millis("ts").alias("ts")), "user_id")
    return tumble_measures([days], [], ["back_count", "uv_count"], window)


def dws_user_register_window(registrations: DataFrame, window: str = WINDOW) -> DataFrame:
    rows = _timed(newest(registrations, "user_id", ["ts"]), _one("register_count"))
    return tumble_measures([rows], [], ["register_count"], window)
