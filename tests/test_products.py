"""Detail tables and summaries on hand-made feeds."""

import datetime as dt
from decimal import Decimal

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from lyceum import schemas
from lyceum.plans import details, logs, summaries

T0 = 1655049600  # 2022-06-12 16:00:00 UTC


def change(table, seconds, data, kind="insert"):
    return ("edu", table, kind, data, str(T0 + seconds))


@pytest.fixture
def changes(frame):
    return frame([
        change("order_detail", 0, {"id": "1", "order_id": "o1", "user_id": "u1", "course_id": "c1",
                                   "create_time": "2022-06-12 16:00:00", "origin_amount": "100.00",
                                   "coupon_reduce": "0.10", "final_amount": "99.90"}),
        change("order_detail", 1, {"id": "2", "order_id": "o1", "user_id": "u1", "course_id": "c2",
                                   "create_time": "bad", "origin_amount": "50", "final_amount": "50.05"}),
        change("order_detail", 2, {"id": "3", "order_id": "o2", "user_id": "u2", "course_id": "c1",
                                   "create_time": "2022-06-12 16:00:02", "final_amount": "10"}),
        change("order_detail", 3, {"id": "4", "order_id": "gone", "user_id": "u2", "final_amount": "1"}),
        change("order_detail", 3, {"id": "1", "order_id": "o1", "final_amount": "0"}, "update"),
        change("order_info", 2, {"id": "o1", "province_id": "p1", "session_id": "s1", "user_id": "u1",
                                 "final_amount": "149.95", "out_trade_no": "T1", "trade_body": "b1"}),
        change("order_info", 3, {"id": "o2", "province_id": "p1", "session_id": "s2", "user_id": "u2",
                                 "final_amount": "10", "out_trade_no": "T2", "trade_body": "b2"}),
        change("payment_info", 600, {"order_id": "o1", "payment_status": "1602", "alipay_trade_no": "A",
                                     "trade_body": "paid"}, "update"),
        change("payment_info", 601, {"order_id": "o2", "payment_status": "1601"}, "update"),
        change("user_info", 0, {"id": "u1", "create_time": "2022-06-12 16:00:00"}),
        change("user_info", 5, {"id": "u9", "create_time": "2022-06-12 16:00:05"}),
    ], schemas.CHANGE_RECORD)


@pytest.fixture
def pages(frame):
    def page(ms, page_id, last=None, **common):
        return (common, {"page_id": page_id, **({"last_page_id": last} if last else {})}, T0 * 1000 + ms)
    return frame([
        page(0, "home", sid="s1", uid="u1", sc="9", ch="c"),
        page(500, "order", "home", sid="s1", uid="u1", sc="2", ch="c2", mid="m"),
        page(800, "order", "home", sid="s1", uid="u1", sc="3", ch="c3", mid="m"),
        page(900, "order", "home", sid="s3", sc="4"),
    ], schemas.PAGE_LOG_MAPS)


@pytest.mark.parametrize("within", [None, "10 seconds"])
def test_order_detail(changes, pages, within):
    out = details.dwd_trade_order_detail(changes, pages, within)
    assert out.columns == schemas.ORDER_DETAIL.names
    rows = {r.id: r for r in out.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert (rows["1"].source_id, rows["1"].date_id, rows["1"].coupon_reduce_amount) == ("3", "2022-06-12", "0.10")
    assert rows["2"].date_id is None and rows["2"].province_id == "p1"
    assert rows["3"].source_id is None and rows["3"].session_id == "s2"
    assert out.count() == 3  # the newest page of the session only


def test_payment_detail_renames_the_amount(changes, pages):
    orders = details.dwd_trade_order_detail(changes, pages)
    paid = details.dwd_trade_pay_suc_detail(changes, orders)
    assert paid.columns == schemas.PAY_SUC_DETAIL.names
    assert tuples(paid, "id", "trade_body", "original_amount", "ts") == [
        ("1", "paid", "100.00", str(T0 + 600)), ("2", "paid", "50", str(T0 + 600))]
    assert details.dwd_trade_pay_suc_detail(changes, orders, "500 seconds").count() == 0
    assert details.dwd_trade_pay_suc_detail(changes, orders, "905 seconds").count() == 2


def test_salted_path_gives_the_same_details(changes, pages, monkeypatch):
    plain = tuples(details.dwd_trade_order_detail(changes, pages).drop("row_op_ts"))
    monkeypatch.setattr(details, "join_feeds", _forced(details.join_feeds))
    assert tuples(details.dwd_trade_order_detail(changes, pages).drop("row_op_ts")) == plain


def _forced(join):
    def call(*args, **kwargs):
        return join(*args, salted=True, slice_rows=1, share=0.1, **kwargs)
    return call


def test_registration_has_one_row_per_user(changes, pages):
    for within in (None, "10 seconds"):
        out = details.dwd_user_user_register(changes, pages, within)
        assert tuples(out, "user_id", "register_date", "source_id", "mid_id") == [
            ("u1", "2022-06-12", "3", "m"), ("u9", "2022-06-12", None, None)]


def test_simple_details_take_inserts_only(frame):
    feed = frame([
        change("cart_info", 0, {"id": "1", "user_id": "u", "create_time": "2022-06-12 16:00:00", "cart_price": "3"}),
        change("cart_info", 0, {"id": "1", "user_id": "u"}, "update"), change("other", 0, {"id": "2"}),
    ], schemas.CHANGE_RECORD)
    out = details.simple_detail(feed, "dwd_trade_cart_add")
    assert out.columns == "id user_id course_id date_id session_id create_time cart_price ts".split()
    assert tuples(out) == [("1", "u", None, "2022-06-12", None, "2022-06-12 16:00:00", "3", str(T0))]


@pytest.fixture
def dims(frame):
    data = {
        "dim_course_info": [("c1", "Spark", "s1"), ("c2", "SQL", "missing")],
        "dim_base_subject_info": [("s1", "Data", "g1")], "dim_base_category_info": [("g1", "Computing")],
        "dim_base_province": [("p1", "North")], "dim_base_source": [("2", "site2"), ("3", "site3")],
        "dim_test_paper": [("t1", "Paper", "c1")], "dim_test_question_info": [("q1", "Why?")],
        "dim_video_info": [("v1", "h1"), ("v2", "h1")], "dim_chapter_info": [("h1", "Intro")],
    }
    return {name: frame(data[name], schema) for name, schema in schemas.DIMENSIONS.items()}


def test_order_summaries(changes, pages, dims):
    orders = details.dwd_trade_order_detail(changes, pages)
    again = orders.unionByName(orders.withColumn("final_amount", F.lit("1000")).withColumn(
        "row_op_ts", F.col("row_op_ts") - F.expr("interval 1 hour")))  # older versions must not count
    stt, edt = "2022-06-12 16:00:00", "2022-06-12 16:00:10"
    assert tuples(summaries.dws_trade_order_window(again)) == [(stt, edt, 2, 2)]
    assert tuples(summaries.dws_trade_course_order_window(again, dims)) == [
        (stt, edt, "c1", "Spark", "s1", "Data", "g1", "Computing", Decimal("109.90")),
        (stt, edt, "c2", "SQL", "missing", None, None, None, Decimal("50.05"))]
    assert tuples(summaries.dws_trade_source_order_window(again, dims)) == [
        (stt, edt, "3", "site3", Decimal("149.95"), 1, 1)]
    assert tuples(summaries.dws_trade_subject_user_order_window(again, dims)) == [
        (stt, edt, "missing", None, None, None, "u1", 1, Decimal("50.05")),
        (stt, edt, "s1", "Data", "g1", "Computing", "u1", 1, Decimal("99.90")),
        (stt, edt, "s1", "Data", "g1", "Computing", "u2", 1, Decimal("10.00"))]
    assert tuples(summaries.dws_trade_province_order_window(changes, dims)) == [
        (stt, edt, "p1", "North", Decimal("159.95"), 2, 2)]
    paid = details.dwd_trade_pay_suc_detail(changes, again)
    assert tuples(summaries.dws_trade_pay_suc_window(paid), "pay_suc_uv_count", "pay_suc_new_user_count") == [(1, 1)]


def test_second_day_counts_users_but_not_new_ones(frame):
    rows = [("1", "u", 0), ("2", "u", 5), ("3", "u", 8 * 3600), ("4", "w", 8 * 3600 + 1)]
    orders = frame([(i, u, str(T0 + s), dt.datetime(2022, 6, 13)) for i, u, s in rows],
                   "id string, user_id string, ts string, row_op_ts timestamp")
    out = summaries.dws_trade_order_window(orders)
    assert tuples(out, "stt", "order_uv_count", "new_order_user_count") == [
        ("2022-06-12 16:00:00", 1, 1), ("2022-06-13 00:00:00", 2, 1)]


def test_exam_question_review_summaries(frame, dims):
    papers = frame([("t1", "59.9", "10", str(T0)), ("t1", "95", "20", str(T0 + 9)), ("t2", "100", "5", str(T0 + 10))],
                   "paper_id string, score string, duration_sec string, ts string")
    taken = summaries.dws_examination_paper_exam_window(papers, dims)
    assert tuples(taken.drop("stt", "edt")) == [("t1", "Paper", "c1", "Spark", 2, 154, 30),
                                               ("t2", None, None, None, 1, 100, 5)][::1]
    bands = summaries.dws_examination_paper_score_duration_exam_window(papers, dims)
    assert tuples(bands, "paper_id", "score_duration", "user_count") == [
        ("t1", "[0, 60)", 1), ("t1", "[95, 100]", 1), ("t2", "[95, 100]", 1)]
    questions = frame([("q1", "1", str(T0)), ("q1", "0", str(T0)), ("q1", None, str(T0))],
                      "question_id string, is_correct string, ts string")
    answered = summaries.dws_examination_question_answer_window(questions, dims)
    assert tuples(answered.drop("stt", "edt")) == [("q1", "Why?", 1, 3)]
    reviews = frame([("c1", "5", str(T0)), ("c1", "4", str(T0 + 1))], "course_id string, review_stars string, ts string")
    assert tuples(summaries.dws_interaction_course_review_window(reviews, dims).drop("stt", "edt")) == [
        ("c1", "Spark", 9, 2, 1)]


def test_play_summary_counts_a_user_once_a_day(frame, dims):
    plays = frame([("v1", "u", 5, T0 * 1000), ("v2", "u", 6, T0 * 1000 + 1), ("v1", "w", 7, T0 * 1000 + 2)],
                  "video_id string, user_id string, play_sec int, ts bigint")
    out = summaries.dws_learn_chapter_play_window(plays, dims)
    assert out.columns == "stt edt chapter_id chapter_name play_count play_total_sec play_uu_count".split()
    assert tuples(out.drop("stt", "edt")) == [("h1", "Intro", 1, 6, 0), ("h1", "Intro", 2, 12, 2)]
    per_chapter = summaries.dws_learn_chapter_play_window(plays, dims, by_chapter=True)
    assert tuples(per_chapter.drop("stt", "edt")) == [("h1", "Intro", 3, 18, 2)]


def log(frame, rows):
    schema = schemas.BEHAVIOUR_LOG
    return frame([{
        "common": dict({"mid": "m", "sid": "s", "is_new": "0", "vc": "v", "sc": "2", "ar": "p1"}, **common),
        "page": page, "ts": T0 * 1000 + ms} for ms, common, page in rows], schema).select("common", "page", "ts")


def test_traffic_summaries(frame, dims):
    pages = log(frame, [
        (0, {}, {"page_id": "home", "during_time": 7}),
        (1000, {}, {"page_id": "course_list", "last_page_id": "home"}),
        (2000, {}, {"page_id": "home", "last_page_id": "course_list", "during_time": 3}),
        (3000, {"mid": "n", "sc": "x"}, {"page_id": "home", "item": "Spark sql", "item_type": "keyword"}),
    ])
    assert tuples(summaries.dws_traffic_page_view_window(pages).drop("stt", "edt")) == [(2, 1, 0)]
    assert tuples(summaries.dws_traffic_source_page_view_window(pages, dims).drop("stt", "edt")) == [
        ("2", "site2", 1), ("x", None, 1)]
    assert tuples(summaries.dws_traffic_source_keyword_page_view_window(pages).drop("stt", "edt")) == [
        ("SEARCH", "spark", 1), ("SEARCH", "sql", 1)]
    visitors = logs.dwd_traffic_unique_visitor_detail(pages)
    jumps = logs.dwd_traffic_user_jump_detail(pages)
    assert (visitors.count(), tuples(jumps, "common.mid")) == (2, [("n",)])
    out = summaries.dws_traffic_vc_source_ar_is_new_page_view_window(pages, visitors, jumps, dims)
    assert tuples(out.drop("stt", "edt")) == [
        ("v", "2", "site2", "p1", "North", "0", 1, 1, 3, 10, 0), ("v", "x", None, "p1", "North", "0", 1, 1, 1, 0, 1)]


def test_logins_and_returning_users(frame):
    day = 86_400_000
    pages = log(frame, [
        (1500, {"uid": "u"}, {"page_id": "home"}), (200, {"uid": "u"}, {"page_id": "order"}), (0, {}, {"page_id": "home"}),
        (9 * day, {"uid": "u", "sid": "s2"}, {"page_id": "home"}), (9 * day + 5000, {"uid": "u", "sid": "s3"}, {"page_id": "home"}),
    ])
    logins = logs.dwd_user_user_login(pages)
    assert tuples(logins, "user_id", "date_id", "login_time", "ts") == [
        ("u", "2022-06-12", "2022-06-12 16:00:00", T0 * 1000 + 200),
        ("u", "2022-06-21", "2022-06-21 16:00:00", T0 * 1000 + 9 * day),
        ("u", "2022-06-21", "2022-06-21 16:00:05", T0 * 1000 + 9 * day + 5000)]
    assert tuples(summaries.dws_user_login_window(logins)) == [
        ("2022-06-12 16:00:00", "2022-06-12 16:00:10", 0, 1), ("2022-06-21 16:00:00", "2022-06-21 16:00:10", 1, 1)]


def test_plays_roll_up_by_session(frame):
    rows = [({"sid": "s", "uid": "u", "mid": "m"}, {"video_id": v, "play_sec": p, "position_sec": x}, T0 * 1000 + ms)
            for v, p, x, ms in [("v1", 10, 10, 0), ("v1", 10, 20, 10_000), ("v2", 5, 25, 21_000), ("v1", 1, 1, 40_000)]]
    plays = frame([{"common": c, "appVideo": a, "ts": t} for c, a, t in rows], schemas.BEHAVIOUR_LOG)
    out = logs.dwd_learn_play(plays)
    assert tuples(out, "session_id", "video_id", "play_sec", "position_sec", "ts") == [
        ("s", "v1", 1, 1, T0 * 1000 + 40_000), ("s", "v1", 25, 25, T0 * 1000)]
    assert tuples(logs.dwd_learn_play(plays, by_video=True), "video_id", "play_sec") == [("v1", 1), ("v1", 20), ("v2", 5)]
