"""Detail tables built from the behaviour log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lyceum.functions.times import date_text, datetime_text, from_epoch_millis
from lyceum.operators import firsts, routing, sessions
from lyceum.operators.windows import watermark

PLAY_GAP_SECONDS = 11
BOUNCE_SECONDS = 10

PLAY_COLUMNS = {
    "sc": "source_id", "ar": "province_id", "uid": "user_id", "os": "operating_system",
    "ch": "channel", "is_new": "is_new", "md": "model", "mid": "machine_id", "vc": "version_code",
    "ba": "brand", "sid": "session_id",
}
LOGIN_COLUMNS = {
    "ch": "channel", "ar": "province_id", "vc": "version_code", "mid": "mid_id", "ba": "brand",
    "md": "model", "sc": "source_id", "os": "operating_system",
}


def repaired_logs(logs: DataFrame) -> DataFrame:
    """The behaviour log with wrong new-visitor flags cleared (batch form)."""
    flat = logs.withColumn("_mid", F.col("common.mid")).withColumn("_new", F.col("common.is_new")) \
        .withColumn("_time", from_epoch_millis("ts"))
    fixed = firsts.repair_new_visitor(flat, "_mid", "_new", "_time")
    return fixed.withColumn("common", F.col("common").withField("is_new", F.col("_new"))).select(*logs.columns)


def base_logs(logs: DataFrame) -> dict[str, DataFrame]:
    """Page, start, display, action, error and play logs, after the flag repair."""
    return routing.split_logs(repaired_logs(logs))


def dwd_learn_play(plays: DataFrame, gap_seconds: int = PLAY_GAP_SECONDS, by_video: bool = False) -> DataFrame:
    """One row per play session: attributes of its first heartbeat, seconds played, and the
    position at its latest heartbeat.  ``by_video`` also separates the videos of a session."""
    rows = plays.select(
        *[F.col(f"common.{k}").alias(name) for k, name in PLAY_COLUMNS.items()],
        "appVideo.play_sec", "appVideo.position_sec", "appVideo.video_id", "ts",
        from_epoch_millis("ts").alias("event_time"),
    )
    keys = ["session_id", "video_id"] if by_video else ["session_id"]
    firsts_ = [c for c in [*PLAY_COLUMNS.values(), "video_id", "ts"] if c not in keys]
    rolled = sessions.session_rollup(
        watermark(rows, "event_time"), keys, gap_seconds, {"play_sec": "play_sec"}, firsts_,
        ["position_sec"], "event_time", ["video_id", "position_sec"],
    )
    return rolled.select(*PLAY_COLUMNS.values(), "play_sec", "position_sec", "video_id", "ts")


def _is_session_start() -> "F.Column":
    return F.col("page.last_page_id").isNull()


def dwd_traffic_unique_visitor_detail(pages: DataFrame, ties: list[str] = ("page",)) -> DataFrame:
    """The first session-start page of each visitor on each day."""
    starts = pages.where(_is_session_start()).withColumn("_mid", F.col("common.mid")).withColumn(
        "_time", from_epoch_millis("ts")
    )
    picked = firsts.first_rows_of_day(watermark(starts, "_time"), ["_mid"], "_time", list(ties))
    return picked.select(*pages.columns)


def dwd_traffic_user_jump_detail(
    pages: DataFrame, within_seconds: int = BOUNCE_SECONDS, ties: list[str] = ("page",)
) -> DataFrame:
    """Session starts that bounced (batch form; see ``streaming.state`` for streams)."""
    rows = pages.withColumn("_mid", F.col("common.mid")).withColumn("_time", from_epoch_millis("ts"))
    left = sessions.bounces(rows, "_mid", _is_session_start(), within_seconds, "_time", list(ties))
    return left.select(*pages.columns)


def login_rows(first_logins: DataFrame) -> DataFrame:
    time = from_epoch_millis("ts")
    return first_logins.select(
        F.col("common.uid").alias("user_id"),
        date_text(time).alias("date_id"),
        datetime_text(time).alias("login_time"),
        *[F.col(f"common.{k}").alias(name) for k, name in LOGIN_COLUMNS.items()],
        "ts",
    )


def dwd_user_user_login(pages: DataFrame, ties: list[str] = ("page",)) -> DataFrame:
    """The first logged-in page of each session (batch form)."""
    rows = pages.withColumn("_sid", F.col("common.sid")).withColumn("_uid", F.col("common.uid"))
    return login_rows(sessions.first_login(rows, "_sid", "_uid", "ts", list(ties)))
