"""Split the behaviour log into its six detail logs.

A record with ``err`` goes to the error log in full and then, without ``err``, to exactly one of
start / play / page.  Page records also spread their displays and actions into rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TOPICS = {
    "page": "dwd_traffic_page_log",
    "start": "dwd_traffic_start_log",
    "display": "dwd_traffic_display_log",
    "action": "dwd_traffic_action_log",
    "error": "dwd_traffic_error_log",
    "play": "dwd_traffic_play_pre_process",
}


def _has(name: str) -> Column:
    return F.col(name).isNotNull()


def _kinds() -> tuple[Column, Column, Column]:
    start = _has("start")
    play = ~start & _has("appVideo")
    page = ~start & ~_has("appVideo")
    return start, play, page


def error_log(logs: DataFrame) -> DataFrame:
    return logs.where(_has("err"))


def start_log(logs: DataFrame) -> DataFrame:
    return logs.where(_kinds()[0]).drop("err")


def play_log(logs: DataFrame) -> DataFrame:
    return logs.where(_kinds()[1]).drop("err")


def page_log(logs: DataFrame) -> DataFrame:
    return logs.where(_kinds()[2]).drop("err", "displays", "actions")


def display_log(logs: DataFrame) -> DataFrame:
    return logs.where(_kinds()[2]).select(
        F.explode("displays").alias("display"), "common", "page", "ts"
    )


def action_log(logs: DataFrame) -> DataFrame:
    """Action rows carry no record time."""
    return logs.where(_kinds()[2]).select(F.explode("actions").alias("action"), "common", "page")


def split_logs(logs: DataFrame) -> dict[str, DataFrame]:
    return {
        "page": page_log(logs),
        "start": start_log(logs),
        "display": display_log(logs),
        "action": action_log(logs),
        "error": error_log(logs),
        "play": play_log(logs),
    }


def as_topic_records(logs: DataFrame) -> DataFrame:
    """All six logs as (topic, value) rows from a single pass over the feed.

    Kafka takes the topic from the column; a file sink partitions by it.  So one scan (or one
    streaming query) feeds six outputs without caching the input.
    """
    start, play, page = _kinds()
    body = [c for c in logs.columns if c not in ("err", "displays", "actions")]
    whole = F.to_json(F.struct(*logs.columns))
    no_err = F.to_json(F.struct(*[c for c in logs.columns if c != "err"]))

    def one(kind: str, condition: Column, value: Column) -> Column:
        record = F.struct(F.lit(TOPICS[kind]).alias("topic"), value.alias("value"))
        return F.when(condition, F.array(record)).otherwise(F.array().cast(_RECORDS))

    def many(kind: str, items: str, name: str, rest: list[str]) -> Column:
        spread = F.transform(
            F.coalesce(F.col(items), F.array().cast(logs.schema[items].dataType)),
            lambda item: F.struct(
                F.lit(TOPICS[kind]).alias("topic"),
                F.to_json(F.struct(item.alias(name), *rest)).alias("value"),
            ),
        )
        return F.when(page, spread).otherwise(F.array().cast(_RECORDS))

    records = F.concat(
        one("error", _has("err"), whole),
        one("start", start, no_err),
        one("play", play, no_err),
        one("page", page, F.to_json(F.struct(*body))),
        many("display", "displays", "display", ["common", "page", "ts"]),
        many("action", "actions", "action", ["common", "page"]),
    )
    return logs.select(F.explode(records).alias("r")).select("r.topic", "r.value")


_RECORDS = "array<struct<topic:string,value:string>>"
