"""Detail tables built from the change feed and the page log.

``changes`` is a frame of (database, table, type, data, ts); ``pages`` a frame of (common, page, ts)
with ``common`` and ``page`` as maps or structs.  Given ``within``, joins are limited to rows whose
event times are that close, which a stream needs; without it, batch joins take all history.  A stream
may emit a line once per match, for the keyed sink to keep the last; batch finds that one directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lyceum import schemas
from lyceum.functions.times import date_id, from_epoch_millis, from_epoch_seconds
from lyceum.operators.joins import MATCHED, join_feeds, latest_within, left_with_updates, near, span_seconds
from lyceum.operators.latest import latest_per_key
from lyceum.operators.windows import watermark
from lyceum.streaming.joins import join_within

# Fixed value: payment status of a successful payment.
PAID = "1602"
ORDER_WITHIN = "10 seconds"
PAYMENT_WITHIN = "905 seconds"


def rows_of(changes: DataFrame, table: str, kind: str | None = "insert") -> DataFrame:
    wanted = F.col("table") == table
    return changes.where(wanted & (F.col("type") == kind) if kind else wanted)


def field(name: str) -> Column:
    return F.col("data")[name].alias(name)


def simple_detail(changes: DataFrame, name: str) -> DataFrame:
    """Any of the six details that are one source table's inserts, projected."""
    table, columns = schemas.SIMPLE_DETAILS[name]
    computed = {"date_id": date_id(F.col("data")["create_time"]).alias("date_id"), "ts": F.col("ts")}
    return rows_of(changes, table).select(*[computed.get(c, field(c)) for c in columns.split()])


def version(given: Column | None) -> Column:
    """When a row was changed; the clock of the run would give all rows of a batch the same version."""
    return given if given is not None else from_epoch_seconds("ts")


def order_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("page")["page_id"] == "order").select(
        F.col("common")["sid"].alias("log_session_id"),
        F.col("common")["sc"].alias("source_id"),
        from_epoch_millis("ts").alias("log_time"),
    )


def dwd_trade_order_detail(
    changes: DataFrame, pages: DataFrame, within: str | None = None, row_op_ts: Column | None = None,
    with_source: bool = True, changelog: bool = False, page_within: str | None = None,
) -> DataFrame:
    """Order lines with their order's attributes and the traffic source of the order page.

    ``row_op_ts``, the version of a line, is the time of its change unless given.  Without
    ``with_source`` the page log is not read and the source is null.  A stream with ``changelog`` gives each
    line at once and again for each page of its order (``left_with_updates``), with ``matched_at``; the page
    may be ``page_within`` away."""
    details = rows_of(changes, "order_detail").select(
        *[field(c) for c in ("id", "order_id", "user_id", "course_id")],
        date_id(F.col("data")["create_time"]).alias("date_id"),
        *[field(c) for c in ("create_time", "origin_amount")],
        F.col("data")["coupon_reduce"].alias("coupon_reduce_amount"),
        field("final_amount"),
        "ts",
        from_epoch_seconds("ts").alias("detail_time"),
    )
    orders = rows_of(changes, "order_info").select(
        F.col("data")["id"].alias("info_id"),
        *[field(c) for c in ("province_id", "out_trade_no", "session_id", "trade_body")],
        from_epoch_seconds("ts").alias("order_time"),
    )
    sources = order_pages(pages)
    if changes.isStreaming:
        details, orders, sources = (
            watermark(details, "detail_time"), watermark(orders, "order_time"), watermark(sources, "log_time")
        )
        if changelog:
            reach = page_within or within or ORDER_WITHIN
            orders = left_with_updates(orders, sources, "session_id", "log_session_id", "order_time", "log_time", reach, "seen_at")
            joined = join_within(details, orders, "order_id", "info_id", "detail_time", "order_time",
                                 span_seconds(within or ORDER_WITHIN), right_seen="seen_at", right_late_seconds=span_seconds(reach))
        else:
            joined = join_feeds(details, orders, "order_id", "info_id", "inner",
                                "detail_time", "order_time", within or ORDER_WITHIN)
        if with_source and not changelog:
            joined = join_feeds(joined, sources, "session_id", "log_session_id", "left",
                                "order_time", "log_time", within or ORDER_WITHIN)
    else:
        # The sink is keyed and keeps the last row written per line, so one order row per order and
        # one page row per order are enough; reducing them first keeps the joins one-to-many.
        # Orders get their source before they meet the many order lines: both left sides are then
        # plain scans, whose hot keys are cheap to find.
        orders = latest_per_key(orders, "info_id", ["order_time", "session_id"])
        if not with_source:
            sourced = orders
        elif within:
            sourced = latest_within(orders, sources, "session_id", "log_session_id", "order_time", "log_time", within)
        else:
            sources = latest_per_key(sources, "log_session_id", ["log_time", "source_id"])
            sourced = join_feeds(orders, sources, "session_id", "log_session_id", "left")
        joined = join_feeds(details, sourced, "order_id", "info_id", "inner")
        if within:
            joined = joined.where(near("detail_time", "order_time", within))
    if not with_source:
        joined = joined.withColumn("source_id", F.lit(None).cast("string"))
    extra = [MATCHED] if MATCHED in joined.columns else []
    return joined.withColumn("row_op_ts", version(row_op_ts)).select(*schemas.ORDER_DETAIL.names, *extra)


def dwd_trade_pay_suc_detail(
    changes: DataFrame, order_details: DataFrame, within: str | None = None
) -> DataFrame:
    """Paid order lines.  Any change of a payment counts once its status says paid."""
    paid = rows_of(changes, "payment_info", kind=None).where(F.col("data")["payment_status"] == PAID)
    paid = paid.select(
        F.col("data")["order_id"].alias("paid_order_id"),
        *[F.col("data")[c].alias(c) for c in
          ("alipay_trade_no", "trade_body", "payment_type", "payment_status", "callback_time",
           "callback_content")],
        F.col("ts").alias("paid_ts"),
        from_epoch_seconds("ts").alias("paid_time"),
    )
    lines = order_details.drop("trade_body").withColumn("detail_time", from_epoch_seconds("ts"))
    if changes.isStreaming:
        paid, lines = watermark(paid, "paid_time"), watermark(lines, "detail_time")
        joined = join_within(lines, paid, "order_id", "paid_order_id", "detail_time", "paid_time",
                             span_seconds(within or PAYMENT_WITHIN))
    elif within:
        joined = latest_within(lines, paid, "order_id", "paid_order_id", "detail_time", "paid_time", within)
        joined = joined.where(F.col("paid_time").isNotNull())
    else:
        paid = latest_per_key(paid, "paid_order_id", ["paid_time", "alipay_trade_no"])
        joined = join_feeds(lines, paid, "order_id", "paid_order_id", "inner")
    return joined.withColumn("ts", F.col("paid_ts")).withColumn(
        "original_amount", F.col("origin_amount")
    ).select(*schemas.PAY_SUC_DETAIL.names)


def dwd_user_user_register(
    changes: DataFrame, pages: DataFrame, within: str | None = None, row_op_ts: Column | None = None,
    changelog: bool = False,
) -> DataFrame:
    """Registrations with the device attributes seen in the user's page log.  A stream with ``changelog``
    gives each at once and again for each page (``left_with_updates``), with ``matched_at``."""
    users = rows_of(changes, "user_info").select(
        F.col("data")["id"].alias("user_id"),
        F.col("data")["create_time"].alias("register_time"),
        date_id(F.col("data")["create_time"]).alias("register_date"),
        "ts",
        from_epoch_seconds("ts").alias("user_time"),
    )
    # Names of the log's device attributes and of the columns they fill.
    attributes = {"ch": "channel", "ar": "province_id", "vc": "version_code", "sc": "source_id",
                  "mid": "mid_id", "ba": "brand", "md": "model", "os": "operate_system"}
    devices = pages.where(F.col("common")["uid"].isNotNull()).select(
        F.col("common")["uid"].alias("log_user_id"),
        *[F.col("common")[k].alias(name) for k, name in attributes.items()],
        from_epoch_millis("ts").alias("log_time"),
    )
    if changes.isStreaming:
        users, devices = watermark(users, "user_time"), watermark(devices, "log_time")
        join = left_with_updates if changelog else join_feeds
        joined = join(users, devices, "user_id", "log_user_id", *([] if changelog else ["left"]), "user_time", "log_time",
                      within or ORDER_WITHIN)
    else:
        # The sink keeps one row per user: reduce to that before joining.
        users = latest_per_key(users, "user_id", ["user_time", "register_time"])
        if within:
            joined = latest_within(users, devices, "user_id", "log_user_id", "user_time", "log_time", within)
        else:
            devices = latest_per_key(devices, "log_user_id", ["log_time", *attributes.values()])
            joined = join_feeds(users, devices, "user_id", "log_user_id", "left")
    extra = [MATCHED] if MATCHED in joined.columns else []
    return joined.withColumn("row_op_ts", version(row_op_ts)).select(*schemas.USER_REGISTER.names, *extra)


def paid_changes(changes: DataFrame, versions: DataFrame, within: str | None = None) -> DataFrame:
    """Changelog of the paid lines, from payments and the keyed order detail read as versions.

    ``versions`` (``feeds.keyed_versions``) has new versions of lines and, with ``deleted``, their ends.  Each
    version meets the payments at most ``within`` away, whichever comes first; an end passes as it is.  The
    newest ``row_op_ts`` of an id tells what holds now; a keyed sink reads it (``read_keyed`` with
    ``deleted``).  Both sides' state ends when the watermark passes the limit."""
    paid = dwd_trade_pay_suc_detail(changes, versions.where(~F.col("deleted")).select(*schemas.ORDER_DETAIL.names), within)
    paid = paid.withColumn("deleted", F.lit(False))
    ended = versions.where("deleted").select("id", "row_op_ts", "deleted")
    return paid.unionByName(ended, allowMissingColumns=True)
