"""The supplied tables, and the raw feeds derived from them.

Each feed is a projection of whole tables (no shuffle): orders, lineitem and events play the
change feed and the behaviour log, the small tables play the dimensions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lyceum import schemas
from lyceum.functions.times import DATE_TIME


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TIMES = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; its time becomes a zoned timestamp, which windows and watermarks need."""
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    return zoned(df, name)


def zoned(df: DataFrame, name: str) -> DataFrame:
    time = TIMES.get(name)
    return df.withColumn(time, F.col(time).cast("timestamp")) if time else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number ``k`` from their JSON properties."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").withColumn("k", k)


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def decimal_text(c: Column | str) -> Column:
    return text((F.col(c) if isinstance(c, str) else c).cast("decimal(16,2)"))


def _record(df: DataFrame, name: str, seconds: Column, data: dict[str, Column], kind: str = "insert") -> DataFrame:
    entries = [part for key, value in data.items() for part in (F.lit(key), text(value))]
    return df.select(
        F.lit("edu").alias("database"), F.lit(name).alias("table"), F.lit(kind).alias("type"),
        F.create_map(*entries).alias("data"), text(seconds).alias("ts"),
    )


def _seconds(c: str) -> Column:
    return F.unix_timestamp(F.col(c))


def _time_text(c: str) -> Column:
    return F.date_format(c, DATE_TIME)


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_info_of(table(spark, sf_dir, "orders"))


def order_info_of(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return _record(orders, "order_info", _seconds("o_orderdate") + key % 86400, {
        "id": key, "user_id": F.col("o_custkey"), "province_id": F.col("o_custkey") % 30,
        "out_trade_no": F.concat(F.lit("T"), text(key)), "session_id": F.concat(F.lit("s"), text(key % 200)),
        "trade_body": F.col("o_orderpriority"), "final_amount": decimal_text("o_totalprice"),
        "create_time": _time_text("o_orderdate"),
    })


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_detail_of(table(spark, sf_dir, "lineitem"))


def order_detail_of(lines: DataFrame) -> DataFrame:
    """Order and line number repeat in lineitem: the repeats act as versions of one line."""
    price = F.col("l_extendedprice").cast("decimal(16,2)")
    reduce_ = (price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(16,2)")
    return _record(
        lines, "order_detail", _seconds("l_shipdate") + F.col("l_orderkey") % 86400, {
            "id": F.concat_ws("-", text("l_orderkey"), text("l_linenumber")),
            "order_id": F.col("l_orderkey"), "user_id": F.col("l_suppkey"), "course_id": F.col("l_partkey"),
            "create_time": _time_text("l_shipdate"), "origin_amount": price, "coupon_reduce": reduce_,
            "final_amount": (price - reduce_).cast("decimal(16,2)"),
        })


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_info_of(table(spark, sf_dir, "orders"))


def payment_info_of(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", F.lit("1602")).otherwise(F.lit("1601"))
    return _record(orders, "payment_info", _seconds("o_orderdate") + 600, {
        "alipay_trade_no": F.concat(F.lit("A"), text(key)), "trade_body": F.col("o_orderpriority"),
        "order_id": key, "payment_type": F.lit("1101"), "payment_status": status,
        "callback_time": _time_text("o_orderdate"), "callback_content": F.col("o_orderstatus"),
    }, "update")


def _of_type(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == event_type)


def cart_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record(_of_type(spark, sf_dir, "purchase"), "cart_info", _seconds("ts"), {
        "id": F.col("event_id"), "user_id": F.col("user_id"), "course_id": F.col("k"),
        "create_time": _time_text("ts"), "session_id": F.concat(F.lit("s"), text("user_id")),
        "cart_price": decimal_text("value"),
    })


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_info_of(events(spark, sf_dir))


def user_info_of(rows: DataFrame) -> DataFrame:
    return _record(rows.where(F.col("event_type") == "signup"), "user_info", _seconds("ts"), {
        "id": F.col("user_id"), "create_time": _time_text("ts"),
    })


def review_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record(_of_type(spark, sf_dir, "view"), "review_info", _seconds("ts"), {
        "id": F.col("event_id"), "user_id": F.col("user_id"), "course_id": F.col("k"),
        "create_time": _time_text("ts"), "review_txt": F.col("props"), "review_stars": F.col("event_id") % 5 + 1,
    })


def favor_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record(_of_type(spark, sf_dir, "signup"), "favor_info", _seconds("ts"), {
        "id": F.col("event_id"), "user_id": F.col("user_id"), "course_id": F.col("k"),
        "create_time": _time_text("ts"),
    })


def comment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.lit(1704067200) + F.col("conv_id") * 60 + F.col("turn")
    return _record(table(spark, sf_dir, "conversations"), "comment_info", seconds, {
        "id": F.concat_ws("-", text("conv_id"), text("turn")), "user_id": F.col("conv_id"),
        "chapter_id": F.col("turn"), "course_id": F.col("conv_id") % 100,
        "create_time": F.date_format(F.timestamp_seconds(seconds), DATE_TIME), "comment_txt": F.col("text"),
    })


def test_exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record(_of_type(spark, sf_dir, "click"), "test_exam", _seconds("ts"), {
        "id": F.col("event_id"), "paper_id": F.col("k") % 20, "user_id": F.col("user_id"),
        "score": decimal_text(F.least(F.col("value"), F.lit(100.0))), "duration_sec": F.col("k") * 30,
        "create_time": _time_text("ts"), "submit_time": _time_text("ts"), "update_time": F.lit(None).cast("string"),
    })


def test_exam_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record(_of_type(spark, sf_dir, "error"), "test_exam_question", _seconds("ts"), {
        "id": F.col("event_id"), "user_id": F.col("user_id"), "paper_id": F.col("k") % 20,
        "question_id": F.col("k"), "answer": F.col("event_type"), "is_correct": F.col("event_id") % 2,
        "score": F.col("k") % 10, "create_time": _time_text("ts"), "update_time": _time_text("ts"),
    })


CHANGE_TABLES = {make.__name__: make for make in (
    order_info, order_detail, payment_info, cart_info, user_info, review_info, favor_info, comment_info,
    test_exam, test_exam_question,
)}


def change_feed(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Change records of the named tables (default: all).  A filter on ``table`` leaves one branch
    of the union to be read."""
    return reduce(DataFrame.unionByName, [CHANGE_TABLES[n](spark, sf_dir) for n in names or CHANGE_TABLES])


def behaviour_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_of(events(spark, sf_dir))


def log_of(df: DataFrame) -> DataFrame:
    """Events as behaviour-log records: sign-ups are starts, purchases are plays, the rest are pages;
    errors carry ``err``, views show displays, clicks hold an action."""
    kind, k, user = F.col("event_type"), F.col("k"), text("user_id")
    is_page = kind.isin("view", "click", "error")

    def when(condition: Column, value: Column) -> Column:
        return F.when(condition, value)

    common = F.struct(
        F.concat(F.lit("m"), user).alias("mid"),
        when(k % 5 != 0, user).alias("uid"),
        F.concat(F.lit("s"), user).alias("sid"),
        text(F.col("user_id") % 6).alias("sc"),
        text(k % 30).alias("ar"),
        F.concat(F.lit("c"), text(k % 4)).alias("ch"),
        F.concat(F.lit("v"), text(k % 3)).alias("vc"),
        F.concat(F.lit("b"), text(F.col("user_id") % 7)).alias("ba"),
        F.concat(F.lit("d"), text(F.col("user_id") % 11)).alias("md"),
        F.when(k % 2 == 0, F.lit("ios")).otherwise(F.lit("android")).alias("os"),
        F.when(kind == "signup", F.lit("1")).otherwise(F.lit("0")).alias("is_new"),
    )
    page_names = F.array(*[F.lit(n) for n in ("home", "course_list", "course_detail", "order", "search")])
    search = k % 5 == 4
    page = F.struct(
        F.element_at(page_names, (k % 5 + 1).cast("int")).alias("page_id"),
        when(k % 3 != 0, F.lit("home")).alias("last_page_id"),
        F.when(search, F.concat_ws(" ", kind, F.lit("Course"), text(k % 10))).otherwise(text(k)).alias("item"),
        F.when(search, F.lit("keyword")).otherwise(F.lit("course_id")).alias("item_type"),
        when(k % 7 != 0, (k * 100).cast("long")).alias("during_time"),
    )
    display = F.struct(
        F.lit("query").alias("display_type"), text(k).alias("item"), F.lit("course_id").alias("item_type"),
        F.lit("1").alias("pos_id"),
    )
    second = F.struct(
        F.lit("promotion").alias("display_type"), text(k + 1).alias("item"), F.lit("course_id").alias("item_type"),
        F.lit("2").alias("pos_id"),
    )
    action = F.struct(
        F.lit("favor_add").alias("action_id"), text(k).alias("item"), F.lit("course_id").alias("item_type"),
    )
    return df.select(
        common.alias("common"),
        when(kind == "signup", F.struct(F.lit("icon").alias("entry"), (k * 10).cast("long").alias("loading_time")))
        .alias("start"),
        when(is_page, page).alias("page"),
        when(kind == "view", F.array(display, second)).alias("displays"),
        when(kind == "click", F.array(action)).alias("actions"),
        when(kind == "purchase", F.struct(
            text(k).alias("video_id"), (k % 30 + 1).cast("int").alias("play_sec"),
            F.col("value").cast("int").alias("position_sec"),
        )).alias("appVideo"),
        when(kind == "error", F.struct(k.alias("error_code"), F.col("props").alias("msg"))).alias("err"),
        F.unix_millis("ts").alias("ts"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine dimensions, all columns text."""
    part, nation = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    region, supplier = table(spark, sf_dir, "region"), table(spark, sf_dir, "supplier")
    customer = table(spark, sf_dir, "customer")

    def dim(df: DataFrame, **columns: Column | str) -> DataFrame:
        return df.select(*[text(c).alias(name) for name, c in columns.items()])

    return {
        "dim_course_info": dim(part, id="p_partkey", course_name="p_name", subject_id=F.col("p_partkey") % 30),
        "dim_base_subject_info": dim(nation, id="n_nationkey", subject_name="n_name", category_id="n_regionkey"),
        "dim_base_category_info": dim(region, id="r_regionkey", category_name="r_name"),
        "dim_test_paper": dim(supplier, id="s_suppkey", paper_title="s_name", course_id=F.col("s_suppkey") * 3),
        "dim_test_question_info": dim(customer, id="c_custkey", question_txt="c_name"),
        "dim_video_info": dim(part, id="p_partkey", chapter_id="p_size"),
        "dim_chapter_info": dim(supplier, id="s_suppkey", chapter_name="s_name"),
        "dim_base_province": dim(nation, id="n_nationkey", name="n_name"),
        "dim_base_source": dim(region, id="r_regionkey", source_site="r_name"),
    }


def course_info_of(parts: DataFrame) -> DataFrame:
    """Parts as change records of the course table, with a column the dimension does not keep."""
    return _record(parts, "course_info", F.lit(1704067200), {
        "id": F.col("p_partkey"), "course_name": F.col("p_name"), "subject_id": F.col("p_partkey") % 30,
        "price": decimal_text("p_retailprice"),
    }, "bootstrap-insert")


def nation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as change records of the province table."""
    return _record(table(spark, sf_dir, "nation"), "base_province", F.lit(1704067200), {
        "id": F.col("n_nationkey"), "name": F.col("n_name"), "region_id": F.col("n_regionkey"),
    }, "bootstrap-insert")


# Source tables, the dimensions they fill, and the columns kept.
DIMENSION_CONFIG = [
    ("course_info", "dim_course_info", "id,course_name,subject_id", None, None),
    ("base_province", "dim_base_province", "id,name", "id", None),
]


def dimension_config(spark: SparkSession) -> DataFrame:
    """Which source tables feed which dimension, and the columns each keeps."""
    return spark.createDataFrame(DIMENSION_CONFIG, schemas.CONFIG_ROW)


def config_feed(spark: SparkSession) -> DataFrame:
    """The same as change-log text, as a snapshot read would send it."""
    row = F.struct(*schemas.CONFIG_ROW.names)
    return json_feed(dimension_config(spark).select(F.lit("r").alias("op"), row.alias("after"), F.lit(1).alias("ts_ms")))


def json_feed(df: DataFrame) -> DataFrame:
    """Records as the JSON text a topic would carry."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
