"""Sources: topics, files, and their typed forms.

Kafka needs the public ``spark-sql-kafka-0-10`` package on the class path; files work everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lyceum import schemas
from lyceum.operators.cleaning import drop_tombstones


def kafka_options(servers: str, topic: str, group: str | None = None, starting: str = "latest",
                  **extra: str) -> dict[str, str]:
    """Reader options.  ``starting`` only matters without a checkpoint; after a restart the
    checkpoint's offsets count."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group:
        options["groupIdPrefix"] = group
    return {**options, **extra}


def topic_stream(spark: SparkSession, servers: str, topic: str, group: str | None = None,
                 starting: str = "latest", **extra: str) -> DataFrame:
    """Text values of a topic as a stream; deletions are null values.  ``arrival`` is a record's place in
    its partition, which all records of a key share, and ``arrival_time`` its time stamp."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, group, starting, **extra))
    return topic_records(reader.load())


def topic_batch(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """All that a topic holds now."""
    options = kafka_options(servers, topic, None, "earliest", endingOffsets="latest", **extra)
    reader = spark.read.format("kafka").options(**options)
    return topic_records(reader.load())


def topic_records(raw: DataFrame) -> DataFrame:
    """Columns of Kafka's source as (key, value, partition, arrival, arrival_time)."""
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "partition",
                      F.col("offset").alias("arrival"), F.col("timestamp").alias("arrival_time"))


def file_arrival() -> Column:
    """Place of arrival of a row of a Parquet file: when the file was written, its path, the row in it."""
    return F.struct(F.col("_metadata.file_modification_time").alias("written"), F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.row_index").alias("row"))


def text_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Files with one JSON text per line, as a stream of ``value``."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def table_stream(spark: SparkSession, path: str, schema: T.StructType | str, pattern: str | None = None,
                 files_per_trigger: int | None = None) -> DataFrame:
    """A parquet folder as a stream; ``pattern`` picks files by name."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def typed(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON text to columns; deletions are dropped."""
    parsed = drop_tombstones(df, value).select(F.from_json(value, schema).alias("r"))
    return parsed.select("r.*")


def keyed_versions(records: DataFrame, schema: T.StructType, keys: list[str], version: str = "row_op_ts",
                   arrived: str = "arrival_time") -> DataFrame:
    """A keyed topic as versions: the columns of ``schema``, ``deleted``, and the place of arrival if there is
    one.  Nothing is dropped: a deletion has a null value, its key, and the time it arrived as its version."""
    named = T.StructType([schema[k] for k in keys])
    read = records.withColumns({"_key": F.from_json("key", named), "_row": F.from_json("value", schema)})
    deleted = F.col("value").isNull()
    columns = []
    for name in schema.names:
        column = F.coalesce(F.col(f"_row.{name}"), F.col(f"_key.{name}")) if name in keys else F.col(f"_row.{name}")
        columns.append((F.when(deleted, F.col(arrived)).otherwise(column) if name == version else column).alias(name))
    places = [c for c in ("partition", "arrival") if c in records.columns]
    return read.where(deleted | F.col("_row").isNotNull()).select(*columns, deleted.alias("deleted"), *places)


def change_records(df: DataFrame) -> DataFrame:
    return typed(df, schemas.CHANGE_RECORD)


def page_log_maps(df: DataFrame) -> DataFrame:
    return typed(df, schemas.PAGE_LOG_MAPS)


def config_changes(df: DataFrame) -> DataFrame:
    return typed(df, schemas.CONFIG_CHANGE)


def order_details(df: DataFrame) -> DataFrame:
    return typed(df, schemas.ORDER_DETAIL)


def pay_suc_details(df: DataFrame) -> DataFrame:
    return typed(df, schemas.PAY_SUC_DETAIL)


def registrations(df: DataFrame) -> DataFrame:
    return typed(df, schemas.USER_REGISTER)
