"""Sinks for batches and streams.

Keyed tables are kept as a log of versions, one folder per micro-batch: a replayed batch overwrites
its own folder, and readers take the newest version per key.  Nothing rewrites the whole table per
batch; ``compact`` does so when asked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from lyceum.operators.latest import latest_per_key
from lyceum.operators.lookup import dimension_changes, dimension_rows

BatchWriter = Callable[[DataFrame, int], None]

# Codec of the tables that streams write for each other, which wait on disk until the last stage is done.
CODEC = "zstd"


def json_values(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Rows as JSON text in ``value``; with ``key``, those columns as JSON text in ``key``."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(F.to_json(F.struct(*key)).alias("key"), value) if key else df.select(value)


def to_topic(df: DataFrame, servers: str, topic: str | None, checkpoint: str) -> DataStreamWriter:
    """Kafka writer for (key, value) rows; at least once.  Without ``topic`` the rows name their own."""
    writer = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    writer = writer.option("topic", topic) if topic else writer
    return writer.option("checkpointLocation", checkpoint)


def to_files(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] = (),
             fmt: str = "parquet") -> DataStreamWriter:
    """Append writer for files; exactly once through the sink's own log."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.option("compression", CODEC) if fmt == "parquet" else writer
    return (writer.partitionBy(*partition_by) if partition_by else writer).option("path", path)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process all data present, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch files that nobody reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


# --- keyed tables -----------------------------------------------------------------------------
def version_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def keyed_writer(path: str, keys: list[str], order: list[str]) -> BatchWriter:
    """``foreachBatch`` function: newest version per key of each micro-batch, replay-safe."""
    def write(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, keys, order).write.mode("overwrite").parquet(version_folder(path, batch_id), compression=CODEC)
    return write


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: list[str],
               deleted: str | None = None) -> DataFrame:
    """Current rows: newest version per key; of equal versions the later batch wins.  Where the newest
    version of a key is marked by the column ``deleted``, the key has no row."""
    with_batch = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
    versions = spark.read.schema(with_batch).parquet(path)
    current = latest_per_key(versions, keys, [*order, "batch_id"]).drop("batch_id")
    return current.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted) if deleted else current


def compact(spark: SparkSession, path: str, target: str, schema: T.StructType, keys: list[str],
            order: list[str]) -> None:
    """Write the current rows to a new table; readers are pointed to it afterwards."""
    read_keyed(spark, path, schema, keys, order).write.mode("errorifexists").parquet(version_folder(target, 0))


# --- dimensions ---------------------------------------------------------------------------------
def dimension_schema(sink_columns: str) -> T.StructType:
    """All columns are text."""
    return T.StructType([T.StructField(c.strip(), T.StringType()) for c in sink_columns.split(",")])


def ensure_dimension(spark: SparkSession, root: str, sink_table: str, sink_columns: str) -> T.StructType:
    """Create the dimension's (empty) table if it is not there yet."""
    schema = dimension_schema(sink_columns)
    versioned = T.StructType(schema.fields + [T.StructField("_version", T.LongType())])
    spark.createDataFrame([], versioned).write.mode("ignore").parquet(version_folder(f"{root}/{sink_table}", -1))
    return schema


def dimension_writer(root: str, read_config: Callable[[SparkSession], DataFrame]) -> BatchWriter:
    """``foreachBatch`` function for clean change records.

    The configuration is read anew for every micro-batch, so a table configured while the stream
    runs is picked up.  It has one row per source table; only those few rows reach the driver.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        config = read_config(spark)
        routed = dimension_changes(batch, config).persist()
        try:
            for row in config.select("sink_table", "sink_columns", "sink_pk").collect():
                schema = ensure_dimension(spark, root, row.sink_table, row.sink_columns)
                rows = dimension_rows(routed, row.sink_table, schema.names, row.sink_pk or "id")
                rows.write.mode("overwrite").parquet(version_folder(f"{root}/{row.sink_table}", batch_id))
        finally:
            routed.unpersist()
    return write


def read_dimension(spark: SparkSession, root: str, sink_table: str, schema: T.StructType, pk: str = "id") -> DataFrame:
    versioned = T.StructType(schema.fields + [T.StructField("_version", T.LongType())])
    return read_keyed(spark, f"{root}/{sink_table}", versioned, [pk], ["_version"]).drop("_version")


# --- summaries ----------------------------------------------------------------------------------
def sink_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The sink's columns in its order; helper columns are left out."""
    return df.select(*columns)


def jdbc_writer(columns: list[str], batch_size: int = 1000, **options: str) -> BatchWriter:
    """``foreachBatch`` function for a JDBC table.  ``options``: url, dbtable, driver, user, ...; take
    logins from configuration.  A replayed batch is written again, so the target should replace
    rows by window and key."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = sink_columns(batch, columns).write.format("jdbc").options(**options)
        writer.option("batchsize", batch_size).mode("append").save()
    return write


def summary_writer(path: str, columns: list[str]) -> BatchWriter:
    """``foreachBatch`` function for files: one folder per micro-batch, replay-safe."""
    def write(batch: DataFrame, batch_id: int) -> None:
        sink_columns(batch, columns).write.mode("overwrite").parquet(version_folder(path, batch_id))
    return write
