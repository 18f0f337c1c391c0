"""Run streaming stages: each reads a stream, transforms it and writes a detail table or topic."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lyceum.functions.times import from_epoch_millis
from lyceum.operators import routing
from lyceum.operators.windows import watermark
from lyceum.plans.logs import BOUNCE_SECONDS, login_rows
from lyceum.session import scratch_path
from lyceum.sources.sinks import CODEC, BatchWriter, drop, keyed_writer, read_keyed, run_available, to_files, version_folder
from lyceum.streaming import state


def materialise(stream: DataFrame, name: str, partition_by: list[str] = ()) -> DataFrame:
    """Process all data present into a table in the shared folder and read it back."""
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    run_available(to_files(stream, path, checkpoint, partition_by))
    return spark.read.schema(stream.schema).parquet(path)


def replay(spark: SparkSession, pieces: Iterable[DataFrame], build: Callable[[DataFrame], DataFrame], name: str,
           partition_by: list[str] = ()) -> DataFrame:
    """Feed a stream piece by piece: each is added to the input folder and processed by a run of its own,
    which goes on from the checkpoint of the last; then its files are deleted.  Returns the table that
    ``build(input)`` wrote."""
    feed, path, checkpoint = (scratch_path(spark, f"{name}-{part}") for part in ("feed", "out", "checkpoint"))
    schema = None
    for piece in pieces:
        piece.write.mode("append").parquet(feed, compression=CODEC)
        stream = build(spark.readStream.schema(piece.schema).parquet(feed))
        run_available(to_files(stream, path, checkpoint, partition_by))
        schema = stream.schema
        done_with(spark, feed)
    return spark.read.schema(schema).parquet(path)


def replay_feeds(spark: SparkSession, pieces: Iterable[dict[str, DataFrame]], run: Callable[[dict[str, DataFrame]], None],
                 name: str) -> None:
    """Feed several streams piece by piece.  Each piece holds rows by feed; they are added to the feeds'
    folders, and ``run(streams)`` processes what is there, from checkpoints of its own; then they are deleted."""
    folder = scratch_path(spark, f"{name}-feeds")
    for piece in pieces:
        for feed, rows in piece.items():
            rows.write.mode("append").parquet(f"{folder}/{feed}", compression=CODEC)
        run({feed: spark.readStream.schema(rows.schema).parquet(f"{folder}/{feed}") for feed, rows in piece.items()})
        done_with(spark, folder)


def done_with(spark: SparkSession, feed: str) -> None:
    """Delete a piece that was processed.  Its shuffle files go when the driver's JVM finds that nothing refers to
    them any more; it is asked to look, as another piece is to come."""
    drop(spark, feed)
    spark._jvm.System.gc()


class KeyedTable:
    """A keyed table that a stream fills, run after run, from one checkpoint."""

    def __init__(self, spark: SparkSession, name: str, keys: list[str], order: list[str]):
        self.spark, self.keys, self.order, self.schema = spark, keys, order, None
        self.path, self.checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")

    def fill(self, stream: DataFrame) -> None:
        self.schema = stream.schema
        for_each_batch(stream, keyed_writer(self.path, self.keys, self.order), self.checkpoint)

    def read(self, deleted: str | None = None) -> DataFrame:
        return read_keyed(self.spark, self.path, self.schema, self.keys, self.order, deleted)


def append(stream: DataFrame, path: str) -> DataFrame:
    """Process all data present into the table at ``path``, from the checkpoint beside it, and give the table
    as a stream for the next stage."""
    run_available(to_files(stream, path, f"{path}-checkpoint"))
    return table_as_stream(stream.sparkSession, path, stream)


class LateRows:
    """Splits a stream into rows in time and rows behind the watermark, each a table of its own.

    The watermark of a micro-batch is the latest event time of all batches before it, less ``delay``; a row
    without a time is late.  One number per batch is kept beside the tables.  A replayed batch reads the
    numbers of earlier batches only and overwrites its own folders, so the split does not change."""

    def __init__(self, spark: SparkSession, name: str, ts: str, delay: str):
        self.spark, self.ts, self.delay, self.schema = spark, ts, delay, None
        self.root = scratch_path(spark, name)
        self.marks = f"{self.root}/marks"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        before = self.spark.read.schema("latest timestamp, batch_id bigint").parquet(self.marks)
        passed = before.where(F.col("batch_id") < batch_id).agg(
            (F.max("latest") - F.expr(f"INTERVAL {self.delay}")).alias("mark")).first()["mark"]
        late = F.col(self.ts).isNull() | (F.lit(False) if passed is None else F.col(self.ts) < F.lit(passed))
        for folder, rows in (("in_time", batch.where(~late)), ("late", batch.where(late))):
            rows.write.mode("overwrite").parquet(version_folder(f"{self.root}/{folder}", batch_id))
        batch.agg(F.max(self.ts).alias("latest")).write.mode("overwrite").parquet(version_folder(self.marks, batch_id))

    def split(self, stream: DataFrame) -> None:
        self.schema = stream.schema
        self.spark.createDataFrame([], "latest timestamp").write.mode("ignore").parquet(version_folder(self.marks, -1))
        for_each_batch(stream, self.write, f"{self.root}/checkpoint")

    def in_time(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/in_time")

    def late(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/late")

    def in_time_stream(self) -> DataFrame:
        """The rows in time as a stream, for windows with the same delay, which then drop none."""
        return self.spark.readStream.schema(self.schema).parquet(f"{self.root}/in_time")


def for_each_batch(stream: DataFrame, write: BatchWriter, checkpoint: str) -> StreamingQuery:
    """Process all data present with a ``foreachBatch`` function."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_available(writer)


# --- behaviour-log stages --------------------------------------------------------------------------
def repaired_logs(logs: DataFrame) -> DataFrame:
    """Streaming form of the new-visitor repair."""
    flat = logs.withColumn("_mid", F.col("common.mid")).withColumn("_new", F.col("common.is_new")) \
        .withColumn("_time", from_epoch_millis("ts"))
    fixed = state.repair_new_visitor(flat, "_mid", "_new", "_time")
    return fixed.withColumn("common", F.col("common").withField("is_new", F.col("_new"))).select(*logs.columns)


def base_log_records(logs: DataFrame) -> DataFrame:
    """(topic, value) rows of the six logs: one query feeds all outputs."""
    return routing.as_topic_records(repaired_logs(logs))


def user_jump_detail(pages: DataFrame, within_seconds: int = BOUNCE_SECONDS) -> DataFrame:
    rows = pages.withColumn("_mid", F.col("common.mid")).withColumn("_time", from_epoch_millis("ts"))
    rows = watermark(rows, "_time", "0 seconds")
    left = state.bounces(rows, "_mid", F.col("page.last_page_id").isNull(), within_seconds, "_time")
    return left.select(*pages.columns)


def user_login(pages: DataFrame, keep_ms: int = state.DAY_MS) -> DataFrame:
    """The first login of each session; a session is forgotten ``keep_ms`` after it."""
    rows = pages.withColumn("_sid", F.col("common.sid")).withColumn("_uid", F.col("common.uid"))
    rows = watermark(rows.withColumn("_time", from_epoch_millis("ts")), "_time")
    return login_rows(state.first_login(rows, "_sid", "_uid", "_time", keep_ms=keep_ms))


def table_as_stream(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The next stage's input: a detail table written by the stage before."""
    return spark.readStream.schema(like.schema).parquet(path)
