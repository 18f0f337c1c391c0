"""Session settings, and the one place that decides where durable scratch data goes."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Runtime settings every job relies on.  All of them can be changed on a live session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sizes seen at run time are compressed; a broadcast table is built whole on the driver.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "4m",
    # The same before the run, where sizes are those of compressed files.
    "spark.sql.autoBroadcastJoinThreshold": "4m",
    # Skip the sorts of a sort-merge join when every partition of one side is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Rows that go to a Python worker at a time; texts may be long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # transformWithState needs the RocksDB provider; its state lives on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Micro-batches are large and few: a store is closed after each, so that an executor holds those of its running
    # tasks and not of all partitions, in memory and on its disk.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    # What was dropped or rewritten leaves the files, and versions that no restart needs leave the checkpoint.
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.ratioExtraSpaceAllowedInCheckpoint": "0",
}

# Partitions of a batch shuffle for each core, and the size to which Spark joins them again at run time: a task's memory
# follows that size, where a small number of partitions would have it grow with the input.
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITION_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PER_CORE, SIZE = 32, "16m"
SIZED: dict[str, str] = {}

SHIPPED: dict[str, str] = {}


def build_session(app: str = "lyceum", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; ``conf`` keys use ``__`` for dots (``spark__driver__memory="8g"``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created, and send it the package."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if "spark.sql.shuffle.partitions" not in spark.conf.getAll:
        # Nobody has chosen a number: two tasks for each core that there is.
        spark.conf.set("spark.sql.shuffle.partitions", str(2 * spark.sparkContext.defaultParallelism))
    for key, value in SIZED.items():
        if spark.conf.get(key, None) == value:
            spark.conf.unset(key)
    SIZED.clear()
    ship(spark)
    return spark


def sized(spark: SparkSession) -> SparkSession:
    """Has batch shuffles start with many partitions, unless the session chose their number or size, until ``prepare`` is
    called again.  Streams keep theirs, which their state depends on."""
    first = max(int(spark.conf.get("spark.sql.shuffle.partitions")), PER_CORE * spark.sparkContext.defaultParallelism)
    for key, value in {FIRST_PARTITIONS: str(first), PARTITION_SIZE: SIZE}.items():
        if key not in spark.conf.getAll:
            spark.conf.set(key, value)
            SIZED[key] = value
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their Python workers import it, wherever
    the driver was started."""
    context = spark.sparkContext
    if SHIPPED.get("application") == context.applicationId:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="lyceum-package-")  # on the driver, which serves the file itself
    path = os.path.join(folder, "lyceum.zip")
    with zipfile.ZipFile(path, "w") as out:
        for top, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.join("lyceum", os.path.relpath(full, root)))
    context.addPyFile(path)
    # The driver's own workers, which start streams with keyed state, take no added files.
    paths = [path, context.environment.get("PYTHONPATH", "")]
    context.environment["PYTHONPATH"] = os.pathsep.join(p for p in paths if p)
    SHIPPED["application"] = context.applicationId


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for stream checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a folder in the warehouse is
    taken, which the executors share as well."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        # Only named here: a live session takes no such setting any more.
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
