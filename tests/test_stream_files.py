"""What replayed streams leave on disk, and what their stores hold."""

import glob
import random

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_buckets import DAY, At
from test_stream_joins import Handle, blobs

from lyceum.operators.windows import watermark
from lyceum.session import RUNTIME
from lyceum.streaming import jobs, joins, state


def held_pieces(frame, pieces):
    rows = frame([(f"k{i % 50}", i, i * 100) for i in range(600)], "id string, version int, s int").withColumn("ts", F.timestamp_seconds("s"))
    return [rows.where(F.floor(F.col("version") * pieces / 600) == k) for k in range(pieces)]


def test_old_versions_of_state_leave_the_checkpoint(spark, frame, tmp_path):
    out, made = str(tmp_path / "held"), []

    def run(feed):
        held = state.hold_latest(watermark(feed["rows"], "ts"), ["id"], "ts", "ts", 5_000, DAY, event_time=True)
        made.append(jobs.append(held, out))

    jobs.replay_feeds(spark, [{"rows": p} for p in held_pieces(frame, 5)], run, "held")
    stores = glob.glob(f"{out}-checkpoint/state/0/[0-9]*")
    versions = [len(glob.glob(f"{s}/*.zip")) for s in stores]
    assert versions and max(versions) <= 3
    assert spark.read.parquet(out).count() == 50
    # A store is closed after its micro-batch.
    assert RUNTIME["spark.sql.streaming.stateStore.unloadOnCommit"] == "true"


def test_feeds_are_deleted_and_tables_are_small(spark, frame):
    root, seen = spark.conf.get("spark.checkpoint.dir").removeprefix("file://"), []
    rows = held_pieces(frame, 4)
    table = jobs.KeyedTable(spark, "kept-table", ["id"], ["version"])

    def run(feed):
        table.fill(feed["rows"])
        seen.append(len(glob.glob(f"{root}/short-lived-feeds-*/rows/*.parquet")))

    jobs.replay_feeds(spark, [{"rows": p.coalesce(1)} for p in rows], run, "short-lived")
    assert seen == [1, 1, 1, 1] and not glob.glob(f"{root}/short-lived-feeds-*")
    assert table.read().count() == 50
    files = glob.glob(f"{table.path.removeprefix('file://')}/batch_id=*/*.parquet")
    assert len(files) >= 4 and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)
    out = jobs.replay(spark, rows, lambda feed: feed.select("id"), "short-replay")
    assert out.count() == 600 and not glob.glob(f"{root}/short-replay-feed-*")


def test_a_join_keeps_and_gives_small_parts():
    rnd, handle = random.Random(5), Handle()
    processor = joins.WithinJoin(("k", "rk"), ("lt", "rt"), DAY, (DAY, DAY))
    processor.init(handle)
    left = [{"k": "a", "lt": rnd.randrange(3 * DAY) * 1000, "n": i} for i in range(50_000)]
    chunk = pd.DataFrame(blobs([{"rk": "a", "rt": DAY * 1000, "v": 1}], 1), columns=["side", "rows"])
    types = pa.schema([("k", pa.string()), ("lt", pa.timestamp("us", "UTC")), ("n", pa.int64())])
    whole = pd.DataFrame([(0, state._to_bytes(pa.Table.from_pylist(left, types)))], columns=["side", "rows"])
    out = [state._from_bytes(b) for f in processor.handleInputRows((0,), iter([whole, chunk]), At(0)) for b in f["rows"]]
    kept = [state._from_bytes(bytes(v[0])) for (side, _, _), v in handle.kept.entries.items() if side == 0]
    assert sum(t.num_rows for t in kept) == 50_000
    assert sum(t.num_rows for t in out) == sum(r["lt"] <= 2 * DAY * 1000 for r in left) > 30_000
    assert max(t.num_rows for t in out + kept) <= 20_000


def test_blobs_of_text_are_packed_close():
    rnd = random.Random(6)
    table = pa.table({"id": [f"{rnd.randrange(10**7)}-{i % 7}" for i in range(5000)], "t": [rnd.randrange(10**6) for _ in range(5000)]})
    blob = state._to_bytes(table)
    assert state._from_bytes(blob).equals(table) and len(blob) < 13 * 5000
