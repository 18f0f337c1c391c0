"""Keyed state on streams, for what built-in streaming operators cannot say.

Operators that need every row of a key in turn pack a row's columns into one JSON text, so the state processors
only handle a key, a time, a rank and that text.  The others (first of the day, held versions) take
many keys at a time: rows travel as Arrow tables, a table for a bucket of keys, and one call of the processor
does a bucket's keys of a micro-batch at once.  Spark partitions keys and buckets, keeps the state in RocksDB and
restores it from the checkpoint.  Where a stage follows another one, write the first one's result to a detail
table and read that as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _pack(df: DataFrame, keys: list[str], ts: str, **extra: Column) -> DataFrame:
    """Keys (as text), ``t`` in milliseconds, extra columns, and the row as JSON."""
    named = [F.col(k).cast("string").alias(f"key{i}") for i, k in enumerate(keys)]
    more = [column.alias(name) for name, column in extra.items()]
    time = [F.col(ts)]
    # A row without a time belongs to no day and follows no other row.
    return df.where(F.col(ts).isNotNull()).select(*named, *time, F.unix_millis(ts).alias("t"), *more,
                     F.to_json(F.struct(*df.columns), _JSON).alias("payload"))


def _unpack(packed: DataFrame, schema: T.StructType, *flags: str) -> DataFrame:
    return packed.select(F.from_json("payload", schema, _JSON).alias("r"), *flags).select("r.*", *flags)


def _key_schema(keys: list[str]) -> str:
    return ", ".join(f"key{i} string" for i in range(len(keys)))


def _key_columns(key: tuple) -> dict[str, object]:
    return {f"key{i}": value for i, value in enumerate(key)}


# --- first of day, first ever, returning ---------------------------------------------------------
class LastDay(StatefulProcessor):
    """Remembers the last day a key was seen and flags each row against it.

    A key's rows of a micro-batch come chunk by chunk.  Only the earliest row found so far of each day waits
    for the end; every other row leaves with its chunk, so memory holds a row per day, not per event."""

    NEVER = -(10**6)

    def __init__(self, away_days: int, ttl_ms: int | None, time: str | None = None, forget: bool = False,
                 only_first: bool = False):
        self.away_days = away_days
        self.ttl_ms = ttl_ms
        self.time = time  # event-time column to pass on, for a stateful operator that follows
        self.forget = forget  # drop a key's day when the watermark has passed its end
        self.only_first = only_first  # other rows are left out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last_day", "day int", self.ttl_ms)

    def _flagged(self, key, rows: pd.DataFrame, first, new, back) -> pd.DataFrame:
        return pd.DataFrame({
            **_key_columns(key),
            **({self.time: rows[self.time].array} if self.time else {}),
            "payload": rows["payload"].to_numpy(),
            "is_first": np.broadcast_to(first, len(rows)).astype("int64"),
            "is_new": np.broadcast_to(new, len(rows)).astype("int64"),
            "is_back": np.broadcast_to(back, len(rows)).astype("int64"),
        })

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.state.get()[0] if self.state.exists() else self.NEVER
        firsts = None  # the earliest row of each day after the last one
        for chunk in rows:
            old = chunk["day"].to_numpy() <= last
            # Of equal times the earlier arrival is the first, so the rows found before come before the chunk.
            fresh = chunk[~old] if firsts is None else pd.concat([firsts, chunk[~old]])
            fresh = fresh.sort_values("t", kind="stable", ignore_index=True)
            taken = fresh.duplicated("day").to_numpy()
            firsts = fresh[~taken]
            if not self.only_first:
                rest = pd.concat([chunk[old], fresh[taken]])
                if len(rest):
                    yield self._flagged(key, rest, 0, 0, 0)
        if len(firsts):
            firsts = firsts.sort_values("day", ignore_index=True)
            days = firsts["day"].to_numpy()
            before = np.concatenate([[last], days[:-1]])
            known = before != self.NEVER
            last = int(days[-1])
            self.state.update((last,))
            yield self._flagged(key, firsts, 1, ~known, known & (days - before >= self.away_days))
        if self.forget:
            self.handle.registerTimer((last + 2) * DAY_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists() and (self.state.get()[0] + 2) * DAY_MS <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter([])


def thin_days(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Before the shuffle, each batch of rows keeps the earliest row of each key and day (of equal times the
    first to come), so a hot key brings a row per batch to its task and not all its rows.  Rows without a time
    are left out, as they belong to no day.  The watermark stays on ``ts``."""
    day, columns = "_day_of_row", df.columns
    dated = df.where(F.col(ts).isNotNull()).withColumn(day, F.to_date(ts))

    def earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table({name: batch[name] for name in [*keys, day, ts]}).append_column(
                "_at", pa.array(np.arange(batch.num_rows)))
            order = table.sort_by([(ts, "ascending"), ("_at", "ascending")])
            first = order.group_by([*keys, day], use_threads=False).aggregate([("_at", "first")])
            yield batch.select(columns).take(pa.array(np.sort(first["_at_first"].to_numpy())))

    # The schema carries the watermark's delay with the column.
    return dated.mapInArrow(earliest, df.schema)


def flag_days(df: DataFrame, keys: list[str], ts: str = "ts", away_days: int = 8,
              ttl_ms: int | None = None) -> DataFrame:
    """Every row plus ``is_first`` (of its day), ``is_new`` (first ever) and ``is_back`` (first of the
    day after at least ``away_days``).  ``ttl_ms`` forgets silent keys; then only ``is_first`` is
    meaningful, and the query runs on processing time: it needs a running trigger, as one that
    stops when no data is left never sees time stand still."""
    packed = _pack(df, keys, ts, day=F.unix_date(F.to_date(ts))).drop(ts)
    out = packed.groupBy(*[f"key{i}" for i in range(len(keys))]).transformWithStateInPandas(
        LastDay(away_days, ttl_ms),
        f"{_key_schema(keys)}, payload string, is_first bigint, is_new bigint, is_back bigint",
        "append", "ProcessingTime" if ttl_ms else "None")
    return _unpack(out, df.schema, "is_first", "is_new", "is_back")


# --- buckets of keys ------------------------------------------------------------------------------
# Keys are dealt to buckets by their hash; part of the checkpoint, so it is not a setting of the session.
BUCKETS = 256
# Rows that a task packs at a time, and their bytes.
PACKED_ROWS, PACKED_BYTES = 200_000, 32 << 20
# Rows of one entry of a state list or of one packed result.
PART_ROWS = 20_000
_ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")


def _to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_ZSTD) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_bytes(blob: bytes) -> pa.Table:
    with pa.ipc.open_stream(blob) as stream:
        return stream.read_all()


def _parts(table: pa.Table) -> list[bytes]:
    return [_to_bytes(table.slice(at, PART_ROWS)) for at in range(0, table.num_rows, PART_ROWS)]


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Equal keys get equal numbers, in the order of their first rows."""
    return pc.dictionary_encode(column).combine_chunks().indices.to_numpy(zero_copy_only=False)


def _firsts_of_days(table: pa.Table) -> pa.Table:
    """The earliest row of each key and day (of equal times the first to come), by key and day."""
    code, day, at = _codes(table["_key"]), table["_day"].to_numpy(), table["_at"].to_numpy()
    order = np.lexsort((at, day, code))
    code, day = code[order], day[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (day[1:] != day[:-1])
    return table.take(pa.array(order[new]))


def _packed(df: DataFrame, keys: list[str], ts: str, thin: bool = False, **extra: Column) -> DataFrame:
    """(bucket, ts, rows): rows of a bucket of keys as an Arrow table, with ``_key`` (as text), ``_t`` in
    milliseconds, ``_at`` in microseconds and the extra columns.  ``thin`` keeps the earliest row of each key and day of those that a task packs at a
    time, so a hot key brings few rows to its task.  A row without a time is left out."""
    key = F.to_json(F.struct(*[F.col(k).cast("string").alias(f"key{i}") for i, k in enumerate(keys)]))
    rows = df.where(F.col(ts).isNotNull()).withColumns({
        "_key": key, "_t": F.unix_millis(ts), "_at": F.unix_micros(ts), **extra})
    return _dealt(rows, "_key", ts, thin)


def _dealt(rows: DataFrame, key: str, ts: str, thin: bool = False, needed: tuple[str, ...] = ()) -> DataFrame:
    """(bucket, ts, rows): rows dealt to buckets by ``key``, those of a bucket as Arrow tables.  Rows without one of the
    ``needed`` columns are left out here, as a filter before it would have Spark parse their texts again."""
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))

    def blocks(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        if thin:
            table = _firsts_of_days(table)
        bucket = table["_bucket"].to_numpy()
        order = np.argsort(bucket, kind="stable")
        table, bucket = table.take(pa.array(order)).combine_chunks(), bucket[order]
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        at = table[ts].cast(pa.int64()).to_numpy()
        table = table.drop_columns(["_bucket"])
        ends = [*starts[1:], len(bucket)]
        return pa.record_batch({
            "bucket": pa.array(bucket[starts], pa.int32()),
            # The last time, so that rows in time are not dropped with late ones.
            ts: pa.array(np.maximum.reduceat(at, starts), pa.int64()).cast(pa.timestamp("us", "UTC")),
            "rows": pa.array([_to_bytes(table.slice(a, b - a)) for a, b in zip(starts, ends)], pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            for name in needed:
                batch = batch.filter(batch[name].is_valid())
            if batch.num_rows:
                held.append(batch)
                rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= PACKED_ROWS or size >= PACKED_BYTES:
                yield blocks(held)
                held, rows, size = [], 0, 0
        if held:
            yield blocks(held)

    # The schema carries the watermark's delay with the time.
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), rows.schema[ts], T.StructField("rows", T.BinaryType())])
    return rows.mapInArrow(pack, schema)


def _unpacked(packed: DataFrame, schema: T.StructType) -> DataFrame:
    names = schema.names

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["rows"]:
                yield from _from_bytes(blob.as_py()).select(names).to_batches(max_chunksize=10_000)

    return packed.mapInArrow(unpack, schema)


def _tables(rows: Iterator[pd.DataFrame]) -> Iterator[pa.Table]:
    for chunk in rows:
        for blob in chunk["rows"]:
            yield _from_bytes(blob)


def _listed(state) -> list[pa.Table]:
    return [_from_bytes(bytes(entry[0])) for entry in state.get()] if state.exists() else []


def _store(state, table: pa.Table) -> None:
    if table.num_rows:
        state.put([(blob,) for blob in _parts(table)])
    elif state.exists():
        state.clear()


class FirstDays(StatefulProcessor):
    """``LastDay`` for a bucket of keys, first rows only: remembers each key's last day."""

    # Rows that wait for the earlier ones of their days.
    WAITING = 500_000

    def __init__(self, away_days: int, time: str | None = None, forget: bool = False):
        self.away_days = away_days
        self.time = time  # event-time column to pass on, for a stateful operator that follows
        self.forget = forget  # drop a key's day when the watermark has passed its end

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getListState("last_days", "rows binary")

    def _keep(self, last: pa.Table, passed: int) -> None:
        if self.forget:
            last = last.filter(pa.array((last["_day"].to_numpy().astype("int64") + 2) * DAY_MS > passed))
        _store(self.state, last)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, count = [], 0
        for table in _tables(rows):
            held, count = [*held, table], count + table.num_rows
            if count >= self.WAITING:
                held = [_firsts_of_days(pa.concat_tables(held))]
                count = 0
        firsts = _firsts_of_days(pa.concat_tables(held))
        # A stage that follows has a watermark too, and takes no older rows.
        mark = timerValues.getCurrentWatermarkInMs() if self.time else None
        if mark is not None:
            firsts = firsts.filter(pa.array(firsts["_t"].to_numpy() >= mark))
        if not firsts.num_rows:
            return
        last = _listed(self.state)
        known = np.full(firsts.num_rows, LastDay.NEVER, dtype="int64")
        if last:
            last = pa.concat_tables(last)
            found = pc.fill_null(pc.index_in(firsts["_key"], last["_key"].combine_chunks()), -1).to_numpy()
            known = np.where(found >= 0, last["_day"].to_numpy().astype("int64")[found], known)
        day = firsts["_day"].to_numpy().astype("int64")
        fresh = day > known
        firsts, day, known = firsts.filter(pa.array(fresh)), day[fresh], known[fresh]
        if not firsts.num_rows:
            return
        # By key and day: the day before is that of the row before, or the remembered one.
        code = _codes(firsts["_key"])
        opens = np.diff(code, prepend=-1) != 0
        before = np.where(opens, known, np.roll(day, 1))
        seen = before != LastDay.NEVER
        closes = np.append(opens[1:], True)
        latest = firsts.select(["_key", "_day"]).filter(pa.array(closes))
        if last:
            others = pc.invert(pc.is_in(last["_key"], latest["_key"].combine_chunks()))
            latest = pa.concat_tables([last.filter(others), latest])
        self._keep(latest, -(10**18) if mark is None else mark)
        if self.forget:
            self.handle.registerTimer((int(day.max()) + 2) * DAY_MS)
        out = firsts.append_column("is_first", pa.array(np.ones(len(day), "int64"))).append_column(
            "is_new", pa.array((~seen).astype("int64"))).append_column(
            "is_back", pa.array((seen & (day - before >= self.away_days)).astype("int64")))
        for at in range(0, out.num_rows, PART_ROWS):
            part = out.slice(at, PART_ROWS)
            earliest = pd.Timestamp(pc.min(part["_at"]).as_py(), unit="us", tz="UTC")
            yield pd.DataFrame({**({self.time: [earliest]} if self.time else {}), "rows": [_to_bytes(part)]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = _listed(self.state)
        if last:
            self._keep(pa.concat_tables(last), expiredTimerInfo.getExpiryTimeInMs())
        return iter([])


def _flags(df: DataFrame, columns: list[str], *flags: str) -> T.StructType:
    return T.StructType([df.schema[c] for c in columns] + [T.StructField(f, T.LongType()) for f in flags])


def first_of_day(df: DataFrame, keys: list[str], ts: str = "ts", away_days: int = 8,
                 forget: bool = False) -> DataFrame:
    """The first row of each key and day, plus ``is_new`` and ``is_back``.

    ``ts`` stays the stream's event time, so a window aggregate can follow in the same query.  With
    ``forget`` a key is dropped when the watermark passes the day after its last one, which is the end of
    that day in any time zone; ``is_new`` and
    ``is_back`` are then of no use.
    """
    packed = _packed(df, keys, ts, thin=True, _day=F.unix_date(F.to_date(ts)))
    out = packed.groupBy("bucket").transformWithStateInPandas(
        FirstDays(away_days, ts, forget), f"{ts} timestamp, rows binary", "append", "EventTime", eventTimeColumnName=ts)
    schema = _flags(df, [ts, *[c for c in df.columns if c != ts]], "is_new", "is_back")
    schema.fields[0] = out.schema[ts]
    return _unpacked(out, schema)


def returning_users(df: DataFrame, user: str, ts: str = "ts", away_days: int = 8) -> DataFrame:
    """(user, ts, uv_count, back_count), one row per user and day."""
    rows = df.where(F.col(user).isNotNull()).select(user, ts)
    packed = _packed(rows, [user], ts, thin=True, _day=F.unix_date(F.to_date(ts))).drop(ts)
    out = packed.groupBy("bucket").transformWithStateInPandas(FirstDays(away_days), "rows binary", "append", "None")
    return _unpacked(out, _flags(rows, [user, ts], "is_first", "is_back")).select(
        user, ts, F.col("is_first").alias("uv_count"), F.col("is_back").alias("back_count"))


# --- new-visitor repair --------------------------------------------------------------------------
class FirstDate(StatefulProcessor):
    """Remembers a visitor's first day and marks claims to be new on any other day.

    In the micro-batch that brings a visitor, the first row is known when all chunks were seen.  Rows without
    a claim leave at once; those with one wait in the state store, chunk by chunk, and not in memory."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("first_day", "day int")
        self.waiting = handle.getMapState("waiting", "chunk int", "days array<int>, payloads array<string>")

    def _marked(self, key, payloads, wrong) -> pd.DataFrame:
        return pd.DataFrame({**_key_columns(key), "payload": payloads,
                             "wrong": np.broadcast_to(wrong, len(payloads)).astype("int64")})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = self.state.get()[0] if self.state.exists() else None
        earliest, held = None, 0
        for chunk in rows:
            days, claims = chunk["day"].to_numpy(), chunk["claims"].to_numpy() == 1
            payloads = chunk["payload"].to_numpy()
            if first is not None:
                yield self._marked(key, payloads, claims & (days != first))
                continue
            at = np.lexsort((claims, chunk["t"].to_numpy()))[0]
            found = (int(chunk["t"].iloc[at]), bool(claims[at]), int(days[at]))
            earliest = found if earliest is None else min(earliest, found)
            if not claims.all():
                yield self._marked(key, payloads[~claims], 0)
            if claims.any():
                self.waiting.updateValue((held,), (days[claims].tolist(), payloads[claims].tolist()))
                held += 1
        if first is None:
            _, claims_first, day = earliest
            first = day if claims_first else day - 1
            self.state.update((first,))
        for chunk in range(held):
            days, payloads = self.waiting.getValue((chunk,))
            self.waiting.removeKey((chunk,))
            yield self._marked(key, np.array(payloads, dtype=object), np.array(days) != first)


def repair_new_visitor(df: DataFrame, visitor: str = "mid", flag: str = "is_new", ts: str = "ts") -> DataFrame:
    """Clear a new-visitor flag on any date but the visitor's first.  Rows without a time stay as they are."""
    df, untimed = df.where(F.col(ts).isNotNull()), df.where(F.col(ts).isNull())
    claims = F.when(F.col(flag) == "1", 1).otherwise(0)
    packed = _pack(df, [visitor], ts, day=F.unix_date(F.to_date(ts)), claims=claims).drop(ts)
    out = packed.groupBy("key0").transformWithStateInPandas(
        FirstDate(), "key0 string, payload string, wrong bigint", "append", "None")
    fixed = _unpack(out, df.schema, "wrong")
    return fixed.withColumn(flag, F.when(F.col("wrong") == 1, F.lit("0")).otherwise(F.col(flag))).drop("wrong").unionByName(untimed)


# --- hold a key's best row -----------------------------------------------------------------------
class HoldBest(StatefulProcessor):
    """Keeps the best row of a key, emits it once after a hold of wall-clock time, and forgets the key later."""

    def __init__(self, newest: bool, hold_ms: int, keep_ms: int):
        self.newest, self.hold_ms, self.keep_ms = newest, hold_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("best", "rank bigint, payload string, emitted boolean, until bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        best = None if held is None else (held[0], held[1])
        until = held[3] if held else timerValues.getCurrentProcessingTimeInMs() + self.hold_ms
        for chunk in rows:
            rank = chunk["rank"].to_numpy()
            # Of equal versions the later arrival wins; of equal first rows the earlier one stays.
            at = len(rank) - 1 - int(np.argmax(rank[::-1])) if self.newest else int(np.argmin(rank))
            found = (int(rank[at]), str(chunk["payload"].iloc[at]))
            better = best is None or (found[0] >= best[0] if self.newest else found[0] < best[0])
            best = found if better else best
        if held is None:
            self.handle.registerTimer(until)
        if held is None or not held[2]:
            self.state.update((best[0], best[1], False, until))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        if held is None:
            return
        rank, payload, emitted, until = held
        if emitted:
            self.state.clear()
            return
        self.state.update((rank, "", True, until))
        self.handle.registerTimer(expiredTimerInfo.getExpiryTimeInMs() + self.keep_ms)
        yield pd.DataFrame({**_key_columns(key), "payload": [payload]})


class HoldBests(StatefulProcessor):
    """``HoldBest`` by event time for a bucket of keys.

    Rows of a micro-batch are looked at together, as the hold of a new key starts at its earliest one; then one
    row a key waits.  ``held`` is rewritten with each micro-batch, and holds what the watermark has not passed;
    keys that are done are added to a list of parts, which is rewritten when it has many."""

    PARTS = 32

    def __init__(self, newest: bool, hold_ms: int, keep_ms: int):
        self.newest, self.hold_ms, self.keep_ms = newest, hold_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "rows binary")
        self.done = handle.getListState("done", "rows binary")

    def _best(self, table: pa.Table, before: int) -> pa.Table:
        """The best row of each key; the first ``before`` rows were held, with the end of their hold."""
        code, t = _codes(table["_key"]), table["_t"].to_numpy()
        until = np.full(int(code.max()) + 1, np.iinfo("int64").max)
        np.minimum.at(until, code[before:], t[before:] + self.hold_ms)
        until[code[:before]] = table["_until"].to_numpy()[:before]
        rank, place = table["_rank"].to_numpy(), np.arange(len(code))
        # Of equal versions the later arrival wins; of equal first rows the earlier one stays.
        order = np.lexsort((-place, -rank, code) if self.newest else (place, rank, code))
        order = order[t[order] <= until[code[order]]]
        first = order[np.diff(code[order], prepend=-1) != 0]
        best = table.take(pa.array(first))
        return best.set_column(best.column_names.index("_until"), "_until", pa.array(until[code[first]]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tables, held = list(_tables(rows)), _listed(self.held)
        new = pa.concat_tables(tables)
        for part in _listed(self.done):
            new = new.filter(pc.invert(pc.is_in(new["_key"], part["_key"].combine_chunks())))
        if new.num_rows:
            new = new.append_column("_until", pa.array(np.zeros(new.num_rows, "int64")))
            before = sum(t.num_rows for t in held)
            best = self._best(pa.concat_tables([*held, new.select(held[0].column_names) if held else new]), before)
            _store(self.held, best)
            self.handle.registerTimer(pc.min(best["_until"]).as_py())
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held, done = _listed(self.held), _listed(self.done)
        past = [pc.max(part["_forget"]).as_py() <= now for part in done]
        if any(past) or len(done) > self.PARTS:
            kept = pa.concat_tables(done)
            _store(self.done, kept.filter(pc.greater(kept["_forget"], now)))
        if not held:
            return
        held = pa.concat_tables(held)
        due = held["_until"].to_numpy() <= now
        if not due.any():
            return
        out, rest = held.filter(pa.array(due)), held.filter(pa.array(~due))
        _store(self.held, rest)
        if rest.num_rows:
            self.handle.registerTimer(pc.min(rest["_until"]).as_py())
        for at in range(0, out.num_rows, PART_ROWS):
            part = out.slice(at, PART_ROWS)
            forget = pc.add(part["_until"], self.keep_ms)
            self.done.appendValue((_to_bytes(part.select(["_key"]).append_column("_forget", forget)),))
            self.handle.registerTimer(max(pc.max(forget).as_py(), now + 1))
            yield pd.DataFrame({"rows": [_to_bytes(part)]})


def _hold(df: DataFrame, keys: list[str], ts: str, rank: Column, newest: bool, hold_ms: int, keep_ms: int,
          event_time: bool) -> DataFrame:
    if event_time:
        out = _packed(df, keys, ts, _rank=rank).groupBy("bucket").transformWithStateInPandas(
            HoldBests(newest, hold_ms, keep_ms), "rows binary", "append", "EventTime")
        return _unpacked(out, df.schema)
    packed = _pack(df, keys, ts, rank=rank)
    out = packed.groupBy(*[f"key{i}" for i in range(len(keys))]).transformWithStateInPandas(
        HoldBest(newest, hold_ms, keep_ms), f"{_key_schema(keys)}, payload string", "append", "ProcessingTime")
    return _unpack(out, df.schema)


def hold_latest(df: DataFrame, keys: list[str], version: str, ts: str = "ts", hold_ms: int = 5_000,
                keep_ms: int = 60_000, event_time: bool = False) -> DataFrame:
    """The newest version that arrives within ``hold_ms`` of a key's first row.

    By default the hold is wall-clock time, which needs a running trigger.  With ``event_time`` it counts the
    rows' own times and ends when the watermark passes; later versions are lost for ``keep_ms``.  Rows leave
    when the watermark has passed them, so a stage that follows in event time reads them from a detail table,
    with a watermark delay longer by ``hold_ms``.
    """
    return _hold(df, keys, ts, F.unix_micros(version), True, hold_ms, keep_ms, event_time)


def first_login(df: DataFrame, session: str, user: str, ts: str = "ts", hold_ms: int = 10_000,
                keep_ms: int = DAY_MS) -> DataFrame:
    """The earliest logged-in row of each session, ``hold_ms`` of event time after its first row."""
    return _hold(df.where(F.col(user).isNotNull()), [session], ts, F.unix_millis(ts), False, hold_ms, keep_ms, True)


# --- bounces -------------------------------------------------------------------------------------
class Bounces(StatefulProcessor):
    """Holds a visitor's rows until the watermark settles what followed each session start.

    A visitor has one state row and one timer.  Of the time that the watermark has passed, the row holds at
    most one start, the one that still waits; of the time beyond it, where rows may yet come in between, it
    holds the times, and the whole row only of a start."""

    def __init__(self, within_ms: int):
        self.within_ms = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("pending", "t array<bigint>, start array<int>, payload array<string>, "
                                          "timer bigint")

    def _keep(self, t: np.ndarray, start: np.ndarray, payload: np.ndarray, timer: int, before: int | None) -> None:
        """``start`` is a row's place in ``payload``, or -1.  The timer moves when another time is due first."""
        if before is not None and before != timer:
            self.handle.deleteTimer(before)
        if before != timer:
            self.handle.registerTimer(timer)
        self.state.update((t.tolist(), start.tolist(), payload.tolist(), timer))

    def _held(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int | None]:
        if not self.state.exists():
            return np.array([], "int64"), np.array([], "int64"), np.array([], object), None
        t, start, payload, timer = self.state.get()
        return np.array(t, "int64"), np.array(start, "int64"), np.array(payload, object), timer

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        t, start, payload, timer = self._held()
        times, places, payloads, found = [t], [start], [payload], len(payload)
        for chunk in rows:
            starts = chunk["starts"].to_numpy().astype(bool)
            times.append(chunk["t"].to_numpy())
            places.append(np.where(starts, found + np.cumsum(starts) - 1, -1))
            payloads.append(chunk["payload"].to_numpy()[starts])
            found += int(starts.sum())
        t = np.concatenate(times)
        order = np.argsort(t, kind="stable")
        t, start, payload = t[order], np.concatenate(places)[order], np.concatenate(payloads)
        due = int(t[0]) + self.within_ms
        self._keep(t, start, payload, due if timer is None else min(timer, due), timer)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        t, start, payload, timer = self._held()
        complete = timerValues.getCurrentWatermarkInMs()
        passed = int(np.searchsorted(t, complete, side="right"))
        last = max(passed - 1, 0)  # the last row that no other can come before
        # A start is settled by the row after it, if none can come between, or by the time that went by.
        at = np.flatnonzero(start[:last] >= 0)
        alone = (start[at + 1] >= 0) | (t[at + 1] - t[at] >= self.within_ms)
        left = list(payload[start[at[alone]]])
        settled = last
        if passed:
            waits = start[last] >= 0 and t[last] + self.within_ms > complete
            if start[last] >= 0 and not waits:
                left.append(payload[start[last]])
            settled = last if waits else passed
        t, start = t[settled:], start[settled:]
        if len(t):
            kept = np.flatnonzero(start >= 0)
            payload = payload[start[kept]]
            start = start.copy()
            start[kept] = np.arange(len(kept))
            self._keep(t, start, payload, max(int(t[0]) + self.within_ms, complete + 1), None)
        else:
            self.state.clear()
        if left:
            yield pd.DataFrame({**_key_columns(key), "payload": left})


class BouncesOfBuckets(StatefulProcessor):
    """``Bounces`` for a bucket of visitors.

    A micro-batch only adds its rows; when the watermark has passed some, all visitors' rows are looked at
    together, and those that still wait are kept.  Rows that are no starts come without their columns."""

    def __init__(self, within_ms: int):
        self.within_ms = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "rows binary")
        self.settled = handle.getValueState("settled", "until bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pa.concat_tables(list(_tables(rows)))
        if self.settled.exists():
            # What lies behind the settled time is late, though its block was not.
            new = new.filter(pc.greater(new["_t"], self.settled.get()[0]))
        if new.num_rows:
            for blob in _parts(new):
                self.held.appendValue((blob,))
            self.handle.registerTimer(pc.min(new["_t"]).as_py() + self.within_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = _listed(self.held)
        if not held:
            return
        table, complete = pa.concat_tables(held), timerValues.getCurrentWatermarkInMs()
        code, t = _codes(table["_key"]), table["_t"].to_numpy()
        order = np.lexsort((np.arange(len(t)), t, code))
        code, t, start = code[order], t[order], table["_start"].to_numpy()[order]
        passed = t <= complete
        # A start is settled by the visitor's next row, if none can come between, or by the time that went by.
        followed = passed & np.append((code[1:] == code[:-1]) & passed[1:], False)
        apart = np.append(start[1:] | (t[1:] - t[:-1] >= self.within_ms), False)
        waits = passed & ~followed & start & (t + self.within_ms > complete)
        left = order[start & np.where(followed, apart, passed & ~waits)]
        rest = table.take(pa.array(order[~passed | waits]))
        _store(self.held, rest)
        self.settled.update((complete,))
        if rest.num_rows:
            self.handle.registerTimer(max(pc.min(rest["_t"]).as_py() + self.within_ms, complete + 1))
        for at in range(0, len(left), PART_ROWS):
            yield pd.DataFrame({"rows": [_to_bytes(table.take(pa.array(left[at:at + PART_ROWS])))]})


def bounces(df: DataFrame, visitor: str, is_start: Column, within_seconds: int = 10, ts: str = "ts") -> DataFrame:
    """Session starts that bounced, once the watermark has passed them."""
    marked = df.withColumns({"_visitor": F.col(visitor), "_start": F.coalesce(is_start, F.lit(False))})
    slim = marked.select("_visitor", "_start", *[
        F.col(c) if c == ts else F.when(F.col("_start"), F.col(c)).alias(c) for c in df.columns])
    out = _packed(slim, ["_visitor"], ts).groupBy("bucket").transformWithStateInPandas(
        BouncesOfBuckets(within_seconds * 1000), "rows binary", "append", "EventTime")
    return _unpacked(out, df.schema)
