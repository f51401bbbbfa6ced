"""Exponentially weighted mean kept up between batches (C129).

Rows are packed into chunks where they are read: a key's rows of many Arrow batches, in order, behind a few numbers that tell the
chunk's effect on any state (see ``decay``). The stateful step chains the chunks of a key by these numbers, without looking into
them, and puts the state that each starts from in their place; only where a key has several chunks are they opened, and merged if
they overlap in order. The means of the rows are worked out afterwards, by all tasks, for many chunks at once. So a key that
holds most of a batch costs its one task a line per chunk, and a key of few rows costs no array work of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sensorlake.operators.decay import Decay, State, numbers_of

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# The numbers of a key, and by which time they go out of use: that of its newest row, or of its last batch.
STATE = ", ".join(f"{f} double" for f in (*State.FIELDS, "seen"))
LINE, START = 8 * len(Decay.SUMMARY), 8 * len(State.FIELDS)
# Rows and bytes that a task packs or opens at a time.
CUT_ROWS, CUT_BYTES = 100_000, 32 << 20


def _sorted(table: pa.Table, columns: Sequence[str]) -> pa.Table:
    return table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in columns], null_placement="at_start")) if columns else table


class Chunks:
    """Rows to chunks and back, inside tasks. A chunk is one binary: its numbers, then its rows as a record batch without the schema."""

    def __init__(self, by: Sequence[str], order: Sequence[str], col: str, time: str | None, keep: Sequence[str], schema: pa.Schema, decay: Decay):
        self.by, self.order, self.col, self.time, self.keep, self.schema, self.decay = list(by), list(order), col, time, list(keep), schema, decay

    def packed(self, table: pa.Table, begins: np.ndarray) -> list[bytes]:
        lines = self.decay.summaries(numbers_of(table[self.col]), begins)
        rows = pa.RecordBatch.from_struct_array(table.select(self.schema.names).cast(self.schema).to_struct_array().combine_chunks())
        sizes = np.diff(np.append(begins, table.num_rows)).tolist()
        return [line.tobytes() + rows.slice(a, n).serialize().to_pybytes() for line, a, n in zip(lines, begins.tolist(), sizes)]

    def opened(self, data: bytes, head: int) -> pa.RecordBatch:
        return pa.ipc.read_record_batch(pa.py_buffer(data).slice(head), self.schema)

    def _cut(self, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _sorted(pa.Table.from_batches(batches), [*self.by, *self.order]).combine_chunks()
        begins = np.zeros(1, np.int64)
        if self.by:
            places = table.select(self.by).append_column("__i", pa.array(np.arange(table.num_rows)))
            begins = np.sort(places.group_by(self.by).aggregate([("__i", "min")])["__i_min"].to_numpy())
        columns = {c: table[c].take(pa.array(begins)) for c in self.by}
        if self.time:
            newest = np.maximum.reduceat(table["__at"].cast(pa.int64()).to_numpy(), begins)
            columns["__at"] = pa.array(newest).cast(table["__at"].type)
        columns["__chunk"] = pa.array(self.packed(table, begins), pa.binary())
        yield from pa.table(columns).to_batches(max_chunksize=1_000)

    def pack(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held, rows, size = [*held, batch], rows + batch.num_rows, size + batch.nbytes
            if rows >= CUT_ROWS or size >= CUT_BYTES:
                yield from self._cut(held)
                held, rows, size = [], 0, 0
        if held:
            yield from self._cut(held)

    def unpack(self, out: str):
        def means(parts: list[pa.RecordBatch], states: list[bytes]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts).select(self.keep)
            begins = np.cumsum([0, *[p.num_rows for p in parts[:-1]]])
            found = self.decay.means(numbers_of(table[self.col]), begins, np.frombuffer(b"".join(states)).reshape(len(parts), -1))
            yield from table.append_column(out, pa.array(found, pa.float64(), from_pandas=True)).combine_chunks().to_batches(max_chunksize=10_000)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, states, rows, size = [], [], 0, 0
            for batch in batches:
                for chunk in batch.column(0):
                    data = chunk.as_py()
                    parts.append(self.opened(data, START))
                    states.append(data[:START])
                    rows, size = rows + parts[-1].num_rows, size + len(data)
                    if rows >= CUT_ROWS or size >= CUT_BYTES:
                        yield from means(parts, states)
                        parts, states, rows, size = [], [], 0, 0
            if parts:
                yield from means(parts, states)

        return run


class MeanOfKey:
    """Chains the chunks of a key; the state goes when the key has been idle long enough."""

    def __init__(self, chunks: Chunks, idle_ms: int | None, ttl_ms: int | None):
        self.chunks, self.idle_ms, self.ttl_ms = chunks, idle_ms, ttl_ms

    def _merged(self, parts: list[pa.RecordBatch]) -> bytes:
        return self.chunks.packed(_sorted(pa.Table.from_batches(parts), self.chunks.order).combine_chunks(), np.zeros(1, np.int64))[0]

    def _ordered(self, chunks: list[bytes]) -> Iterator[bytes]:
        """In order; chunks that overlap become one."""
        if len(chunks) == 1:
            yield from chunks
            return

        def point(rows: pa.RecordBatch, i: int) -> tuple:
            values = [rows.column(c)[i].as_py() for c in self.chunks.order]
            return tuple((0, 0) if pd.isna(v) else (1, v) for v in values)

        opened = [(self.chunks.opened(c, LINE), c) for c in chunks]
        found = sorted(((point(r, 0), point(r, r.num_rows - 1), r, c) for r, c in opened), key=lambda f: f[0])
        i = 0
        while i < len(found):
            high, k = found[i][1], i + 1
            while k < len(found) and found[k][0] <= high:
                high, k = max(high, found[k][1]), k + 1
            yield found[i][3] if k == i + 1 else self._merged([f[2] for f in found[i:k]])
            i = k

    def _fresh(self, data: bytes, watermark: int) -> tuple[bytes | None, int]:
        """The chunk without rows later than the watermark, which are dropped one by one, and its newest time."""
        rows = self.chunks.opened(data, LINE)
        due = pa.scalar(max(watermark, 0) * 1000, pa.int64()).cast(rows.column("__at").type)
        fresh = rows.filter(pc.greater_equal(rows.column("__at"), due))
        if not fresh.num_rows:
            return None, 0
        newest = pc.max(fresh.column("__at")).cast(pa.int64()).as_py() // 1000
        return (data if fresh.num_rows == rows.num_rows else self._merged([fresh])), newest

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        chunks, latest = [c for f in frames for c in f["__chunk"]], 0
        if self.idle_ms is not None:
            watermark = state.getCurrentWatermarkMs()
            fresh = [f for f in (self._fresh(c, watermark) for c in chunks) if f[0] is not None]
            chunks, latest = [c for c, _ in fresh], max((at for _, at in fresh), default=0)
        if not chunks:
            return
        held = state.getOption
        if self.ttl_ms is not None:
            latest = state.getCurrentProcessingTimeMs()
            # A state whose time is over may still be there.
            held = None if held and held[-1] + self.ttl_ms <= latest else held
        now, out = State(*held[:-1]) if held else State(), []
        for data in self._ordered(chunks):
            out.append(np.array(now.numbers()).tobytes() + data[LINE:])
            now = self.chunks.decay.after(now, np.frombuffer(data, count=len(Decay.SUMMARY)).tolist())
        if self.idle_ms is not None:
            latest = max(latest, int(held[-1])) if held else latest
            # Time is over once the watermark is past this, not when it is there.
            state.setTimeoutTimestamp(max(latest + self.idle_ms - 1, watermark, 1))
        elif self.ttl_ms is not None:
            state.setTimeoutDuration(self.ttl_ms)
        state.update((*now.numbers(), float(latest)))
        yield pd.DataFrame({"chunk": out})


def _milliseconds(text: str | None) -> int | None:
    return None if text is None else int(pd.Timedelta(text).total_seconds() * 1000)


def online_ewm(
    stream: DataFrame, col: str, alpha: float, by: Sequence[str], order: Sequence[str], adjust: bool = True, out: str = "ewm", ignore_na: bool = False,
    time: str | None = None, lateness: str = "1 hour", idle: str | None = None, ttl: str | None = None,
) -> DataFrame:
    """The mean after every row, per key, going on from the batch before.

    Rows of a batch are put in ``order``; over batches they are taken as they come. The state of a key is a few numbers and
    goes, so that the key starts anew, either ``idle`` after its newest ``time`` (by the watermark, which follows the newest time
    seen by ``lateness``; rows behind it are dropped) or ``ttl`` after its last batch by the clock. Without both it stays. By the
    clock Spark also runs batches without rows, for ever: with the trigger ``availableNow`` turn
    ``spark.sql.streaming.noDataMicroBatches.enabled`` off.
    """
    if (time is None) != (idle is None) or (idle and ttl):
        raise ValueError("give time with idle, or ttl, or neither")
    by, order = list(by), list(order)
    keep = list(dict.fromkeys([*by, *order, col]))
    spark, schema = stream.sparkSession, stream.schema
    # Timers and expiry need a store that keeps them.
    spark.conf.set(PROVIDER, ROCKSDB)
    rows = stream.select(*keep, F.col(time).cast("timestamp").alias("__at")).where(F.col("__at").isNotNull()) if time else stream.select(*keep)
    within = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]).toArrow().schema
    chunks = Chunks(by, order, col, time, keep, within, Decay(alpha, adjust, ignore_na))
    fields = [schema[c] for c in by] + ([T.StructField("__at", T.TimestampType())] if time else []) + [T.StructField("__chunk", T.BinaryType())]
    packed = rows.mapInArrow(chunks.pack, T.StructType(fields))
    if time:
        packed = packed.withWatermark("__at", lateness)
    keyed = packed if by else packed.withColumn("__all", F.lit(0))
    timeout = GroupStateTimeout.EventTimeTimeout if idle else GroupStateTimeout.ProcessingTimeTimeout if ttl else GroupStateTimeout.NoTimeout
    processor = MeanOfKey(chunks, _milliseconds(idle), _milliseconds(ttl))
    # Spark hands over state and rows of many keys at a time.
    chained = keyed.groupBy(*(by or ["__all"])).applyInPandasWithState(processor.__call__, "chunk binary", STATE, "append", timeout)
    # Chunks are dealt out again, those of one key to many tasks.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    result = T.StructType([*[schema[c] for c in keep], T.StructField(out, T.DoubleType())])
    # The projection makes rows of the kind that a shuffle takes.
    return chained.select(F.col("chunk").alias("__chunk")).repartition(parts).mapInArrow(chunks.unpack(out), result)
