"""Keyed state for streams: which keys came before, and when a key was kept last.

State lives in RocksDB beside each shuffle partition and in the checkpoint, so a batch looks up the keys that occur in it and
nothing else: its cost does not grow with what came before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEY_SLOTS = 1024  # groups that the keys of a stream are dealt to; a checkpoint is tied to this number


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def whole_row(df: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def key_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """The values of a key as one text, which is equal where a grouping takes them for equal."""
    kinds = dict(df.dtypes)
    parts = [F.col(f"`{c}`") + F.lit(0.0).cast(kinds[c]) if kinds[c] in ("float", "double") else F.col(f"`{c}`") for c in columns]
    whole = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    options = {"ignoreNullFields": "false", "timestampFormat": f"{whole}XXX", "timestampNTZFormat": whole}
    return F.to_json(F.struct(*(part.alias(str(i)) for i, part in enumerate(parts))), options)


def slot_of(key: Column | str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_SLOTS)).cast("int")


# ---- keys that are new to a stream --------------------------------------------------------------


def ahead_of_task(df: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
    """``df`` with a flag: no earlier row of this task's part of the batch has the same key.

    This merges a hot key before the shuffle: a task sends it once.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(flag, T.BooleanType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            flags = []
            for key in zip(*(batch.column(c).to_pylist() for c in columns)):
                flags.append(key not in seen)
                seen.add(key)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flags, pa.bool_())], schema.names)

    return df.mapInArrow(run, schema)


def latest_of_task(df: DataFrame, columns: Sequence[str], event_time: str) -> DataFrame:
    """The rows of a stream that are later than every earlier one of their key in the task's part of the batch, at most one a
    record batch and key.

    Whatever the watermark, a key that has a row in time keeps one: its latest is always among them.  Nothing is shuffled and
    no state is kept, so this merges a hot key before it is dealt out.  A task holds its keys, each with a time.
    """
    names, before = df.columns, -(1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        latest: dict[str, int] = {}
        for batch in batches:
            times = batch.column(event_time).cast(pa.int64()).to_pylist()
            rows: dict[str, int] = {}
            for row, (key, at) in enumerate(zip(batch.column("__key").to_pylist(), times)):
                at = before + 1 if at is None else at
                if at > latest.get(key, before):
                    latest[key], rows[key] = at, row
            yield batch.select(names).take(pa.array(sorted(rows.values()), pa.int64()))

    return df.withColumn("__key", key_text(df, columns)).mapInArrow(run, df.schema)


def with_new_keys(df: DataFrame, unique: Sequence[str], columns: Sequence[str], flag: str = "new") -> DataFrame:
    """All rows of a stream, and one more row with a true ``flag`` for each key that the stream has not brought before.

    The further rows hold the key only, all else is null; a key with a null is never new.  ``unique`` tells the rows of the
    whole stream apart.  Keys are state of the engine's own deduplication, which calls no Python for a key; rows take
    the way through the same operator, as a stream cannot be read twice, and leave their ``unique`` columns in its state.
    """
    ahead = ahead_of_task(df, columns, "__ahead")
    new = F.col("__ahead")
    for c in columns:
        new = new & F.col(c).isNotNull()
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns), F.lit(False).alias(flag))
    only = (F.col(f"`{f.name}`") if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema)
    key = F.struct(*only, F.lit(True).alias(flag))
    both = ahead.select(F.explode(F.when(new, F.array(row, key)).otherwise(F.array(row))).alias("__both")).select("__both.*")
    return both.dropDuplicates([flag, *unique, *columns])


def content(df: DataFrame, id_column: str) -> Column:
    """What tells rows without an id apart; null where there is one."""
    return F.when(F.col(id_column).isNull(), F.xxhash64(whole_row(df)))


def new_ids(df: DataFrame, id_column: str, column: str) -> DataFrame:
    """Rows whose id the stream has not brought before; rows without an id are told apart by their ``content``, added as ``column``."""
    return df.withColumn(column, content(df, id_column)).dropDuplicates([id_column, column])


# ---- repeats inside a bound of event time -------------------------------------------------------


class KeepApart(StatefulProcessor):
    """Keeps a row if no row of its key was kept within ``bound`` before it.

    One state holds the keys of a slot, each with the time it was kept last: it is read and written once a batch, as a call for
    every key costs more than the rows.  What the watermark has passed by ``bound`` is left out; a timer frees slots at rest.
    """

    def __init__(self, bound_micros: int, event_time: str, order: str):
        self.bound, self.event_time, self.order = bound_micros, event_time, order

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "keys array<string>, times array<bigint>")

    def _end(self, at: int) -> int:
        """The millisecond from which a row kept at ``at`` has no bearing on others."""
        return (at + self.bound) // 1000 + 1

    def _live(self, now: int) -> dict[str, int]:
        return {key: at for key, at in zip(*(self.last.get() or ((), ()))) if self._end(at) > now}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self._live(timerValues.getCurrentWatermarkInMs())
        found = [(r["__row"], r["__key"]) for r in rows]
        for r, name in sorted(found, key=lambda f: (f[0][self.event_time], f[0][self.order] is None, f[0][self.order])):
            at, before = r[self.event_time], last.get(name)
            if before is None or at > before + self.bound:
                last[name] = at
                yield Row(row=r)
        if last:
            self.last.update((list(last), list(last.values())))
            self.handle.registerTimer(self._end(max(last.values())))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last = self._live(expiredTimerInfo.getExpiryTimeInMs())
        if last:
            self.last.update((list(last), list(last.values())))
        else:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def keep_apart(df: DataFrame, event_time: str, bound: str, columns: Sequence[str], order: str) -> DataFrame:
    """Rows of a stream that no kept row of the same ``columns`` precedes by ``bound`` (an interval such as ``6 hours``) or less.

    ``event_time`` is a timestamp; rows go by it, then by ``order``, a column that tells the rows of one time apart.  The
    watermark follows ``bound`` behind the latest time seen: a row older than that is late and left out, and the state of a
    key goes once the watermark has passed the end of its bound.  So the result does not depend on how rows in order
    are cut into batches, and the state holds the keys of the last two bounds only.  Rows without a time are
    left out as late ones are; nulls in the key are a value.  Keys are dealt to ``KEY_SLOTS`` slots, see ``KeepApart``;
    a checkpoint with a state for every key, as this had before, cannot be carried on.
    """
    spark = df.sparkSession
    micros = spark.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {bound})")).first()[0]
    # Python takes times as microseconds: exact in any time zone, and a fraction of the cost of time objects
    times = [f.name for f in df.schema if f.dataType == T.TimestampType()]
    plain = df.withColumns({c: F.unix_micros(f"`{c}`") for c in times})
    late = df.withWatermark(event_time, bound).where(F.col(event_time).isNotNull())
    columns_of = (F.unix_micros(f"`{c}`").alias(c) if c in times else F.col(f"`{c}`") for c in df.columns)
    keyed = late.select(event_time, key_text(df, columns).alias("__key"), F.struct(*columns_of).alias("__row"))
    out = T.StructType([T.StructField("row", plain.schema)])
    processor = KeepApart(micros, event_time, order)
    slots = keyed.withColumn("__slot", slot_of("__key")).groupBy("__slot")
    kept = slots.transformWithState(processor, out, "Append", "EventTime").select("row.*")
    return kept.withColumns({c: F.timestamp_micros(f"`{c}`") for c in times})
