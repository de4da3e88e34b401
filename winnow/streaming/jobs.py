"""The ingestion, cleaning and deduplication steps as Structured Streaming jobs.

Every job reads what is there, commits to its checkpoint and stops; started again it takes up only new
data.  Pass another trigger to keep one running.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from winnow.functions import minhash
from winnow.functions.minhash import SHINGLE_WIDTH
from winnow.operators import dedup
from winnow.session import materialize
from winnow.sources.ingest import stamp
from winnow.streaming import state

ONCE: Mapping[str, object] = {"availableNow": True}


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Append a stream to a parquet table; the file sink's log makes every batch count once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start(path)


def to_bronze(
    stream: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Append with the time of ingestion."""
    return append_stream(stamp(stream), path, checkpoint, trigger)


def to_silver(
    stream: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Append after a stateless step such as scrubbing, cleaning or standardising."""
    return append_stream(clean(stream), path, checkpoint, trigger)


def to_deduplicated(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    id_column: str = "id",
    prompt: str = "prompt",
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Upsert a stream of rows into ``path/kept`` and ``path/quarantine``.

    A row is kept if its band is new to the stream and its id the lowest of that band in its batch.  The others go to the
    quarantine with a reason: ``near_duplicate``, ``null_<prompt>``, or ``too_short`` for a prompt without a shingle.  Rows
    whose id came before are skipped: they are in one of the tables.

    Ids and bands are keyed state, so a batch reads no table of earlier ones and costs what its own rows cost, however long
    the stream has run.  The state only tells which bands are new to the stream; the lowest id of each is found among the
    rows of the batch.  A batch overwrites its own ``batch_id`` partition, and its state is that of the batch before it, so
    running it again after a failure changes nothing.  ``path`` and ``checkpoint`` belong together; start a new table with a
    new checkpoint.
    """
    unique = [id_column, "__content"]
    columns = [*stream.columns, *dedup.BAND]
    rows = state.new_ids(stream, id_column, "__content")
    good = F.length(prompt) >= SHINGLE_WIDTH
    hashes = minhash.signature(F.when(good, F.col(prompt)), len(dedup.BAND))
    banded = rows.withColumn("__hashes", hashes).select(*rows.columns, *minhash.band_hashes("__hashes"))
    marked = state.with_new_keys(banded, unique, dedup.BAND, "__new")
    why = (
        F.when(F.col(prompt).isNull(), F.lit(f"null_{prompt}")).when(~good, F.lit("too_short")).otherwise(F.lit("near_duplicate"))
    )
    lowest = F.min(F.struct(F.col(id_column).isNull(), F.col(id_column).alias("id"), F.col("__content").alias("content")))

    def one_batch(batch_rows: DataFrame, batch: int) -> None:
        # the batch is computed once, as it moves the state on; each overwrites the one before, so staging does not grow
        staged = materialize(batch_rows, "batch", f"{path}/_staging/batch")
        new, found = staged.where("__new").select(*dedup.BAND), staged.where("NOT __new")
        # one row a band on both sides, and texts are only met on what tells rows apart
        first = found.groupBy(*dedup.BAND).agg(lowest.alias("first")).join(new, dedup.BAND, "left_semi").select("first.id", "first.content")
        first = materialize(first, "first", f"{path}/_staging/first")
        same = found[id_column].eqNullSafe(first["id"]) & found["__content"].eqNullSafe(first["content"])
        kept, others = found.join(first, same, "left_semi"), found.join(first, same, "left_anti")
        aside = others.select(*columns, F.array(why).alias("reason"))
        for name, part in (("quarantine", aside), ("kept", kept.select(*columns))):
            part.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch}")

    with state.rocksdb(stream.sparkSession):
        writer = marked.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start()


def to_kept_apart(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    event_time: str,
    bound: str,
    columns: Sequence[str],
    order: str,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Append the rows that do not repeat a kept one within a bound of event time; see ``state.keep_apart``."""
    with state.rocksdb(stream.sparkSession):
        return append_stream(state.keep_apart(stream, event_time, bound, columns, order), path, checkpoint, trigger)


def drop_repeats(
    stream: DataFrame,
    event_time: str,
    delay: str,
    columns: Sequence[str],
    spread_by: str | None = None,
    ways: int | None = None,
    ahead: bool = False,
) -> DataFrame:
    """Drop rows whose ``columns`` repeat within ``delay`` of event time; state older than that is freed.

    With ``ahead``, each task first drops the copies of a key that are no later than one it has seen in the batch, so a hot key
    is a few rows of each task before the shuffle, at no state of its own; of the copies in a task the latest ones go on.

    With ``spread_by``, a column that tells copies apart, the copies of a hot key are first thinned out by a state of their own
    in ``ways`` parts (as many as there are shuffle partitions, unless given), so that no task gets more than that
    many of them per batch.
    """
    ways = ways or int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if ahead:
        stream = state.latest_of_task(stream, columns, event_time)
    late = stream.withWatermark(event_time, delay)
    if spread_by is None:
        return late.dropDuplicatesWithinWatermark(list(columns))
    parted = late.withColumn("_part", F.pmod(F.xxhash64(spread_by), F.lit(ways)))
    thinned = parted.dropDuplicatesWithinWatermark([*columns, "_part"]).drop("_part")
    return thinned.dropDuplicatesWithinWatermark(list(columns))
