"""Sharding by a two-pass external shuffle.

The first pass scatters rows uniformly into buckets that fit in memory, by a seeded hash of each row's place in
the input.  The second shuffles each bucket with Fisher-Yates.  The buckets laid end to end are one uniformly
shuffled sequence, which is dealt out to the shards in turn, so shard sizes differ by one row at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_BYTES = 32 << 20
ROW_BYTES = 16

PLACE, BUCKET, INDEX = "__place", "__bucket", "__index"
OWN = (PLACE, BUCKET, INDEX)


def row_size(text: str) -> Column:
    """UTF-8 bytes of a text, none for null, plus a fixed amount per row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")


def _shuffler(seed: int):
    def shuffle(key: tuple, rows: pa.Table) -> pa.Table:
        """Order that does not depend on how the bucket arrived, then Fisher-Yates (numpy's ``permutation``)."""
        arrived = np.argsort(rows.column(PLACE).to_numpy(), kind="stable")
        order = arrived[np.random.default_rng([seed, key[0].as_py()]).permutation(len(arrived))]
        taken = rows.take(pa.array(order))
        return taken.append_column(INDEX, pa.array(np.arange(len(order), dtype=np.int64)))

    return shuffle


def shuffle_into_shards(
    docs: DataFrame,
    text: str = "text",
    shards: int = 40,
    seed: int = 20240229,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each).

    ``docs`` is read three times and rows are told apart by their place, so it must be a table or another input
    that yields the same partitions when read again; stage anything else first.  That is also what splits a hot
    group: copies and fully repeated rows get different places and so scatter like any others.

    Null texts count as empty, a single row larger than a bucket is a bucket's only hardship, and an empty table
    gives an empty result.  Columns named ``shard`` or ``slot`` are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    docs = docs.drop("shard", "slot", *OWN)
    total = docs.agg(F.sum(row_size(text))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))

    placed = docs.withColumn(PLACE, F.monotonically_increasing_id())
    scattered = placed.withColumn(BUCKET, F.pmod(F.xxhash64(F.lit(seed), PLACE), F.lit(buckets)).cast("int"))

    schema = T.StructType([*scattered.schema.fields, T.StructField(INDEX, T.LongType())])
    shuffled = scattered.groupBy(BUCKET).applyInArrow(_shuffler(seed), schema)

    # one row per bucket: bounded by the bytes of the input over the bytes of a bucket
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = scattered.groupBy(BUCKET).count().select(
        BUCKET, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset")
    )
    position = F.col("__offset") + F.col(INDEX)
    return (
        shuffled.join(F.broadcast(offsets), BUCKET)
        .withColumn("shard", F.pmod(position, F.lit(shards)).cast("int"))
        .withColumn("slot", F.expr(f"(__offset + {INDEX}) div {shards}"))
        .drop(*OWN, "__offset")
    )

