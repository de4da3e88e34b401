"""Consecutive surrogate ids without pulling the rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.session import materialize


def assign_ids(
    df: DataFrame, order_by: Sequence[str | Column] = (), start: int = 0, id_column: str = "id"
) -> DataFrame:
    """Add ids ``start, start + 1, ...``.

    With ``order_by``, a unique key, ids follow that order whatever the layout of the input; without,
    they follow the order of the partitions and cost no shuffle.  ``df`` is computed once.  Rows and offsets, one per
    partition, are written once, so an id never changes when a task is run again.
    """
    if order_by:
        # the range partitioner samples its input first: written, the input is not computed twice
        df = materialize(df, "unnumbered").repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    # partition number in the upper 31 bits, position within the partition in the lower 33
    staged = materialize(df.withColumn("_place", F.monotonically_increasing_id()), "ids")
    part = F.shiftright("_place", 33).alias("_part")
    sizes = staged.groupBy(part).agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    offsets = materialize(offsets, "offsets")
    numbered = staged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    place = F.col("_place").bitwiseAND((1 << 33) - 1)
    new_id = (F.lit(start) + F.col("_offset") + place).cast("bigint").alias(id_column)
    return numbered.select(new_id, *(F.col(c) for c in df.columns))


def next_id(table: DataFrame, id_column: str = "id") -> int:
    """The first free id after those already in ``table``."""
    highest = table.agg(F.max(id_column)).first()[0]
    return 0 if highest is None else highest + 1
