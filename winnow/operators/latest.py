"""Latest row per key by a version that counts as a number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], version: Column | str) -> DataFrame:
    """For each key the row with the highest numeric version (10 after 9).

    Each task picks the best row of a key among its own before anything is shuffled (a partial window group limit), so the one
    exchange carries a row per key and task at most, however many versions a key has, and the input is read once.  Among
    rows of one version the whole row decides, so ties have one answer.  Rows whose version is no number count as
    lower than all others.
    """
    number = (F.col(version) if isinstance(version, str) else version).try_cast("bigint")
    rest = [c for c in df.columns if c not in keys]
    best = Window.partitionBy(*keys).orderBy(F.col("_version").desc(), F.struct(*rest).desc())
    numbered = df.withColumn("_version", F.coalesce(number, F.lit(-(1 << 63))))
    return numbered.withColumn("_place", F.row_number().over(best)).where("_place = 1").select(*keys, *rest)
