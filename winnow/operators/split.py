"""Train/test split that depends on the text alone."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_point(text: Column | str, seed: int = 42) -> Column:
    """A number in [0, 1) from the SHA-1 of seed and text: equal texts get equal numbers."""
    digest = F.sha1(F.concat_ws(":", F.lit(str(seed)), text))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def with_split(
    df: DataFrame, text: str = "prompt", weights: Mapping[str, float] | None = None, seed: int = 42
) -> DataFrame:
    """Add ``split``; the same whatever the layout, and copies of a text never straddle it."""
    weights = weights or {"train": 0.7, "test": 0.3}
    total, reached, names = sum(weights.values()), 0.0, list(weights)
    chosen = F.lit(names[-1])
    bounds = []
    for name in names[:-1]:
        reached += weights[name]
        bounds.append((name, reached / total))
    for name, bound in reversed(bounds):
        chosen = F.when(split_point(text, seed) < bound, F.lit(name)).otherwise(chosen)
    return df.withColumn("split", chosen)


def split_by_text(
    df: DataFrame, text: str = "prompt", weights: Mapping[str, float] | None = None, seed: int = 42
) -> dict[str, DataFrame]:
    """One frame per split; each is a map-only filter."""
    marked = with_split(df, text, weights, seed)
    names = list(weights) if weights else ["train", "test"]
    return {name: marked.where(F.col("split") == name).drop("split") for name in names}
