"""Rows that cannot go on are set aside with the reasons, never dropped."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions import text
from winnow.functions.minhash import SHINGLE_WIDTH


def _rules(prompt: str, required: Sequence[str], threshold: int | None) -> list[tuple[str, Column]]:
    rules = [(f"null_{c}", F.col(c).isNull()) for c in dict.fromkeys([prompt, *required])]
    rules.append(("too_short", F.coalesce(F.length(prompt) < SHINGLE_WIDTH, F.lit(False))))
    if threshold is not None:
        enough = text.longer_than(text.normalize(prompt), threshold)
        rules.append(("below_threshold", F.coalesce(~enough, F.lit(False))))
    return rules


def split_quality(
    df: DataFrame, prompt: str = "prompt", required: Sequence[str] = (), threshold: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(good, set aside)``, together every row; the second frame says why in a ``reason`` array.

    Reasons are ``null_<column>`` for the prompt and each required column, ``too_short`` for a prompt
    without a single shingle, and ``below_threshold`` for one whose normalised text is not longer than
    ``threshold``.  The rows are parted by a plain condition, cheap rules first.
    """
    rules = _rules(prompt, required, threshold)
    bad = reduce(or_, (rule for _, rule in rules))
    named = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules)))
    return df.where(~bad), df.where(bad).withColumn("reason", named)


def min_length(df: DataFrame, prompt: str = "prompt", threshold: int = 50) -> DataFrame:
    """Rows whose normalised prompt, added as ``text``, is longer than ``threshold``.

    The one-element array keeps the optimizer from normalising once for the filter and once more for
    the result.
    """
    long_enough = F.filter(F.array(text.normalize(prompt)), lambda t: F.length(t) > threshold)
    others = [c for c in df.columns if c != "text"]
    return df.select(*others, F.explode(long_enough).alias("text"))
