"""Mixing sources to target weights by Pareto order sampling.

A source's target over its size is the number of copies that each of its documents is expected to give.  The whole part
is certain.  For the rest, documents are ranked by random odds over inclusion odds and the first ones are taken until
the source's target is met, a sample of fixed size.  The main path is DataFrame operations only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.session import materialize

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_COPIES = 2
SEED = 97
BUCKET_ROWS = 20_000  # rows of all sources that one rank bucket holds on average


def word_count(text: str) -> Column:
    """Runs of characters other than ASCII white space; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share_percent: float, most: float) -> DataFrame:
    """``source``, ``source_size``, ``target``: the sources' shares of ``share_percent`` of all sizes.

    ``sizes`` has one row per source.  Sources in order (code points, null last) take the weights in turn.  Where a
    share exceeds ``most`` times the source's size it stops there and the excess is shared by weight among the rest;
    that settles at the level where weight * level fills what is left.  Sorted by the level at which each one stops,
    the stopped sources are a prefix, found with running sums.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight).withColumn("stop", F.lit(float(most)) * F.col("source_size"))
    up = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(every) * F.lit(share_percent / 100)
    left = budget - F.coalesce(F.sum("stop").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # the level if this source and all above it don't stop; the first for which that holds sets it
    levels = weighed.withColumn("level", left / weights_left)
    free = F.col("level") * F.col("weight") <= F.col("stop")
    settled = levels.withColumn("level", F.min(F.when(free, F.struct(F.col("stop") / F.col("weight"), F.col("level").alias("l")))).over(every)["l"])
    share = F.col("level") * F.col("weight")
    target = F.when(share.isNull() | (share > F.col("stop")), F.col("stop")).otherwise(share)
    return settled.select("source", "source_size", target.alias("target"))


def _ranks(docs: DataFrame, id: str, text: str, source: str, seed: int) -> DataFrame:
    """The input with its size and random numbers: hashes of id, text and source, so that reruns and layouts agree."""
    key = (F.col(id), F.col(text), F.col(source))
    return docs.withColumns(
        {"size": word_count(text), "__a": F.xxhash64(F.lit(seed), *key), "__b": F.xxhash64(F.lit(seed + 1), *key)}
    )


def _rank_key() -> Column:
    """Pareto: odds of the random number over odds of inclusion, as q / (1 + q), which has the same order."""
    u = (F.pmod(F.col("__a"), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    q = (u / (1 - u)) * ((1 - F.col("part")) / F.col("part"))
    return F.when(F.col("part") > 0, q / (1 + q)).otherwise(F.lit(1.0))


def plan(
    docs: DataFrame, id: str, text: str, source: str, weights: tuple[float, ...], share_percent: float, most: int, seed: int
) -> DataFrame:
    """One row per source: its size, target, certain copies (``whole``), inclusion probability (``part``) and the ``cut``,
    the highest rank that still goes in (null if none does).

    A hot source is never put in order as a whole.  Ranks are cut into buckets, a running sum over (source, bucket)
    totals finds the bucket in which each source meets its target, and only the rows of that bucket are sorted.
    """
    narrow = _ranks(docs.select(id, text, source), id, text, source, seed)
    sized = materialize(narrow.select(F.col(source).alias("source"), "size", "__a", "__b"), "mix-sizes")
    sums = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "mix-sources")
    buckets = max(256, math.ceil((sums.agg(F.sum("n")).first()[0] or 0) / BUCKET_ROWS))

    goals = targets(sums.select("source", "source_size"), weights, share_percent, most)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goals = goals.withColumn("whole", F.least(F.floor(expected), F.lit(most)).cast("int"))
    goals = goals.withColumn("part", expected - F.col("whole"))
    goals = materialize(goals.withColumn("open", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")

    ranked = _by_source(sized, "source", goals).withColumn("key", _rank_key())
    ranked = ranked.withColumn("bucket", F.least(F.floor(F.col("key") * buckets), F.lit(buckets - 1)).cast("int"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = ranked.groupBy("source", "bucket", "open").agg(F.sum("size").alias("words"))
    filled = filled.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
    last = filled.where((F.col("before") <= F.col("open")) & (F.col("before") + F.col("words") > F.col("open")))
    last = materialize(last.select("source", F.col("bucket").alias("last"), "before"), "mix-buckets")

    # rows that repeat id, text and source are one unit of this order
    edge = _by_source(ranked, "source", last).where("bucket = last")
    units = edge.groupBy("source", "key", "__a", "__b", "open", "before").agg(F.sum("size").alias("words"))
    inside = Window.partitionBy("source").orderBy("key", "__a", "__b").rowsBetween(Window.unboundedPreceding, -1)
    halfway = F.col("before") + F.coalesce(F.sum("words").over(inside), F.lit(0)) + F.col("words") / 2
    taken = units.withColumn("halfway", halfway).where("halfway <= open")  # the last goes in if that comes nearer
    rank = F.struct("key", "__a", "__b")
    lowest = F.struct((F.col("last") / F.lit(buckets)).alias("key"), F.lit(-(1 << 63)).alias("__a"), F.lit(-(1 << 63)).alias("__b"))
    cuts = last.select("source", lowest.alias("floor")).join(
        taken.groupBy(F.col("source").alias("of")).agg(F.max(rank).alias("top")), F.col("source").eqNullSafe(F.col("of")), "left"
    )
    cuts = cuts.select("source", F.coalesce("top", "floor").alias("cut"))
    return materialize(_by_source(goals, "source", cuts).drop("open"), "mix-plan")


def _by_source(left: DataFrame, source: str, right: DataFrame) -> DataFrame:
    """Left join on the source, null being one; the right side has a row per source."""
    right = right.withColumnRenamed("source", "__of")
    return left.join(right, F.col(source).eqNullSafe(F.col("__of")), "left").drop("__of")


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share_percent: float = SHARE_PERCENT,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``size`` (words), ``source_size``, ``target``, ``copies`` and ``taken``.

    ``copies`` (0 to ``most``) is how often the document goes into the mix, ``taken`` copies times size.  Each source's taken
    words differ from its target by half of one document at most.  Null sources are one source, null texts have
    no words.  Rows that repeat id, text and source get the same number of copies and count as one document in that bound.
    Texts without words weigh nothing and go where their rank falls.  An empty table gives an empty result; columns named
    like a result are replaced.

    ``docs`` is read twice, first for the plan (one narrow row per document, then one per source), then map-only against it,
    so texts are never shuffled while the sources fit a broadcast; otherwise that join is on the source.
    """
    docs = docs.drop(*({"size", "source_size", "target", "copies", "taken", "__a", "__b"} - {id, text, source}))
    goals = plan(docs, id, text, source, weights, share_percent, most, seed)
    ranked = _by_source(_ranks(docs, id, text, source, seed), source, goals)
    more = F.coalesce(F.struct(_rank_key().alias("key"), "__a", "__b") <= F.col("cut"), F.lit(False)) & (F.col("part") > 0)
    copies = F.least(F.col("whole") + more.cast("int"), F.lit(most)).cast("int")
    mixed = ranked.withColumn("copies", copies).withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
    return mixed.select(*(F.col(f"`{c}`") for c in docs.columns), "size", "source_size", "target", "copies", "taken")
