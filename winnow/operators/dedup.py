"""Near-duplicate buckets: rows whose first three MinHash values are all equal.

A bucket may hold a third of all rows, so no step gathers one.  Survivors come from a partially
aggregated minimum, texts are joined on the unique id only, and whatever needs the rows of a bucket
in order works on pieces cut by range over (bucket, id), which the range partitioner keeps even.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions import minhash
from winnow.session import materialize

BAND = list(minhash.BAND_COLUMNS)


def signatures(
    df: DataFrame,
    id_column: str = "id",
    prompt: str = "prompt",
    num_hashes: int = minhash.NUM_HASHES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(id, hashes, hash1, hash2, hash3)`` of every row with at least one shingle; map-only.

    ``keep`` passes further columns through.
    """
    hashed = df.where(F.length(prompt) >= minhash.SHINGLE_WIDTH).select(
        id_column, *keep, minhash.signature(prompt, num_hashes).alias("hashes")
    )
    return hashed.select(id_column, *keep, "hashes", *minhash.band_hashes("hashes"))


def bands(
    df: DataFrame, id_column: str = "id", prompt: str = "prompt", keep: Sequence[str] = ()
) -> DataFrame:
    """``(id, hash1, hash2, hash3)`` only: three hash functions instead of 128."""
    return signatures(df, id_column, prompt, len(BAND), keep).drop("hashes")


def survivors(banded: DataFrame, id_column: str = "id") -> DataFrame:
    """The lowest id of each bucket; a hot bucket collapses in the map-side aggregation."""
    return banded.groupBy(*BAND).agg(F.min(id_column).alias(id_column)).select(id_column, *BAND)


def keep_first(df: DataFrame, id_column: str = "id", prompt: str = "prompt") -> DataFrame:
    """Only the surviving rows, with their band columns; rows without a shingle are not among them (``split_duplicates``
    sets those aside)."""
    return df.join(survivors(bands(df, id_column, prompt), id_column), id_column)


def split_duplicates(
    df: DataFrame,
    id_column: str = "id",
    prompt: str = "prompt",
    num_hashes: int | None = None,
    known: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(kept, quarantine)`` with band columns, disjoint and together all rows.

    The quarantine says why in ``reason``: ``near_duplicate``, or ``too_short`` or ``null_<prompt>`` for a row
    without a shingle, which has no band.  With ``num_hashes`` the whole signature is carried as ``hashes``.  ``known`` holds the bands kept
    earlier; whatever falls into one of them is quarantined.  All decisions are taken on ids and bands,
    and texts are only ever joined on the unique id.  Signatures and surviving ids are written at once:
    both results rest on the same decisions, even if ``known`` is a table that they are appended to.
    """
    if num_hashes is None:
        signed = bands(df, id_column, prompt)
    else:
        signed = signatures(df, id_column, prompt, num_hashes)
    signed = materialize(signed, "signatures")
    first = survivors(signed, id_column)
    if known is not None:
        # only bands that occur here matter: while they are few, the known ones are scanned, not shuffled
        seen = known.select(*BAND).join(first.select(*BAND), BAND, "left_semi")
        first = first.join(seen, BAND, "left_anti")
    first = materialize(first.select(id_column, *BAND), "survivors")
    first_ids = first.select(id_column)
    kept_rows = first if num_hashes is None else signed.join(first_ids, id_column, "left_semi")
    kept = df.join(kept_rows, id_column)
    copies = df.join(signed.join(first_ids, id_column, "left_anti"), id_column)
    copies = copies.withColumn("reason", F.array(F.lit("near_duplicate")))
    length = F.length(prompt)
    why = F.when(length.isNull(), F.lit(f"null_{prompt}")).otherwise(F.lit("too_short"))
    short = df.where(length.isNull() | (length < minhash.SHINGLE_WIDTH)).withColumn("reason", F.array(why))
    return kept, copies.unionByName(short, allowMissingColumns=True)


def _pieces(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number the range partitions of a unique order, written once so that the number is stable."""
    return materialize(df.repartitionByRange(*order).withColumn(name, F.spark_partition_id()), "pieces")


def bucket_rank(banded: DataFrame, id_column: str = "id") -> DataFrame:
    """``banded`` with ``DupRank``, the 1-based place by id in the bucket, and ``survivor``, its lowest id.

    Rows are ranked inside each (bucket, piece).  Only the first bucket of a piece can have begun in
    an earlier one, so both what is counted and what has to be added are a few rows per piece, and are
    broadcast.  The range partitioner reads its input twice, so pass bands that have been written, not
    ones to be computed.
    """
    cut = _pieces(banded.select(id_column, *BAND), [*BAND, id_column], "piece")
    group = [*BAND, "piece"]
    heads = cut.groupBy("piece").agg(F.min(F.struct(*BAND)).alias("head")).select("head.*").distinct()
    counts = (
        cut.join(F.broadcast(heads), BAND, "left_semi")
        .groupBy(*group)
        .agg(F.count("*").alias("n"), F.min(id_column).alias("low"))
    )
    earlier = Window.partitionBy(*BAND).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.select(
        *group, F.sum("n").over(earlier).alias("before"), F.min("low").over(earlier).alias("lowest")
    ).where(F.col("before").isNotNull())
    local = Window.partitionBy(*group).orderBy(id_column)
    placed = cut.select(
        id_column, *group, F.row_number().over(local).alias("place"), F.first(id_column).over(local).alias("low")
    )
    rank = (F.col("place") + F.coalesce("before", F.lit(0))).cast("bigint").alias("DupRank")
    survivor = F.coalesce("lowest", "low").alias("survivor")
    return placed.join(F.broadcast(begun), group, "left").select(id_column, *BAND, rank, survivor)


def bucket_sizes(banded: DataFrame) -> DataFrame:
    """Buckets of several rows, with the number of rows and of ordered pairs ``a.id < b.id`` in each."""
    sizes = banded.groupBy(*BAND).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
    pairs = F.expr("n_rows * (n_rows - 1) div 2").alias("n_pairs")
    return sizes.select(*BAND, "n_rows", pairs)


def duplicate_pairs(banded: DataFrame, id_column: str = "id") -> DataFrame:
    """``(a_id, b_id)``: every duplicate with the survivor of its bucket, ``a_id < b_id``.

    The members of a bucket are candidates of one another by definition, so these pairs describe all
    candidate pairs while growing with the rows and not with their square.
    """
    ranked = bucket_rank(banded, id_column).where(F.col("DupRank") > 1)
    return ranked.select(F.col("survivor").alias("a_id"), F.col(id_column).alias("b_id"))


def score_pairs(
    pairs: DataFrame,
    signed: DataFrame,
    id_column: str = "id",
    min_score: float | None = None,
    repeated: Sequence[str] = ("a", "b"),
) -> DataFrame:
    """Add ``score`` (``overlap_score``) and ``equal_share`` to any given ``(a_id, b_id)`` pairs from a frame of ``(id, hashes)``.

    ``repeated`` names the sides whose ids may occur in a great many pairs.  Such a side is looked up by
    (id, piece): the hashes are copied once to every piece that needs them and no join key is larger
    than a piece.
    """
    found, keys = pairs.select("a_id", "b_id"), {side: [f"{side}_id"] for side in "ab"}
    for side in repeated:
        found = _pieces(found, [f"{side}_id", "a_id" if side == "b" else "b_id"], f"{side}_piece")
        keys[side].append(f"{side}_piece")
    cut = found
    for side, key in keys.items():
        hashes = signed.select(F.col(id_column).alias(key[0]), F.col("hashes").alias(f"{side}_hashes"))
        if side in repeated:
            hashes = cut.select(*key).distinct().join(hashes, key[0])
        found = found.join(hashes, key)
    score = minhash.overlap_score("a_hashes", "b_hashes").alias("score")
    scored = found.select("a_id", "b_id", score, minhash.equal_share("a_hashes", "b_hashes").alias("equal_share"))
    return scored if min_score is None else scored.where(F.col("score") >= min_score)


def survivor_pairs(banded: DataFrame, id_column: str = "id") -> DataFrame:
    """The pairs of ``duplicate_pairs`` without ranks: buckets of several rows with their lowest id, joined back on the band.

    Most buckets hold one row and are gone after the aggregation, which is partial before its shuffle.  Where the
    others do not fit a broadcast, a hot bucket is one row on their side, so adaptive execution splits the rows that meet it.
    """
    several = banded.groupBy(*BAND).agg(F.min(id_column).alias("a_id"), F.max(id_column).alias("_high")).where("a_id <> _high")
    met = banded.join(several.drop("_high"), BAND).where(F.col(id_column) != F.col("a_id"))
    return met.select("a_id", F.col(id_column).alias("b_id"))


def near_duplicates(
    df: DataFrame, id_column: str = "id", prompt: str = "prompt", min_score: float | None = None
) -> DataFrame:
    """Every duplicate with its survivor and their signature score; ids are unique.

    All rows are hashed for their bands only, three hashes.  Whole signatures are made for the rows of pairs, a few percent
    of most corpora, from a second scan of ``df``.
    """
    pairs = materialize(survivor_pairs(materialize(bands(df, id_column, prompt), "bands"), id_column), "pairs")
    paired = pairs.select(F.col("a_id").alias(id_column)).union(pairs.select("b_id")).distinct()
    few = df.join(paired, id_column, "left_semi").select(id_column, prompt)
    # few rows with much work each: a number of its own keeps adaptive execution from putting them into one task
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = signatures(few.repartition(tasks, id_column), id_column, prompt)
    # a duplicate occurs once, its survivor as often as its bucket is large
    return score_pairs(pairs, materialize(signed, "signatures"), id_column, min_score, repeated=["a"])
