"""A training corpus from documents: quality, near-duplicates, secrets, mix, tokens.

Each stage is one operator of ``winnow.llm``, works on all that the one before it kept, and reads Parquet.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import bayes_dedup, bpe, mixing, quality_vote, secrets
from winnow.session import new_path

WIDTH = 5  # words in a shingle
NO_ID = 1 << 61  # ids from here on are those of rows without one
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _apart(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with every column but those an operator reads under a private name, out of reach of the names it adds."""
    return docs.select(*(F.col(f"`{c}`").alias(c if c in used else f"__{i}") for i, c in enumerate(docs.columns)))


def _back(rows: DataFrame, docs: DataFrame, *used: str, **new: Column) -> DataFrame:
    """The columns of ``docs`` under their own names again, some of them new."""
    old = {c: F.col(c if c in used else f"__{i}") for i, c in enumerate(docs.columns)}
    return rows.select(*((new.get(c, old[c])).alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' vote does not reject, as they came.

    Null and empty texts score the share of good labels, as ``quality_vote.score`` states; without labels nothing is rejected.
    Repeated rows share their fate, ties and long texts are those of the operator, an empty table stays empty.
    """
    model = quality_vote.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _back(quality_vote.score(_apart(docs, "text"), model).where("predicted = 1"), docs, "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the least id.

    Rows that repeat an id are one document, whether they have one text or several: the row least by text (nulls first), then
    by a digest of the whole row, stands for it.  A row without an id gets one for this stage that follows from its text and
    lies above all others, so it stays only where nothing with an id is a copy of it, one row of each text.  Texts without
    words are no copies of each other.  An empty table stays empty.

    Only rows of ids that repeat are grouped, with a partial minimum in front of the shuffle, so no id is a hot key.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID) + F.pmod(F.xxhash64("text"), F.lit(NO_ID)))
    found = bayes_dedup.near_duplicates(docs.select(key.alias("doc_id"), "text"), "doc_id", "text", width=WIDTH)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("__key")).distinct()
    keyed = docs.select(key.alias("__key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    left = keyed.join(gone, "__key", "left_anti")
    many = docs.select(key.alias("__key")).groupBy("__key").count().where("count > 1").select("__key")
    rank = F.struct("__row.text", F.sha2(F.to_json("__row"), 256))
    again = left.join(many, "__key", "left_semi").groupBy("__key").agg(F.min_by("__row", rank).alias("__row"))
    return left.join(many, "__key", "left_anti").unionByName(again).select("__row.*")


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars`` follows the text and keeps its type.

    Null texts stay null and have no number of characters.  Everything else of a row stays as it is, repeated rows alike; an
    empty table stays empty.
    """
    masked = secrets.redact(_apart(docs, "text"), "text")
    return _back(masked, docs, "text", n_chars=F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice, as it came.

    Null sources are one source and null texts have no words, as ``mixing.mix`` states; repeated rows fare alike.
    """
    used = ("doc_id", "text", "source")
    taken = mixing.mix(_apart(docs, *used)).where("copies > 0")
    return _back(taken.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))), docs, *used)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, the ids of every document, their number and digest, and whether they decode to its text.

    Null texts count as empty and have no ids.  The decoded text is compared where it is made.
    """
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), TOKENIZER, digests=True)
    return encoded.select("doc_id", "source", "ids", "n_tokens", "ids_sha256", "round_trip")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", hide_secrets),
    ("mix", mix),
    ("tokens", tokens),
]

#: The votes, the linking and the tokens are beyond SQL; ``tests/llm/test_pipeline.py`` runs them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
