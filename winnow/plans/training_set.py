"""From raw sources to an exported training set."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.prompts import format_prompt
from winnow.operators import dedup, entities, ids, quality, split, standardize
from winnow.session import materialize
from winnow.sources import export, tables

GOLD_COLUMNS = ("prompt", "response", "source")

Find = Callable[[str], Column]


@dataclass(frozen=True)
class TrainingSet:
    """Silver rows split three ways; ``kept``, ``duplicates`` and ``rejected`` together hold all of them."""

    kept: DataFrame
    duplicates: DataFrame
    rejected: DataFrame

    @property
    def gold(self) -> DataFrame:
        return self.kept.select(*GOLD_COLUMNS)

    @property
    def quarantine(self) -> DataFrame:
        return self.duplicates.unionByName(self.rejected, allowMissingColumns=True)


def _scrubbed(df: DataFrame, columns: Sequence[str], find: Find) -> DataFrame:
    return df.withColumns({c: entities.scrub(c, find(c)) for c in columns})


def clean_instruct(
    bronze: DataFrame,
    find: Find = entities.detect_patterns,
    keep: Sequence[str] = (),
    scrub: Sequence[str] = ("prompt", "response"),
) -> DataFrame:
    """The instruct source, which has the standard columns already; ``scrub`` names those to take personal data out of."""
    columns = {"prompt": "prompt", "response": "response"}
    return standardize.standardize(_scrubbed(bronze, scrub, find), columns, keep=keep)


def clean_code_gen(
    bronze: DataFrame,
    source: str,
    style: str = "training",
    keep: Sequence[str] = (),
    find: Find = entities.detect_patterns,
    scrub: Sequence[str] = ("instruction", "input", "output"),
) -> DataFrame:
    """An (instruction, input, output) source, scrubbed, with the prompt template put in.

    ``scrub`` names the columns to take personal data out of, before the template goes around them.
    """
    prompt = format_prompt("instruction", "input", style)
    return standardize.standardize(_scrubbed(bronze, scrub, find), {"prompt": prompt, "response": "output"}, source, keep)


def silver(frames: Sequence[DataFrame], order_by: Sequence[str], start: int = 0) -> DataFrame:
    """All sources in one frame under consecutive ids, in the order of ``order_by``, a unique key.

    The order decides which of two near-duplicates stays, so it must not be left to the layout.  The sources are
    computed once, whatever they cost.
    """
    return ids.assign_ids(standardize.consolidate(frames), order_by, start)


def build(
    silver_rows: DataFrame, threshold: int | None = None, known: DataFrame | None = None
) -> TrainingSet:
    """Set aside rows that cannot be used and near-duplicates of rows with a lower id.

    ``known`` holds the bands that earlier batches have kept; their near-duplicates are set aside too.
    """
    good, rejected = quality.split_quality(silver_rows, required=["response"], threshold=threshold)
    kept, duplicates = dedup.split_duplicates(good, known=known)
    return TrainingSet(kept, duplicates, rejected)


def store(built: TrainingSet, kept_table: str, quarantine_table: str, gold_view: str) -> DataFrame:
    """Insert the rows that are new by id into both tables and publish the gold columns as a view."""
    spark = built.kept.sparkSession
    tables.insert_new(built.kept, kept_table)
    tables.insert_new(built.quarantine, quarantine_table)
    return tables.publish_view(spark, gold_view, kept_table, GOLD_COLUMNS)


def export_splits(
    gold: DataFrame,
    path: str,
    weights: Mapping[str, float] | None = None,
    shards: int = export.SHARDS,
    style: str = "training",
) -> dict[str, DataFrame]:
    """Write each split as shards and as JSON lines below ``path``; returns the shard index per split.

    The gold set is computed once and staged with its split; every output reads that.
    """
    names = list(weights) if weights else ["train", "test"]
    marked = materialize(split.with_split(gold, weights=weights), "gold")
    indexes = {}
    for name in names:
        rows = marked.where(F.col("split") == name).drop("split")
        indexes[name] = export.write_shards(rows, f"{path}/{name}", shards=shards, style=style)
        export.write_jsonl(rows, f"{path}/jsonl/{name}")
    return indexes
