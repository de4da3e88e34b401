"""Write training sets: sharded with a merged index, or JSON lines."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from winnow.session import materialize

EXPORT_COLUMNS = ("prompt", "response")
# Fixed value: number of shards of a split.
SHARDS = 8


# What a shard folder and the index are called by.
SHARD = "shard"
FILES = "shard int, file string, n_rows bigint, first_row bigint, first_sample bigint, file_bytes bigint"
TASK_BYTES = 256 << 20  # text that one task writes
INDEX = "shard int, n_files int, n_rows bigint, text_bytes bigint, file_bytes bigint, style string"


def _shards(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    schema = ", ".join([*(f"{c} string" for c in columns), f"{SHARD} int"])
    return spark.read.schema(schema).parquet(f"{path}/shards")


def read_shards(spark: SparkSession, path: str, columns: Sequence[str] = EXPORT_COLUMNS) -> DataFrame:
    return _shards(spark, path, columns).drop(SHARD)


def sample_index(spark: SparkSession, path: str) -> DataFrame:
    """``path/files`` as written by ``write_shards``: one row per file with rows, its shard, and where its samples begin.

    Samples are numbered from 0 through the shards in order, their files by name, and the rows of a file as they lie;
    ``first_row`` counts within the shard, ``first_sample`` over all shards.  Empty shards and files take no number.
    """
    return spark.read.schema(FILES).json(f"{path}/files")


def _file_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each file.  No column is read, only what the footers say of the rows."""
    written = spark.read.schema(f"{SHARD} int").parquet(f"{path}/shards")
    return written.groupBy(SHARD, F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("file_bytes")).agg(
        F.count("*").alias("n_rows")
    )


def _sample_numbers(files: DataFrame) -> DataFrame:
    """Running sums over the files: one row each, so a window over all of them is small; texts are no part of it."""
    inside = Window.partitionBy(SHARD).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy(SHARD, "file").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda window: F.coalesce(F.sum("n_rows").over(window), F.lit(0))
    return files.select(
        SHARD, "file", "n_rows", before(inside).alias("first_row"), before(over).alias("first_sample"), "file_bytes"
    )


def _merged(spark: SparkSession, files: DataFrame, told: dict[str, int], shards: int, style: str | None) -> DataFrame:
    """One row per shard, empty ones too, from the rows of files and what was counted while writing."""
    found = {r[SHARD]: r for r in files.groupBy(SHARD).agg(
        F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"), F.sum("file_bytes").alias("file_bytes")
    ).collect()}
    rows = []
    for shard in range(shards):
        r, n = found.get(shard), told.get(f"rows_{shard}") or 0
        if n != (r["n_rows"] if r else 0):
            raise RuntimeError(f"shard {shard} of the export has {r['n_rows'] if r else 0} rows, {n} were written")
        rows.append((shard, r["n_files"] if r else 0, n, told.get(f"bytes_{shard}") or 0, r["file_bytes"] if r else 0, style))
    return spark.createDataFrame(rows, INDEX)


def text_bytes(columns: Sequence[str]) -> Column:
    """UTF-8 bytes of the text of a row."""
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0)).cast("bigint")


def tasks_for(df: DataFrame, columns: Sequence[str], shards: int, task_bytes: int = TASK_BYTES) -> int:
    """Tasks per shard so that each writes about ``task_bytes`` of text; one pass over the columns."""
    total = df.select(text_bytes(columns).alias("n")).agg(F.sum("n")).first()[0] or 0
    return max(1, math.ceil(total / (shards * task_bytes)))


def write_shards(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = EXPORT_COLUMNS,
    shards: int = SHARDS,
    max_rows_per_file: int = 0,
    tasks_per_shard: int | None = None,
    style: str | None = None,
) -> DataFrame:
    """Write even shards to ``path/shards/shard=n``, replacing earlier ones, their merged index to ``path/index`` and the index
    of their files to ``path/files``.

    Rows are dealt out in turn, so copies of a row cannot fill one shard.  Each shard is written by ``tasks_per_shard``
    tasks, a file each; unless given it follows from the bytes of text, ``TASK_BYTES`` a task, which costs a pass over the
    columns, so pass a frame that is cheap to compute twice.  ``max_rows_per_file`` cuts files further.  ``style`` names the
    prompt template in the index, as training and serving wording differ.  Rows and bytes of the shards are counted while
    they are written and checked against the footers of the files; no text is read again.  Returns the merged index, which
    lists empty shards too.
    """
    spark = df.sparkSession
    if tasks_per_shard is None:
        tasks_per_shard = tasks_for(df, columns, shards)
    # the number of a partition is that of its shard and writer; dealing by it is the one shuffle
    dealt = df.select(*columns).repartition(shards * tasks_per_shard)
    dealt = dealt.withColumn(SHARD, (F.spark_partition_id() % shards).cast("int"))
    seen = Observation(f"export-{uuid.uuid4().hex}")
    size, of = text_bytes(columns), lambda n: F.col(SHARD) == n
    counts = [F.count_if(of(n)).alias(f"rows_{n}") for n in range(shards)]
    counts += [F.sum(F.when(of(n), size)).alias(f"bytes_{n}") for n in range(shards)]
    writer = dealt.observe(seen, *counts).write.mode("overwrite").partitionBy(SHARD)
    writer.option("maxRecordsPerFile", max_rows_per_file).parquet(f"{path}/shards")
    _sample_numbers(_file_rows(spark, path)).coalesce(1).write.mode("overwrite").json(f"{path}/files")
    merged = _merged(spark, sample_index(spark, path), seen.get, shards, style)
    merged.coalesce(1).write.mode("overwrite").json(f"{path}/index")
    return spark.read.schema(INDEX).json(f"{path}/index")


def numbered(spark: SparkSession, path: str, columns: Sequence[str] = EXPORT_COLUMNS) -> DataFrame:
    """Every row of an export with its ``sample`` number, by one join of files with the index of files."""
    rows = _shards(spark, path, columns).select(
        *columns, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    index = sample_index(spark, path).select("file", "first_sample")
    return rows.join(index, "file").select((F.col("first_sample") + F.col("row")).alias("sample"), *columns)


def locate(
    spark: SparkSession, path: str, numbers: DataFrame, columns: Sequence[str] = EXPORT_COLUMNS, sample: str = "sample"
) -> DataFrame:
    """The rows with these sample numbers, and the ``shard``, ``file`` and ``row`` where each lies.

    Numbers meet the files by bins as wide as the largest file, of which a file touches two at most.  Then only files that
    hold a wanted row are opened.  A number that occurs several times is found once; one that the export does not have, or a
    null, is left out.
    """
    index = sample_index(spark, path).where("n_rows > 0")
    width = index.agg(F.max("n_rows")).first()[0] or 1
    last = F.col("first_sample") + F.col("n_rows") - 1
    bins = F.explode(F.sequence(F.floor(F.col("first_sample") / width), F.floor(last / width))).alias("bin")
    wanted = numbers.select(F.col(sample).cast("bigint").alias("sample")).where("sample IS NOT NULL").distinct()
    placed = wanted.withColumn("bin", F.floor(F.col("sample") / width)).join(index.select("*", bins), "bin")
    placed = placed.where("sample >= first_sample AND sample < first_sample + n_rows")
    placed = materialize(placed.select("sample", SHARD, "file", (F.col("sample") - F.col("first_sample")).alias("row")), "samples")
    files = [r["file"] for r in placed.select("file").distinct().collect()]  # at most the files of the export
    here = _shards(spark, path, columns).where(F.col("_metadata.file_name").isin(files))
    here = here.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), *columns)
    return placed.join(here, ["file", "row"]).select("sample", SHARD, "file", "row", *columns)


def write_jsonl(df: DataFrame, path: str, columns: Sequence[str] = EXPORT_COLUMNS) -> None:
    """One JSON object per line and row, nulls included, in a folder of files written by the executors."""
    df.select(*columns).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str, columns: Sequence[str] = EXPORT_COLUMNS) -> DataFrame:
    return spark.read.schema(", ".join(f"{c} string" for c in columns)).json(path)


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of a row, in which null and every string are told apart."""
    parts = []
    for c in columns:
        parts += [F.coalesce(F.length(c).cast("string"), F.lit("null")), F.coalesce(F.col(c).cast("string"), F.lit(""))]
    return F.sha2(F.concat_ws(":", *parts), 256)


def verify(expected: DataFrame, written: DataFrame, columns: Sequence[str] = EXPORT_COLUMNS) -> DataFrame:
    """One row: rows and nulls on both sides, and how many rows either lacks.  Zero lacking means equal.

    Rows are compared as multisets of digests that are counted before the shuffle, so neither long
    texts nor many copies of one row travel.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in columns), F.lit(0))
        rows = df.select(row_digest(columns).alias("digest"), nulls.alias("nulls"))
        return rows.groupBy("digest").agg(F.count("*").alias(name), F.sum("nulls").alias(f"{name}_nulls"))

    both = counted(expected, "expected").join(counted(written, "written"), "digest", "full_outer").fillna(0)
    gap = F.col("expected") - F.col("written")
    return both.agg(
        F.sum("expected").alias("expected_rows"),
        F.sum("written").alias("written_rows"),
        F.sum("expected_nulls").alias("expected_nulls"),
        F.sum("written_nulls").alias("written_nulls"),
        F.sum(F.greatest(gap, F.lit(0))).alias("missing_rows"),
        F.sum(F.greatest(-gap, F.lit(0))).alias("extra_rows"),
    ).fillna(0)
