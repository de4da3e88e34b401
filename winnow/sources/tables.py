"""Life cycle of catalog tables.  The table format is a parameter; parquet needs no extra package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from winnow.operators.upsert import not_matched


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    spark.catalog.setCurrentDatabase(name)


def create(spark: SparkSession, name: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    """An empty table with the given columns in place of whatever had the name."""
    drop(spark, name)
    spark.createDataFrame([], schema).write.format(fmt).saveAsTable(name)
    return spark.table(name)


def clone_empty(spark: SparkSession, source: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A table with the columns of ``source`` and no rows, unless the name exists."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} AS SELECT * FROM {source} WHERE 1 = 0")
    return spark.table(name)


def append(
    df: DataFrame, name: str, fmt: str = "parquet", bucket_by: tuple[str, int] | None = None
) -> DataFrame:
    """Append rows, creating the table if need be; columns are matched by name.

    ``bucket_by=("id", n)`` stores the table in ``n`` buckets sorted by id, so that later joins on the id
    do not shuffle its texts.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df = df.select(*spark.table(name).columns)
    writer = df.write.format(fmt).mode("append")
    if bucket_by:
        column, buckets = bucket_by
        writer = writer.bucketBy(buckets, column).sortBy(column)
    writer.saveAsTable(name)
    return spark.table(name)


def insert_new(
    df: DataFrame, name: str, on: str | Sequence[str] = "id", fmt: str = "parquet"
) -> DataFrame:
    """Append the rows whose key is not in the table yet, creating the table if need be.

    Run again with the same rows it adds nothing.  The key must be unique in ``df``.
    """
    spark = df.sparkSession
    new = not_matched(df, spark.table(name), on) if spark.catalog.tableExists(name) else df
    return append(new, name, fmt)


def insert_query(spark: SparkSession, name: str, query: str, columns: Sequence[str] = ()) -> None:
    """``INSERT INTO name [(columns)] query``; without columns they are matched by position."""
    spark.sql(f"INSERT INTO {name}{' (' + ', '.join(columns) + ')' if columns else ''} {query}")


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def publish_view(spark: SparkSession, name: str, table: str, columns: Sequence[str]) -> DataFrame:
    """A view of some columns of a table, in place of an older one."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(columns)} FROM {table}")
    return spark.table(name)


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = 128 << 20) -> DataFrame:
    """Rewrite a parquet folder into files of about ``target_bytes``.

    The rebalance hint lets the engine merge small pieces and split large ones by their true size, so a
    hot value cannot make one huge file.
    """
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    earlier = spark.conf.get(setting)
    spark.conf.set(setting, str(target_bytes))
    try:
        spark.read.parquet(source).hint("rebalance").write.mode("overwrite").parquet(target)
    finally:
        spark.conf.set(setting, earlier)
    return spark.read.parquet(target)
