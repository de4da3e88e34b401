"""Read instruction datasets from files, tables and other Spark connectors."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

INSTRUCT_SCHEMA = StructType([StructField(name, StringType(), False) for name in ("prompt", "response", "source")])


def load(
    spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None, path: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Any batch connector by name, its options passed through (files, jdbc, kafka, ...)."""
    reader = spark.read.format(fmt).options(**(options or {}))
    return (reader.schema(schema) if schema else reader).load(path)


def load_stream(
    spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None, path: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Any streaming connector by name, its options passed through (files, kafka, kinesis, rate, ...)."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    return (reader.schema(schema) if schema else reader).load(path)


def require_not_null(df: DataFrame, schema: StructType) -> DataFrame:
    """Make a null in a column declared non-null an error; file readers themselves let it pass."""
    return df.select(
        *(
            F.col(f.name)
            if f.nullable
            else F.coalesce(f.name, F.raise_error(F.lit(f"null in non-null column {f.name}"))).alias(f.name)
            for f in schema.fields
        )
    )


def load_declared(
    spark: SparkSession, path: str, schema: StructType = INSTRUCT_SCHEMA, fmt: str = "parquet"
) -> DataFrame:
    """A dataset with a declared schema, whose non-null columns are checked while reading."""
    return require_not_null(load(spark, fmt, path=path, schema=schema), schema)


def as_strings(df: DataFrame) -> DataFrame:
    """Every column as a string."""
    return df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))


def load_as_strings(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A dataset with whatever columns it has, all of them strings."""
    return as_strings(load(spark, fmt, options, path))


def load_splits(
    spark: SparkSession, paths: Mapping[str, str], schema: StructType | None = None, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """One frame per split that is there: ``train`` always, others such as ``test`` where given."""
    if "train" not in paths:
        raise ValueError("a dataset needs a train split")
    if schema is None:
        return {name: load_as_strings(spark, path, fmt) for name, path in paths.items()}
    return {name: load_declared(spark, path, schema, fmt) for name, path in paths.items()}


def stamp(df: DataFrame, at: datetime | str | None = None) -> DataFrame:
    """Add ``update_timestamp``: ``at``, or the start of the query that runs."""
    when = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumn("update_timestamp", when)
