"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SPREAD_SCANS = "spark.winnow.spreadScans"

_scopes: list[str] = []
_databases: dict[str, list[str]] = {}


def build_session(app_name: str = "winnow", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings this package is tuned for; keyword names use ``__`` for a dot."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # joins of a narrow id table to texts: hash the narrow side where its parts are small at run time,
        # instead of sorting the texts
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "128MB")
        .config("spark.sql.session.timeZone", "UTC")
        # a record batch of long documents must fit a Python worker, so bound it by rows and by bytes
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables; only a local session may do without one."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="winnow-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, below one folder per application, and per scope inside one."""
    scope = f"/{_scopes[-1]}" if _scopes else ""
    return f"{shared_dir(spark)}/winnow/{spark.sparkContext.applicationId}{scope}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever file system it is in."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def own(database: str) -> None:
    """The current scope, if there is one, drops this database when it ends."""
    if _scopes:
        _databases[_scopes[-1]].append(database)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables and databases made inside are removed at the end.

    Results read them until then, so use up or write a result before the scope ends.  Scopes nest; one per thread of work
    at a time.
    """
    name = f"scope-{uuid.uuid4().hex}"
    _scopes.append(name)
    _databases[name] = []
    try:
        yield
    finally:
        for database in _databases.pop(name):
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
        remove(spark, f"{shared_dir(spark)}/winnow/{spark.sparkContext.applicationId}/{name}")
        _scopes.remove(name)


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, or over ``path``, and read it back.

    Used where a costly or layout-dependent frame has several readers: the written table outlives
    lost executors, is read column by column, and gives the optimizer its true size.
    """
    path = path or new_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_scan(df: DataFrame, key: str) -> DataFrame:
    """A table scan, shuffled by a unique key where ``spark.winnow.spreadScans`` is true.

    That is for tables of a single split on a machine with many cores, as in a bench; a large scan has more splits than
    cores and needs no shuffle, so the setting is off unless the caller sets it.  The plan depends on nothing else.
    """
    wanted = df.sparkSession.conf.get(SPREAD_SCANS, "false") == "true"
    return df.repartition(key) if wanted else df
