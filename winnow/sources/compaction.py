"""Compaction of the small files of a parquet folder by bin packing.

Files of the target size and more stay where they are.  The others are packed first-fit decreasing by their sizes, and
each pack becomes one new file.  New files are written to a hidden folder first, then a plan of what comes and what goes is
put down, and only then files change place.  A run that fails before the plan leaves the old set as it is; one that
fails after it is finished by the next run, which looks for plans first.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

TARGET_BYTES = 128 << 20
MARK = "compact-"  # what names of new files begin with
WORK = "_compaction"  # hidden from readers, as all names are that begin with an underscore


class DataFile(NamedTuple):
    name: str
    size: int


class _Folder:
    """A folder in whatever file system it is in."""

    def __init__(self, spark: SparkSession, path: str):
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self._system = self._new(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._new(f"{self.path}/{name}" if name else self.path)

    def files(self, name: str = "") -> list[DataFile]:
        at = self._at(name)
        if not self._system.exists(at):
            return []
        return [DataFile(s.getPath().getName(), s.getLen()) for s in self._system.listStatus(at) if s.isFile()]

    def exists(self, name: str) -> bool:
        return self._system.exists(self._at(name))

    def move(self, old: str, new: str) -> None:
        if not self._system.rename(self._at(old), self._at(new)):
            raise OSError(f"cannot rename {old} to {new} in {self.path}")

    def size(self) -> int:
        return self._system.getContentSummary(self._at("")).getLength()

    def delete(self, name: str) -> None:
        self._system.delete(self._at(name), True)

    def put(self, name: str, text: str) -> None:
        """Write a small file under another name first, so that it is there whole or not at all."""
        out = self._system.create(self._at(f"{name}.tmp"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(f"{name}.tmp", name)

    def get(self, name: str) -> str:
        stream = self._system.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def data_files(spark: SparkSession, path: str) -> list[DataFile]:
    """The parquet files of a folder by name; hidden ones are no data."""
    return sorted(f for f in _Folder(spark, path).files() if f.name.endswith(".parquet") and f.name[0] not in "._")


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a parquet file or folder, from one call to its file system."""
    return _Folder(spark, path).size()


def packs(files: list[DataFile], target_bytes: int) -> list[list[DataFile]]:
    """First-fit decreasing: files below the target in packs of at most the target.

    A pack needs two files that were not made by packing.  No two of those that are left over fit together, so running again
    changes nothing, however small the packed files have become.
    """
    small = sorted((f for f in files if f.size < target_bytes), key=lambda f: (-f.size, f.name))
    found: list[tuple[int, list[DataFile]]] = []
    for file in small:
        for i, (size, pack) in enumerate(found):
            if size + file.size <= target_bytes:
                found[i] = size + file.size, [*pack, file]
                break
        else:
            found.append((file.size, [file]))
    return [p for _, p in found if sum(not f.name.startswith(MARK) for f in p) > 1]


def pack_small_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> int:
    """Pack the small files of a parquet folder; returns how many files went.

    Only files below the target are read, each once, and one task writes one pack, which has at most the target's bytes of
    input.  Names and sizes of files are all that is on the driver.  No other writer may be at work on the folder.
    """
    folder = _Folder(spark, path)
    _finish(folder)
    plan = packs(data_files(spark, path), target_bytes)
    if not plan:
        return 0
    work = f"{WORK}/{uuid.uuid4().hex}"
    of = spark.createDataFrame([(f.name, i) for i, pack in enumerate(plan) for f in pack], "__file string, __pack int")
    rows = spark.read.parquet(*(f"{folder.path}/{f.name}" for pack in plan for f in pack))
    kept = rows.columns
    rows = rows.withColumn("__file", F.col("_metadata.file_name")).join(of, "__file").select(*kept, "__pack")
    # by number, not by hash: packs that share a hash would share a task
    rows.repartitionById(len(plan), "__pack").write.partitionBy("__pack").parquet(f"{folder.path}/{work}")
    old = [f.name for pack in plan for f in pack]
    new = {}
    for i in range(len(plan)):  # a pack of files without rows has none
        for part in folder.files(f"{work}/__pack={i}"):
            if part.name.endswith(".parquet"):
                new[f"{work}/__pack={i}/{part.name}"] = f"{MARK}{uuid.uuid4().hex}.parquet"
    if not new and len(old) == len(data_files(spark, path)):
        new, old = {}, old[1:]  # nothing but empty files: one has to stay, for the schema
    folder.put(f"{work}.plan", json.dumps({"work": work, "new": new, "old": old}))
    _finish(folder)
    return len(old)


def _finish(folder: _Folder) -> None:
    """Carry out the plans that are there.  Each step may have been done before."""
    for file in folder.files(WORK):
        if not file.name.endswith(".plan"):
            continue
        plan = json.loads(folder.get(f"{WORK}/{file.name}"))
        # the old files go first: then a reader in between misses rows rather than counting them twice
        for name in plan["old"]:
            folder.delete(name)
        for written, name in plan["new"].items():
            if not folder.exists(name):
                folder.move(written, name)
        folder.delete(plan["work"])
        folder.delete(f"{WORK}/{file.name}")
