"""A connector of our own for paged exports: a table cut into numbered pages, as services hand theirs out.

A page is a folder ``page=n`` with one text file.  Its first line says which page it is and how many rows it has, every further
line is a row as JSON.  ``write_pages`` makes such an export from a DataFrame; ``register`` makes Spark read one by the name
``paged``, in batch with pages spread over tasks, and as a stream whose offset is a page number.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from winnow.operators.ids import assign_ids
from winnow.session import materialize

NAME = "paged"
#: Types whose JSON form is read back exactly.
KINDS = (T.StringType, T.LongType, T.IntegerType, T.DoubleType, T.BooleanType)


class BrokenPage(ValueError):
    """A page that is not what its first line says."""


def write_pages(df: DataFrame, path: str, order_by: list[str], rows: int = 1000, first: int = 0) -> None:
    """Write ``df``, in the order of a unique key, as pages of ``rows`` rows from number ``first`` on, beside those that are there.

    Numbers come from ``assign_ids``, so pages are cut and written in parallel; a page is never larger than ``rows`` rows.
    """
    wrong = [f.name for f in df.schema.fields if not isinstance(f.dataType, KINDS)]
    if wrong:
        raise TypeError(f"pages hold strings, numbers and booleans; cast {', '.join(wrong)}")
    line = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
    numbered = materialize(assign_ids(df.withColumn("__line", line), order_by, id_column="__n"), "pages")
    page = (F.lit(first) + F.expr(f"__n div {rows}")).alias("page")
    pages = numbered.groupBy(page).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("__n", "__line"))).alias("rows"))
    head = F.to_json(F.struct("page", F.col("n").alias("rows")))
    text = F.concat_ws("\n", head, F.transform("rows", lambda r: r["__line"]))
    pages.select("page", text.alias("value")).write.mode("append").partitionBy("page").text(path)


class PageRange(InputPartition):
    """Pages that one task reads."""

    def __init__(self, pages: list[int]):
        super().__init__(pages)
        self.pages = pages


class PagedExport(DataSource):
    """Options: ``path``, and ``pagesPerTask`` (1 unless given).  The schema has to be stated."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(self.options, schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PagedStream(self.options, schema)


class _Pages:
    """What batch and stream share: which pages there are, and the rows of some."""

    def __init__(self, options, schema: T.StructType):
        from pyspark.sql.pandas.types import to_arrow_schema

        if "path" not in options:
            raise ValueError("a paged export needs the option path")
        self.path, self.schema = options["path"], to_arrow_schema(schema)
        self.per_task = int(options.get("pagesPerTask", "1"))

    def _folder(self) -> tuple[fs.FileSystem, str]:
        if "://" not in self.path:
            return fs.LocalFileSystem(), self.path.removeprefix("file:")
        return fs.FileSystem.from_uri(self.path)

    def numbers(self) -> list[int]:
        """The pages that are there, in order."""
        system, folder = self._folder()
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        names = (f.base_name for f in found if f.type == fs.FileType.Directory)
        return sorted(int(n.removeprefix("page=")) for n in names if n.startswith("page="))

    def ranges(self, pages: list[int]) -> list[PageRange]:
        return [PageRange(pages[at : at + self.per_task]) for at in range(0, len(pages), self.per_task)]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        system, folder = self._folder()
        for page in partition.pages:
            yield self._page(system, f"{folder}/page={page}", page)

    def _page(self, system: fs.FileSystem, folder: str, page: int) -> pa.RecordBatch:
        try:
            files = [f.path for f in system.get_file_info(fs.FileSelector(folder)) if not f.base_name.startswith((".", "_"))]
            if len(files) != 1:
                raise BrokenPage(f"{len(files)} files")
            with system.open_input_stream(files[0]) as file:
                head, *lines = file.read().decode().removesuffix("\n").split("\n")
            told = json.loads(head)
            if (told["page"], told["rows"]) != (page, len(lines)):
                raise BrokenPage(f"its first line tells of page {told['page']} with {told['rows']} rows, and {len(lines)} are there")
            rows = [json.loads(line) for line in lines]
            columns = [pa.array([r.get(f.name) for r in rows], f.type) for f in self.schema]
        except Exception as error:
            raise BrokenPage(f"page {page} of {self.path}: {error}") from error
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


class PagedReader(_Pages, DataSourceReader):
    def partitions(self) -> list[PageRange]:
        return self.ranges(self.numbers()) or [PageRange([])]


class PagedStream(_Pages, DataSourceStreamReader):
    """Takes up pages in the order of their numbers; a page that is missing holds up those behind it."""

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        there, page = set(self.numbers()), 0
        while page in there:
            page += 1
        return {"page": page}

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        return self.ranges(list(range(start["page"], end["page"])))

    def commit(self, end: dict) -> None:
        pass  # pages stay where they are


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedExport)


def load_pages(spark: SparkSession, path: str, schema: T.StructType | str, pages_per_task: int = 1) -> DataFrame:
    register(spark)
    return spark.read.format(NAME).schema(schema).option("pagesPerTask", pages_per_task).load(path)


def stream_pages(spark: SparkSession, path: str, schema: T.StructType | str, pages_per_task: int = 1) -> DataFrame:
    register(spark)
    return spark.readStream.format(NAME).schema(schema).option("pagesPerTask", pages_per_task).load(path)
