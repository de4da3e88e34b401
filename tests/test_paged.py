import shutil
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from winnow.sources import paged
from winnow.streaming import jobs

SCHEMA = "n long, text string, x double, ok boolean"


@pytest.fixture
def rows(spark):
    texts = ["plain", None, "", 'quote " and \\', "two\nlines\r\n", "é 👩  ", "x" * 5000]
    made = [(i, texts[i % 7], None if i % 5 == 0 else i / 7, None if i % 3 == 0 else i % 2 == 0) for i in range(95)]
    return spark.createDataFrame(made, SCHEMA).repartition(4)


def content(df):
    return sorted(map(repr, df.collect()))


def test_batch_gives_the_table_and_reads_in_parallel(spark, rows, tmp_path):
    path = f"{tmp_path}/export"
    paged.write_pages(rows, path, ["n"], rows=10)
    assert len(list(Path(path).glob("page=*"))) == 10
    got = paged.load_pages(spark, path, SCHEMA)
    assert content(got) == content(rows) and got.rdd.getNumPartitions() == 10
    assert paged.load_pages(spark, f"file:{path}", SCHEMA, pages_per_task=4).rdd.getNumPartitions() == 3
    first = [r.n for r in paged.load_pages(spark, path, SCHEMA).where(F.col("n") < 10).collect()]
    assert sorted(first) == list(range(10))


def test_an_empty_export(spark, rows, tmp_path):
    assert paged.load_pages(spark, f"{tmp_path}/none", SCHEMA).collect() == []
    paged.write_pages(rows.limit(0), f"{tmp_path}/empty", ["n"])
    assert paged.load_pages(spark, f"{tmp_path}/empty", SCHEMA).collect() == []


def test_a_restarted_stream_goes_on_at_its_page(spark, rows, tmp_path):
    path, out = f"{tmp_path}/export", f"{tmp_path}/out"

    def run():
        query = jobs.append_stream(paged.stream_pages(spark, path, SCHEMA), out, f"{out}-progress")
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    paged.write_pages(rows.where("n < 40"), path, ["n"], rows=10)
    assert run() == 40
    paged.write_pages(rows.where("n >= 50"), path, ["n"], rows=10, first=5)
    assert run() == 0  # page 4 is not there yet
    paged.write_pages(rows.where("n >= 40 AND n < 50"), path, ["n"], rows=10, first=4)
    assert run() == 55 and run() == 0
    assert content(spark.read.parquet(out)) == content(rows)


@pytest.mark.parametrize("damage", ["cut", "other", "empty", "gone"])
def test_a_broken_page_is_an_error_that_names_it(spark, rows, tmp_path, damage):
    path = f"{tmp_path}/export"
    paged.write_pages(rows, path, ["n"], rows=10)
    (file,) = Path(path).glob("page=3/part-*")
    lines = file.read_text().split("\n")
    for crc in Path(path).glob("page=3/.*.crc"):
        crc.unlink()
    if damage == "gone":
        file.unlink()
    elif damage == "other":
        shutil.copy(next(Path(path).glob("page=4/part-*")), file)
    else:
        file.write_text("" if damage == "empty" else "\n".join(lines[:-2]))
    with pytest.raises(PySparkException, match="page 3 of"):
        paged.load_pages(spark, path, SCHEMA).collect()


def test_types_that_json_does_not_keep_are_refused(rows, tmp_path):
    with pytest.raises(TypeError, match="cast at"):
        paged.write_pages(rows.withColumn("at", F.current_timestamp()), f"{tmp_path}/x", ["n"])
