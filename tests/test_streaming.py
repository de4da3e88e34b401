import shutil

import pytest
from pyspark.sql import functions as F

from winnow.functions.prompts import training_prompt
from winnow.operators import dedup
from winnow.plans import queries
from winnow.sources import ingest
from winnow.streaming import jobs, state

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def feed(spark, documents, tmp_path):
    """A folder with the first half of the documents and a way to add the second."""
    path = f"{tmp_path}/feed"
    documents.where("doc_id < 100").coalesce(1).write.parquet(path)

    def add():
        documents.where("doc_id >= 100").coalesce(1).write.mode("append").parquet(path)

    stream = ingest.load_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, path, SCHEMA)
    return stream, add


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_bronze_takes_up_new_files_once(spark, feed, tmp_path):
    stream, add = feed
    out, progress = f"{tmp_path}/bronze", f"{tmp_path}/progress"
    for expected in (100, 100):
        jobs.to_bronze(stream, out, progress).awaitTermination()
        assert spark.read.parquet(out).count() == expected
    add()
    for _ in range(2):
        jobs.to_bronze(stream, out, progress).awaitTermination()
        bronze = spark.read.parquet(out)
        assert ids(bronze) == list(range(200))
    assert bronze.where("update_timestamp IS NULL").count() == 0
    assert bronze.select("update_timestamp").distinct().count() == 2


def test_silver(spark, feed, documents, tmp_path):
    stream, add = feed
    add()

    def clean(df):
        return df.select("doc_id", training_prompt("text", "lang").alias("prompt"))

    jobs.to_silver(stream, clean, f"{tmp_path}/silver", f"{tmp_path}/progress").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/silver").exceptAll(clean(documents)).count() == 0
    assert spark.read.parquet(f"{tmp_path}/silver").count() == 200


def test_dedup_over_batches_equals_batch(spark, feed, documents, tmp_path):
    stream, add = feed
    out, progress = f"{tmp_path}/out", f"{tmp_path}/progress"

    def run():
        jobs.to_deduplicated(stream, out, progress, "doc_id", "text").awaitTermination()
        return ids(spark.read.parquet(f"{out}/kept")), spark.read.parquet(f"{out}/quarantine")

    run()
    add()
    expected = ids(dedup.keep_first(documents, "doc_id", "text"))
    for _ in range(2):
        kept, quarantine = run()
        assert kept == expected
        assert sorted(kept + ids(quarantine)) == list(range(200))
    reasons = {tuple(r.reason): r["count"] for r in quarantine.groupBy("reason").count().collect()}
    assert reasons == {("near_duplicate",): 16, ("too_short",): 2}
    # a batch that ran but was not recorded as done is run again and changes nothing
    shutil.rmtree(f"{progress}/commits")
    kept, quarantine = run()
    assert kept == expected
    assert sorted(kept + ids(quarantine)) == list(range(200))


def test_drop_repeats(spark, documents, tmp_path):
    path = f"{tmp_path}/feed"
    copies = documents.select("doc_id", "text", F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, doc_id)").alias("at"))
    copies.repartition(4).write.parquet(path)
    for spread in (None, "doc_id"):
        stream = ingest.load_stream(spark, "parquet", path=path, schema="doc_id long, text string, at timestamp")
        once = jobs.drop_repeats(stream, "at", "1 day", ["text"], spread_by=spread)
        out = f"{tmp_path}/out-{spread}"
        jobs.append_stream(once, out, f"{out}-progress").awaitTermination()
        got = [r.text for r in spark.read.parquet(out).select("text").collect()]
        assert sorted(got) == sorted(r.text for r in documents.select("text").distinct().collect())


def test_drop_repeats_merges_a_hot_key_without_a_state_of_its_own(spark, tmp_path):
    """All but a few copies go before the shuffle, into one state; a late copy ahead of one in time does not take it along."""
    feed, out = f"{tmp_path}/feed", f"{tmp_path}/out"
    at = "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, {}, 0)"
    hot = spark.range(0, 3000).selectExpr("id", "array(if(id % 100 = 0, string(id), 'hot')) AS k", f"{at.format('10')} AS at")
    late = spark.sql(
        f"SELECT 5000L AS id, array('x') AS k, {at.format('1')} AS at UNION ALL SELECT 5001L, array('x'), {at.format('11')} "
        f"UNION ALL SELECT 5002L, array('y'), {at.format('1')} UNION ALL SELECT 5003L, array('hot'), {at.format('10')} "
        f"UNION ALL SELECT 5004L, CAST(NULL AS ARRAY<STRING>), {at.format('11')} UNION ALL SELECT 5005L, NULL, {at.format('11')}"
    )
    operators = []
    for rows in (hot, late):
        rows.coalesce(1).write.mode("append").parquet(feed)
        stream = ingest.load_stream(spark, "parquet", path=feed, schema="id long, k array<string>, at timestamp")
        query = jobs.append_stream(jobs.drop_repeats(stream, "at", "1 hour", ["k"], ahead=True), out, f"{out}-progress")
        query.awaitTermination()
        operators += [p["stateOperators"] for p in query.recentProgress]
    got = [tuple(r.k) if r.k else None for r in spark.read.parquet(out).collect()]
    assert sorted(k for k in got if k) == sorted([("hot",), ("x",), *((str(i),) for i in range(0, 3000, 100))])
    assert got.count(None) == 1
    assert {len(o) for o in operators} == {1}
    assert sum(o[0]["customMetrics"]["numDroppedDuplicateRows"] for o in operators) < 10


def test_latest_of_task_keeps_one_in_time(spark):
    """Of a key, rows that no earlier one of the task is as late as; rows without a time go where there is another."""
    times = [("a", 3), ("b", None), ("a", 3), ("a", 2), ("a", 5), ("b", None), ("b", 1), (None, 4), (None, 4)]
    made = " UNION ALL ".join(f"SELECT {i} AS i, {repr(k) if k else 'CAST(NULL AS STRING)'} AS k, timestamp_seconds({t or 'CAST(NULL AS INT)'}) AS at" for i, (k, t) in enumerate(times))
    rows = spark.sql(made).coalesce(1).sortWithinPartitions("i")
    with_size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(with_size)
    try:
        found = {}
        for size in ("100", "1"):
            spark.conf.set(with_size, size)
            found[size] = sorted(r.i for r in state.latest_of_task(rows, ["k"], "at").collect())
    finally:
        spark.conf.set(with_size, before)
    assert found == {"100": [4, 6, 7], "1": [0, 1, 4, 6, 7]}


def test_stream_drop_repeats_deals_out_texts_and_has_one_state(spark, monkeypatch):
    started, start, hashed, bands = [], jobs.append_stream, [], dedup.bands
    monkeypatch.setattr(jobs, "append_stream", lambda *given: started.append(start(*given)) or started[-1])
    monkeypatch.setattr(dedup, "bands", lambda df, *given: hashed.append(df) or bands(df, *given))
    rows = queries.stream_drop_repeats(spark, "/root/testdata/sf0.001")
    assert rows.count() == rows.distinct().count() > 0
    assert {len(p["stateOperators"]) for p in started[0].recentProgress} == {1}
    assert "RepartitionByExpression [doc_id" in hashed[0]._jdf.queryExecution().analyzed().toString()


def test_dedup_reads_nothing_of_earlier_batches(spark, documents, tmp_path):
    """With the tables of every batch taken away before the next, the rows of the next are still decided rightly."""
    feed, out, progress = f"{tmp_path}/feed", f"{tmp_path}/out", f"{tmp_path}/progress"
    expected, kept, aside = ids(dedup.keep_first(documents, "doc_id", "text")), [], []
    stream = None
    for i in range(8):
        part = documents.where(F.floor(F.col("doc_id") / 25) == i)
        again = documents.where(F.col("doc_id") < 5)  # ids that came before are skipped
        part.union(again).coalesce(1).write.mode("append").parquet(feed)
        stream = stream or ingest.load_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, feed, SCHEMA)
        query = jobs.to_deduplicated(stream, out, progress, "doc_id", "text")
        query.awaitTermination()
        assert query.lastProgress["numInputRows"] == 30
        kept += ids(spark.read.parquet(f"{out}/kept"))
        aside += ids(spark.read.parquet(f"{out}/quarantine"))
        shutil.rmtree(out)
    assert sorted(kept) == expected and sorted(kept + aside) == list(range(200))


def test_dedup_of_a_hot_band_and_odd_rows(spark, tmp_path):
    """Most rows are copies; the lowest id of the batch is kept, and rows without id or shingle are all accounted for."""
    same = "one text that most of the rows of this batch have in common"
    rows = [(900 - i, same, i) for i in range(600)] + [(None, same, -1), (None, same, -1), (None, "another text without any id", -2), (1, None, -3), (2, "short", -4)]
    feed, out = f"{tmp_path}/feed", f"{tmp_path}/out"
    spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(5).write.parquet(feed)
    stream = ingest.load_stream(spark, "parquet", path=feed, schema="doc_id long, text string, n int")
    jobs.to_deduplicated(stream, out, f"{tmp_path}/progress", "doc_id", "text").awaitTermination()
    kept = {(r.doc_id, r.text) for r in spark.read.parquet(f"{out}/kept").collect()}
    assert kept == {(301, same), (None, "another text without any id")}
    why = {tuple(r.reason): r["count"] for r in spark.read.parquet(f"{out}/quarantine").groupBy("reason").count().collect()}
    # rows without an id that are equal in everything are one row
    assert why == {("near_duplicate",): 600, ("null_text",): 1, ("too_short",): 1}


def test_kept_apart_frees_state_and_leaves_out_late_rows(spark, tmp_path):
    feed, out = f"{tmp_path}/feed", f"{tmp_path}/out"
    at = lambda hours: f"timestamp'2024-01-01' + make_interval(0, 0, 0, 0, {hours}, 0)"
    batches = [
        [(1, "a", 0), (2, "a", 1), (3, "b", 1), (4, None, 1)],
        [(5, "a", 2), (6, "a", 3), (7, "c", 3), (8, "c", 3)],  # 5 is exactly at the bound, 6 beyond it
        [(9, "b", 9), (10, None, 9), (11, "d", 10)],
        [(12, "a", 6), (13, "b", 11), (14, "b", 12), (15, "c", None)],  # 12 is late
        [(16, "e", 30)],
        [(17, "e", 31)],
    ]
    schema, queries = "n long, k string, at timestamp", []
    for i, rows in enumerate(batches):
        made = " UNION ALL ".join(f"SELECT {n}L AS n, {repr(k) if k else 'CAST(NULL AS STRING)'} AS k, {at(h) if h is not None else 'CAST(NULL AS TIMESTAMP)'} AS at" for n, k, h in rows)
        spark.sql(made).coalesce(1).write.mode("append").parquet(feed)
        stream = ingest.load_stream(spark, "parquet", path=feed, schema=schema)
        query = jobs.to_kept_apart(stream, out, f"{out}-progress", "at", "2 hours", ["k"], "n")
        query.awaitTermination()
        queries.append(query)
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [1, 3, 4, 6, 7, 9, 10, 11, 14, 16]
    operators = [p["stateOperators"][0] for q in queries for p in q.recentProgress]
    assert sum(o["numRowsDroppedByWatermark"] for o in operators) == 1
    totals = [o["numRowsTotal"] for o in operators]
    assert sum(o["numRowsRemoved"] for o in operators) > 0 and totals[-1] < max(totals)


def test_keep_apart_does_not_depend_on_the_batches(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", F.col("user_id"), F.col("ts").cast("timestamp").alias("ts"))
    found = []
    for files in (1, 3):
        feed = f"{tmp_path}/feed{files}"
        for i in range(files):
            events.where(F.floor(F.col("event_id") * files / 1000) == i).coalesce(1).write.mode("append").parquet(feed)
        stream = ingest.load_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, feed, events.schema)
        jobs.to_kept_apart(stream, f"{feed}-out", f"{feed}-progress", "ts", "1 day", ["user_id"], "event_id").awaitTermination()
        found.append(sorted(r.event_id for r in spark.read.parquet(f"{feed}-out").collect()))
    assert found[0] == found[1] and 15 < len(found[0]) < 1000


def test_keep_apart_calls_for_slots_not_for_keys(spark, tmp_path, monkeypatch):
    """With as many keys as rows the state is asked for once a slot; odd keys are told apart, rows come out as they came in."""
    monkeypatch.setattr(state, "KEY_SLOTS", 3)
    at = "timestamp_micros(1704067200000001 + id * 1000)"
    rows = spark.range(0, 500).selectExpr("id AS n", f"{at} AS at", "IF(id % 5 = 0, NULL, string(id)) AS k", "IF(id = 7, NULL, -0.0D * (id % 2)) AS d", "named_struct('a', id) AS s")
    rows = rows.unionByName(rows.withColumn("n", F.col("n") + 1000).withColumn("d", F.col("d") + F.lit(0.0)))
    rows.repartition(2).write.parquet(f"{tmp_path}/feed")
    stream = ingest.load_stream(spark, "parquet", path=f"{tmp_path}/feed", schema=rows.schema)
    query = jobs.to_kept_apart(stream, f"{tmp_path}/out", f"{tmp_path}/progress", "at", "1 hour", ["k", "d"], "n")
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    expected = rows.where("n < 1000 AND n % 5 <> 0").union(rows.where("n = 0"))
    assert got.dtypes == rows.dtypes and got.exceptAll(expected).count() == 0 and got.count() == expected.count()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 6


def test_dedup_asks_no_python_for_a_band_and_skipped_rows_mark_none(spark, tmp_path):
    """Row 1 comes again with another text, which is skipped: its band is still new when row 5 brings it."""
    feed, out = f"{tmp_path}/feed", f"{tmp_path}/out"
    said = {c: " ".join(f"{c}{i * i}" for i in range(20)) for c in "abc"}
    batches = [[(1, said["a"]), (2, said["b"])], [(1, said["c"])], [(5, said["c"]), (4, said["b"]), (3, None), (None, said["c"])]]
    for rows in batches:
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(feed)
    stream = ingest.load_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, feed, "doc_id long, text string")
    query = jobs.to_deduplicated(stream, out, f"{tmp_path}/progress", "doc_id", "text")
    query.awaitTermination()
    kept, aside = spark.read.parquet(f"{out}/kept"), spark.read.parquet(f"{out}/quarantine")
    assert {(r.doc_id, r.text, r.batch_id) for r in kept.collect()} == {(1, said["a"], 0), (2, said["b"], 0), (5, said["c"], 2)}
    why = {(r.doc_id, *r.reason) for r in aside.collect()}
    assert why == {(4, "near_duplicate"), (3, "null_text"), (None, "near_duplicate")}
    assert {s["operatorName"] for p in query.recentProgress for s in p["stateOperators"]} == {"dedupe"}


def test_feed_has_batches_of_several_files(spark, tmp_path, monkeypatch):
    """No task writes a whole batch of a large table; a part with few rows does not move the batches behind it."""
    monkeypatch.setattr(queries, "PIECE_BYTES", 300)
    rows = spark.range(0, 400).selectExpr("id", "CAST(IF(id < 200, 0, IF(id = 200, 1, 2)) AS INT) AS part")
    stream = queries._feed(rows, "part", 3).withColumn("file", F.input_file_name())
    seen = []
    writer = stream.writeStream.foreachBatch(
        lambda df, n: seen.append(tuple(df.agg(F.count("*"), F.min("id"), F.count_distinct("file")).first()))
    )
    query = writer.option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [s[:2] for s in seen] == [(200, 0), (1, 200), (199, 201)]
    assert seen[0][2] > 1 and seen[2][2] > 1
