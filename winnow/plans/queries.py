"""One query per operator over the whole tables; ``oracles`` holds the same results in plain SQL."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.functions import minhash, prompts, repair, text
from winnow.functions.sql import register_all
from winnow.operators import (
    dedup,
    entities,
    inference,
    latest,
    names,
    quality,
    split,
    standardize,
    upsert,
)
from winnow.plans import training_set
from winnow.session import materialize, new_path, own, spread_scan
from winnow.sources import compaction, export, ingest, paged, tables
from winnow.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

STAMP = "2024-01-01 00:00:00"
INSTRUCT = "conversations"
CODE_GEN = "documents"
PIECE_BYTES = 64 << 20  # of a table, to be cut into one large and many small files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for CPU-bound work; see ``spread_scan`` for tables of a single split."""
    return spread_scan(table(spark, sf_dir, "documents"), "doc_id")


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.turn_pairs(table(spark, sf_dir, "conversations"))


def _map(scan: Query, **columns: Callable[[str], Column]) -> Query:
    """A map-only query over documents: each column is a function of the text."""
    return lambda spark, sf_dir: scan(spark, sf_dir).select(
        "doc_id", *(make("text").alias(name) for name, make in columns.items())
    )


def plain_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _prompted(template: Callable[[str], Column]) -> Query:
    """Every user turn, answered or not."""
    return lambda spark, sf_dir: table(spark, sf_dir, "conversations").where("role = 'user'").select(
        "conv_id", "turn", template("text").alias("prompt")
    )


# ---- near-duplicate removal -------------------------------------------------------------------


def near_dup_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup.keep_first(documents(spark, sf_dir), "doc_id", "text")
    return kept.select("doc_id", "text", "source", *dedup.BAND)


def near_dup_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantine = dedup.split_duplicates(documents(spark, sf_dir), "doc_id", "text")
    return quarantine.select("doc_id", "text", "source", *dedup.BAND, F.array_join("reason", ",").alias("reason"))


def _bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(dedup.bands(documents(spark, sf_dir), "doc_id", "text"), "bands")


def near_dup_bucket_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.bucket_rank(_bands(spark, sf_dir), "doc_id").select("doc_id", *dedup.BAND, "DupRank")


def near_dup_bucket_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.bucket_sizes(dedup.bands(documents(spark, sf_dir), "doc_id", "text"))


def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_pairs(_bands(spark, sf_dir), "doc_id")


def near_dup_pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = dedup.near_duplicates(documents(spark, sf_dir), "doc_id", "text")
    return scored.select(
        "a_id", "b_id", F.round(F.col("score").cast("double"), 6).alias("score"), F.round("equal_share", 6).alias("equal_share")
    )


def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = dedup.signatures(documents(spark, sf_dir), "doc_id", "text")
    return signed.select("doc_id", F.array_join("hashes", ",").alias("hashes"))


def band_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.bands(documents(spark, sf_dir), "doc_id", "text")


def shingle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of each document, distinct fingerprints among them, and their extremes."""
    prints = documents(spark, sf_dir).select(
        "doc_id", minhash.shingle_count("text").alias("n_shingles"), minhash.fingerprints("text").alias("f")
    )
    return prints.select(
        "doc_id",
        "n_shingles",
        F.size("f").alias("n_fingerprints"),
        F.array_min("f").alias("lowest"),
        F.array_max("f").alias("highest"),
    )


# ---- text and prompts -------------------------------------------------------------------------


def min_length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumnRenamed("text", "prompt")
    return quality.min_length(docs, threshold=50).select("doc_id", "text")


def prompt_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction and context form over documents; the context is none, one or both letters of the language code."""
    context = F.expr("substr(lang, 1, int(doc_id % 3))")
    prompt = prompts.training_prompt("text", "context").alias("prompt")
    return table(spark, sf_dir, "documents").withColumn("context", context).select("doc_id", prompt)


def stop_token_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    generated = F.concat("text", F.lit(text.STOP_TOKEN), "source", F.lit(text.STOP_TOKEN))
    return table(spark, sf_dir, "documents").select("doc_id", text.cut_at_stop(generated).alias("answer"))


def repair_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of four documents damaged (read as Latin-1, as Windows-1252, as both in turn), one left alone; all repaired."""
    once, other = repair.misread("text", "ISO-8859-1"), repair.misread("text", "windows-1252")
    kind = F.col("doc_id") % 4
    damaged = F.when(kind == 1, once).when(kind == 2, other).when(kind == 3, repair.misread(once)).otherwise(F.col("text"))
    docs = documents(spark, sf_dir).select("doc_id", damaged.alias("text"))
    return docs.select("doc_id", repair.repair_decoding("text").alias("text"))


def reply_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers out of serving replies that carry whole documents."""
    candidates = F.array(F.struct(F.col("text")))
    reply = F.to_json(F.struct(F.array(F.struct(candidates.alias("candidates"))).alias("predictions")))
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.reply_text(reply).alias("answer"))


def reply_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All answers out of replies with three candidates: the text of a document, its language and its source."""
    candidates = F.array(*(F.struct(F.col(c).alias("text")) for c in ("text", "lang", "source")))
    reply = F.to_json(F.struct(F.array(F.struct(candidates.alias("candidates"))).alias("predictions")))
    answers = table(spark, sf_dir, "documents").select("doc_id", text.reply_texts(reply).alias("answers"))
    return answers.select("doc_id", F.posexplode("answers").alias("candidate", "answer"))


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_all(spark)
    return spark.sql(
        "SELECT doc_id, normalize_text(text) AS cleaned, format_prompt(text, lang) AS prompt, "
        "inference_prompt(text) AS asked, serving_prompt(text) AS served, strip_punctuation(text) AS stripped, "
        "collapse_whitespace(text) AS collapsed, remove_bad_characters(text) AS printable, nfc(text) AS composed, "
        "scrub_patterns(text) AS scrubbed, scrub_entities(text, detect_patterns(text)) AS replaced, "
        "reply_text(to_json(named_struct('predictions', array(named_struct('candidates', array(named_struct('text', text))))))) "
        "AS reply, cut_at_stop(concat(text, '<|endoftext|>')) AS answer, "
        "round(CAST(minhash_score(array(1, 2, CAST(n_chars AS INT)), array(1, 2, 3)) AS DOUBLE), 6) AS score "
        "FROM {docs}",
        docs=documents(spark, sf_dir),
    )


# ---- personal data ----------------------------------------------------------------------------


def entity_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules find the entities, the general operator replaces them."""
    docs = documents(spark, sf_dir).withColumn("found", entities.detect_patterns("text"))
    return entities.scrub_prompts(docs, "found", "text").select(
        "doc_id", "text", F.size("found").alias("n_entities")
    )


def _codes_in(texts):
    """Detector that names every run of capitals and digits of three or more a code; three are not sure enough."""
    import re

    find = re.compile(r"[A-Z0-9]{3,}").findall
    return [[{"word": w, "entity_group": "CODE", "score": len(w) / 5} for w in find(t)] for t in texts]


def entity_scrub_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detector in Python, loaded once per worker; its weakest finds (score 0.8) are the limit."""
    found = entities.detect("text", lambda: _codes_in, "codes")
    docs = documents(spark, sf_dir).withColumn("found", found)
    return entities.scrub_prompts(docs, "found", "text").select("doc_id", "text")


def with_names(docs: DataFrame) -> DataFrame:
    """Documents with a name of a person put in after one of their words; every second one has a title in front.

    Names are made of syllables that follow from the id: ``name`` and ``titled`` say what was put in.
    """
    syllables = F.array(*map(F.lit, "ba ke li mo nu ra se ti vo za dre fin gal hel jor pim".split()))
    digit = lambda i: F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), i, 1), 16, 10).cast("int")
    made = lambda *at: F.initcap(F.concat(*(F.get(syllables, digit(i)) for i in at)))
    where = F.get(F.array(*map(F.lit, (" met with ", " as told by ", " wrote to "))), digit(9) % 3)
    titled = digit(10) % 2 == 0
    name = F.concat(made(1, 2), F.lit(" "), made(3, 4, 5))
    said = F.concat(where, F.when(titled, "Dr. ").otherwise(""), name, F.lit(" in town "))
    place = F.floor(F.length("text") * digit(11) / 32).cast("int") + 1
    at = F.call_function("locate", F.lit(" "), F.col("text"), place)
    text = F.when(at > 0, F.concat(F.expr("left(text, at - 1)"), said, F.expr("substr(text, at + 1)"))).otherwise(F.concat("text", said))
    return docs.withColumn("at", at).select("doc_id", text.alias("text"), name.alias("name"), titled.alias("titled"))


def named_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names found by a model that learns from those with a title, in documents of which half have one without."""
    docs = with_names(documents(spark, sf_dir)).select("doc_id", "name", "titled", names.windows("text").alias("windows"))
    docs = materialize(docs, "named")
    found = names.detect(docs, names.fit(docs, found="windows"), column="found", found="windows")
    sure = F.filter("found", lambda e: e["score"] >= entities.MIN_SCORE)
    return found.select("doc_id", "name", "titled", F.array_join(F.transform(sure, lambda e: e["word"]), ",").alias("names"))


# ---- standard form, ids, quality, upsert ------------------------------------------------------


def _instruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.format_string("%012d-%06d", "conv_id", "turn").alias("key")
    pairs = turn_pairs(spark, sf_dir).select(key, "prompt", "response", F.lit(INSTRUCT).alias("source"))
    return training_set.clean_instruct(ingest.stamp(pairs, STAMP), keep=["key"])


def _code_gen(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.format_string("%012d", "doc_id").alias("key")
    docs = documents(spark, sf_dir).select(
        key, F.col("text").alias("instruction"), F.col("lang").alias("input"), F.col("source").alias("output")
    )
    return training_set.clean_code_gen(ingest.stamp(docs, STAMP), CODE_GEN, keep=["key"])


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = [_instruct(spark, sf_dir), _code_gen(spark, sf_dir)]
    return training_set.silver(both, order_by=["source", "key"])


def standardize_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = standardize.consolidate([_instruct(spark, sf_dir), _code_gen(spark, sf_dir)])
    when = F.date_format("update_timestamp", "yyyy-MM-dd HH:mm:ss").alias("stamped")
    return both.select("key", "prompt", "response", "source", when)


def consolidate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select("id", "prompt", "response", "source")


def gold_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_set.build(_silver(spark, sf_dir)).gold


def quality_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without Spanish as a language and with every 97th text missing."""
    docs = documents(spark, sf_dir).withColumns(
        {"lang": F.nullif("lang", F.lit("es")), "text": F.when(F.col("doc_id") % 97 != 0, F.col("text"))}
    )
    _, aside = quality.split_quality(docs, "text", ["lang"], threshold=50)
    return aside.select("doc_id", F.array_join("reason", ",").alias("reason"))


def upsert_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document arrives; those with a label are in the target already."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi").withColumn("origin", F.lit("target"))
    return upsert.upsert(docs.withColumn("origin", F.lit("inserted")), known, "doc_id")


def upsert_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents came first; the others must not repeat a band of theirs."""
    banded = materialize(dedup.bands(documents(spark, sf_dir), "doc_id", "text", ["lang"]), "bands")
    first = dedup.survivors(banded.where("lang = 'en'"), "doc_id")
    second = dedup.survivors(banded.where("lang <> 'en'"), "doc_id")
    return upsert.upsert(second, first, dedup.BAND).select("doc_id", *dedup.BAND)


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = F.get_json_object("props", "$.k").cast("bigint")
    events = table(spark, sf_dir, "events").select("user_id", version.alias("version"), "event_id", "event_type")
    return latest.latest_per_key(events, ["user_id"], "version")


# ---- sources, tables, export ------------------------------------------------------------------


def load_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.load_as_strings(spark, f"{sf_dir}/documents.parquet")


def load_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ingest.load_splits(
        spark, {"train": f"{sf_dir}/documents.parquet", "test": f"{sf_dir}/benchmark.parquet"}
    )
    return standardize.consolidate(
        [rows.select(F.lit(name).alias("split"), "text") for name, rows in found.items()]
    )


def load_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "instruct")
    turn_pairs(spark, sf_dir).select("prompt", "response", F.lit(INSTRUCT).alias("source")).write.parquet(path)
    return ingest.load_declared(spark, path)


@contextmanager
def own_database(spark: SparkSession) -> Iterator[None]:
    """A new database in the shared folder as the current one, for as long as it is being filled."""
    home = spark.catalog.currentDatabase()
    name = f"winnow_{uuid.uuid4().hex}"
    tables.use_database(spark, name, new_path(spark, "database"))
    own(name)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(home)


def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze by append, clean by clone and insert, gold by view, in a database of its own."""
    with own_database(spark):
        tables.create(spark, "bronze", "prompt string, response string, source string, update_timestamp timestamp")
        pairs = turn_pairs(spark, sf_dir).select("prompt", "response", F.lit(INSTRUCT).alias("source"))
        docs = table(spark, sf_dir, "documents").select(
            F.col("text").alias("prompt"), F.col("lang").alias("response"), F.lit(CODE_GEN).alias("source")
        )
        for rows in (pairs, docs):
            tables.append(ingest.stamp(rows, STAMP), "bronze")
        tables.clone_empty(spark, "bronze", "clean")
        columns = ["prompt", "response", "source", "update_timestamp"]
        tables.insert_query(spark, "clean", f"SELECT {', '.join(columns)} FROM bronze", columns)
        tables.drop(spark, "bronze")
        return tables.publish_view(spark, "gold", "clean", training_set.GOLD_COLUMNS)


def table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents are in the table when all of them arrive, twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    with own_database(spark):
        tables.insert_new(known.withColumn("origin", F.lit("target")), "target", "doc_id")
        for _ in range(2):
            tables.insert_new(docs.withColumn("origin", F.lit("inserted")), "target", "doc_id")
        return spark.table("target")


def gold_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold set by way of tables and a view."""
    built = training_set.build(_silver(spark, sf_dir))
    with own_database(spark):
        return training_set.store(built, "kept", "quarantine", "gold")


def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, compacted = new_path(spark, "pieces"), new_path(spark, "compacted")
    table(spark, sf_dir, "documents").repartition(32, "doc_id").write.parquet(path)
    return tables.compact(spark, path, compacted)


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a table in a stated order; a top-k, not a full sort."""
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text").orderBy("doc_id").limit(20)


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.with_split(table(spark, sf_dir, "documents"), "text").select("doc_id", "split")


def _split_pairs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return split.split_by_text(turn_pairs(spark, sf_dir).select("prompt", "response"))


def export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "export")
    indexes = [
        export.write_shards(rows, f"{path}/{name}").withColumn("split", F.lit(name))
        for name, rows in _split_pairs(spark, sf_dir).items()
    ]
    return standardize.consolidate(indexes).groupBy("split").agg(
        F.count("*").alias("n_shards"), F.sum("n_rows").alias("n_rows"), F.sum("text_bytes").alias("text_bytes")
    )


def export_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold set from both sources to its files: rows of each split in shards and in JSON lines, read back."""
    path = new_path(spark, "gold-export")
    training_set.export_splits(training_set.build(_silver(spark, sf_dir)).gold, path)
    counts = [
        rows.agg(F.lit(name).alias("split"), F.lit(fmt).alias("format"), F.count("*").alias("n_rows"), F.sum(F.length("prompt")).alias("n_chars"))
        for name in ("train", "test")
        for fmt, rows in (
            ("shards", export.read_shards(spark, f"{path}/{name}")),
            ("jsonl", export.read_jsonl(spark, f"{path}/jsonl/{name}")),
        )
    ]
    return standardize.consolidate(counts)


def export_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "export")
    pairs = turn_pairs(spark, sf_dir)
    export.write_shards(pairs, path)
    return export.verify(pairs, export.read_shards(spark, path))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "jsonl")
    export.write_jsonl(turn_pairs(spark, sf_dir), path)
    return export.read_jsonl(spark, path)


def _paged_events(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A folder for an export in pages, and the events as pages can hold them."""
    events = table(spark, sf_dir, "events")
    return new_path(spark, "export"), events.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")))


def paged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, out of an export in pages of 1,000 rows, four pages a task."""
    path, events = _paged_events(spark, sf_dir)
    paged.write_pages(events, path, ["event_id"])
    return paged.load_pages(spark, path, events.schema, pages_per_task=4)


def stream_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream that is stopped and started again when more pages are there."""
    export_path, events = _paged_events(spark, sf_dir)
    middle = (events.count() // 2000) * 1000
    out = new_path(spark, "stream")
    parts = (events.where(F.col("event_id") < middle), 0), (events.where(F.col("event_id") >= middle), middle // 1000)
    for rows, first in parts:
        paged.write_pages(rows, export_path, ["event_id"], first=first)
        stream = paged.stream_pages(spark, export_path, events.schema, pages_per_task=4)
        jobs.append_stream(stream, out, f"{out}-progress").awaitTermination()
    return spark.read.schema(events.schema).parquet(out)


def export_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh sample of an export, found by its number through the index; ``same`` says that a scan in order agrees."""
    path = new_path(spark, "export")
    export.write_shards(turn_pairs(spark, sf_dir), path)
    total = export.sample_index(spark, path).agg(F.sum("n_rows")).first()[0] or 0
    numbers = spark.range(0, total, 7).withColumnRenamed("id", "sample")
    found = export.locate(spark, path, numbers)
    digest = export.row_digest(export.EXPORT_COLUMNS)
    scanned = export.numbered(spark, path).select(F.col("sample").alias("s"), digest.alias("d"))
    both = found.withColumn("digest", digest).join(scanned, F.col("sample") == F.col("s"), "left")
    return both.select("sample", F.coalesce(F.col("digest") == F.col("d"), F.lit(False)).alias("same"))


def compact_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in large files and many small ones: the small ones are packed, the large ones are left where they are.

    There are one large file and 24 small ones for every ``PIECE_BYTES`` of the table, so no task reads more of a larger one.
    """
    path, docs = new_path(spark, "pieces"), table(spark, sf_dir, "documents")
    pieces = math.ceil(compaction.table_bytes(spark, f"{sf_dir}/documents.parquet") / PIECE_BYTES) or 1
    docs.where("doc_id % 3 <> 0").coalesce(pieces).write.parquet(path)
    docs.where("doc_id % 3 = 0").repartition(24 * pieces, "doc_id").write.mode("append").parquet(path)
    large = max(f.size for f in compaction.data_files(spark, path))
    compaction.pack_small_files(spark, path, target_bytes=large // 2)
    return spark.read.parquet(path)


# ---- inference --------------------------------------------------------------------------------


def batch_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("prompt"))
    return inference.generate(items).select("item_id", "request", "answer")


def _unsteady(failing: bool):
    """A service that answers with the number of characters, and fails on every third request for as long as it is ill."""
    import json

    def load():
        def answer(sent):
            replies = []
            for r in sent:
                if failing and len(r["prompt"]) % 3 == 0:
                    raise ConnectionError("no answer")
                replies.append(json.dumps({"predictions": [{"candidates": [{"text": f"{len(r['prompt'])} characters"}]}]}))
            return replies

        return answer

    return load


def resumed_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents sent to a service that fails for a third of them, then once more; the second run sends only those."""
    docs = documents(spark, sf_dir).select("doc_id", F.col("text").alias("prompt"))
    path = new_path(spark, "answers")
    first = inference.send(docs, path, _unsteady(True), attempts=2, wait=0)
    failed = first.groupBy("digest").agg(F.count("error").alias("n")).select("digest", (F.col("n") > 0).alias("failed_first"))
    failed = materialize(failed, "failed")
    done = inference.send(docs, path, _unsteady(False), attempts=2, wait=0)
    return done.join(failed, "digest").select("doc_id", "failed_first", "answer", "error", "runs")


# ---- streams ----------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream.  A file source takes a folder or a pattern; the pattern also fits a single file."""
    schema = table(spark, sf_dir, name).schema
    return ingest.load_stream(spark, "parquet", path=f"{sf_dir}/{name}.parque[t]", schema=schema)


def _run(spark: SparkSession, start: Callable[[str, str], object]) -> str:
    path = new_path(spark, "stream")
    start(path, f"{path}-progress").awaitTermination()
    return path


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _stream(spark, sf_dir, "events")
    path = _run(spark, lambda out, progress: jobs.to_bronze(events, out, progress))
    stamped = F.col("update_timestamp").isNotNull().alias("stamped")
    return spark.read.parquet(path).select("event_id", "user_id", "event_type", "value", "props", stamped)


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _stream(spark, sf_dir, "documents")

    def clean(rows: DataFrame) -> DataFrame:
        found = entities.detect_patterns("text")
        return rows.select("doc_id", prompts.training_prompt(entities.scrub("text", found), "lang").alias("prompt"))

    path = _run(spark, lambda out, progress: jobs.to_silver(docs, clean, out, progress))
    return spark.read.parquet(path)


def _feed(parts: DataFrame, part: str, count: int) -> DataFrame:
    """A stream of ``count`` batches in the order of ``part``; the column itself is left out.

    A batch is one file for every ``PIECE_BYTES`` of the average part, so no task writes more of a larger table.
    """
    spark, feed, whole = parts.sparkSession, new_path(parts.sparkSession, "feed"), new_path(parts.sparkSession, "parts")
    parts = materialize(parts, "parts", whole)
    files = math.ceil(compaction.table_bytes(spark, whole) / count / PIECE_BYTES) or 1
    for i in range(count):
        rows = parts.where(F.col(part) == i).drop(part)
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(feed)
        # a batch is a number of files: empty ones stand in for those of a part with few rows
        for _ in range(files * (i + 1) - len(compaction.data_files(spark, feed))):
            rows.limit(0).coalesce(1).write.mode("append").parquet(feed)
    return ingest.load_stream(spark, "parquet", path=feed, schema=parts.drop(part).schema, options={"maxFilesPerTrigger": str(files)})


def _eighths(rows: DataFrame, column: Column) -> Column:
    """0 to 7 by equal ranges of a number."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    return F.floor((column - F.lit(low)) / (((high or 0) - (low or 0)) // 8 + 1)).cast("int")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive in eight batches in the order of their ids: what is kept is what a batch run keeps."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    arriving = _feed(docs.withColumn("part", _eighths(docs, F.col("doc_id"))), "part", 8)
    path = _run(spark, lambda out, progress: jobs.to_deduplicated(arriving, out, progress, "doc_id", "text"))
    return spark.read.parquet(f"{path}/kept").select("doc_id", "text", "source", *dedup.BAND)


def stream_keep_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in eight batches in the order of time; one of a user and type goes if one was kept in the six hours before.

    The last one also brings the events of the first again under other ids; they are late by then.
    """
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    parted = events.withColumn("part", _eighths(events, F.unix_micros("ts")))
    again = parted.where("part = 0").withColumns({"event_id": -1 - F.col("event_id"), "part": F.lit(7)})
    arriving = _feed(parted.unionByName(again), "part", 8)
    bound, key = "6 hours", ["user_id", "event_type"]
    path = _run(spark, lambda out, progress: jobs.to_kept_apart(arriving, out, progress, "ts", bound, key, "event_id"))
    return spark.read.parquet(path).select("event_id", "user_id", "event_type", F.unix_micros("ts").alias("micros"))


def stream_drop_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of documents that arrive in one batch, each once.

    The texts are dealt out first: a batch has no more tasks than its files have row groups, few and uneven ones, and hashing
    a text costs many times what its shuffle does.
    """
    docs = _stream(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")
    banded = dedup.bands(ingest.stamp(docs, STAMP), "doc_id", "text", ["update_timestamp"])
    once = jobs.drop_repeats(banded, "update_timestamp", "1 hour", dedup.BAND, ahead=True)
    path = _run(spark, lambda out, progress: jobs.append_stream(once, out, progress))
    return spark.read.parquet(path).select(*dedup.BAND)


QUERIES: dict[str, Query] = {
    "near_dup_keep": near_dup_keep,
    "near_dup_quarantine": near_dup_quarantine,
    "near_dup_bucket_rank": near_dup_bucket_rank,
    "near_dup_bucket_sizes": near_dup_bucket_sizes,
    "near_dup_pairs": near_dup_pairs,
    "near_dup_pair_scores": near_dup_pair_scores,
    "minhash_signatures": minhash_signatures,
    "band_hashes": band_hashes,
    "shingle_counts": shingle_counts,
    "lowercase": _map(plain_documents, text=F.lower),
    "strip_punctuation": _map(documents, text=text.strip_punctuation),
    "collapse_whitespace": _map(documents, text=text.collapse_whitespace),
    "normalize_text": _map(documents, text=text.normalize),
    "remove_bad_characters": _map(documents, text=text.remove_bad_characters),
    "nfc_text": _map(documents, text=text.nfc),
    "repair_text": repair_text,
    "text_length": _map(plain_documents, n=F.length, long=lambda c: text.longer_than(c, 50)),
    "min_length_filter": min_length_filter,
    "prompt_training": prompt_training,
    "prompt_inference": _prompted(prompts.inference_prompt),
    "prompt_serving": _prompted(prompts.serving_prompt),
    "stop_token_cut": stop_token_cut,
    "reply_extract": reply_extract,
    "reply_candidates": reply_candidates,
    "json_extract": json_extract,
    "sql_functions": sql_functions,
    "rule_pii_scrub": _map(documents, text=entities.scrub_patterns),
    "entity_scrub": entity_scrub,
    "entity_scrub_detector": entity_scrub_detector,
    "named_entities": named_entities,
    "standardize_sources": standardize_sources,
    "consolidate_ids": consolidate_ids,
    "gold_set": gold_set,
    "quality_quarantine": quality_quarantine,
    "upsert_by_id": upsert_by_id,
    "upsert_by_band": upsert_by_band,
    "latest_per_key": latest_per_key,
    "load_strings": load_strings,
    "load_splits": load_splits,
    "load_declared": load_declared,
    "table_lifecycle": table_lifecycle,
    "table_upsert": table_upsert,
    "gold_view": gold_view,
    "compact_table": compact_table,
    "preview": preview,
    "hash_split": hash_split,
    "export_manifest": export_manifest,
    "export_gold": export_gold,
    "export_verify": export_verify,
    "jsonl_roundtrip": jsonl_roundtrip,
    "paged_source": paged_source,
    "stream_paged": stream_paged,
    "export_samples": export_samples,
    "compact_small_files": compact_small_files,
    "batch_inference": batch_inference,
    "resumed_inference": resumed_inference,
    "stream_bronze": stream_bronze,
    "stream_silver": stream_silver,
    "stream_dedup": stream_dedup,
    "stream_drop_repeats": stream_drop_repeats,
    "stream_keep_apart": stream_keep_apart,
}
