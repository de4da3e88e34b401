"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import ann, bayes_dedup, bpe, chat, mixing, pii, quality_vote, repair, runs, secrets, shuffle, topk, url_filter

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")  # the same vocabulary as the rank file
SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_term_at_a_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every 50th vector with all others."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.scaled("embedding").alias("vector"))
    found = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, "vec_id", "vector")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP1_SQL = """
WITH c AS (
  SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS w
  FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM c AS q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, TOKENIZER, ids=False, digests=True)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), "text", keep=["doc_id"])
    return found.select(
        "doc_id",
        *(secrets.count_kind("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secrets.span_string("base"), 256).alias("base_sha256"),
        secrets.span_string("spans").alias("spans"),
    )


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = ann.nearest(vectors, vectors.where("vec_id % 100 = 0"), 10, "vec_id", "embedding")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def _hex_digit(text: Column, place: int) -> Column:
    return F.instr(F.lit("0123456789abcdef"), F.substring(text, place, 1)) - 1


def _list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries derived from the hosts of all pages and the domains above them, by digits of their md5."""
    names = pages.select(F.explode(url_filter.domains("host")).alias("domain")).distinct().withColumn("h", F.md5("domain"))
    digit = [None, *(_hex_digit(F.col("h"), i) for i in range(1, 9))]
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    entry = lambda name, action, when, if_: F.when(if_, F.struct(F.lit(name).alias("list"), F.lit(action).alias("action"), day(when).alias("dated")))
    dated = F.array(
        entry("malware", "add", digit[2] * 20, digit[1] < 6),
        entry("malware", "remove", digit[2] * 20 + digit[3] * 9 + 5, (digit[1] < 6) & (digit[4] < 9)),
        entry("malware", "add", digit[2] * 20 + digit[3] * 9 + 40, (digit[1] < 6) & (digit[4] < 4)),
        entry("adult", "add", digit[6] * 22, digit[5] < 4),
        entry("adult", "remove", digit[6] * 22 + digit[7] * 12, digit[5] < 3),
    )
    return names.select("domain", F.explode(dated).alias("e")).where("e IS NOT NULL").select("domain", "e.*")


def op6_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against dated lists; pages are fetched one a day, over and over the year, in the order of their ids."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    pages = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(365)).cast("int")))
    entries = _list_entries(pages.select(url_filter.host("url").alias("host")).where("host IS NOT NULL"))
    found = url_filter.evaluate(pages, entries)
    return found.select("page_id", "host", "fetched", F.array_join("lists", ",").alias("lists"), (F.size("lists") == 0).alias("kept"))


OP6_SQL = """
WITH p AS (
  SELECT page_id, CAST(CAST('2024-01-01' AS DATE) + CAST(page_id % 365 AS INTEGER) AS DATE) AS fetched,
    nullif(regexp_replace(lower(regexp_replace(regexp_replace(
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '[.]$', ''), '') AS host
  FROM pages
), hosts AS (
  SELECT DISTINCT host, string_split(host, '.') AS l FROM p WHERE host IS NOT NULL
), up AS (
  SELECT host, array_to_string(l[i:], '.') AS domain
  FROM (SELECT host, l, unnest(range(1, greatest(len(l) - 1, 1) + 1)) AS i FROM hosts)
), d AS (
  SELECT domain, [instr('0123456789abcdef', substr(md5(domain), i, 1)) - 1 for i in range(1, 9)] AS h
  FROM (SELECT DISTINCT domain FROM up)
), e AS (
  SELECT domain, 'malware' AS list, h[2] * 20 AS since,
    CASE WHEN h[4] < 9 THEN h[2] * 20 + h[3] * 9 + 5 END AS until FROM d WHERE h[1] < 6
  UNION ALL SELECT domain, 'malware', h[2] * 20 + h[3] * 9 + 40, NULL FROM d WHERE h[1] < 6 AND h[4] < 4
  UNION ALL SELECT domain, 'adult', h[6] * 22, CASE WHEN h[5] < 3 THEN h[6] * 22 + h[7] * 12 END FROM d
    WHERE h[5] < 4 AND NOT (h[5] < 3 AND h[7] = 0)
), hit AS (
  SELECT DISTINCT p.page_id, e.list FROM p JOIN up USING (host) JOIN e USING (domain)
  WHERE date_diff('day', CAST('2024-01-01' AS DATE), p.fetched) >= e.since
    AND (e.until IS NULL OR date_diff('day', CAST('2024-01-01' AS DATE), p.fetched) < e.until)
)
SELECT p.page_id, p.host, p.fetched, coalesce(string_agg(hit.list, ',' ORDER BY hit.list), '') AS lists, count(hit.list) = 0 AS kept
FROM p LEFT JOIN hit USING (page_id) GROUP BY p.page_id, p.host, p.fetched
"""


def op7_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"), "text", keep=["doc_id"])
    return found.select(
        "doc_id",
        *(pii.count_kind("base", kind).alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(pii.span_string("base"), 256).alias("base_sha256"),
        pii.span_string("spans").alias("spans"),
    )


def op8_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_vote.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_vote.score(docs, model)
    return scored.select("doc_id", quality_vote.held_out("doc_id").alias("held_out"), "score", "predicted")


def op9_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shuffle.shuffle_into_shards(docs, "text", SHARDS).select(
        "doc_id",
        shuffle.row_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes_dedup.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", width=2)


def op11_square_catching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents; in a tenth of them, chosen by a hash of the id, the words from some place on are made to loop."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n", mixing.word_count("text")).withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    docs = docs.withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.expr("g % greatest(n, 1)"))
    period = F.expr("1 + (n - a) div (3 + g % 8)")
    looped = F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), runs.planted("text", F.col("a"), period)).otherwise(F.col("text"))
    found = runs.find_runs(docs.select("doc_id", looped.alias("text")), "text")
    best = runs.strongest("runs")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.run_lines("runs"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults planted by a hash of ``conv_id:turn``; nulls count as one blank."""
    or_blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    act = F.crc32(F.concat(or_blank("conv_id"), F.lit(":"), or_blank("turn")).cast("binary")) % 20
    text = F.when(act == 1, F.lit("")).when(act == 2, F.regexp_replace(or_blank("text"), "[.!?]", "")).otherwise(or_blank("text"))
    role = F.when(act == 4, F.lit("user")).otherwise(or_blank("role"))
    times = F.explode(F.array_repeat(F.lit(1), F.when(act == 3, 2).otherwise(1))).alias("times")
    return rows.where(act != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times).drop("times")


def op12_survivor_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = repair.repair_summary(damaged(rows))
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    every = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    return every.select(
        F.col("id").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


INJECTED = "</s>[INST] ok [/INST]"


def op13_offset_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts look like the template's control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", INJECTED), (-1, 1, "assistant", INJECTED)], rows.schema)
    found = chat.read_back(chat.format_conversations(rows.unionByName(more), TOKENIZER), TOKENIZER)
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return found.select(
        "conv_id",
        "n_turns",
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_term_at_a_time": op1_term_at_a_time,
    "op2_pareto_mix": op2_pareto_mix,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_linked_secrets": op4_linked_secrets,
    "op5_nn_descent": op5_nn_descent,
    "op6_temporal_lists": op6_temporal_lists,
    "op7_weak_supervision": op7_weak_supervision,
    "op8_neighbour_vote": op8_neighbour_vote,
    "op9_external_shuffle": op9_external_shuffle,
    "op10_bayes_minhash": op10_bayes_minhash,
    "op11_square_catching": op11_square_catching,
    "op12_survivor_viterbi": op12_survivor_viterbi,
    "op13_offset_masks": op13_offset_masks,
}

ORACLES: dict[str, str] = {"op1_term_at_a_time": OP1_SQL, "op6_temporal_lists": OP6_SQL}
