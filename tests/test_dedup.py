import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.test_minhash import known_signatures
from winnow.functions import minhash
from winnow.operators import dedup
from winnow.session import materialize

SF01 = "/root/testdata/sf0.01/documents.parquet"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize(
    ("path", "n", "kept", "pairs"),
    [("/root/testdata/sf0.001/documents.parquet", 198, 182, 17), (SF01, 995, 894, 134)],
)
def test_known_counts(spark, path, n, kept, pairs):
    docs = spark.read.parquet(path)
    first, rest = dedup.split_duplicates(docs, "doc_id", "text")
    short = docs.where(F.length("text") < 13).count()
    assert (first.count(), rest.count()) == (kept, n - kept + short)
    banded = dedup.bands(docs, "doc_id", "text")
    assert dedup.bucket_sizes(banded).agg(F.sum("n_pairs")).first()[0] == pairs


def test_kept_and_quarantine_are_the_input(spark, documents):
    odd = spark.createDataFrame([(900, "too short"), (901, None), (902, "")], "doc_id long, text string")
    documents = documents.unionByName(odd, allowMissingColumns=True)
    kept, quarantine = dedup.split_duplicates(documents, "doc_id", "text", num_hashes=8)
    assert kept.columns == [*documents.columns, "hashes", *dedup.BAND]
    both = kept.unionByName(quarantine, allowMissingColumns=True)
    assert rows(both, "doc_id", "text") == rows(documents, "doc_id", "text")
    reasons = {r.doc_id: r.reason for r in quarantine.collect()}
    assert [reasons[i] for i in (900, 901, 902)] == [["too_short"], ["null_text"], ["too_short"]]
    quarantine = quarantine.where("hash1 IS NOT NULL")
    assert {tuple(r.reason) for r in quarantine.collect()} == {("near_duplicate",)}
    low = kept.select(*dedup.BAND, F.col("doc_id").alias("low"))
    with_kept = quarantine.join(low, dedup.BAND)
    assert with_kept.count() == quarantine.count()
    assert with_kept.where("low >= doc_id").count() == 0


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_independent_of_layout(documents, parts):
    expected = rows(dedup.keep_first(documents, "doc_id", "text"), "doc_id")
    shuffled = documents.orderBy(F.desc("text")).repartition(parts)
    assert rows(dedup.keep_first(shuffled, "doc_id", "text"), "doc_id") == expected


def plain_rank(banded):
    window = Window.partitionBy(*dedup.BAND).orderBy("id")
    return banded.select(
        "*", F.row_number().over(window).cast("long").alias("DupRank"), F.first("id").over(window).alias("survivor")
    )


@pytest.fixture(scope="module")
def hot(spark):
    """A third of 30,000 rows in one bucket, a few more in middling ones, ids out of order."""
    ids = spark.range(30000).select(((F.col("id") * 7919) % 30011).alias("id"))
    third = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id") % 40).otherwise(F.col("id"))
    return materialize(ids.select("id", *(third.cast("int").alias(c) for c in dedup.BAND)), "hot")


def test_hot_bucket_rank_and_pairs(spark, hot):
    columns = ["id", *dedup.BAND, "DupRank", "survivor"]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # keep the hot bucket in several pieces
    try:
        ranked = dedup.bucket_rank(hot)
        pieces = dedup._pieces(hot, [*dedup.BAND, "id"], "piece").groupBy("piece").count().collect()
        pairs = rows(dedup.duplicate_pairs(hot), "a_id", "b_id")
    finally:
        spark.conf.unset(setting)
    assert rows(ranked, *columns) == rows(plain_rank(hot), *columns)
    assert len(pieces) == 8
    assert max(r["count"] for r in pieces) < 30000 / 8 * 1.5
    expected = plain_rank(hot).where("DupRank > 1")
    assert pairs == rows(expected, F.col("survivor").alias("a_id"), F.col("id").alias("b_id"))


def test_hot_bucket_scores(spark, hot):
    """Every duplicate of the hot bucket is scored although all share one survivor."""
    signed = hot.select("id", F.array(F.lit(1), F.col("id").cast("int")).alias("hashes"))
    pairs = dedup.duplicate_pairs(hot)
    scored = dedup.score_pairs(pairs, signed).drop("equal_share")
    assert scored.count() == pairs.count()
    expected = pairs.select("a_id", "b_id", F.lit(1 / 3).cast("float").alias("score"))
    assert scored.where("a_id > 1 and b_id > 1").exceptAll(expected.where("a_id > 1 and b_id > 1")).count() == 0


def test_scores_equal_brute_force(documents):
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    scored = dedup.near_duplicates(documents, "doc_id", "text").collect()
    assert len(scored) == 16
    for a, b, score, equal in scored:
        left, right = known_signatures([texts[a], texts[b]], minhash.NUM_HASHES)
        shared = len(set(left) & set(right))
        assert score == pytest.approx(shared / (256 - shared), rel=1e-6)
        assert equal == sum(x == y for x, y in zip(left, right)) / minhash.NUM_HASHES
    strict = dedup.near_duplicates(documents, "doc_id", "text", min_score=0.9)
    assert strict.count() == sum(r.score >= 0.9 for r in scored)


def test_copies_and_near_copies(spark):
    base = "The quick brown fox jumps over the lazy dog and runs away."
    texts = [(5, base), (3, base), (9, base), (1, base.upper()), (7, "something else entirely, with no relation")]
    kept = dedup.keep_first(spark.createDataFrame(texts, "id long, prompt string"))
    assert rows(kept, "id") == [(1,), (3,), (7,)]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id long, prompt string")
    kept, quarantine = dedup.split_duplicates(empty)
    assert kept.count() == quarantine.count() == 0
    assert dedup.near_duplicates(empty).count() == 0
