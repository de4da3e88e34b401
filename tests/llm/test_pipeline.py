import collections

import pytest

import corpus_pipeline
from tests.llm.test_bayes_dedup import brute as components
from winnow.llm import quality_vote, secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return dict(out)


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    for name in ("quality", "near_duplicates", "secrets", "mix"):
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality_rejects_what_the_vote_rejects(spark, stages):
    docs = stages["documents"]
    model = quality_vote.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality_vote.score(docs, model).where("predicted = 1").collect()}
    assert set(rows(stages["quality"])) == good and 0 < len(good) < docs.count()


def test_one_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages["quality"].collect()]
    kept = {i for i, _, c in components(before, corpus_pipeline.WIDTH) if i == c}
    assert set(rows(stages["near_duplicates"])) == kept and len(kept) < len(before)


def test_secrets_are_masked_and_nothing_is_lost(stages):
    before, after = rows(stages["near_duplicates"]), rows(stages["secrets"])
    assert set(before) == set(after)
    for i, r in after.items():
        spans = secrets.base_spans(before[i].text)
        assert r.n_chars == len(r.text)
        assert not secrets.base_spans(r.text)
        if not spans and not secrets.parts(before[i].text, spans):
            assert r.text == before[i].text


def test_mix_repeats_documents(stages):
    before, after = stages["secrets"].collect(), stages["mix"].collect()
    copies = collections.Counter(r.doc_id for r in after)
    assert set(copies) <= {r.doc_id for r in before} and max(copies.values()) <= 2
    texts = {r.doc_id: r.text for r in before}
    assert all(r.text == texts[r.doc_id] for r in after)


def test_tokens_of_every_row(stages):
    tokens = stages["tokens"].collect()
    assert collections.Counter(r.doc_id for r in tokens) == collections.Counter(r.doc_id for r in stages["mix"].collect())
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in tokens)


def test_run_equals_the_stages(spark, stages):
    key = lambda r: (r.doc_id, r.ids_sha256)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, stages["tokens"].collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_documents(spark, stages, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, stages["documents"].where("doc_id < 0"), SF).collect() == []


ODD = "doc_id long, text string, lang string, source string, n_chars long, score string, copies int, size string, __row int"


def odd_rows():
    one, two = "the same words stand here in one row after the other until it is long enough", "another text that has nothing to do with it at all, word for word"
    texts = [(1, one), (1, one), (2, one + " again"), (3, two), (3, one), (4, None), (4, None), (5, ""), (None, two), (None, "no id at all here"), (None, "no id at all here"), (None, None), (6, "password = hunter2hunter2")]
    return [(i, t, "en", None if n % 4 == 0 else "s", None if t is None else len(t), f"mine {n}", n, "big", n) for n, (i, t) in enumerate(texts)]


def test_near_duplicates_leaves_one_row_of_each_group(spark):
    docs = spark.createDataFrame(odd_rows(), ODD)
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    left = out.collect()
    assert out.columns == docs.columns and all(tuple(r) in odd_rows() for r in left)
    # the two texts of id 3 tie all copies of both to id 1
    assert sorted((repr(r.doc_id), repr(r.text)[:12]) for r in left) == sorted(
        [("1", "'the same wo"), ("4", "None"), ("5", "''"), ("None", "None"), ("None", "'no id at al"), ("6", "'password = ")]
    )


@pytest.mark.parametrize("name", ["quality", "near_duplicates", "secrets", "mix"])
def test_columns_of_the_caller_come_back_unchanged(spark, name):
    docs = spark.createDataFrame(odd_rows(), ODD)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    assert out.dtypes == docs.dtypes
    given = {r[-1]: r for r in odd_rows()}
    got = out.collect()
    assert got
    for r in got:
        expected = given[r["__row"]]
        if name == "secrets" and r.doc_id == 6:
            assert r.text == "[SECRET]" and r.n_chars == 8 and tuple(r)[5:] == expected[5:]
        else:
            assert tuple(r) == expected


def test_tokens_of_odd_rows(spark):
    got = corpus_pipeline.tokens(spark, spark.createDataFrame(odd_rows(), ODD), SF).collect()
    assert len(got) == len(odd_rows()) and all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
