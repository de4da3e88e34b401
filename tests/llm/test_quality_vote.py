import random
import zlib

import numpy as np

from winnow.llm import quality_vote, queries

SCHEMA = "doc_id long, text string, score string, predicted string, label int"


def corpus(n, pick=random.Random(3)):
    words = ["and", "river", "stone", "under", "bright", "seldom", "été", "market", "window", "of", "the", "quickly"]
    rows, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        if good:
            text = ". ".join(" ".join(pick.choices(words, k=9)).capitalize() for _ in range(6)) + "."
        else:
            word = pick.choice(words)
            text = [" ".join([word] * 40), " ".join(f"{w.upper()}!!" for w in pick.choices(words, k=40)), " | ".join(pick.choices(words, k=40))][i // 4 % 3]
        rows.append((i, text, "clash", "clash", 9))
        labels.append((i, int(good), "clash"))
    return rows, labels


def make(spark, rows, labels):
    return spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, text string")


def test_held_out_rows_are_predicted(spark):
    docs, labels = make(spark, *corpus(600))
    model = quality_vote.fit(docs, labels, sample=300)
    assert len(model.labels) == 300
    out = quality_vote.score(docs, model)
    assert out.columns == ["doc_id", "text", "label", "score", "predicted"]
    rows = out.select("*", quality_vote.held_out("doc_id").alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.out]
    assert len(held) > 80 and np.mean([r.predicted == (r.doc_id % 4 > 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_held_out_labels_are_never_read(spark):
    rows, labels = corpus(200)
    docs, known = make(spark, rows, labels)
    spoiled = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    first = {r.doc_id: r.score for r in quality_vote.score(docs, quality_vote.fit(docs, known)).collect()}
    second = {r.doc_id: r.score for r in quality_vote.score(docs, quality_vote.fit(docs, make(spark, rows, spoiled)[1])).collect()}
    assert first == second


def test_votes_against_brute_force(spark):
    """Every score is the similarity-weighted share among the nearest labelled vectors, one row at a time."""
    docs, labels = make(spark, *corpus(240))
    model = quality_vote.fit(docs, labels)
    for r in quality_vote.score(docs, model).limit(60).collect():
        vector = (quality_vote.term_counts(r.text) * model.weight) @ model.axes
        vector = vector / np.linalg.norm(vector)
        cosine = model.vectors @ vector
        near = sorted(range(len(cosine)), key=lambda i: -cosine[i])[: quality_vote.NEIGHBOURS]
        weight = np.maximum(cosine[near], 0) ** 8 + 1e-9
        assert abs(r.score - (weight * model.labels[near]).sum() / weight.sum()) < 0.02


def test_edge_rows(spark):
    rows, labels = corpus(80)
    rows += [(200, None, None, None, None), (201, "", "", "", 1), (202, " \n", "", "", 1), (None, "no id", "", "", 1), (203, "long " * 300_000, "", "", 1)]
    rows += [rows[1], rows[1]]
    labels += [(1, 0, "twice"), (None, 1, ""), (300, None, ""), (200, 1, "")]
    docs, known = make(spark, rows, labels)
    model = quality_vote.fit(docs, known)
    got = quality_vote.score(docs, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[200].score == by[201].score == model.prior
    assert len({r.score for r in got if r.doc_id == 1}) == 1


def test_no_labels_and_no_rows(spark):
    docs, labels = make(spark, *corpus(8))
    none = labels.where("doc_id > 100")
    assert quality_vote.fit(docs, none) is None
    assert {(r.score, r.predicted) for r in quality_vote.score(docs, None).collect()} == {(0.5, 1)}
    assert quality_vote.fit(docs.where("doc_id > 100"), labels) is None
    assert quality_vote.score(docs.where("doc_id > 100"), quality_vote.fit(docs, labels)).collect() == []


def test_chunks_do_not_change_the_terms(monkeypatch):
    text = "Some words, and more!! " * 200
    whole = quality_vote.term_counts(text)
    monkeypatch.setattr(quality_vote, "CHUNK", 97)
    assert np.array_equal(whole, quality_vote.term_counts(text))


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op8_neighbour_vote(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) >= 0.95
    assert all(p for q, p in held if q)
