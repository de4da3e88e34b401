import math

import numpy as np
import pytest

from winnow.llm import queries, topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def brute(vectors, query_ids, k):
    """Exact integers; rows whose id is null or vector unusable left out; the smallest vector of an id stands."""
    whole = {}
    for i, v in vectors:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * float(np.float32(x))) for x in v]
        whole[i] = min(whole.get(i, w), w)
    out = []
    for q in sorted(set(query_ids) & set(whole)):
        scores = [(-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return out


def run(spark, rows, ids, k=5, **more):
    df = spark.createDataFrame([(*r, "clash", 9) for r in rows], SCHEMA)
    df = df.select("*", topk.scaled("embedding").alias("vector"))
    found = topk.top_k(df, df.where(df.vec_id.isin(ids)), k, "vec_id", "vector", **more)
    assert found.columns == ["query_id", "rank", "id", "score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("blocks", [{}, {"block_cells": 40, "query_rows": 3}])
def test_against_brute_force(spark, blocks):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 4]) for i in range(60)]  # many ties
    rows += [(60 + i, rows[0][1]) for i in range(25)]  # a hot vector
    rows += [(100, None), (101, []), (102, [1.0, None]), (103, [float("nan")] * 6), (104, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(105, [0.0] * 6), (106, [1.0, 2.0]), rows[3], (4, [9.0] * 6), (-7, [0.5] * 9)]
    ids = [0, 4, 61, 100, 101, 103, 105, 106, -7]
    assert run(spark, rows, ids, **blocks) == brute(rows, ids, 5)


def test_few_and_none(spark):
    assert run(spark, [(1, [1.0]), (2, [2.0])], [1]) == [(1, 1, 2, 256 * 512)]
    assert run(spark, [(1, [1.0])], [1]) == []
    assert run(spark, [], [1]) == []


def test_sums_beyond_long_wrap(spark):
    rows = [(1, [float(2**40), 1.0]), (2, [float(2**40), 0.0])]
    product = (2**48 * 2**48 + (1 << 63)) % (1 << 64) - (1 << 63)
    assert run(spark, rows, [1]) == [(1, 1, 2, product)]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in queries.op1_term_at_a_time(spark, sf).collect())
    assert got == brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
