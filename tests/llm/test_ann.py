import numpy as np
import pytest

from winnow.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>, score string, rank int, node int"


def brute(vectors, ids, k):
    """The k nearest by distance, then id, of every query id; repeated (id, vector) rows once."""
    held = []
    for i, v in vectors:
        fine = i is not None and v and not any(x is None or not np.isfinite(x) for x in v) and any(v)
        if fine and (i, tuple(map(float, np.float32(v)))) not in held:
            held.append((i, tuple(map(float, np.float32(v)))))
    out = {}
    for q, w in held:
        if q not in ids:
            continue
        best = {}
        for i, v in held:
            if i != q and len(v) == len(w):
                d = float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum()))
                best[i] = min(d, best.get(i, np.inf))
        out[q] = sorted((d, i) for i, d in best.items())[:k]
    return out


def run(spark, rows, ids, k=10, **more):
    df = spark.createDataFrame([(*r, "clash", 9, 9) for r in rows], SCHEMA)
    found = ann.nearest(df, df.where(df.vec_id.isin(ids)), k, "vec_id", "embedding", **more)
    assert found.columns == ["query_id", "rank", "id", "score"]
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.id))
        assert len(out[r.query_id]) == r["rank"]
    return out


def same(got, expected):
    assert set(got) == {q for q in expected if expected[q]}
    for q in got:
        assert [i for _, i in got[q]] == [i for _, i in expected[q]]
        assert [d for d, _ in got[q]] == pytest.approx([d for d, _ in expected[q]], abs=1e-12)


def test_edge_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]  # a hot vector
    rows += [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan")] * 4), (204, [float("inf")] * 4), (205, [0.0] * 4), (None, [1.0] * 4)]
    rows += [(206, [1.0, 2.0]), (207, [1.0, 2.5]), rows[3], rows[3], (-5, rows[4][1])]
    ids = {0, 3, 110, 200, 201, 203, 205, 206, -5}
    same(run(spark, rows, ids), brute(rows, ids, 10))


def test_few_and_none(spark):
    assert run(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])], [1]) == {1: [(np.sqrt(2.0), 2)]}
    assert run(spark, [(1, [1.0])], [1]) == {}
    assert run(spark, [], [1]) == {}


def test_recall_over_several_shards(spark):
    sf = "/root/testdata/sf0.1"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    ids, held = np.array(sorted(rows)), np.stack([rows[i] for i in sorted(rows)])
    nodes = ann.distinct_vectors(vectors.selectExpr("vec_id AS id", "transform(embedding, x -> double(x)) AS vector"), 700)
    assert nodes.select("shard").distinct().count() == 3
    got = {}
    for r in queries.op5_nn_descent(spark, sf).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits = []
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((held - rows[q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        nearest = set(ids[np.lexsort((ids, d))[:10]])
        assert sorted(got[q]) == list(range(1, 11))
        assert all(got[q][n][1] == pytest.approx(float(np.sqrt(((rows[got[q][n][0]] - rows[q]) ** 2).sum())), abs=1e-12) for n in got[q])
        hits.append(len(nearest & {i for i, _ in got[q].values()}) / 10)
    assert np.mean(hits) >= 0.95


def test_descent_improves_the_graph(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(600, 12))
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vector array<double>")
    nodes = ann.distinct_vectors(rows)

    def share(state):
        d = ((points[:, None] - points[None]) ** 2).sum(axis=2)
        np.fill_diagonal(d, np.inf)
        true = np.argsort(d, axis=1)[:, : ann.DEGREE]
        return np.mean([len(set(r.near) & set(true[r.node])) / ann.DEGREE for r in state.collect()])

    first, last = share(ann.build_graph(nodes, rounds=0)), share(ann.build_graph(nodes))
    assert first < 0.1 and last > 0.9
