import collections
import random
import re

import numpy as np
import pytest

from winnow.llm import bayes_dedup, queries

SCHEMA = "doc_id long, text string, component_id string, kept int, band int"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORDS.findall((text or "").encode().lower())
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, width, percent=80):
    """doc_id -> (set size, component), over an inverted index; rows with one id are one document."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = collections.defaultdict(list)
    for n, (_, s) in enumerate(sets):
        for x in s:
            at[x].append(n)
    for n, (i, s) in enumerate(sets):
        met = collections.Counter(k for x in s for k in at[x] if k < n)
        for k, shared in met.items():
            j = sets[k][0]
            if i is not None and j is not None and 100 * shared >= percent * (len(s) + len(sets[k][1]) - shared):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def run(spark, rows, width=2, **more):
    docs = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)
    out = bayes_dedup.near_duplicates(docs, width=width, **more)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = out.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return [(r.doc_id, r.n_shingles, r.component_id) for r in got]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], -1 if r[2] is None else r[2]))


def edited(words, pick, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        words[pick.randrange(len(words))] = pick.choice(vocabulary)
    return " ".join(words)


@pytest.mark.parametrize("width", [2, 5])
def test_groups_against_brute_force(spark, width):
    pick = random.Random(width)
    vocabulary = [f"w{i}" for i in range(900)]
    draw = lambda n: pick.choices(vocabulary, k=n)
    base, chain, passage = draw(120), draw(100), draw(60)
    texts = [" ".join(base)] * 40 + [edited(base, pick, pick.randrange(1, 9), vocabulary) for _ in range(90)]
    for step in range(12):  # each is near the one before, the ends are far apart
        chain = chain[3:] + draw(3)
        texts.append(" ".join(chain))
    texts += [" ".join(draw(50) + passage + draw(50)) for _ in range(40)]
    texts += [" ".join(draw(80)) for _ in range(60)]
    pick.shuffle(texts)
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    assert order(run(spark, rows, width)) == order(brute(rows, width))


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "One"), (5, "one"), (6, "ONE two"), (7, "one  two"), (8, "two one"),
            (9, "É a b c"), (10, "é a b c"), (11, "a\x85b c"), (12, "a b c"), (13, "x y z " * 20_000), (14, "z x y " * 20_000),
            (6, "one TWO"), (20, "p q r s"), (20, "one\ttwo"), (21, "P q r S"), (22, None), (0, "a b c")]
    assert order(run(spark, rows)) == order(brute(rows, 2))


def test_null_ids(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (None, "q r s t"), (None, None)]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = sorted((r.n_shingles, r.doc_id or -1, r.component_id or -1) for r in bayes_dedup.near_duplicates(docs, width=2).collect())
    assert got == [(0, -1, -1), (3, -1, -1), (3, -1, 3), (3, 3, 3)]


def test_empty_table(spark):
    assert bayes_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_screen_keeps_the_threshold_and_drops_the_far():
    rng = np.random.default_rng(1)
    limits = bayes_dedup.batch_limits()
    hashes = bayes_dedup.BANDS * bayes_dedup.ROWS

    def pairs(similarity, n=4000):
        a = rng.integers(0, 1 << 32, (n, hashes), dtype=np.uint32)
        return a, np.where(rng.random(a.shape) < similarity, a, a + np.uint32(1))

    assert bayes_dedup.plausible(*pairs(0.8), limits).all()
    assert bayes_dedup.plausible(*pairs(0.5), limits).mean() < 0.01
    assert [n for n, _ in limits] == list(range(40, 201, 40))
    # the posterior of one step, worked out by the integral
    s = np.linspace(0, 1, 200_001)
    weight = s**20 * (1 - s) ** 20
    above = weight[s >= 0.8].sum() / weight.sum()
    assert (bayes_dedup.least_matches(0.8, 40, above * 1.001) > 20) and bayes_dedup.least_matches(0.8, 40, above * 0.999) <= 20


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(100, 400)]
    hub = [(5000, i) for i in range(5001, 5400)]
    links = spark.createDataFrame([*path, *hub, (7, 7), (9, 8), (8, 9)], "a long, b long")
    got = {r.node: r.component for r in bayes_dedup.components(links).collect()}
    assert all(got[i] == 100 for i in range(101, 401)) and all(got[i] == 5000 for i in range(5001, 5400)) and got[9] == 8
    assert 7 not in got


def test_query(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = queries.op10_bayes_minhash(spark, "/root/testdata/sf0.001").collect()
    assert order([(r.doc_id, r.n_shingles, r.component_id) for r in got]) == order(brute(rows, 2))
