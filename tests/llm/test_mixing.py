import collections
import re

import pytest

from winnow.llm import mixing, queries

SCHEMA = "doc_id long, text string, source string, size string, target string, `copies` string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def expected_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Shares by weight, the excess over a stop dealt out again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    stopped, budget = set(), share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in stopped]
        left = budget - sum(most * sizes[s] for s in stopped)
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s] + 1e-9}
        if not over:
            return {s: most * sizes[s] if s in stopped else left * weight[s] / total for s in order}
        stopped |= over


def check(rows, mixed):
    sizes = collections.Counter()
    for r in rows:
        sizes[r[2]] += len(WORDS.findall(r[1] or ""))
    goals = expected_targets(sizes)
    taken, largest = collections.Counter(), collections.Counter()
    for r in mixed:
        assert r.size == len(WORDS.findall(r.text or ""))
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goals[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - goals[s]) <= largest[s] / 2 + 1e-6
    return taken


def texts(n, source, first, words=7):
    return [(first + i, "w " * (1 + (i * 13) % words), source, "x", "y", "z") for i in range(n)]


def test_edge_rows(spark):
    rows = texts(300, "hot", 0) + texts(40, "b", 1000) + texts(5, "é", 2000) + texts(30, None, 3000)
    rows += [(9000, None, "b", None, None, None), (9001, "", "only empty", None, None, None), (None, "no id here", "b", None, None, None)]
    rows += [(9002, "long " * 20_000, "long", None, None, None), (9003, "\x85nbsp\xa0 is a word\t\n", "é", None, None, None)]
    rows += [(5000, "the same row", "rep", None, None, None)] * 4
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = mixing.mix(docs)
    assert mixed.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies", "taken"]
    got = mixed.collect()
    assert len(got) == len(rows)
    by_source = [r for r in got if r.source != "rep"]
    assert len({r.copies for r in got if r.source == "rep"}) == 1
    goals = expected_targets(collections.Counter({s: sum(len(WORDS.findall(r[1] or "")) for r in rows if r[2] == s) for s in {r[2] for r in rows}}))
    taken = collections.Counter()
    for r in by_source:
        taken[r.source] += r.taken
        assert r.target == pytest.approx(goals[r.source])
    assert abs(taken["hot"] - goals["hot"]) <= 4 and abs(taken[None] - goals[None]) <= 4


def test_reruns_and_layouts_agree(spark):
    docs = spark.createDataFrame(texts(400, "a", 0) + texts(90, "b", 500), SCHEMA)
    first = {r.doc_id: r.copies for r in mixing.mix(docs.repartition(3)).collect()}
    second = {r.doc_id: r.copies for r in mixing.mix(docs.repartition(11, "doc_id")).collect()}
    other = {r.doc_id: r.copies for r in mixing.mix(docs, seed=3).collect()}
    assert first == second != other


def test_inclusion_is_even(spark):
    """Over seeds, the documents of a source are taken about as often as its share says."""
    docs = spark.createDataFrame([(i, f"one two {i}", "a" if i < 120 else "b", "", "", "") for i in range(240)], SCHEMA)
    total = collections.Counter()
    for seed in range(6):
        for r in mixing.mix(docs, weights=(1, 2), share_percent=75, seed=seed).collect():
            total[r.doc_id] += r.copies
    # 540 of 720 words, 180 for the first source and 360 for the second: half of the first, all of the second
    assert all(total[i] == 6 for i in range(120, 240))
    assert sum(total[i] for i in range(120)) == 6 * 60
    spread = collections.Counter(total[i] for i in range(120))
    assert spread[0] + spread[6] <= 16 and spread[2] + spread[3] + spread[4] >= 70  # binomial: 3.75 and 94


def test_no_words_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "", "a", "", "", ""), (2, None, None, "", "", "")], SCHEMA)
    assert [(r.target, r.taken) for r in mixing.mix(docs).collect()] == [(0.0, 0)] * 2
    assert mixing.mix(docs.where("doc_id > 5")).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts_of = {r[0]: r for r in rows}
    got = [
        type("Row", (), {**r.asDict(), "text": texts_of[r.doc_id][1], "source": texts_of[r.doc_id][2]})
        for r in queries.op2_pareto_mix(spark, sf).collect()
    ]
    assert len(got) == len(rows)
    check(rows, got)


def _hash(seed, *values):
    """Spark's xxhash64 over columns: each value is hashed with the hash before it as the seed; nulls change nothing."""
    import struct

    import xxhash

    state = 42
    # the seed is an int literal of four bytes, ids are longs
    parts = [struct.pack("<i", seed), *(v.encode() if isinstance(v, str) else struct.pack("<q", v) for v in values if v is not None)]
    for raw in parts:
        state = xxhash.xxh64_intdigest(raw, state)
    return state - (1 << 64) if state >> 63 else state


def test_the_sample_is_that_of_pareto_ranks(spark):
    """Ranks worked out again in plain Python, sorted as a whole, and taken until the source's words are met."""
    import random

    pick = random.Random(12)
    rows = [(i, "w " * pick.randrange(1, 60), pick.choice("aaaabbc") if i % 17 else None) for i in range(700)]
    got = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    partly = 0
    for source in ("a", "b", "c", None):
        docs = [(i, t) for i, t, s in rows if s == source]
        size = sum(t.count("w") for _, t in docs)
        target = got[docs[0][0]].target
        whole = min(int(target // size), 2)
        part, left = target / size - whole, target - whole * size
        ranked = []
        for i, t in docs:
            u = (_hash(mixing.SEED, i, t, source) % (1 << 52) + 0.5) / (1 << 52)
            q = (u / (1 - u)) * ((1 - part) / part) if part > 0 else 0
            ranked.append((q / (1 + q), i, t.count("w")))
        expected, before = {i: whole for i, _ in docs}, 0
        for _, i, n in sorted(ranked):
            if part > 0 and before + n / 2 <= left:
                expected[i] += 1
                partly += 1
            before += n
        assert {i: got[i].copies for i, _ in docs} == expected, source
    assert partly > 50
