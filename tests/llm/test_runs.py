import hashlib
import random
import zlib

import numpy as np
import pytest

from winnow.llm import queries, runs
from winnow.llm.runs import SquareCatcher, runs_of


def brute(words, min_length=24, power=3):
    n, found = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, power * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def texts(seed, count, letters, longest):
    pick = random.Random(seed)
    for _ in range(count):
        words = [pick.choice(letters) for _ in range(pick.randrange(longest))]
        for _ in range(pick.randrange(4)):
            at, q = pick.randrange(len(words) + 1), pick.randrange(1, 40)
            loop = [pick.choice(letters) for _ in range(q)]
            words[at:at] = (loop * 9)[: pick.randrange(9 * q)]
        yield words


@pytest.mark.parametrize("limits", [(24, 3), (1, 2), (10, 2), (7, 4), (100, 3)])
@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefghijklmnop"])
def test_equals_brute_force(limits, letters):
    for words in texts(len(letters), 60, letters, 260):
        assert runs_of(words, *limits) == (brute(words, *limits) if len(words) >= limits[0] else []), words


def test_blocks_cover_every_period_once():
    for length, power in [(24, 3), (1, 2), (50, 2), (9, 5)]:
        seen = [q for k in range(12) for a, b in runs.watched(length, power, 1 << k) for q in range(a, b)]
        assert sorted(q for q in seen if q < 500) == list(range(1, 500))


@pytest.mark.parametrize("step", [1, 3, 50])
def test_words_in_pieces_give_the_same_and_squares_are_told_at_once(step):
    for words in texts(step, 25, "abcd", 200):
        ids = np.array([ord(w) for w in words], np.int64)
        catcher, told = SquareCatcher(), []
        for at in range(0, len(ids), step):
            for start, q in catcher.append(ids[at : at + step]):
                assert words[start : start + q] == words[start + q : start + 2 * q]
                told.append((start, q))
        assert catcher.runs() == brute(words)
        assert {(s, q) for s, _, q in catcher.runs()} <= set(told)


def test_long_and_periodic_texts_are_quick():
    assert runs_of(["a"] * 300_000) == [(0, 300_000, 1)]
    loop = [str(i) for i in range(40_000)]
    assert runs_of(loop * 4) == [(0, 160_000, 40_000)]
    nearly = (["a"] * 23 + ["b"]) * 2000
    assert runs_of(nearly) == [(0, 48_000, 24)]
    word = ["a"]
    while len(word) < 100_000:  # overlap-free words hold no cube
        word += ["b" if w == "a" else "a" for w in word]
    assert runs_of(word) == []


def test_collapse_keeps_the_first_period():
    words = "x a b a b a b y".split()
    assert runs.collapse([w.encode() for w in words], runs_of(words, 6, 3)) == b"x a b y"


def test_edge_rows(spark):
    long = " ".join(["one two"] * 60_000)
    rows = [(1, None, "clash", 1), (2, "", None, 2), (3, "w " * 24, "c", 3), (3, "w " * 24, "c", 3), (None, long, "d", None), (5, " \t\n", "e", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int")
    out = runs.find_runs(docs).collect()
    assert out[0].__fields__ == ["doc_id", "runs", "collapsed"] and len(out) == 6
    got = {r.doc_id: (list(map(tuple, r.runs)), r.collapsed) for r in out}
    assert got == {1: ([], ""), 2: ([], ""), 3: ([(0, 24, 1)], "w"), None: ([(0, 120_000, 2)], "one two"), 5: ([], "")}
    assert runs.find_runs(docs.limit(0)).collect() == []


def test_the_query_equals_brute_force(spark, tmp_path):
    pick = random.Random(4)
    rows = [(i, " ".join(pick.choice("abcdefg") for _ in range(pick.randrange(200)))) for i in range(400)]
    rows += [(400, None), (401, ""), (None, "a " * 30), (402, "\x1c \x85 x\t\ty")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op11_square_catching(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    loops = 0
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if doc_id is not None and h % 10 == 0 and words:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            loops += 1
        found, r = brute(words), got[doc_id]
        assert r.n_runs == len(found)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(left).hexdigest()
        best = max(found, key=lambda f: (f[1] / f[2], -f[0], -f[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
    assert loops > 10
