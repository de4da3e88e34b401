import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from winnow.operators import entities, names
from winnow.plans import queries


@pytest.fixture(scope="module")
def corpus(spark):
    pick = random.Random(5)
    given, family = ["Anna", "Bob", "Carla", "Émile"], ["Schmidt", "Miller", "O’Neil", "Ray-Blanc"]
    lower = "the dog went home and then it was seen near some old house".split()
    capital = ["Berlin", "Monday", "The", "House"]
    rows = []
    for i in range(160):
        out = []
        for _ in range(pick.randrange(2, 12)):
            kind = pick.random()
            if kind < 0.25:
                title = pick.choice(["Dr ", "Mr. ", "Frau ", ""])
                out.append(f"{pick.choice(['with', 'by', 'for'])} {title}{pick.choice(given)} {pick.choice(family)}")
            elif kind < 0.5:
                out.append(pick.choice(capital))
            else:
                out.append(pick.choice(lower) + pick.choice(["", ".", ","]))
        rows.append((i, " ".join(out)))
    return spark.createDataFrame(rows, "id int, text string")


@pytest.fixture(scope="module")
def model(corpus):
    return names.fit(corpus)


@pytest.fixture(scope="module")
def bucket(spark):
    known = {}

    def of(word):
        if word not in known:
            known[word] = spark.range(1).select(F.pmod(F.xxhash64(F.lit(word)), F.lit(names.BUCKETS)).cast("int")).first()[0]
        return known[word]

    return of


def weight(model, bucket, left, words, states):
    step = lambda a, b: model.steps[4 * names.FROM.index(a) + names.TO.index(b)]
    total = model.left[(states[0] == "B") * names.BUCKETS + bucket(left)]
    for a, b, word in zip("S" + states, states, words):
        total += step(a, b) + model.words["OBI".index(b) * names.BUCKETS + bucket(word.lower())]
    return total + step(states[-1], "E")


def scan(text):
    """Windows by a walk over the words of a text whose words are parted by single blanks."""
    titles = {*names.TITLES, *(t + "." for t in names.TITLES)}
    is_name = lambda w: bool(re.fullmatch("[A-ZÉ](?=.*[a-zé])[A-Za-zÉé]*", w))
    words, found, i = text.split(), [], 0
    left = ""
    while i < len(words):
        titled = words[i] in titles
        run = i + titled
        end = run
        while end < len(words) and is_name(words[end]) and words[end] not in titles:
            end += 1
        if end > run:
            found.append(("." if left[-1:] == "." else left.lower(), titled, words[run:end]))
            left, i = "", end
        else:
            left, i = ("" if titled else words[i]), i + 1
    return found


def test_windows_equal_a_scan_of_words(spark):
    pick = random.Random(3)
    alphabet = ["Anna", "Bob", "Dr", "Mr.", "the", "NASA", "end.", "x,", "McIver", "é", "Émile", "12"]
    rows = [(i, " ".join(pick.choices(alphabet, k=pick.randrange(12)))) for i in range(400)]
    got = spark.createDataFrame(rows, "i int, t string").select("i", names.windows("t").alias("w")).collect()
    for r in got:
        assert [tuple(x) for x in r.w] == scan(rows[r.i][1]), rows[r.i][1]


def test_decoding_equals_all_state_strings(spark, corpus, model, bucket):
    df = corpus.limit(60)
    got = {r.id: r for r in names.detect(df.withColumn("w", names.windows("text")), model).collect()}
    seen = 0
    for r in got.values():
        expected = []
        for left, _, words in r.w:
            if len(words) > 5:
                continue
            best = max(
                ("".join(s) for s in itertools.product("OBI", repeat=len(words)) if s[0] != "I" and "OI" not in "".join(s)),
                key=lambda s: weight(model, bucket, left, words, s),
            )
            for m in re.finditer("BI*", best):
                plain = best[: m.start()] + "O" * len(m[0]) + best[m.end() :]
                odds = weight(model, bucket, left, words, plain) - weight(model, bucket, left, words, best)
                expected.append((" ".join(words[m.start() : m.end()]), "PERSON", 1 / (1 + math.exp(odds))))
        if all(len(w) <= 5 for _, _, w in r.w):
            assert [(e.word, e.entity_group) for e in r.entities] == [e[:2] for e in expected]
            for e, (word, _, score) in zip(r.entities, expected):
                assert math.isclose(e.score, score, rel_tol=1e-6) and 0 < e.score <= 1, (word, e.score, score, r.w)
            seen += len(expected)
    assert seen > 30


def test_probabilities_add_up(model):
    for i in range(3):
        part = model.words[i * names.BUCKETS : (i + 1) * names.BUCKETS]
        assert math.isclose(sum(map(math.exp, part)), 1)
    for i, a in enumerate(names.FROM):
        row = [p for b, p in zip(names.TO, model.steps[4 * i : 4 * i + 4]) if a + b not in names.IMPOSSIBLE]
        assert math.isclose(sum(map(math.exp, row)), 1)


def test_names_that_no_rule_names_are_found(spark):
    """Held out: names without a title.  The model has seen none of them as a name, only titled ones."""
    rows = queries.named_entities(spark, "/root/testdata/sf0.01").collect()
    bare = [r for r in rows if not r.titled]
    caught = sum(r.name in r.names.split(",") for r in bare) / len(bare)
    extra = sum(len([n for n in r.names.split(",") if n and n != r.name]) for r in rows) / len(rows)
    print(f"caught {caught:.3f}, others a document {extra:.3f}")
    assert len(bare) > 300 and caught >= 0.9 and extra < 0.1


def test_edge_rows_and_scrubbing(spark, model):
    long = "told by Anna Schmidt " * 3000
    rows = [(1, None, "x"), (2, "", "x"), (3, "told by Anna Schmidt", "x"), (3, "told by Anna Schmidt", "x"), (4, "Anna " * 3000, None), (5, long, None)]
    df = spark.createDataFrame(rows, "id int, text string, entities string")
    out = names.detect(df, model)
    assert out.columns == ["id", "text", "entities"]
    got = {r.id: r.entities for r in out.collect()}
    assert got[1] is None and got[2] == [] and [e.word for e in got[3]] == ["Anna Schmidt"] and len(got[5]) == 3000
    assert entities.scrub_prompts(out, "entities", "text").where("id = 3").first().text == "told by PERSON"
    assert names.detect(df.limit(0), model).collect() == []
    nothing = names.fit(df.limit(0))
    assert all(r.entities in (None, []) for r in names.detect(df, nothing).collect())


def test_no_python_and_no_shuffle(corpus, model):
    plan = names.detect(corpus, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_windows_are_found_once(spark, corpus, model, monkeypatch):
    """Windows that are there are taken, without the text; the query finds them once for both steps."""
    there = corpus.withColumn("w", names.windows("text"))
    there = there.drop("text").withColumnRenamed("w", "there is")
    assert names.fit(there, found="there is") == names.fit(corpus)
    got = names.detect(there, model, found="there is").select("entities").collect()
    assert got == names.detect(corpus, model).select("entities").collect() and any(r.entities for r in got)
    asked, find = [], names.windows
    monkeypatch.setattr(names, "windows", lambda *a: asked.append(a) or find(*a))
    assert queries.named_entities(spark, "/root/testdata/sf0.001").count() == 200 and len(asked) == 1
