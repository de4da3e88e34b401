import hashlib
import random
import re

import pytest

from winnow.llm import pii, queries

SCHEMA = "doc_id long, text string, base string, scope string, found int"
RULES = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def holds(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in RULES for m in p.finditer(text or "") if holds(k, m[0])]


def run(spark, texts):
    rows = [(i, t, "clash", "clash", 1) for i, t in enumerate(texts)]
    out = pii.find_personal_data(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert out.columns == ["doc_id", "base", "spans"]
    name = lambda spans: [(pii.KINDS[s.kind], s.start, s.end) for s in spans]
    return {r.doc_id: (name(r.base), name(r.spans)) for r in out.collect()}


EDGES = [
    None, "", "   ", "a@b.c", "a@b.c_x@d.e", "a@b", "a@b.c.d..e", "x" * 50_000, "x" * 50_000 + "@y.z", "a@b" + ".c" * 30_000, "@a.b", "é.a@b.c@d.e",
    "1.2.3.4.5.6.7.8", "1.2.3x4.5.6.7", "256.1.1.1", "000000255.0.0.1", "1.1.1.0000256", "9" * 60_000, "1." * 30_000, "👩 10.0.0.1 👩 10.0.0.2",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111", "4111111111111112", "1 2 3 4", "5  5", "0" * 13, "0" * 19, "0" * 20,
    "+1 (017) 555-7713", "+1 (017) 555-7713 and +44 20 7946 0958.", "+12", "+1" + " " * 20_000, "+123456789", "+1234567890123456", "++49 (0) 30-123456", "+1-2-+3-45678901",
    "-5 " * 4000,
]


def test_base_spans_of_edge_texts(spark):
    got = run(spark, EDGES)
    for i, t in enumerate(EDGES):
        assert got[i][0] == brute(t), (t or "")[:80]
        assert [s for s in got[i][1] if s[0] in pii.BASE] == got[i][0]


def test_base_spans_of_random_texts(spark):
    pick = random.Random(6)
    alphabet = [*"0123456789.@+-() aZ_é\n", "10.0.0.1", "a.b@c.de", "4111111111111111", "👩"]
    texts = ["".join(pick.choices(alphabet, k=pick.randrange(60))) for _ in range(400)]
    got = run(spark, texts)
    for i, t in enumerate(texts):
        assert got[i][0] == brute(t), t


def test_luhn(spark):
    numbers = ["4111111111111111", "4111111111111112", "0", "59", "79927398713"]
    rows = spark.createDataFrame([(n,) for n in numbers], "n string").select("n", pii.luhn(pii.F.col("n")).alias("ok")).collect()
    assert {r.n: r.ok for r in rows} == {n: luhn(n) for n in numbers}


def people(n):
    names = pii.GIVEN_NAMES
    return [f"please contact Mr {names[i % len(names)]} Smith by mail {names[i % 7].lower()}{i}@x.org or call +1 (212) 555-{1000 + i}." for i in range(n)]


def test_classifier_accepts_what_labelers_agree_on(spark):
    numbers = [f"section {i} table 212-555-{1000 + i} page {i} version" for i in range(30)]
    ids = [f"ssn 123-45-{6000 + i} signed by Dr Jones, mail j{i}@y.com" for i in range(40)]
    got = run(spark, people(60) + ids + numbers + [people(60)[0]] * 3)
    for i in range(60):
        assert "person" in [k for k, _, _ in got[i][1]]
    assert sum("national_id" in [k for k, _, _ in got[60 + i][1]] for i in range(40)) == 40
    assert not any(got[100 + i][1] for i in range(30))
    assert got[130] == got[131] == got[132] == got[0]


def test_reliabilities_recover_planted_labelers(spark):
    pick = random.Random(8)
    right = {"shape": 0.95, "gazetteer": 0.8, "cue": 0.7, "anti_cue": 0.9, "company": 0.5}
    rows = []
    for _ in range(20_000):
        true = pick.random() < 0.4
        rows.append(tuple((1 if (pick.random() < right[c]) == true else -1) if pick.random() < 0.8 else 0 for c in pii.LABELERS))
    voted = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in pii.LABELERS))
    prior, table = pii.reliabilities(voted.groupBy(*pii.LABELERS).agg(pii.F.count("*").alias("n")), rounds=25)
    assert prior == pytest.approx(0.4, abs=0.05)
    for c, p in right.items():
        assert table[c, 1, 1] / (table[c, 1, 1] + table[c, -1, 1]) == pytest.approx(p, abs=0.06)


def test_empty_table_and_nothing_found(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert pii.find_personal_data(docs).collect() == []
    assert run(spark, ["plain words", None]) == {0: ([], []), 1: ([], [])}


def test_no_python_in_the_plan(spark, documents):
    plan = pii.find_personal_data(documents, keep=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = queries.op7_weak_supervision(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        expected = brute(texts[r.doc_id])
        digest = ",".join(f"{k}:{a}:{b}" for k, a, b in expected)
        assert r.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in expected) for kind in pii.BASE]
