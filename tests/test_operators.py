import json

import pytest
from pyspark.sql import functions as F

from winnow.functions import prompts
from winnow.operators import entities, ids, inference, latest, quality, split, standardize, upsert
from winnow.plans import training_set
from winnow.sources import ingest

STAMP = "2024-01-01 00:00:00"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# ---- entities ---------------------------------------------------------------------------------


def entity(word, group, score):
    return (word, group, score)


@pytest.mark.parametrize(
    ("text", "found", "expected"),
    [
        ("Bob met Bob", [entity("Bob", "PER", 0.8)], "PER met PER"),
        ("Bob met Al", [entity("Bob", "PER", 0.79), entity("Al", "PER", 0.81)], "Bob met PER"),
        ("Anna (Inc) a.c abc", [entity("Anna (Inc)", "ORG", 1.0), entity("a.c", "X", 1.0)], "ORG X abc"),
        ("keep", [entity("", "Z", 1.0)], "keep"),
        ("Bob", [entity("Bob", "PER", 1.0), entity("PER", "LOC", 1.0)], "LOC"),
        ("Bob", [entity(None, "X", 1.0), entity("Bob", None, 1.0), entity("B", "X", float("nan")), None], "Bob"),
        ("none", [], "none"),
        ("none", None, "none"),
        (None, [entity("a", "b", 1.0)], None),
    ],
)
def test_scrub(spark, text, found, expected):
    df = spark.createDataFrame([(text, found)], f"prompt string, found {entities.ENTITY_TYPE}")
    assert entities.scrub_prompts(df, "found").first()[0] == expected


def test_detector_is_loaded_once_per_worker_and_skips_nulls(values):
    def load():
        calls = []

        def detector(texts):
            calls.append(len(texts))
            assert None not in texts
            return [[{"word": w, "entity_group": "W", "score": 0.9} for w in t.split()] for t in texts]

        return detector

    got = values(lambda c: entities.detect(c, load), ["a b", None, "", "c"])
    assert [None if g is None else [(e.word, e.entity_group) for e in g] for g in got] == [
        [("a", "W"), ("b", "W")], None, [], [("c", "W")],
    ]


def test_model_is_loaded_once_per_process(spark, tmp_path):
    marks = str(tmp_path)

    def load():
        import os
        import uuid

        open(f"{marks}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda texts: [[] for _ in texts]

    df = spark.range(0, 64, 1, 16).select(F.col("id").cast("string").alias("t"))
    for _ in range(2):
        assert df.select(entities.detect("t", load, f"model {marks}").alias("f")).where("size(f) = 0").count() == 64
    loads = [f.name.split("-")[0] for f in tmp_path.iterdir()]
    assert len(loads) == len(set(loads)) <= 16


@pytest.mark.parametrize("extra", [-1, 1])
def test_wrong_number_of_answers_is_an_error(spark, extra):
    def detector():
        return lambda texts: [[]] * (len(texts) + extra)

    def generator():
        return lambda requests: ["{}"] * (len(requests) + extra)

    df = spark.createDataFrame([("a",), ("b",)], "prompt string").coalesce(1)
    with pytest.raises(Exception, match="2 texts were sent, . entity lists came back"):
        df.select(entities.detect("prompt", detector)).collect()
    with pytest.raises(Exception, match="2 texts were sent, . replies came back"):
        inference.generate(df, generator).collect()


def test_detector_in_sql(spark):
    def load():
        return lambda texts: [[{"word": "Bob", "entity_group": "PER", "score": 0.95}] for _ in texts]

    from winnow.functions.sql import register_all

    register_all(spark)
    spark.udf.register("detect_names", entities.detector_udf(load))
    assert spark.sql("SELECT scrub_entities(t, detect_names(t)) FROM VALUES ('Bob ran') AS v(t)").first()[0] == "PER ran"


def test_patterns(values):
    texts = ["mail a.b+c@x-y.example.com now", "ip 10.0.0.255!", "card 1234-5678 9012 3456", "call +49 170 123 4567", None]
    assert values(entities.scrub_patterns, texts) == ["mail EMAIL now", "ip IP!", "card CARD", "call PHONE", None]
    scrubbed = values(lambda c: entities.scrub(c, entities.detect_patterns(c)), texts)
    assert scrubbed == ["mail EMAIL now", "ip IP!", "card CARD", "call PHONE", None]


def test_phone_numbers_and_other_numbers(values):
    scrubbed = {
        "call +1 (017) 555-7713 now": "call PHONE now", "(212) 555-0100, 212.555.0100": "PHONE, PHONE", "+49 30 1234567.": "PHONE.",
        "+1 (017) 555-7713 +1 (018) 555-7714": "PHONE PHONE", "1.2.3.4 5.6.7.8,9.10.11.12": "IP IP,IP",
        "4111 1111 1111 1111 4222-2222-2222-2222": "CARD CARD", "a@b.org 10.0.0.1 +442079460958": "EMAIL IP PHONE",
    }
    plain = [
        "on 01-02-2024 we met", "on 2024-01-02 we met", "10-20-3000 units", "1234567890123456789", "256.1.1.1 is none", "version 1.2.3", "12 345 6789",
        "x4111111111111111", "4111111111111111_", "1.2.3.4567", "555-7713", "1 000 000 000", "+12 apples",
    ]
    expected = [*scrubbed.values(), *plain]
    assert values(entities.scrub_patterns, [*scrubbed, *plain]) == expected
    assert values(lambda c: entities.scrub(c, entities.detect_patterns(c)), [*scrubbed, *plain]) == expected


def test_entities_do_not_overlap(values):
    found = values(entities.detect_patterns, ["10.20.30.40 and +4111 1111 1111 1111 and a@1.2.3.4.com"])
    assert [(e.word, e.entity_group) for e in found[0]] == [
        ("a@1.2.3.4.com", "EMAIL"), ("4111 1111 1111 1111", "CARD"), ("10.20.30.40", "IP"),
    ]


def test_national_numbers_and_longer_dotted_ones(values):
    expected = {
        "0171 5557713": "PHONE", "ring 0049 30 123456!": "ring PHONE!", "030/1234567": "PHONE", "01 23 45": "01 23 45",
        "1.2.3.4.5": "1.2.3.4.5", "v1.2.3.4": "v1.2.3.4", "9.1.2.3.4": "9.1.2.3.4", "1.2.3.4.": "IP.", "0.1.2.3 x": "IP x",
        "2024-01-05": "2024-01-05", "007 12": "007 12",
    }
    assert values(entities.scrub_patterns, list(expected)) == list(expected.values())


def test_no_phone_number_is_left_in_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    shape = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
    assert docs.where(F.col("text").rlike(shape)).count() > 10
    assert docs.where(entities.scrub_patterns("text").rlike(shape)).count() == 0
    assert docs.where(entities.scrub("text", entities.detect_patterns("text")).rlike(shape)).count() == 0
    code = docs.select(F.col("text").alias("instruction"), F.col("text").alias("input"), F.col("text").alias("output"))
    clean = training_set.clean_code_gen(ingest.stamp(code, STAMP), "code")
    assert clean.where(F.col("prompt").rlike(shape) | F.col("response").rlike(shape)).count() == 0


def test_own_patterns(values):
    own = {"EMAIL": "[0-9]+", "$1\\": "cat"}
    assert values(lambda c: entities.scrub_patterns(c, own), ["12 cat"]) == ["EMAIL $1\\"]
    assert values(lambda c: entities.scrub(c, entities.detect_patterns(c, own)), ["12 cat"]) == ["EMAIL $1\\"]


# ---- ids --------------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_ids_follow_the_order(spark, parts):
    df = spark.range(1000).select((F.col("id") * 17 % 1009).alias("k"), F.lit("x").alias("v")).repartition(parts)
    numbered = ids.assign_ids(df, ["k"], start=100)
    got = [tuple(r) for r in numbered.orderBy("id").select("id", "k").collect()]
    assert [i for i, _ in got] == list(range(100, 1100))
    assert [k for _, k in got] == sorted(i * 17 % 1009 for i in range(1000))
    assert ids.next_id(numbered) == 1100


def test_ids_without_order_and_hot_copies(spark):
    df = spark.range(0, 3000, 1, 5).select(F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("p"))
    numbered = ids.assign_ids(df)
    assert numbered.columns == ["id", "p"]
    assert sorted(r.id for r in numbered.collect()) == list(range(3000))
    assert rows(numbered, "id", "p") == rows(numbered, "id", "p")
    assert ids.next_id(numbered.limit(0)) == 0


# ---- quality, upsert, split, latest -----------------------------------------------------------


def test_quality(spark):
    data = [
        (1, None, "r"), (2, "short", "r"), (3, "a prompt that is fine", None), (4, "...........................x", "r"),
        (5, "long enough to be kept, surely", "r"), (6, "", None), (7, "exactly 13 ch", "r"),
    ]
    df = spark.createDataFrame(data, "id long, prompt string, response string")
    good, aside = quality.split_quality(df, required=["response"], threshold=10)
    assert rows(good, "id") == [(5,), (7,)]
    assert {r.id: r.reason for r in aside.collect()} == {
        1: ["null_prompt"], 2: ["too_short", "below_threshold"], 3: ["null_response"],
        4: ["below_threshold"], 6: ["null_response", "too_short", "below_threshold"],
    }
    assert rows(quality.min_length(df, threshold=10), "id") == [(3,), (5,), (7,)]
    assert quality.split_quality(df)[0].count() + quality.split_quality(df)[1].count() == 7


def test_upsert(spark):
    target = spark.createDataFrame([(1, "old")], "id long, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "two"), (3, "three")], "id long, v string")
    once = upsert.upsert(batch, target)
    assert rows(once, "id", "v") == [(1, "old"), (2, "two"), (3, "three")]
    assert rows(upsert.upsert(batch, once), "id", "v") == rows(once, "id", "v")
    keyed = upsert.not_matched(
        spark.createDataFrame([(9, 1, 2), (8, 3, 4)], "id long, a int, b int"),
        spark.createDataFrame([(7, 1, 2)], "id long, a int, b int"), ["a", "b"],
    )
    assert rows(keyed, "id") == [(8,)]


def test_split(spark, documents):
    parts = split.split_by_text(documents, "text")
    assert sum(p.count() for p in parts.values()) == documents.count()
    assert parts["train"].join(parts["test"], "text", "left_semi").count() == 0
    assert 0.6 < parts["train"].count() / documents.count() < 0.8
    again = split.split_by_text(documents.repartition(7), "text")
    assert rows(again["test"], "doc_id") == rows(parts["test"], "doc_id")
    three = split.with_split(spark.range(3000).select(F.col("id").cast("string").alias("prompt")), weights={"a": 2, "b": 1, "c": 1})
    counts = {r.split: r["count"] for r in three.groupBy("split").count().collect()}
    assert sum(counts.values()) == 3000
    assert 1400 < counts["a"] < 1600


def test_latest_takes_the_best_of_a_task_before_the_one_exchange(spark, tmp_path):
    spark.range(100).selectExpr("id % 7 AS k", "id AS version", "uuid() AS text").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plan = latest.latest_per_key(df, ["k"], "version")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    assert "Partial" in plan[plan.index("Exchange") :] and "WindowGroupLimit" in plan[plan.index("Exchange") :]
    assert "Join" not in plan


def test_latest_of_null_keys_and_versions(spark):
    df = spark.createDataFrame([(None, "3", "a"), (None, "x", "b"), ("m", None, "c"), ("m", "z", "d")], "name string, version string, v string")
    assert rows(latest.latest_per_key(df, ["name"], "version"), "name", "version", "v") == [("m", "z", "d"), (None, "3", "a")]


def test_latest_is_numeric(spark):
    df = spark.createDataFrame([("m", "9", "a"), ("m", "10", "b"), ("n", "2", "c"), ("n", "2", "d")], "name string, version string, v string")
    assert rows(latest.latest_per_key(df, ["name"], "version"), "name", "version", "v") == [("m", "10", "b"), ("n", "2", "d")]


# ---- inference --------------------------------------------------------------------------------


def test_generate_sends_defaults_and_cuts(spark):
    def load():
        def generate(requests):
            assert all(r["prompt"] is not None for r in requests)
            told = [{k: r[k] for k in ("max_tokens", "temperature")} for r in requests]
            texts = [json.dumps(t) + r["stop"] + "rest" for t, r in zip(told, requests)]
            return [json.dumps({"predictions": [{"candidates": [{"text": t}]}]}) for t in texts]

        return generate

    df = spark.createDataFrame([(1, "q", None, "END"), (2, None, 5, None), (3, "q", 7, None), (4, "q", 1, "")], "id int, prompt string, max_tokens int, stop string")
    got = {r.id: r for r in inference.generate(df, load).collect()}
    assert json.loads(got[1].answer) == {"max_tokens": 200, "temperature": 0.0}
    assert json.loads(got[3].answer) == {"max_tokens": 7, "temperature": 0.0}
    assert got[4].answer.endswith("rest")
    assert got[2].answer is None and got[2].reply is None
    assert got[1].prompt == "q"
    assert got[1].request.endswith("### Instruction:\nq\n\n### Response:\n")


def test_generate_survives_bad_replies(spark):
    def load():
        return lambda requests: ["{oops" if r["prompt"].startswith(prompts.INTRO) else "" for r in requests]

    df = spark.createDataFrame([("q",)], "prompt string")
    assert inference.generate(df, load).first().answer is None


def test_generate_returns_every_candidate(spark):
    def load():
        def reply(r):
            texts = [f"{i}{r['stop']}rest" for i in range(r["candidate_count"])]
            return json.dumps({"predictions": [{"candidates": [{"text": t} for t in texts]}]})

        return lambda requests: [reply(r) for r in requests]

    df = spark.createDataFrame([("q", 3), ("q", None)], "prompt string, candidate_count int")
    got = sorted((r.answers, r.answer) for r in inference.generate(df, load).collect())
    assert got == [(["0"], "0"), (["0", "1", "2"], "0")]
    assert [len(r.answers) for r in inference.generate(df.limit(1)).collect()] == [3]


# ---- whole run --------------------------------------------------------------------------------


def test_training_set_holds_every_row(spark, documents):
    bronze = ingest.stamp(
        documents.select(
            F.col("doc_id").cast("string").alias("key"), F.col("text").alias("prompt"),
            F.when(F.col("doc_id") != 7, F.col("lang")).alias("response"), "source",
        ), STAMP,
    )
    code = ingest.stamp(
        spark.createDataFrame([("c1", "write a loop", "in C", "for(;;);"), ("c2", None, None, "x")],
                              "key string, instruction string, input string, output string"), STAMP,
    )
    silver = training_set.silver(
        [training_set.clean_instruct(bronze, keep=["key"]), training_set.clean_code_gen(code, "code", keep=["key"])],
        order_by=["source", "key"],
    )
    built = training_set.build(silver)
    assert built.kept.count() + built.quarantine.count() == 202
    both = built.kept.select("id").unionByName(built.quarantine.select("id"))
    assert sorted(r.id for r in both.collect()) == list(range(202))
    assert built.gold.columns == ["prompt", "response", "source"]
    reasons = {r[0] for r in built.quarantine.select(F.explode("reason")).collect()}
    assert reasons == {"near_duplicate", "null_prompt", "null_response", "too_short"}


def test_standardize_by_name(spark):
    df = spark.createDataFrame([("a", "b", "s")], "q string, a string, source string")
    out = standardize.standardize(ingest.stamp(df, STAMP), {"prompt": "q", "response": "a"})
    assert out.columns == ["prompt", "response", "source", "update_timestamp"]
    both = standardize.consolidate([out, out.select(*reversed(out.columns))])
    assert rows(both, "prompt", "source") == [("a", "s"), ("a", "s")]


# ---- resumable inference ------------------------------------------------------------------------


def _counting(folder, fails):
    """A generator that leaves a file for every request it is sent, and fails where ``fails`` says so."""
    import uuid

    def load():
        def answer(sent):
            bad = [r for r in sent if fails(r["prompt"])]
            for r in sent:
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
                    file.write(f"{len(sent)} {sum(len(x['prompt']) for x in sent)} {r['prompt']}")
            if bad:
                raise ConnectionError("no answer")
            return [f'{{"predictions": [{{"candidates": [{{"text": "ok {len(r["prompt"])}"}}]}}]}}' for r in sent]

        return answer

    return load


def _sent(folder):
    return [file.read_text() for file in folder.iterdir()]


def test_a_second_run_sends_only_what_failed(spark, tmp_path):
    rows = [(i, f"question {i % 40}" if i != 7 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, prompt string").repartition(3)
    first, second, third = (tmp_path / n for n in ("first", "second", "third"))
    for folder in (first, second, third):
        folder.mkdir()
    ill = lambda p: "question 3\n" in p or "question 21" in p
    path = f"{tmp_path}/replies"
    got = {r.id: r for r in inference.send(df, path, _counting(first, ill), attempts=2).collect()}
    assert len(got) == 60
    for i, r in got.items():
        if i == 7:
            assert (r.request, r.digest, r.answer, r.error, r.runs) == (None,) * 5
        elif i % 40 in (3, 21):
            assert r.answer is None and r.error == "ConnectionError: no answer" and r.runs == 1
        else:
            assert r.answer.startswith("ok ") and r.error is None
    # prompt 7 of row 47 is asked for, equal prompts once, the bad ones twice when they stand alone
    alone = [s for s in _sent(first) if s.startswith("1 ") and ("question 3\n" in s or "question 21" in s)]
    assert len(alone) == 4 and len({s.split(" ", 2)[2] for s in _sent(first)}) == 40
    again = {r.id: r for r in inference.send(df, path, _counting(second, lambda p: False), attempts=2).collect()}
    assert sorted({s.split(" ", 2)[2] for s in _sent(second)}) == sorted({r.request for r in got.values() if r.error})
    assert all(r.answer and r.error is None and r.runs == 1 + (i % 40 in (3, 21)) for i, r in again.items() if i != 7)
    inference.send(df, path, _counting(third, lambda p: True)).collect()
    assert _sent(third) == []


def test_batches_are_bounded_by_characters(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    df = spark.createDataFrame([(i, "x" * (i * 37 % 900)) for i in range(50)], "id int, prompt string").coalesce(1)
    out = inference.send(df, f"{tmp_path}/replies", _counting(seen, lambda p: False), batch_chars=2000)
    assert out.where("answer IS NULL").count() == 0
    assert all(int(s.split(" ")[1]) <= 2000 for s in _sent(seen)) and any(int(s.split(" ")[0]) > 1 for s in _sent(seen))
    assert [(s.start, s.stop) for s in inference.batches_of([5, 5, 9, 30, 1], 10)] == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert list(inference.batches_of([], 10)) == []


def test_sending_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "id int, prompt string, runs string")
    out = inference.send(df, f"{tmp_path}/replies")
    assert out.columns == ["id", "prompt", "request", "digest", "reply", "answers", "answer", "error", "runs"] and out.collect() == []


def test_texts_without_digits_are_not_searched_for_numbers(spark):
    """The patterns of numbers come behind one cheap test that holds wherever one of them matches, with the same finds."""
    texts = ["4111 1111 1111 1111", "1.2.3.4", "+1 (2) 34 56", "(212) 555 0100", "212-555-0100", "0049 30 123456", "030/123456", "+4930-12.34", "a1b2c3d4", "x@y.org 12", "none", "", None]
    df = spark.createDataFrame([(i, t and f"to {t} by x@y.org, 1 2") for i, t in enumerate(texts)], "i int, t string")
    both = df.select("t", entities.detect_patterns("t").alias("found"), entities._detected(F.col("t"), entities.PATTERNS).alias("all"))
    for r in both.collect():
        assert r.found == r["all"] and (r.t is None) == (r.found is None)
    numbers = both.where("exists(all, e -> e.entity_group <> 'EMAIL')")
    assert numbers.count() == 8 and numbers.where(~F.col("t").rlike(entities.DIGITS)).count() == 0
    plan = df.select(entities.detect_patterns("t"))._jdf.queryExecution().analyzed().toString()
    assert f"RLIKE {entities.DIGITS}" in plan or f", {entities.DIGITS})" in plan
