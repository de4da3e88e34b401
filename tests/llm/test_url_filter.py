import datetime
import random

import duckdb

from winnow.llm import queries, url_filter

D = datetime.date
CAPTURES = "page_id long, url string, fetched date, host int, lists int, domain string, since int"
ENTRIES = "list string, domain string, action string, dated date, host string"


def test_hosts(spark):
    cases = {
        "HTTP://User:pw@A.Example.COM:8080/x?y#z": "a.example.com", "https://example.org": "example.org", "https://example.org./a": "example.org", "ftp://h": "h",
        "example.org/no-scheme": None, "": None, None: None, "https://": None, "https:///path": None, "https://h?q=http://other.org/": "h", "x y": None,
    }
    rows = spark.createDataFrame([(u,) for u in cases], "url string").select("url", url_filter.host("url").alias("h")).collect()
    assert {r.url: r.h for r in rows} == cases


def brute(captures, entries):
    """For each capture and list, the last action of each of its domains up to the fetch day; a removal beats an addition."""
    out = []
    for page, url, day in captures:
        name = {"u": None}.get(url, url.split("/")[2]) if url and "://" in url else None
        labels = name.split(".") if name else []
        ups = {".".join(labels[i:]) for i in range(max(1, len(labels) - 1))} if name else set()
        on = set()
        for kind in {e[0] for e in entries if e[0]}:
            for d in ups:
                known = [e for e in entries if None not in e and e[0] == kind and e[1].lower() == d and day and e[3] <= day and e[2] in ("add", "remove")]
                if known and max(known, key=lambda e: (e[3], e[2] == "remove"))[2] == "add":
                    on.add(kind)
        out.append((page, url, day, tuple(sorted(on))))
    return out


def run(spark, captures, entries):
    left = spark.createDataFrame([(*c, 1, 2, "clash", 3) for c in captures], CAPTURES)
    found = url_filter.evaluate(left, spark.createDataFrame([(*e, "clash") for e in entries], ENTRIES))
    assert sorted(found.columns) == sorted(["page_id", "url", "fetched", "domain", "since", "host", "lists"])
    return [(r.page_id, r.url, r.fetched, tuple(r.lists)) for r in found.collect()]


def order(rows):
    return sorted(rows, key=repr)


def test_against_brute_force(spark):
    pick = random.Random(5)
    names = ["example.com", "a.example.com", "b.a.example.com", "other.org", "x.other.org", "single"]
    day = lambda: D(2024, 1, 1) + datetime.timedelta(pick.randrange(60))
    entries = [(pick.choice(["bad", "odd"]), pick.choice(names).upper(), pick.choice(["add", "remove"]), day()) for _ in range(70)]
    entries += [(None, "other.org", "add", day()), ("bad", None, "add", day()), ("bad", "other.org", "drop", day()), ("bad", "other.org", None, day()), ("bad", "single", "add", None)]
    captures = [(i, f"https://{pick.choice(names)}/p{i}", day()) for i in range(300)]
    captures += [(1000 + i, "https://b.a.example.com/hot", D(2024, 1, 20)) for i in range(200)]
    captures += [(1, None, day()), (2, "", day()), (3, "https://other.org/x", None), (None, "https://other.org/x", day())] + captures[:3]
    assert order(run(spark, captures, entries)) == order(brute(captures, entries))


def test_bounds_of_an_interval(spark):
    entries = [("bad", "h.org", "add", D(2024, 2, 1)), ("bad", "h.org", "add", D(2024, 2, 3)), ("bad", "h.org", "remove", D(2024, 2, 5))]
    captures = [(i, "https://h.org/", D(2024, 1, 31) + datetime.timedelta(i)) for i in range(7)]
    assert [bool(r[3]) for r in sorted(run(spark, captures, entries))] == [False, True, True, True, True, False, False]


def test_empty_tables(spark):
    captures, entries = [(1, "https://h.org/", D(2024, 2, 2))], [("bad", "h.org", "add", D(2024, 2, 1))]
    assert run(spark, captures, []) == [(1, "https://h.org/", D(2024, 2, 2), ())]
    assert run(spark, [], entries) == []


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op6_temporal_lists(spark, sf)
    names = sorted(got.columns)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    reply = duck.execute(queries.OP6_SQL)
    at = [[d[0] for d in reply.description].index(n) for n in names]
    expected = [tuple(r[i] for i in at) for r in reply.fetchall()]
    assert order([tuple(r) for r in got.select(*names).collect()]) == order(expected)
    assert 0 < sum(not r.kept for r in got.collect()) < len(expected)
