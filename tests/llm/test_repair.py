import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from winnow.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
SOUND = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, repaired) over full paths, by states with whole strings; rows are (role, text, must_go, unfinished)."""
    best = {"": (0, "", ())}

    def better(found, state, path):
        if state not in found or path[:2] < found[state][:2]:
            found[state] = path

    def inserts(found):
        for _ in range(4):
            for state, (cost, audit, out) in list(found.items()):
                role = "assistant" if state == "u" else "user"
                better(found, role[0], (cost + 2, audit + "I", (*out, (role, ""))))
        return found

    best = inserts(best)
    for role, text, must_go, unfinished in rows:
        found = {}
        for state, (cost, audit, out) in best.items():
            better(found, state, (cost + 3, audit + "D", out))
            if must_go:
                continue
            for edit, extra, name in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                if state + name[:1] in ("s", "u", "su", "ua", "au"):
                    better(found, name[:1], (cost + extra + unfinished, audit + edit, (*out, (name, text))))
        best = inserts(found)
    return min(best[s] for s in ("", "a") if s in best)


def by_enumeration(rows, longest):
    """The same by trying every string of edits."""
    best = None
    for n in range(longest + 1):
        for edits in product("DIKR", repeat=n):
            if sum(e != "I" for e in edits) != len(rows):
                continue
            for names in product(("user", "assistant"), repeat=sum(e in "IR" for e in edits)):
                left, take, cost, out = iter(rows), iter(names), 0, []
                for e in edits:
                    if e == "I":
                        out.append((next(take), ""))
                        cost += 2
                        continue
                    role, text, must_go, unfinished = next(left)
                    if e == "D":
                        cost += 3
                        continue
                    cost += (1000 if must_go else 0) + unfinished + 2 * (e == "R")
                    out.append((next(take) if e == "R" else role, text))
                if SOUND.fullmatch("".join(r[:1] or " " for r, _ in out)):
                    best = min(filter(None, (best, (cost, "".join(edits), tuple(out)))))
    return best


def decoded(rows):
    repairer = repair.Repairer()
    edits = [e for row in rows for e in repairer.row(*row)] + list(repairer.end())
    return (repairer.cost, "".join(e for e, *_ in edits), tuple((r, t) for e, r, t in edits if e != "D")), repairer


def random_rows(pick, count):
    roles = ["user", "assistant", "system", "tool", "", "ai", "User"]
    return [(pick.choice(roles), str(i), pick.random() < 0.2, pick.random() < 0.2) for i in range(count)]


def test_equals_every_string_of_edits():
    pick = random.Random(3)
    for count in (0, 1, 2, 3, 3, 3):
        rows = random_rows(pick, count)
        assert decoded(rows)[0] == by_enumeration(rows, count + 3), rows


@pytest.mark.parametrize("roles", ["u", "a", "ua", "sua", "suat"])
def test_equals_full_strings(roles):
    pick = random.Random(len(roles))
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    for _ in range(400):
        rows = [(names[pick.choice(roles)], str(i), pick.random() < 0.15, pick.random() < 0.15) for i in range(pick.randrange(25))]
        assert decoded(rows)[0] == cheapest(rows), rows


def test_memory_follows_the_unresolved_part():
    pick = random.Random(8)
    rows = [(("user", "assistant")[i % 2] if pick.random() < 0.8 else "system", str(i), pick.random() < 0.1, False) for i in range(20_000)]
    (_, audit, _), repairer = decoded(rows)
    assert len(audit) >= 20_000 and repairer.most_live < 400 and repairer.live == 0


def test_faults_count_once(spark):
    rows = [
        (1, None, "user", "Hi."), (1, 0, "user", "Hi."), (1, 3, "assistant", "and"), (1, 3, "assistant", " \n"),
        (1, 7, None, None), (None, 1, "user", "Q?"), (None, 2, "assistant", "A! \t"), (2, None, "assistant", ""),
    ]
    found = {r.conv_id: r for r in repair.repair_summary(spark.createDataFrame(rows, SCHEMA)).collect()}
    # by turn, nulls first, then text: user Hi. / user Hi. (again) / assistant blank / assistant and / blank
    assert tuple(found[1])[1:8] == (5, 2, 1, 1, 3, 10, "KDDKD")
    assert found[1].repaired_sha256 == hashlib.sha256(b"user:Hi.\nassistant:and").hexdigest()
    assert tuple(found[None])[1:8] == (0, 0, 0, 0, 0, 0, "KK")
    assert tuple(found[2])[1:] == (0, 1, 0, 0, 0, 3, "D", hashlib.sha256(b"").hexdigest())


def test_edge_tables(spark):
    empty = spark.createDataFrame([], SCHEMA + ", cost string, c int")
    assert repair.repair_summary(empty).collect() == [] and repair.repair_rows(empty).collect() == []
    long = "word " * 200_000 + "."
    rows = [(5, 1, "user", long, "clash", 1), (5, 2, "user", "b.", "clash", None)]
    got = sorted(repair.repair_rows(spark.createDataFrame(rows, SCHEMA + ", edit string, c int")).collect(), key=lambda r: r.step)
    assert [tuple(r) for r in got] == [(5, 0, "K", "user", long), (5, 1, "R", "assistant", "b.")]


def test_the_query_equals_brute_force(spark, tmp_path):
    pick = random.Random(1)
    say = ["Yes.", "No!", "why", "", " ", "a. b", "Ok? \n", None]
    rows = [
        (c, None if pick.random() < 0.03 else t * (1 + (c % 7 == 0)), pick.choice(["user", "assistant", "system", None]) if c % 3 else ("user", "assistant")[t % 2], pick.choice(say))
        for c in range(300)
        for t in range(pick.randrange(1, 9))
    ] + [(None, 4, "user", "x")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op12_survivor_viterbi(spark, str(tmp_path)).collect()}
    assert set(got) == {c for c, *_ in rows}
    blank = lambda v: " " if v is None else str(v)
    for conv in got:
        after = []
        for _, t, role, text in (r for r in rows if r[0] == conv):
            act = zlib.crc32(f"{blank(conv)}:{blank(t)}".encode()) % 20
            role, text = blank(role), blank(text)
            if act:
                text = {1: "", 2: re.sub("[.!?]", "", text)}.get(act, text)
                after += [(t, "user" if act == 4 else role, text)] * (2 if act == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        counts, seen, judged = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in after:
            said = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, *_ in after if t is not None}
        cost, audit, out = cheapest(judged)
        r = got[conv]
        assert r.gaps == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        assert (r.blank, r.duplicate, r.truncated) == tuple(counts.values())
        pairs = zip(after, after[1:])
        assert r.illegal == sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in pairs)
        assert (r.cost, r.audit) == (cost, audit)
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()
