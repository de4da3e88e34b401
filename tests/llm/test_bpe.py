import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from winnow.llm import bpe

JSON = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, decoded int"
SCHEMA_NAMES = ["doc_id", "text", "ids", "decoded"]


@pytest.fixture(scope="module")
def rank_encoding():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_definition(JSON))


def ids_of(encoder, text):
    packed = encoder.packed([text])[0]
    return [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]


def test_code_points_in_several_places(encoder, rank_encoding):
    """All of the first planes' scripts and signs, and every 29th beyond, where few kinds make up long runs."""
    points = [*range(0x3100), *range(0x3100, 0xD800, 29), *range(0xE000, 0x20000, 29)]
    for at in range(0, len(points), 0x400):
        text = "".join(f"a{c}b {c} 1{c}  {c}{c}x{c}\n {c}" for c in map(chr, points[at : at + 0x400]))
        assert ids_of(encoder, text) == rank_encoding.encode_ordinary(text), hex(points[at])


def test_random_mixtures(encoder, rank_encoding):
    pick = random.Random(1)
    alphabet = ["a", "Zo", "é", "'s", "'LL", "12", " ", "  ", "\n", "\r\n", "\t", " ", "　", "\x1c", "\x85", ".", "!!", "中", "👩‍👩", "<|endoftext|>"]
    texts = ["".join(pick.choices(alphabet, k=pick.randrange(40))) for _ in range(3000)] + ["", " ", "\n\n", "x" * 50_000, " " * 50_000]
    for text, packed in zip(texts, encoder.packed(texts)):
        assert len(packed) // 4 == len(rank_encoding.encode_ordinary(text))
        assert ids_of(encoder, text) == rank_encoding.encode_ordinary(text)


def test_offsets_cover_the_text(encoder):
    text = "Ünïcode 👩 text,\n\n with  gaps"
    spans = encoder.offsets(text)
    assert len(spans) == len(ids_of(encoder, text))
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    covered = {i for a, b in spans for i in range(a, b)}
    assert covered == set(range(len(text)))


def test_edge_rows_round_trip(spark, rank_encoding):
    texts = [None, "", "same", "same", "é" * 5, "👩‍👩‍👧", "long " * 40_000, "<|endoftext|>"]
    rows = [(i if i != 3 else 2, t, "clash", 7) for i, t in enumerate(texts)] + [(None, "no id", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = bpe.encode(docs, JSON, offsets=True, decoded=True)
    assert out.columns == ["doc_id", "text", "ids", "offsets", "decoded", "ids_sha256"]
    got = out.collect()
    short = bpe.encode(docs, JSON, ids=False, digests=True)
    assert short.columns == [*SCHEMA_NAMES, "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"]
    told = sorted((repr(r.doc_id), r.ids_sha256, r.n_tokens, r.decoded_sha256, r.round_trip) for r in short.collect())
    assert told == sorted(
        (repr(r.doc_id), r.ids_sha256, len(r.ids), hashlib.sha256(r.decoded).hexdigest(), True) for r in got
    )
    apart = bpe.decode(bpe.encode(docs, JSON), JSON).select("doc_id", "text", "ids", "decoded", "ids_sha256")
    assert sorted(map(repr, apart.collect())) == sorted(map(repr, out.select(apart.columns).collect()))
    assert len(got) == len(rows)
    for r in got:
        expected = rank_encoding.encode_ordinary(r.text or "")
        assert r.ids == expected and len(r.offsets) == len(expected)
        assert bytes(r.decoded) == (r.text or "").encode()
        packed = b"".join(i.to_bytes(4, "little") for i in expected)
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()


def test_a_cut_through_a_character_decodes_to_its_bytes(spark, encoder):
    ids = ids_of(encoder, "👩")
    assert len(ids) > 1
    halves = spark.createDataFrame([(1, ids[:1]), (2, ids[1:]), (3, None), (4, [])], "k int, ids array<int>")
    parts = {r.k: bytes(r.decoded) for r in bpe.decode(halves, JSON).collect()}
    assert (parts[1] + parts[2]).decode() == "👩" and parts[3] == parts[4] == b""


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bpe.decode(bpe.encode(docs, JSON), JSON).collect() == []


def test_the_memo_turns_over_and_lets_units_in_at_second_sight(encoder, rank_encoding, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 4000)
    fresh = bpe.Encoder(bpe.read_definition(JSON))
    pick = random.Random(6)
    words = ["".join(pick.choices("abcdé中", k=6)) for _ in range(60)]
    for _ in range(40):
        texts = [" ".join(pick.choices(words, k=20)) for _ in range(3)]
        packed, said = fresh.coded(texts)
        assert said == [t.encode() for t in texts]
        assert [len(p) // 4 for p in packed] == [len(rank_encoding.encode_ordinary(t)) for t in texts]
        assert len(fresh.memo.young) + len(fresh.memo.old) <= 2 * 4000 // bpe.ENTRY_BYTES + 2
    once = bpe.Encoder(bpe.read_definition(JSON))
    once.coded(["only once"])
    assert not once.memo.young
    once.coded(["only once"])
    assert set(once.memo.young) == {"only", " once"}
