import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from winnow.llm import bpe, chat, queries

JSON = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = [*chat.CONTROLS, "<|endoftext|>", "\\", "[", "<", "/", "]", ">", "INST", "s", " ", "\n", "é", "👩‍👩", "中", "word", "I", "[INS", "T]"]


@pytest.fixture(scope="module")
def formatter():
    return chat.Formatter(bpe.read_definition(JSON))


def conversations(seed, count):
    pick = random.Random(seed)
    text = lambda: "".join(pick.choices(PARTS, k=pick.randrange(12)))
    roles = ["user", "assistant", "system", "tool", "", "[ROLE]", "a\nb", "\\"]
    return [[(pick.choice(roles), text()) for _ in range(pick.randrange(7))] for _ in range(count)]


def test_turns_and_loss_come_back(formatter):
    for turns in conversations(1, 1500):
        rendered, ids, spans, mask = formatter.format(turns)
        assert formatter.template.read(rendered) == turns
        assert formatter.loss_text(ids, mask) == "".join(x for r, x in turns if r == "assistant")
        assert b"".join(map(formatter.bytes_of.__getitem__, ids.tolist())).decode() == rendered


def test_no_token_crosses_a_border_and_the_mask_equals_a_scan(formatter):
    for turns in conversations(2, 300):
        pieces, texts = formatter.render(turns)
        ids, spans = formatter.encode(pieces)
        learnt = [tuple(s) for s, (r, _) in zip(texts.tolist(), turns) if r == "assistant"]
        _, _, _, mask = formatter.format(turns)
        assert mask.tolist() == [any(a < e and s < b for s, e in learnt) for a, b in spans.tolist()]
        for (a, b), m in zip(spans.tolist(), mask):
            assert not m or any(s <= a and b <= e for s, e in learnt)


def test_escaped_texts_hold_no_control_string(formatter):
    for turns in conversations(3, 500):
        for _, text in turns:
            escaped = formatter.template.escape(text)
            assert not any(c in escaped for c in formatter.template.controls)
            assert formatter.template.unescape(escaped) == text


def test_ids_and_offsets_equal_those_of_the_library(formatter):
    """The library itself, with the control strings as special tokens of its own."""
    from tokenizers import AddedToken, Tokenizer

    library = Tokenizer.from_str(formatter.definition)
    library.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in chat.CONTROLS])
    for turns in conversations(7, 400):
        pieces, _ = formatter.render(turns)
        ids, spans = formatter.encode(pieces)
        expected = library.encode("".join(pieces), add_special_tokens=False)
        assert ids.tolist() == expected.ids
        assert [tuple(s) for s in spans.tolist()] == expected.offsets


def test_pieces_of_a_long_conversation_give_the_same(formatter, monkeypatch):
    turns = [t for c in conversations(4, 60) for t in c]
    whole = formatter.encode(["".join(formatter.render(turns)[0])])
    monkeypatch.setattr(chat, "ENCODE_CHARS", 40)
    apart = formatter.encode(formatter.render(turns)[0])
    assert np.array_equal(whole[0], apart[0]) and np.array_equal(whole[1], apart[1])


def test_text_outside_of_turns_is_an_error(formatter):
    with pytest.raises(ValueError, match="character 10"):
        formatter.template.read("<s>one</s>two")


def test_edge_tables(spark):
    long = "long \\ text [INST] " * 20_000
    rows = [(1, None, None, None, "x", 1), (1, 2, "assistant", long, "x", 2), (1, 2, "assistant", long, "x", 2), (None, 0, "user", "", None, None)]
    made = chat.format_conversations(spark.createDataFrame(rows, SCHEMA + ", formatted string, ids int"), JSON)
    assert made.columns == ["conv_id", "formatted", "ids", "offsets", "loss"]
    got = {r.conv_id: r for r in chat.read_back(made, JSON).collect()}
    assert [tuple(t) for t in got[1].turns] == [("", ""), ("assistant", long), ("assistant", long)] and got[1].loss_text == long * 2
    assert [tuple(t) for t in got[None].turns] == [("user", "")] and got[None].loss_text == ""
    empty = chat.format_conversations(spark.createDataFrame([], SCHEMA), JSON)
    assert chat.read_back(empty, JSON).collect() == []


def test_the_query_equals_its_contract(spark, tmp_path):
    flat = [(c, t, r, x) for c, turns in enumerate(conversations(5, 200)) for t, (r, x) in enumerate(turns)]
    pick = random.Random(2)
    flat = [(c, t, r, None if pick.random() < 0.05 else x) for c, t, r, x in flat]
    spark.createDataFrame(pick.sample(flat, len(flat)), SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op13_offset_masks(spark, str(tmp_path)).collect()}
    flat += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == {c for c, *_ in flat}
    for conv, r in got.items():
        turns = sorted((t, role, x or "") for c, t, role, x in flat if c == conv)
        digest = hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in turns).encode()).hexdigest()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), digest)
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars > sum(len(x) for *_, x in turns)
