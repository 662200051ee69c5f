"""Chat formatting: round trips, masks, long conversations and edge cases."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from billing_guard.llm import chat
from tests.llm.conftest import by

PIECES = list(chat.CONTROL) + ["<", "[", "\\", "/", "s>", "INST]", " ", "SYS>>", "ok", "\n", "ROLE]", "é"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)
ROLES = st.one_of(st.sampled_from([chat.USER, chat.SYSTEM, chat.ASSISTANT, "tool", ""]), TEXT)


@settings(max_examples=800, deadline=None)
@given(st.lists(st.tuples(ROLES, TEXT), max_size=5))
def test_any_conversation_reads_back(turns):
    text, loss = chat.format_turns(turns)
    parsed = chat.parse(text)
    assert [(role, said) for role, said, _, _ in parsed] == turns
    assert [chat.unescape(text[a:b]) for a, b in loss] == [t for r, t in turns if r == chat.ASSISTANT]
    for _, _, start, end in parsed:  # the text under a turn holds no control string
        assert not any(c in text[start:end] for c in chat.CONTROL)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROL)


def test_only_conflicts_are_escaped():
    plain = "a < b [1] \\ <b>bold</b>"
    text, _ = chat.format_turns([(chat.USER, plain), (chat.ASSISTANT, "</s>"), (chat.SYSTEM, "<\\s>")])
    assert text == f"[INST] {plain} [/INST]<\\/s></s><<SYS>><\\\\s><</SYS>>"


@pytest.mark.parametrize("text", ["[INST] no end", "x", "</s>[/INST]</s>", "[INST] a</s> [/INST]", "[ROLE]a</s>"])
def test_what_is_no_sentence_is_refused(text):
    with pytest.raises(chat.GrammarError):
        chat.parse(text)


def expected(turns):
    said = "".join(t for r, t in turns if r == chat.ASSISTANT)
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(said), hashlib.sha256(said.encode()).hexdigest(), len(chat.format_turns(turns)[0]))


SCHEMA = "conv_id long, turn long, role string, text string, place int, part int, whole boolean, loss string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 9, 9, True, "x") for r in rows], SCHEMA)


def test_long_and_short_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_TURNS", 7)
    roles = [chat.USER, chat.ASSISTANT, chat.SYSTEM, "tool"]
    rows = [(5, i, roles[i % 4], f"turn {i} </s>") for i in range(600)]           # over several partitions
    rows += [(c, i, roles[i % 2], "x" * c) for c in range(10, 90) for i in range(1 + c % 4)]
    rows += [(3, 0, "user", "y" * 3_000_000), (3, 1, "assistant", "z"), (3, 2, "user", "w")]
    parts = chat.format_conversations(conversations(spark, rows))
    held = by(parts, "conv_id")
    assert len(held[5]) > 80 and max(p.n_turns for p in held[5]) <= 7 and not any(p.whole for p in held[5])
    assert sum(p.whole for ps in held.values() for p in ps) > 40
    got = by(chat.read_conversations(parts), "conv_id")
    for conv in held:
        turns = [(r, t) for c, _, r, t in sorted(x for x in rows if x[0] == conv)]
        assert [tuple(r)[1:] for r in got[conv]] == [expected(turns)]


def test_edge_cases(spark):
    rows = [(None, 1, "user", "a"), (None, 0, "assistant", "b"), (1, 0, None, None), (1, 1, "user", None),
            (2, 0, "user", ""), (2, 1, "assistant", ""), (3, 0, "user", "same"), (3, 0, "user", "same"),
            (4, 7, "assistant", "later"), (4, None, "system", "first")]
    got = by(chat.read_conversations(chat.format_conversations(conversations(spark, rows))), "conv_id")
    said = {None: [("assistant", "b"), ("user", "a")], 1: [("", ""), ("user", "")],
            2: [("user", ""), ("assistant", "")], 3: [("user", "same")] * 2,
            4: [("system", "first"), ("assistant", "later")]}
    assert {k: [tuple(r)[1:] for r in v] for k, v in got.items()} == {k: [expected(v)] for k, v in said.items()}
    none = chat.format_conversations(conversations(spark, []))
    assert chat.read_conversations(none).count() == 0


def test_a_conversation_of_equal_rows_is_spread(spark):
    rows = conversations(spark, [(1, 0, "user", "hi")] * 4_000)
    parts = chat.format_conversations(rows)
    assert parts.select("place").distinct().count() > 4
    digest, = chat.read_conversations(parts).collect()
    assert tuple(digest)[1:] == expected([("user", "hi")] * 4_000)
