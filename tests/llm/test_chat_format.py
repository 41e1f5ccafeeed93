from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from countermill.llm import chat_format as chat
from tests.helpers import rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BITS = ("<", "\\", "/", "t", "turn", "</turn>\n", ">", "<turn:user>", "%3E", "a", "é", "\n")
HARD = st.lists(st.sampled_from(BITS), max_size=12).map("".join)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def conversations(spark, *more):
    table = [
        (1, 0, "user", "hello <turn:assistant>"),
        (1, 1, "assistant", r"<\turn </turn> <\\/turn>" + "\n</turn>\n"),
        (2, 1, "assistant", "second"),
        (2, 0, "system", "first"),
        (3, 0, "user", None),
        (3, 1, None, "no role"),
        (3, 1, None, "no role"),
        (3, None, "assistant", ""),
        (None, 0, "assistant", "x" * 200_000),
        (None, 1, "a>b%3E<", "é你 "),
        (4, 0, "assistant", "<"),
        (4, 1, "assistant", "/turn>\n"),
    ]
    return spark.createDataFrame([*table, *more], SCHEMA)


def brute(table) -> list[tuple]:
    groups: dict = {}
    for conv_id, turn, role, text in table:
        groups.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv_id, turns in groups.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        digest = sha("".join(f"{r}\n{t}\n" for r, t in turns))
        out.append((conv_id, len(turns), digest, len(loss), sha(loss), len(chat.turn_template(turns))))
    return sorted(out, key=repr)


@given(HARD)
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_hides_control_strings(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert "<turn" not in hidden and "</turn" not in hidden


@given(st.lists(st.tuples(HARD, HARD), max_size=6), st.integers(1, 7))
@settings(max_examples=200, deadline=None)
def test_formatted_text_parses_back_in_parts_of_any_size(turns, size):
    text, parser = chat.turn_template(turns), chat.TurnParser()
    found = [t for i in range(0, len(text), size) for t in parser.feed(text[i : i + size])]
    assert found == turns


def test_read_back_equals_brute_force(spark):
    table = [tuple(r) for r in conversations(spark).collect()]
    wide = conversations(spark).selectExpr("*", "1 as position", "'p' as piece", "0 as start")
    pieces = chat.format_conversations(wide)
    assert rows(chat.read_back(pieces, in_order=True)) == brute(table)
    assert rows(chat.read_back(pieces.repartition(5))) == brute(table)
    assert rows(chat.read_back(chat.format_conversations(wide.limit(0)))) == []


def test_spans_hold_the_texts(spark):
    pieces = chat.format_conversations(conversations(spark)).collect()
    for conv_id in {r.conv_id for r in pieces}:
        own = sorted((r for r in pieces if r.conv_id == conv_id), key=lambda r: r.position)
        whole = "".join(r.piece for r in own)
        assert [r.start for r in own] == [whole.index(r.piece, r.start) for r in own]
        for r in own:
            assert (r.loss_start is not None) == (r.role == "assistant")
        loss = [chat.unescape(whole[r.loss_start : r.loss_end]) for r in own if r.role == "assistant"]
        given_texts = sorted(
            ((x.turn is not None, x.turn or 0, x.text or "") for x in conversations(spark).collect() if x.conv_id == conv_id and x.role == "assistant")
        )
        assert loss == [x[-1] for x in given_texts]


def opening(turns):
    """A text before all turns."""
    return "BEGIN\n" + chat.turn_template(turns)


def counting(turns):
    """Looks back over the whole conversation: each turn carries its number."""
    return "".join(f"[{i}]{role}:{text};" for i, (role, text) in enumerate(turns))


def forgetful(turns):
    """Drops the texts of earlier assistant turns."""
    last = len(turns) - 1
    return "".join(f"{r}:{t if i == last or r != 'assistant' else ''};" for i, (r, t) in enumerate(turns))


TURNS = [(("user", "assistant")[i % 2], f"text {i}") for i in range(100)]


@pytest.mark.parametrize("template", [chat.turn_template, opening, counting])
def test_long_conversations_render_like_the_whole(template):
    renderer = chat.PrefixRenderer(template, ("assistant",), window=4)
    found = [renderer.add(*turn) for turn in TURNS]
    whole = template(TURNS)
    assert "".join(piece for _, piece, *_ in found) == whole
    assert [whole[a:b] for _, _, a, b, _ in found if a is not None] == [t for r, t in TURNS if r == "assistant"]
    assert renderer.local is (template is not counting)
    assert len(renderer.held) <= 8 or template is counting


def test_rewritten_history_is_detected():
    renderer = chat.PrefixRenderer(forgetful, ("assistant",))
    found = [renderer.add(*turn) for turn in TURNS[:4]]
    assert [f[-1] for f in found] == [False, False, True, True]
    out = ""
    for start, piece, *_ in found:
        out = out[:start] + piece
    assert out == forgetful(TURNS[:4])
    assert all(f[2] is None for f in found[2:])


def test_rewriting_templates_give_no_mask(spark):
    out = chat.read_back(chat.format_conversations(conversations(spark), template=chat.turn_template))
    assert all(r.loss_sha256 is not None for r in out.collect())
    pieces = chat.format_conversations(conversations(spark), template=lambda turns: f"{len(turns)}" + chat.turn_template(turns))
    found = {r.conv_id: r.loss_sha256 for r in chat.read_back(pieces).collect()}
    assert found[1] is None and found[2] is None


def test_far_looking_templates_fail_when_they_cannot_be_held():
    renderer = chat.PrefixRenderer(counting, ("assistant",), window=2, history=50)
    with pytest.raises(ValueError):
        for turn in TURNS:
            renderer.add(*turn)
