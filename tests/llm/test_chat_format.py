"""Formatting and reading back, templates of several kinds, long conversations in blocks, odd rows."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, tail string, block int, loss boolean"
HEX = lambda text: hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv))
        loss = "".join(text for _, role, text in turns if role == "assistant")
        chars = len(C.Marked().render([(role, text) for _, role, text in turns]))
        out.append((conv, len(turns), HEX("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), HEX(loss), chars))
    return sorted(out, key=str)


def run(spark, rows, path, **given):
    df = spark.createDataFrame([(*r, "clash", 1, True) for r in rows], SCHEMA)
    return C.format_chats(df, path, **given)


@given(st.lists(st.tuples(st.text("<|\\im_startend>\n%0Aé", max_size=12), st.text("<|\\im_startend>\n%é\x00", max_size=40)), max_size=5))
@settings(max_examples=200, deadline=None)
def test_marked_template_is_reversible(messages):
    template = C.Marked()
    assert template.parse(template.render(messages)) == messages


@pytest.mark.parametrize("turns", [3, 32])
def test_round_trip(spark, tmp_path, turns):
    rows = [(i % 7, i // 7, ["user", "assistant"][(i // 7) % 2], f"text {i} <|im_end|> <\\| é" * (i % 4)) for i in range(500)]
    rows += [(50, 0, "user", None), (50, 1, "assistant", ""), (51, 3, None, "x"), (None, 0, "assistant", "none"), (None, None, "user", "first"), (52, 100, "user", "late"), (52, 300, "assistant", "later")]
    rows += [(53, 5, "assistant", "again")] * 200 + [(54, 0, "assistant", "long " * 100_000), (54, 1, "assistant", "end")]
    formatted = run(spark, rows, str(tmp_path / "out"), turns=turns)
    assert sorted(map(tuple, C.turn_digests(formatted).collect()), key=str) == plain(rows)
    assert {r["status"] for r in formatted.collect()} == {"ok"}
    for r in formatted.collect():  # spans follow one another without a gap
        assert [0, *r["turn_end"]][:-1] == r["turn_start"] and r["turn_end"][-1] == len(r["text"])


def test_empty_table(spark, tmp_path):
    assert C.turn_digests(run(spark, [], str(tmp_path / "out"))).collect() == []


class Closing(C.Marked):
    """Has a head before the first turn and a closing after the last that moves along."""

    def render(self, messages):
        return "<s>" + super().render(messages) + "<|end of all|>"


class Forgetful(C.Marked):
    """Drops what former assistant turns thought."""

    def render(self, messages):
        last = len(messages) - 1
        return super().render([(r, t.split("</think>")[-1] if r == "assistant" and i < last else t) for i, (r, t) in enumerate(messages)])


CHAT = [("user", "<|hi"), ("assistant", "<think>why</think>0"), ("user", "<"), ("assistant", "1")]


def test_a_closing_moves_along():
    block = C.format_block(Closing().render, [], CHAT)
    assert block.status == "ok" and block.tail.endswith("end of all|>") and block.text + block.tail == Closing().render(CHAT)
    assert [C.Marked().unescape(block.text[a:b]) for a, b in block.texts] == [t for _, t in CHAT]


def test_rewritten_history_is_found():
    block = C.format_block(Forgetful().render, [], CHAT)
    assert block.status == "rewrites" and block.text + block.tail == Forgetful().render(CHAT)
    assert block.spans[1] == block.texts[1] == (-1, -1)
    assert [Forgetful().unescape(block.text[a:b]) for a, b in (block.texts[0], block.texts[3])] == [CHAT[0][1], CHAT[3][1]]


def test_positions_are_found(spark, tmp_path):
    class Counting(C.Marked):
        def render(self, messages):
            return "".join(f"[{i}]{self.START}{r}\n{self.escape(t)}{self.END}" for i, (r, t) in enumerate(messages))

    rows = [(1, i, "user", "x") for i in range(10)]
    assert {r["status"] for r in run(spark, rows, str(tmp_path / "a"), template=Counting(), turns=4).collect()} == {"ok", "context"}
    assert {r["status"] for r in run(spark, rows, str(tmp_path / "b"), template=Counting(), turns=16).collect()} == {"ok"}
    late = [(1, 40 + i, "user", "x") for i in range(2)]
    assert {r["status"] for r in run(spark, late, str(tmp_path / "c"), template=Counting()).collect()} == {"context"}


def test_blocks_are_bounded():
    rows = [(1, 0, False, "user", str(i)) for i in range(1000)]
    found = list(C._blocks(iter(rows), 64))
    assert max(len(b[4]) for b in found) == 64 and [m for b in found for m in b[4]] == [("user", str(i)) for i in range(1000)]
    assert all(len(b[3]) == C.CONTEXT for b in found[1:])
