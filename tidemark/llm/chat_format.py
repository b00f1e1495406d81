"""Chat formatting with a template that is only ever called, never looked into.

A template turns a list of messages (role, text) into one string. For every turn
the prefix of the conversation that ends with it is rendered, and then one turn
more. Where two outputs part, the earlier turn ends; what the shorter one has
beyond is a closing that moves along, or the template rewrites its history (as
some drop former reasoning). Such blocks are marked `rewrites`; a turn
that was rewritten, the one that caused it, and turns whose output didn't last
have no span and no loss. The place of a turn's text inside its
span is found with two one-letter texts in its stead: their outputs differ in that
place alone.

Rendering all prefixes takes the square of a conversation's length, so a long one
goes in blocks: `TURNS` consecutive turn numbers to a block, cut further by rows and
bytes, each rendered after the last `CONTEXT` turns before it. A block whose
first turn comes out otherwise with less context is marked `context`: the
template counts turns, or looks back further. Blocks are dealt by (conversation,
block) and streamed in order, so no task holds a long conversation, and the formatted
blocks are written as Parquet with their spans and loss mask, in code points.

`turn_digests` reads such files. A digest of a whole conversation is sequential; a
conversation of one block is digested where its file is read, the blocks of a longer
one go to one task in order, which holds one block at a time.

Null texts and roles are empty; a null conversation is one of its own; rows without a turn come
first; rows of one turn are ordered by role and text, repeated ones all count. Where turn numbers leave a
gap, or begin late, a block has no context: it is rendered as a beginning, and marked `context` if the
template renders a beginning otherwise. Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = 32
CONTEXT = 2
BLOCK_ROWS = 64
BLOCK_CHARS = 4 << 20
LOSS_ROLES = ("assistant",)
_NO_TURN = -(1 << 62)

Message = tuple[str, str]


class Template(Protocol):
    def render(self, messages: list[Message]) -> str: ...

    def unescape(self, text: str) -> str: ...

    def parse(self, formatted: str) -> list[Message]: ...


class Marked:
    """Turns between start and end marks; `<|` inside a text gets a backslash, and one more for those it has."""

    START, END = "<|im_start|>", "<|im_end|>\n"
    _plain, _escaped = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")

    def escape(self, text: str) -> str:
        return self._plain.sub(r"<\\\1|", text) if "<" in text else text

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"<\1|", text) if "<" in text else text

    def render(self, messages: list[Message]) -> str:
        return "".join(f"{self.START}{self._role(role)}\n{self.escape(text)}{self.END}" for role, text in messages)

    def parse(self, formatted: str) -> list[Message]:
        turns = [turn.partition("\n") for turn in formatted.split(self.START)[1:]]
        return [(self._name(role), self.unescape(rest[: -len(self.END)])) for role, _, rest in turns]

    def _role(self, role: str) -> str:
        return self.escape(role.replace("%", "%25").replace("\n", "%0A"))

    def _name(self, role: str) -> str:
        return self.unescape(role).replace("%0A", "\n").replace("%25", "%")


def _shared(a: str, b: str, most: int | None = None) -> int:
    """Length of the common start, by halving, as slices compare fast."""
    low, high = 0, min(len(a), len(b)) if most is None else most
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


@dataclass
class Block:
    """Formatted turns and, per turn, its span and that of its text (-1 where not located), in code points of `text`."""

    text: str
    tail: str
    spans: list[tuple[int, int]]
    texts: list[tuple[int, int]]
    status: str


def format_block(render: Callable[[list[Message]], str], before: list[Message], turns: list[Message], begins: bool = True) -> Block:
    """Render the prefixes of some turns after a context and locate each turn by what it adds.

    Without a context the turns begin a conversation; `begins` is False where that isn't certain.
    """
    outputs = [render(before) if before else ""]
    outputs += [render(before + turns[: k + 1]) for k in range(len(turns))]
    outputs.append(render(before + turns + turns[-1:]))  # one more, to see where the last ends
    cuts, steady, status = [0 if not before else _shared(outputs[0], outputs[1])], [True], "ok"
    for now, later in zip(outputs[1:], outputs[2:]):
        cut = len(now) if later.startswith(now) else _shared(now, later)
        steady.append(cut >= cuts[-1] and later.endswith(now[cut:]))
        if not steady[-1]:
            status = "rewrites"
        cuts.append(cut)
    final, start = outputs[-2], cuts[0]
    if status == "ok" and len(before) > 1:
        short = render(before[-1:] + turns[:1])
        if short[_shared(short, render(before[-1:])) :] != outputs[1][start:]:
            status = "context"
    if status == "ok" and not before and not begins:
        again = render(turns[:1] * 2)
        if again[_shared(again, outputs[1]) :] != outputs[1]:
            status = "context"
    spans, texts = [], []
    for k, (role, _) in enumerate(turns):
        a, b, out = cuts[k], cuts[k + 1], outputs[k + 1]
        if not (steady[k] and steady[k + 1]) or final[:b] != out[:b]:
            spans.append((-1, -1))
            texts.append((-1, -1))
            continue
        spans.append((a - start, b - start))
        head = before + turns[:k]
        one, two = render([*head, (role, "0")]), render([*head, (role, "1")])
        first = _shared(one, two)
        # both end alike from the place of the letter on
        last = len(out) - (len(one) - first - 1)
        texts.append((first - start, last - start) if len(one) == len(two) and first <= last else (-1, -1))
    end = cuts[-1] if status != "rewrites" else len(final)
    return Block(final[start:end], final[end:], spans, texts, status)


def _blocks(rows: Iterator[tuple], turns: int) -> Iterator[tuple[object, int, int, list[Message], list[Message]]]:
    """(conversation, block, part, context, turns) of sorted rows; parts are bounded by rows and code points."""
    key, part, before, held, size = None, 0, [], [], 0
    for conv, block, context, role, text in rows:
        if key != (conv, block):
            if held:
                yield *key, part, before, held
            key, part, before, held, size = (conv, block), 0, [], [], 0
        if context:
            before = [*before, (role, text)][-CONTEXT:]
            continue
        if held and (len(held) >= turns or size + len(text) > BLOCK_CHARS):
            yield *key, part, before, held
            part, before, held, size = part + 1, [*before, *held][-CONTEXT:], [], 0
        held.append((role, text))
        size += len(text)
    if held:
        yield *key, part, before, held


def format_chats(conversations: DataFrame, path: str, template: Template | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", turns: int = TURNS) -> DataFrame:
    """Write formatted blocks below `path` and return them: conv_id, block, part, text, tail, spans, loss, status."""
    template = template or Marked()
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = conversations.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), plain(role).alias("role"), plain(text).alias("text"))
    block = F.floor(F.col("turn") / turns)
    place = lambda b, context: F.struct(F.coalesce(b, F.lit(_NO_TURN)).alias("block"), F.lit(context).alias("context"))
    next_one = F.when(F.pmod("turn", F.lit(turns)) >= turns - CONTEXT, F.array(place(block + 1, True))).otherwise(F.array())
    dealt = rows.withColumn("p", F.explode(F.concat(F.array(place(block, False)), next_one))).select("conv_id", "p.*", "turn", "role", "text")
    dealt = dealt.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text")
    spans = T.ArrayType(T.IntegerType())
    names = ["turn_start", "turn_end", "text_start", "text_end"]
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("block", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("tail", T.StringType()), *[T.StructField(n, spans) for n in names], T.StructField("loss", T.ArrayType(T.BooleanType())), T.StructField("status", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list[pa.DataType] = []

        def stream() -> Iterator[tuple]:
            for batch in batches:
                kind[:] = [batch.schema.field("conv_id").type]
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "context", "role", "text")), strict=True)

        held: list[tuple] = []
        size = 0
        for key, number, part, before, messages in _blocks(stream(), BLOCK_ROWS):
            found = format_block(template.render, before, messages, begins=number in (0, _NO_TURN))
            loss = [r in LOSS_ROLES and a >= 0 for (r, _), (a, _) in zip(messages, found.texts, strict=True)]
            held.append((key, number, part, found.text, found.tail, *([x[i] for x in pair] for pair in (found.spans, found.texts) for i in (0, 1)), loss, found.status))
            size += len(found.text)
            if size > BLOCK_CHARS:
                yield _batch(held, kind[0], schema.names)
                held, size = [], 0
        if held:
            yield _batch(held, kind[0], schema.names)

    dealt.mapInArrow(run, schema).write.parquet(path)
    return conversations.sparkSession.read.schema(schema).parquet(path)


def _batch(rows: list[tuple], key: pa.DataType, names: list[str]) -> pa.RecordBatch:
    spans = pa.list_(pa.int32())
    types = [key, pa.int64(), pa.int32(), pa.string(), pa.string(), spans, spans, spans, spans, pa.list_(pa.bool_()), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types, strict=True)], names=names)


class _Digest:
    """What a conversation's blocks give, added in order."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.tail = 0

    def add(self, template: Template, text: str, tail: str, starts: list[int], ends: list[int], loss: list[bool]) -> None:
        for role, said in template.parse(text):
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n_turns += 1
        for a, b, counts in zip(starts, ends, loss, strict=True):
            if counts:
                said = template.unescape(text[a:b])
                self.loss.update(said.encode())
                self.loss_chars += len(said)
        self.chars += len(text)
        self.tail = len(tail)  # only the last block's closing stays

    def row(self, key: object) -> tuple:
        return key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars + self.tail


def turn_digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation, from its formatted blocks: turns, digests of turns and of the text under the loss mask, lengths."""
    template = template or Marked()
    columns = ["conv_id", "text", "tail", "text_start", "text_end", "loss"]
    counted = formatted.groupBy("conv_id").agg(F.count(F.lit(1)).alias("blocks")).where("blocks > 1").select(F.col("conv_id").alias("several"))
    split = F.col("conv_id").eqNullSafe(F.col("several"))
    single = formatted.join(counted, split, "left_anti").select(*columns)
    several = formatted.join(counted, split, "left_semi").repartition("conv_id").sortWithinPartitions("conv_id", "block", "part").select(*columns)
    key = formatted.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", key), *[T.StructField(n, T.StringType() if n.endswith("256") else T.LongType()) for n in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, found, kind = None, None, [], None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv, *block in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if held is None or conv != now:
                    if held:
                        found.append(held.row(now))
                    now, held = conv, _Digest()
                held.add(template, *block)
            if len(found) > 4096:
                yield _digests(found, kind, schema.names)
                found = []
        if held:
            found.append(held.row(now))
        if found:
            yield _digests(found, kind, schema.names)

    return single.mapInArrow(run, schema).union(several.mapInArrow(run, schema))


def _digests(rows: list[tuple], key: pa.DataType, names: list[str]) -> pa.RecordBatch:
    types = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types, strict=True)], names=names)
