"""Chat formatting: a finite-state machine over roles checks the turn order
and emits each turn as text segments with loss flags, from a declarative
template whose control strings are escaped reversibly inside texts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import partitions, ship_package


@dataclass(frozen=True)
class Template:
    """``opening role head text closing`` per turn; ``loss_roles`` are trained
    on; ``moves[state][role]`` is the next state, any other role is out of
    order.  A control string begins with a character of ``marks``."""
    opening: str = "<|turn|>"
    head: str = "\n"
    closing: str = "<|end|>\n"
    marks: str = "<["
    loss_roles: frozenset = frozenset({"assistant"})
    start: str = "start"
    moves: dict = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })

    def escape(self, text: str) -> str:
        """A backslash is doubled and one is put behind every mark, so that no
        control string can appear in the result."""
        out = text.replace("\\", "\\\\")
        for mark in self.marks:
            out = out.replace(mark, mark + "\\")
        return out

    def unescape(self, text: str) -> str:
        marks = re.escape(self.marks)
        return re.sub(rf"([{marks}])\\|\\([\\n])",
                      lambda m: m[1] or ("\n" if m[2] == "n" else "\\"), text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        name = self.escape(role).replace("\n", "\\n")
        return [(self.opening + name + self.head, False),
                (self.escape(text), role in self.loss_roles), (self.closing, False)]

    def parse(self, formatted: str) -> tuple[str, str]:
        """Role and text of one formatted turn, from the string alone."""
        body = formatted[len(self.opening):len(formatted) - len(self.closing)]
        role, _, text = body.partition(self.head)
        return self.unescape(role), self.unescape(text)


SEGMENTS = "conv_id bigint, position bigint, segments array<struct<text: string, loss: boolean>>, in_order boolean"
DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
          "formatted_chars bigint, in_order boolean")
_SEGMENT_TYPE = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def format_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per turn: ``conv_id, position`` (0, 1, ...), ``segments``
    (their texts in sequence are the formatted turn) and ``in_order`` (the
    state machine accepts the role here; an unknown role keeps the state).

    Rows are taken by turn; null turns come first and ties are ordered by role
    and text; repeated rows stay.  Null role or text is the empty string; null
    ``conv_id`` is a conversation of its own.  Other columns are not read.
    Turns stream through a sorted partition: memory holds one batch and one
    state, also for a conversation with very many turns (its turns are read by
    one task, as their order asks).
    """
    ship_package(turns.sparkSession)
    source = (turns.select(F.col("conv_id").cast("bigint"), F.col("turn"),
                           F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
              .repartition(partitions(turns.sparkSession), "conv_id")
              .sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, position, state = object(), 0, template.start
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != current:
                    current, position, state = conv, 0, template.start
                target = template.moves.get(state, {}).get(role)
                rows.append((conv, position, [{"text": t, "loss": loss} for t, loss in template.segments(role, text)],
                             target is not None))
                state = target or (role if role in template.moves else state)
                position += 1
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], _SEGMENT_TYPE),
                     pa.array(cols[3], pa.bool_())], names=["conv_id", "position", "segments", "in_order"])
    return source.mapInArrow(run, SEGMENTS)


class _Digest:
    def __init__(self, conv, template: Template):
        self.conv, self.template, self.n, self.loss_chars, self.chars, self.ok = conv, template, 0, 0, 0, True
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segments: list[dict], in_order: bool) -> None:
        formatted = "".join(s["text"] for s in segments)
        role, text = self.template.parse(formatted)
        trained = self.template.unescape("".join(s["text"] for s in segments if s["loss"]))
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(trained.encode())
        self.n += 1
        self.loss_chars += len(trained)
        self.chars += len(formatted)
        self.ok &= in_order

    def row(self) -> tuple:
        return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.ok)


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, what the output of ``format_turns`` holds when it is
    parsed again: number of turns, digest of roles and texts, length and digest
    of the text under the loss mask, length of the whole, ``in_order`` if every
    turn was.  Reads the rows in the order ``format_turns`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=[f.split()[0] for f in DIGEST.split(", ")])
        digest = None
        for batch in batches:
            done = []
            for conv, segments, ok in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segments", "in_order"))):
                if digest is None or conv != digest.conv:
                    if digest is not None:
                        done.append(digest.row())
                    digest = _Digest(conv, template)
                digest.add(segments, ok)
            if done:
                yield out(done)
        if digest is not None:
            yield out([digest.row()])
    return formatted.mapInArrow(run, DIGEST)
