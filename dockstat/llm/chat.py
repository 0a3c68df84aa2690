"""Chat formatting by a declarative template and a role state machine.

A `Template` names the marks around each role's text, the roles under the loss,
and the allowed transitions between roles.  Each turn becomes segments (text,
loss): opening mark, escaped text, closing mark.  Marks inside texts are escaped
reversibly (a backslash after the first character of each mark, and backslashes
doubled), so the output alone gives roles and texts back.

Turns are range-partitioned by (conv_id, turn), so a conversation of any size is
spread over tasks.  A task that starts inside a conversation does not know the
state it starts in: it runs the machine from every state at once and writes, on
its last row of that conversation, where each of them would end.  Composing these
few maps in order gives the conversation's verdict.

Defined cases: null text is empty; a null or unknown role is formatted under the
template's general mark (null as the empty role) and makes the conversation
invalid; turns with equal numbers are ordered by role, then text, nulls first; a
null conv_id is one conversation; an empty table gives no rows.  Conversations
that break the turn order are formatted too, with valid = false.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.llm.common import importable, staged

ERROR = "error"


@dataclass(frozen=True)
class Template:
    """Marks, loss roles and turn order, as plain data."""
    marks: dict[str, tuple[str, str]]
    other: tuple[str, str, str]  # before the role, between role and text, after the text
    loss_roles: frozenset[str]
    start: str
    transitions: dict[tuple[str, str], str]
    accept: frozenset[str]
    strings: tuple[str, ...] = field(default=())  # escaped inside texts

    def states(self) -> list[str]:
        found = {self.start, ERROR, *(s for s, _ in self.transitions), *self.transitions.values()}
        return [self.start, ERROR, *sorted(found - {self.start, ERROR})]


INSTRUCT = Template(
    marks={"system": ("<s>[SYS] ", " [/SYS]</s>"),
           "user": ("<s>[INST] ", " [/INST]</s>"),
           "assistant": ("<s>[ANS] ", " [/ANS]</s>")},
    other=("<s>[ROLE] ", " [TEXT] ", " [/ROLE]</s>"),
    loss_roles=frozenset({"assistant"}),
    start="start",
    transitions={("start", "system"): "instructed", ("start", "user"): "asked",
                 ("instructed", "user"): "asked", ("asked", "assistant"): "answered",
                 ("answered", "user"): "asked"},
    accept=frozenset({"answered"}),
    strings=("<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ANS]", "[/ANS]",
             "[ROLE]", "[/ROLE]", "[TEXT]"),
)


class Formatter:
    """Escaping and the turn format of one template."""

    def __init__(self, template: Template):
        self.t = template
        # at every place where a mark begins, marks that overlap others included
        self.marked = re.compile(f"(?=(?:{'|'.join(map(re.escape, template.strings))}))(.)", re.S)

    def escape(self, text: str) -> str:
        return self.marked.sub(r"\1\\", text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn as (text, loss) segments."""
        if role in self.t.marks:
            begin, end = self.t.marks[role]
        else:
            before, between, end = self.t.other
            begin = before + self.escape(role) + between
        return [(begin, False), (self.escape(text), role in self.t.loss_roles), (end, False)]

    def parse(self, turn: str) -> tuple[str, str]:
        """(role, text) of a formatted turn."""
        for role, (begin, end) in self.t.marks.items():
            if turn.startswith(begin) and turn.endswith(end):
                return role, self.unescape(turn[len(begin):len(turn) - len(end)])
        before, between, end = self.t.other
        role, _, body = turn[len(before):len(turn) - len(end)].partition(between)
        return self.unescape(role), self.unescape(body)


FORMATTED_SCHEMA = ("conv_id long, part int, seq long, segments array<struct<text: string, loss: boolean>>, "
                    "ends array<int>")
SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, states = Formatter(template), template.states()
        number = {s: i for i, s in enumerate(states)}
        step = {(number[s], r): number[n] for (s, r), n in template.transitions.items()}
        error, identity = number[ERROR], list(range(len(states)))
        part, seq, conv, ends, held = TaskContext.get().partitionId(), 0, None, identity, None

        def batch_of(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 pa.array([[{"text": t, "loss": x} for t, x in s] for s in cols[3]], SEGMENTS),
                 pa.array(cols[4], pa.list_(pa.int32()))], ["conv_id", "part", "seq", "segments", "ends"])

        for b in batches:
            rows = []
            for c, role, text in zip(b["conv_id"].to_pylist(), b["role"].to_pylist(), b["text"].to_pylist()):
                if held is not None:
                    rows.append((*held, ends if c != conv else None))
                    if c != conv:
                        ends = identity
                conv, role = c, role or ""
                ends = [step.get((s, role), error) for s in ends]
                held = (c, part, seq, form.segments(role, text or ""))
                seq += 1
            if rows:
                yield batch_of(rows)
        if held is not None:
            yield batch_of([(*held, ends)])
    return run


def format_conversations(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Write the formatted turns and return them as read back.

    Rows in (conv_id, part, seq) order are the output; `segments` carries the text
    and its loss flag, `ends` is the run's state map on its last row.
    """
    importable(turns.sparkSession)
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    keys = ["conv_id", "turn", "role", "text"]
    ordered = turns.repartitionByRange("conv_id", "turn").sortWithinPartitions(*keys)
    return staged(ordered.mapInArrow(_format(template), FORMATTED_SCHEMA), "chat")


DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long, valid boolean")


def _digest(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, states = Formatter(template), template.states()
        accept = {i for i, s in enumerate(states) if s in template.accept}
        fields = [f.split()[0] for f in DIGEST_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        conv, opened = None, False
        turns = loss = n = chars = loss_chars = state = None

        def row():
            return (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, state in accept)

        for b in batches:
            out = []
            for c, segments, ends in zip(b["conv_id"].to_pylist(), b["segments"].to_pylist(),
                                         b["ends"].to_pylist()):
                if not opened or c != conv:
                    if opened:
                        out.append(row())
                    conv, opened, turns, loss = c, True, hashlib.sha256(), hashlib.sha256()
                    n = chars = loss_chars = state = 0
                turn = "".join(s["text"] for s in segments)
                role, text = form.parse(turn)
                turns.update(f"{role}\n{text}\n".encode())
                for s in segments:
                    if s["loss"]:
                        plain = form.unescape(s["text"])
                        loss.update(plain.encode())
                        loss_chars += len(plain)
                n, chars = n + 1, chars + len(turn)
                if ends is not None:
                    state = ends[state]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], fields)
        if opened:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row(), kinds)], fields)
    return run


def conversation_digests(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation, from the output alone: digests, loss extent, verdict.

    A SHA-256 over a whole conversation is one sequential computation, so its turns
    stream through one task in order; nothing of them is held.
    """
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq") \
        .mapInArrow(_digest(template), DIGEST_SCHEMA)
