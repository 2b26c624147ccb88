"""Chat formatting: a role state machine and a declarative template give text segments with loss flags."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Mark(NamedTuple):
    """What stands before and after a turn's text, and whether the text counts for the loss."""

    before: str
    after: str
    loss: bool


class Template(NamedTuple):
    """``start`` opens a conversation. Roles without a mark of their own use ``other``: their name
    stands between ``other.before`` and ``named``. ``controls`` occur in a text only escaped.

    A control begins with one of its own first characters and holds none of them further on, so no
    control can arise where a text and a mark meet.
    """

    start: str
    marks: dict[str, Mark]
    other: Mark
    named: str
    controls: tuple[str, ...]


TEMPLATE = Template(
    start="<s>",
    marks={
        "system": Mark("[SYS] ", " [/SYS]", False),
        "user": Mark("[INST] ", " [/INST]", False),
        "assistant": Mark("[OUT] ", "</s>", True),
    },
    other=Mark("[ROLE]", " [/ROLE]", False),
    named="[TEXT] ",
    controls=("<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[OUT]", "[ROLE]", "[TEXT]", "[/ROLE]"),
)

#: role state -> roles that may follow. A conversation ends well after an assistant's turn.
TRANSITIONS = {
    "start": {"system", "user"},
    "system": {"user"},
    "user": {"assistant"},
    "assistant": {"user"},
}


def escape(text: str, template: Template = TEMPLATE) -> str:
    """A backslash before every control string and every backslash."""
    return re.sub("|".join(map(re.escape, ("\\", *template.controls))), lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


SEGMENT = "conv_id long, turn_no int, role string, text string, loss boolean, valid boolean, last boolean"


def _segments(template: Template):
    """Rows (conv_id, role, text), each conversation's together and in order -> segments.

    The state is the role before; a turn is valid while all turns up to it follow TRANSITIONS, and
    the last one must be an assistant's. Rows pass through one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, until it is known whether it is the last of its conversation
        state, valid, number = "start", True, -1
        out: list[tuple] = []

        def emit(row: tuple, last: bool) -> None:
            nonlocal state, valid, number
            conv_id, role, text = row
            number += 1
            if number == 0:
                out.append((conv_id, number, None, template.start, False, True, False))
            valid = valid and role in TRANSITIONS.get(state, ())
            state = role
            sound = valid and (not last or role == "assistant")
            mark = template.marks.get(role)
            if mark is None:
                out.append((conv_id, number, role, template.other.before, False, sound, False))
                out.append((conv_id, number, role, escape(role, template), False, sound, False))
                out.append((conv_id, number, role, template.named, False, sound, False))
                mark = template.other
            else:
                out.append((conv_id, number, role, mark.before, False, sound, False))
            out.append((conv_id, number, role, escape(text, template), mark.loss, sound, False))
            out.append((conv_id, number, role, mark.after, False, sound, last))
            if last:
                state, valid, number = "start", True, -1

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None:
                    emit(held, last=row[0] != held[0])
                held = row
            if out:
                yield _batch(out, SEGMENT)
                out.clear()
        if held is not None:
            emit(held, last=True)
            yield _batch(out, SEGMENT)

    return run


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(zip(*rows), kinds)], list(names))


def format_chat(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """The formatted text of each conversation as segments, one row each, in order: conv_id,
    turn_no, role, text, loss, valid, last.

    Joining a conversation's texts gives its training text; ``loss`` marks the segments to learn
    from. ``valid`` tells whether the turns so far keep the order that TRANSITIONS allows and, on
    the last turn, whether it is an assistant's; ``last`` marks a conversation's last segment.

    Turns are ordered by turn, then role, then text, null turns first, and all are formatted, valid
    or not. Null texts and roles count as empty; a role without a mark is written by name. Repeated
    rows are turns of their own; rows with a null conv_id are one conversation. Rows stream through
    a task after a sort, so no conversation is held in memory, however long. A conversation's rows
    stay together and in order in one partition of the result.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_segments(template), SEGMENT)


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)


class Reader:
    """Reads one conversation's formatted text back, segment by segment."""

    def __init__(self, template: Template) -> None:
        controls = "|".join(map(re.escape, template.controls))
        self.token = re.compile(rf"\\.|{controls}|[^\\<\[]+|.", re.S)
        self.template = template
        self.controls = set(template.controls)
        self.opens = {m.before.strip(): role for role, m in template.marks.items()}
        self.closes = {m.after.strip() for m in (*template.marks.values(), template.other)}
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.valid = True
        self.role: str | None = None
        self.parts: list[str] = []

    def feed(self, text: str, loss: bool, valid: bool) -> None:
        self.formatted_chars += len(text)
        self.valid = self.valid and valid
        if loss:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        for token in self.token.findall(text):
            if token not in self.controls:
                self.parts.append(token[1:] if token[0] == "\\" and len(token) > 1 else token)
            elif token == self.template.start:
                self.parts = []
            elif token in self.opens:
                self.role, self.parts = self.opens[token], []
            elif token == self.template.other.before.strip():
                self.role, self.parts = None, []
            elif token == self.template.named.strip():
                self.role, self.parts = "".join(self.parts), []
            elif token in self.closes:
                self._turn(token)

    def _turn(self, close: str) -> None:
        mark = self.template.marks.get(self.role, self.template.other)
        before = self.template.named if mark is self.template.other else mark.before
        text = "".join(self.parts)
        text = text[len(before) - len(before.rstrip()) :]
        trail = len(mark.after) - len(mark.after.lstrip())
        text = text[: len(text) - trail]
        self.turns.update(f"{self.role}\n{text}\n".encode())
        self.n_turns += 1
        self.parts = []


def _read_back(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(template)
        for batch in batches:
            rows = []
            for conv_id, text, loss, valid, last in zip(*(c.to_pylist() for c in batch.columns)):
                reader.feed(text, loss, valid)
                if last:
                    rows.append((conv_id, reader.n_turns, reader.turns.hexdigest(), reader.loss_chars,
                                 reader.loss.hexdigest(), reader.formatted_chars, reader.valid))
                    reader = Reader(template)
            if rows:
                yield _batch(rows, DIGEST)

    return run


def read_back(segments: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation of ``format_chat``'s result, from its texts and loss flags alone:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid.

    The formatted text is parsed into turns again, and digests are taken of what was read. Needs
    each conversation's segments together and in order, as ``format_chat`` leaves them.
    """
    return segments.select("conv_id", "text", "loss", "valid", "last").mapInArrow(_read_back(template), DIGEST)
