"""Conversations as training text, with a loss mask, that can be read back without loss.

Each turn is a segment of its own::

    user        [INST] text [/INST]
    assistant    text </s>
    any other   <<role>> text <</role>>

Markers have a blank towards the text, so none can arise across its border.  Each segment is
parsed again after it is rendered.  The parser refuses control strings inside a text and takes
one escape sign away from those that have some; while it refuses, or role and text differ from
the source, control strings in the text get one more escape sign before them.

The segments of a conversation follow each other without anything between; the whole text
is read back by the same parser, segment by segment, in constant memory.  The loss mask
covers the texts of assistant turns.

Null texts and roles are empty.  Turns are ordered by ``turn`` (null first), equal ones by
their segment; rows that come twice are turns of their own.  Rows without a conversation id make
up one conversation without id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedarb.llm.shared import slices

ESCAPE = "\\"
#: Strings that mark something; none has a blank or begins with the escape sign.
CONTROL = r"\[/?INST\]|</?s>|<</?[^<>\s\\]*>>"
# Runs of escape signs are taken whole and from their first sign, so that long ones take linear time.
_control = re.compile(rf"(?<!\\)\\*+(?:{CONTROL})")
_escaped = re.compile(rf"(?<!\\)\\(\\*+(?:{CONTROL}))")
_segment = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]"
    r"|<<(?P<role>(?:[^<>\s\\]|\\u[0-9a-f]{6})*)>> (?P<other>.*?) <</(?P=role)>>"
    r"| (?P<assistant>.*?) </s>",
    re.DOTALL,
)
_unusual = re.compile(r"[<>\s\\]")


class Turn(NamedTuple):
    role: str
    text: str
    #: Bounds of the text, still escaped, in the segment.
    start: int
    end: int


def _role_name(role: str) -> str:
    return _unusual.sub(lambda m: f"\\u{ord(m.group()):06x}", role)


def render(role: str, text: str) -> str:
    """One turn without any escaping of its text."""
    if role == "user":
        return f"[INST] {text} [/INST]"
    if role == "assistant":
        return f" {text} </s>"
    name = _role_name(role)
    return f"<<{name}>> {text} <</{name}>>"


def parse(formatted: str, at: int = 0) -> tuple[Turn, int]:
    """The turn that begins at ``at`` and where the next one begins."""
    found = _segment.match(formatted, at)
    if not found:
        raise ValueError(f"no turn begins at {at}")
    kind = next(k for k in ("user", "assistant", "other") if found[k] is not None)
    role = kind if kind != "other" else re.sub(r"\\u([0-9a-f]{6})", lambda m: chr(int(m[1], 16)), found["role"])
    if any(m.group()[0] != ESCAPE for m in _control.finditer(found[kind])):
        raise ValueError(f"control string inside the turn at {at}")
    return Turn(role, unescape(found[kind]), found.start(kind), found.end(kind)), found.end()


def escape(text: str) -> str:
    """One more escape sign before each control string and the signs before it."""
    return _control.sub(lambda m: ESCAPE + m.group(), text)


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text)


def formatted_turn(role: str, text: str) -> tuple[str, Turn]:
    """The segment that is read back as this turn, and the turn as read back."""
    written = text
    while True:
        segment = render(role, written)
        try:
            turn, end = parse(segment)
            if (turn.role, turn.text, end) == (role, text, len(segment)):
                return segment, turn
        except ValueError:
            pass
        longer = escape(written)
        if longer == written:
            raise ValueError(f"turn cannot be formatted: {role!r}")
        written = longer


SEGMENTS = "conv_id long, turn long, segment string, mask_start int, mask_end int"


def segments(turns: DataFrame) -> DataFrame:
    """The segment of each row (conv_id, turn, role, text) and the bounds of its loss mask in it.

    Where the mask is empty both bounds are 0.
    """

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out, starts, ends = [], [], []
                for role, text in zip(part.column("role"), part.column("text")):
                    segment, turn = formatted_turn(role.as_py() or "", text.as_py() or "")
                    own = turn.role == "assistant"
                    out.append(segment)
                    starts.append(turn.start if own else 0)
                    ends.append(turn.end if own else 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("conv_id"), part.column("turn"), pa.array(out, pa.string()),
                        pa.array(starts, pa.int32()), pa.array(ends, pa.int32()),
                    ],
                    ["conv_id", "turn", "segment", "mask_start", "mask_end"],
                )

    turns = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return turns.mapInArrow(formatted, SEGMENTS)


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss texts of each conversation, parsed from its segments in order, as digests."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def done() -> pa.RecordBatch:
            conv, count, turns, loss_chars, loss, chars = state
            row = [conv, count, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "mask_start", "mask_end"))
            for conv, segment, mask_start, mask_end in zip(*columns):
                if state is None or state[0] != conv:
                    if state is not None:
                        yield done()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                at = 0
                while at < len(segment):
                    turn, at = parse(segment, at)
                    state[1] += 1
                    state[2].update(f"{turn.role}\n{turn.text}\n".encode())
                loss = unescape(segment[mask_start:mask_end])
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(segment)
        if state is not None:
            yield done()

    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "segment")
        .mapInArrow(read, READ)
    )
