r"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "<|im_start|>" role "\n" body "<|im_end|>" "\n"

A turn is rendered as it is, parsed again and compared with its source. If it
differs, its content conflicts with the grammar and is escaped (once more, if
need be) until the parsed turn is identical: in a body, each ``<`` + n
backslashes + ``|`` gets one backslash more, which the parser takes away; in a
role, ``%``, ``<`` and line feeds become %25, %3C and %0A. An escaped body
holds no ``<|``, so no control string, and unescaping is the exact inverse.

Turns are rendered and checked row by row, in parallel. Only the digests of a
conversation need its turns in order: they are read as a sorted stream, one
row in memory at a time, so a conversation of any length takes constant
memory.

Cases: a null text is empty, a null role is an empty role. Rows are ordered by
turn (null first), rows with the same turn by role, then text; repeated rows
are turns of their own. Rows without conv_id form one conversation. An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.llm.arrow import Batches, arrow_schema, map_arrow, rows_of

START, END = "<|im_start|>", "<|im_end|>"
PARTS = "conv_id bigint, turn bigint, rendered string, loss_start bigint, loss_stop bigint"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescaped(body: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", body)


def quoted(role: str) -> str:
    return role.replace("%", "%25").replace("<", "%3C").replace("\n", "%0A")


def unquoted(role: str) -> str:
    return role.replace("%0A", "\n").replace("%3C", "<").replace("%25", "%")


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start and stop of the body) of each turn; ValueError where
    the grammar does not fit."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        line = formatted.find("\n", at)
        stop = formatted.find(END, line + 1)
        if line < 0 or stop < 0:
            raise ValueError(f"the turn at {at} does not end")
        role, body = formatted[at + len(START) : line], formatted[line + 1 : stop]
        if START in body or START in role or END in role or not formatted.startswith("\n", stop + len(END)):
            raise ValueError(f"the turn at {at} holds control strings")
        turns.append((unquoted(role), unescaped(body), line + 1, stop))
        at = stop + len(END) + 1
    return turns


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """The turn's rendering, and start and stop of its body in it."""
    head, body = role, text
    while True:
        out = f"{START}{head}\n{body}{END}\n"
        try:
            turns = parse(out)
        except ValueError:
            turns = []
        if [t[:2] for t in turns] == [(role, text)]:
            return out, *turns[0][2:]
        if (head, body) != (role, text) and (head, body) != (quoted(role), escaped(text)):
            raise AssertionError("an escaped turn reads back as another")
        head, body = quoted(head), escaped(body)


def formatted(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """A row for each turn: its rendering, and the part of it under the loss
    mask (equal start and stop: none). The renderings of a conversation's
    turns, in order, are its formatted text."""
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    fields = arrow_schema(PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(fields)
        for conv_id, turn, role, text in rows_of(batches):
            shown, start, stop = rendered(role, text)
            if role != loss_role:
                start = stop = 0
            yield from out.add((conv_id, turn, shown, start, stop), len(shown))
        yield from out.flush()

    return map_arrow(rows, run, PARTS)


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation, from its formatted turns alone: what the parser reads
    back, and the unescaped text under the loss mask."""
    # Rows with the same turn come in the order of their renderings, which is
    # that of role and text but for escaped content.
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "rendered")
    fields = arrow_schema(DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, state = Batches(fields), None

        def ended():
            conv_id, n, turns, chars, loss, size = state
            return out.add((conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for conv_id, _, shown, start, stop in rows_of(batches):
            if state is None or state[0] != conv_id:
                if state is not None:
                    yield from ended()
                state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text, _, _ in parse(shown):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            under = unescaped(shown[start:stop])
            state[3] += len(under)
            state[4].update(under.encode())
            state[5] += len(shown)
        if state is not None:
            yield from ended()
        yield from out.flush()

    return map_arrow(ordered, run, DIGESTS)
