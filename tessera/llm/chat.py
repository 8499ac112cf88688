"""Chat formatting: a state machine over roles, and text segments with loss flags.

A template declares the marks around turns, the roles that are trained on and the turn
order that is valid.  Rows of a conversation are streamed in turn order; each turn gives a
header, its escaped text and an end mark, so a conversation of any length needs the memory
of one turn.  Inside texts and roles every sign that can begin a mark, and the escape sign
itself, follows an escape sign; so no mark can appear there and reading back is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENTS = "conv_id long, segment long, kind string, role string, text string, loss boolean, turn_ok boolean, valid boolean"
TURNS_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
#: Characters of text that one output batch holds before it is handed on.
BATCH_CHARS = 4_000_000


@dataclass(frozen=True)
class Template:
    """Marks and rules.  A header is ``before_role`` + label + ``after_role``; roles without a label
    are written as ``other`` + the escaped role.  ``after``: the roles that may follow a state
    (the last role, `` `` at the start); ``final``: the states in which a conversation may end."""

    escape: str = "\\"
    before_role: str = "### "
    after_role: str = ": "
    end_turn: str = " </turn>\n"
    end_chat: str = "</chat>"
    other: str = "="
    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss_roles: tuple[str, ...] = ("assistant",)
    after: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)

    def escapes(self) -> re.Pattern:
        """The signs that follow an escape sign inside texts: the first of each mark, blanks aside, and itself."""
        signs = {m.lstrip()[0] for m in (self.before_role, self.after_role, self.end_turn, self.end_chat)} | {self.escape}
        return re.compile("[" + "".join(re.escape(s) for s in sorted(signs)) + "]")


def _order(df: DataFrame, conv: str, *by: str) -> DataFrame:
    """Each conversation in one partition, in order."""
    return df.repartition(conv).sortWithinPartitions(conv, *by)


class _Rows:
    def __init__(self, schema: str):
        kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
        self.fields = [(n, kinds[t]) for n, t in (f.split(" ") for f in schema.split(", "))]
        self.rows: list[tuple] = []
        self.chars = 0

    def add(self, *row, chars: int = 200) -> None:
        self.rows.append(row)
        self.chars += chars

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.fields)
        self.rows, self.chars = [], 0
        return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, self.fields)], names=[n for n, _ in self.fields])


def format_chats(turns: DataFrame, template: Template = Template(), *, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Segments of every conversation, in order (``segment`` from 0), partitioned by conversation.

    ``kind``: header, text, end, and one close per conversation, whose ``valid`` tells whether
    every turn's role could follow the one before and the last may end a conversation.
    ``turn_ok`` marks the turns themselves; invalid ones are formatted all the same.

    A null text is empty, a null role the empty role (never valid); rows of one turn number
    follow each other by role and text, a null number comes first; rows with a null
    conversation id are one conversation; equal rows are turns of their own; an empty table
    gives no rows.  Other columns play no part, whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, out = template.escapes(), _Rows(SEGMENTS)
        put = lambda s: pattern.sub(lambda m: template.escape + m[0], s)
        now, state, n, valid = (), "", 0, True
        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                role, text = role or "", text or ""
                if now != (conv,):
                    if now:
                        out.add(now[0], n, "close", None, template.end_chat, False, None, valid and state in template.final)
                    now, state, n, valid = (conv,), "", 0, True
                ok = role in template.after.get(state, ())
                valid, state = valid and ok, role
                label = template.labels.get(role) or template.other + put(role)
                out.add(conv, n, "header", role, template.before_role + label + template.after_role, False, ok, None)
                out.add(conv, n + 1, "text", role, put(text), role in template.loss_roles, ok, None, chars=len(text))
                out.add(conv, n + 2, "end", role, template.end_turn, False, ok, None)
                n += 3
                if out.chars > BATCH_CHARS:
                    yield out.take()
        if now:
            out.add(now[0], n, "close", None, template.end_chat, False, None, valid and state in template.final)
            yield out.take()

    chosen = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(role_col).cast("string").alias("role"),
                          F.col(text_col).cast("string").alias("text"), F.col(turn_col).cast("long").alias("turn"))
    return _order(chosen, "conv", "turn", "role", "text").select("conv", "role", "text").mapInArrow(run, SEGMENTS)


class _Reader:
    """Reads one conversation back from its formatted text, turn by turn."""

    def __init__(self, template: Template, conv):
        self.t, self.conv = template, conv
        e = re.escape
        body = rf"((?:[^{e(template.escape)}{template.escapes().pattern[1:-1]}]++|{e(template.escape)}.)*+)"
        self.turn = re.compile(rf"{e(template.before_role)}(?:({e(template.other)})?{body}){e(template.after_role)}{body.replace('++', '+').replace('*+', '*')}{e(template.end_turn)}", re.S)
        self.unescape = re.compile(rf"{e(template.escape)}(.)", re.S)
        self.roles = {v: k for k, v in template.labels.items()}
        self.rest, self.n, self.chars, self.loss_chars = "", 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def plain(self, text: str) -> str:
        return self.unescape.sub(r"\1", text)

    def feed(self, text: str, loss: bool) -> None:
        self.chars += len(text)
        if loss:
            told = self.plain(text)
            self.loss_chars += len(told)
            self.loss.update(told.encode())
        self.rest += text
        if text == self.t.end_turn:  # an unescaped mark: a turn is whole
            m = self.turn.fullmatch(self.rest)
            if m is None:
                raise ValueError(f"conversation {self.conv}: not a turn: {self.rest[:80]!r}")
            role = self.plain(m[2]) if m[1] else self.roles[m[2]]
            self.all.update(f"{role}\n{self.plain(m[3])}\n".encode())
            self.n, self.rest = self.n + 1, ""

    def row(self, valid) -> tuple:
        if self.rest != self.t.end_chat:
            raise ValueError(f"conversation {self.conv}: its end is {self.rest[:80]!r}")
        return self.conv, self.n, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, valid


def read_back(segments: DataFrame, template: Template = Template(), *, ordered: bool = False) -> DataFrame:
    """Turns and loss text of each conversation, read from its segments' text and loss flags alone.

    ``ordered``: the segments come straight from :func:`format_chats`; else they are shuffled
    and sorted first.  A text that the template cannot have written raises an error.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, reader, valid = _Rows(TURNS_READ), None, None
        for batch in batches:
            for conv, text, loss, ok in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if reader is None or reader.conv != conv:
                    if reader:
                        out.add(*reader.row(valid))
                    reader = _Reader(template, conv)
                reader.feed(text, loss)
                valid = ok
                if out.chars > BATCH_CHARS:
                    yield out.take()
        if reader:
            out.add(*reader.row(valid))
            yield out.take()

    if not ordered:
        segments = _order(segments, "conv_id", "segment")
    return segments.select("conv_id", "text", "loss", "valid").mapInArrow(run, TURNS_READ)
