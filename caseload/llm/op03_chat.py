"""Chat formatting: a finite-state machine over roles and a declarative template.

``format_chats`` turns rows (conv_id, turn, role, text) into text segments with a loss flag each:
one row for each segment, in order. ``read_chats`` reads conversations back from those segments.

A task streams over rows sorted by conversation and turn and keeps one state, so a conversation
of any length needs no memory. All turns of a conversation pass one task, because its digests are
of one long text.

Control strings inside a text are escaped: the escape character is doubled, and put in front of
every other control string; reading back removes one escape character each.

Defined cases: rows are ordered by turn, then role, then text, nulls first, and repeated rows are
turns of their own; a null role or text is empty; a null conv_id is a conversation; roles that
the template does not name are written as they are, escaped. A turn the machine does not allow is
marked (``allowed`` false) and still written. An empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import in_arrow, partitions, ship

SEGMENTS = (
    "conv_id long, turn_no long, segment_no long, kind string, text string, loss boolean, allowed boolean"
)
TURNS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


@dataclass(frozen=True)
class Template:
    """How turns are written, and which role may follow which."""

    open: str = "### "
    colon: str = ": "
    close: str = " </turn>\n"
    escape: str = "\\"
    titles: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss: frozenset = frozenset({"assistant"})
    moves: dict = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    final: frozenset = frozenset({"assistant"})

    def controls(self) -> list[str]:
        """Strings that must not stand unescaped inside a text."""
        return [self.escape, self.open.strip(), self.colon.strip(), self.close.strip()]


class Writer:
    def __init__(self, template: Template):
        self.t = template
        self.known = re.compile("|".join(map(re.escape, template.controls())))

    def escape(self, text: str) -> str:
        return self.known.sub(lambda m: self.t.escape + m[0], text)

    def turn(self, role: str, text: str) -> list[tuple[str, str, bool]]:
        """(kind, text, loss) of one turn. An unnamed role is written behind an escaped colon
        sign, so it can't be taken for a title."""
        t = self.t
        title = t.titles.get(role)
        head = title if title is not None else t.escape + t.colon.strip() + self.escape(role)
        return [
            ("open", t.open + head + t.colon, False),
            ("text", self.escape(text), role in t.loss),
            ("close", t.close, False),
        ]


class Reader:
    """Turns of a formatted conversation, fed piece by piece."""

    def __init__(self, template: Template):
        self.t = template
        esc, self.mark = re.escape(template.escape), template.colon.strip()
        controls = "|".join(map(re.escape, template.controls()))
        self.escaped = re.compile(f"{esc}({controls})", re.S)
        self.colon = re.compile(f"(?:{esc}(?:{controls})|(?!{re.escape(template.colon)}).)*", re.S)
        self.roles = {v: k for k, v in template.titles.items()}

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[1], text)

    def turn(self, text: str) -> tuple[str, str]:
        """(role, text) of one whole turn, from its open mark to its close mark."""
        t = self.t
        if not text.startswith(t.open):
            raise ValueError("a turn must begin with its open mark")
        at = len(t.open)
        head = self.colon.match(text, at)[0]
        role = self.roles[head] if head in self.roles else self.unescape(head)[len(self.mark) :]
        at += len(head) + len(t.colon)
        if not text.endswith(t.close):
            raise ValueError("a turn must end with its close mark")
        return role, self.unescape(text[at : len(text) - len(t.close)])


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, last, state, turn_no = Writer(template), ("none",), "start", 0
        for batch in batches:
            out = {k: [] for k in ("conv_id", "turn_no", "segment_no", "kind", "text", "loss", "allowed")}
            for conv, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if (conv,) != last:
                    last, state, turn_no = (conv,), "start", 0
                after = template.moves.get(state, {}).get(role or "")
                state = after or (role if role in template.moves else state)
                for n, (kind, piece, loss) in enumerate(writer.turn(role or "", text or "")):
                    for k, v in zip(out, (conv, turn_no, n, kind, piece, loss, after is not None)):
                        out[k].append(v)
                turn_no += 1
            yield pa.RecordBatch.from_arrays([
                pa.array(out["conv_id"], pa.int64()), pa.array(out["turn_no"], pa.int64()),
                pa.array(out["segment_no"], pa.int64()), pa.array(out["kind"], pa.string()),
                pa.array(out["text"], pa.string()), pa.array(out["loss"], pa.bool_()),
                pa.array(out["allowed"], pa.bool_()),
            ], list(out))

    return run


def format_chats(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """Segments of all conversations, in order inside each partition."""
    ship(chats.sparkSession)
    rows = chats.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    ordered = rows.repartition(partitions(chats.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").transform(in_arrow, _format(template or Template()), SEGMENTS)


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.formatted, self.valid = conv, 0, 0, 0, True
        self.all, self.loss, self.role = hashlib.sha256(), hashlib.sha256(), None

    def row(self, template: Template) -> tuple:
        valid = self.valid and self.role in template.final
        return self.conv, self.turns, self.all.hexdigest(), self.chars, self.loss.hexdigest(), self.formatted, valid


def _read(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now, pieces, masks = Reader(template), None, [], []
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            done = []
            conv, text, loss, allowed = (batch.column(i).to_pylist() for i in (0, 4, 5, 6))
            for c, piece, flag, ok in zip(conv, text, loss, allowed):
                if now is None or (c,) != (now.conv,):
                    if now is not None:
                        done.append(now.row(template))
                    now = _Digest(c)
                pieces.append(piece)
                masks += [piece] if flag else []
                now.formatted += len(piece)
                now.valid &= ok
                if piece == template.close and len(pieces) > 1:
                    role, body = reader.turn("".join(pieces))
                    now.all.update(f"{role}\n{body}\n".encode())
                    learned = reader.unescape("".join(masks))
                    now.loss.update(learned.encode())
                    now.chars += len(learned)
                    now.turns, now.role = now.turns + 1, role
                    pieces, masks = [], []
            if done:
                yield batch_of(done)
        if now is not None:
            yield batch_of([now.row(template)])

    return run


def read_chats(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """One row for each conversation, from the segments as ``format_chats`` gives them (each
    conversation in one partition, in order)."""
    ship(segments.sparkSession)
    return segments.transform(in_arrow, _read(template or Template()), TURNS)
