r"""Chat formatting by a finite-state machine over roles and a declarative template.

Rows (conversation, turn, role, text) become text segments, three per turn: header, body, footer; each has a flag
that says whether it counts for the loss. The machine follows the roles and marks each turn valid or not;
conversations of odd order are formatted all the same. Control strings can't come from a text: in roles and
texts every `<` with n backslashes and `|` gets one more backslash, which reading back takes off again; in roles
backslashes and line ends are escaped too.

Rows are partitioned by conversation, sorted, and streamed: state is that of one conversation, memory that of one batch, so a
conversation of any length passes (its digests are sequential by nature). Nulls: a null text or role is empty, a null
turn comes first, rows without conversation id are one conversation. Rows of equal turn are ordered by role, then text;
repeated rows are repeated turns. Other columns are ignored."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """States of the machine are role names; `order` lists the roles that may follow each ("" is the start)."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    order: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)
    loss_roles: tuple[str, ...] = ("assistant",)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, counts for the loss) of one turn."""
        return [
            (f"{self.start}{escape_role(role)}\n", False), (escape(text), role in self.loss_roles), (f"{self.end}\n", False),
        ]


CHATML = Template()
_SEGMENT = pa.schema(
    [
        ("conv_id", pa.int64()), ("place", pa.int64()), ("part", pa.int32()), ("segment", pa.string()),
        ("loss", pa.bool_()), ("role", pa.string()), ("valid", pa.bool_()),
    ]
)
SEGMENT_SCHEMA = "conv_id bigint, place bigint, part int, segment string, loss boolean, role string, valid boolean"
READ_SCHEMA = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, "
    "valid boolean"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_chats(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """The segments, in order within each partition; a conversation is whole in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, state, place = object(), "", 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if conv != conversation:
                    conversation, state, place = conv, "", 0
                role, text = role or "", text or ""
                state = role if role in template.order.get(state, ()) else "?"
                for part, (segment, loss) in enumerate(template.segments(role, text)):
                    rows.append((conv, place, part, segment, loss, role, state != "?"))
                place += 1
            columns = zip(*rows) if rows else [()] * len(_SEGMENT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SEGMENT)], schema=_SEGMENT)

    turns = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    arranged = turns.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    return arranged.mapInArrow(run, SEGMENT_SCHEMA)


class Reader:
    """Turns of one formatted conversation, read piece by piece; holds one turn."""

    def __init__(self, template: Template):
        self.template, self.open, self.marked = template, "", ""
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.turn_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()

    def feed(self, segment: str, loss: bool) -> None:
        self.chars += len(segment)
        self.open += segment
        self.marked += segment if loss else ""
        stop = f"{self.template.end}\n"
        while stop in self.open:
            turn, self.open = self.open.split(stop, 1)
            role, text = turn.removeprefix(self.template.start).split("\n", 1)
            counted = unescape(self.marked)
            self.marked = ""
            self.turns += 1
            self.turn_digest.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
            self.loss_digest.update(counted.encode())
            self.loss_chars += len(counted)


def read_back(segments: DataFrame, template: Template = CHATML, arranged: bool = False) -> DataFrame:
    """What the formatted text says of each conversation: turns, their digest, text under the loss mask, length, validity.
    `arranged`: the segments come straight from `format_chats`, so partitions and order hold already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current, valid, role = None, None, True, ""
        names = [f.split()[0] for f in READ_SCHEMA.split(", ")]

        def row():
            return pa.RecordBatch.from_pylist([
                dict(zip(names, (
                    current, reader.turns, reader.turn_digest.hexdigest(), reader.loss_chars, reader.loss_digest.hexdigest(),
                    reader.chars, valid and role in template.final,
                )))
            ], schema=schema)

        for batch in batches:
            out = []
            for conv, place, part, segment, loss, said, ok in zip(*(c.to_pylist() for c in batch.columns)):
                if reader is None or conv != current:
                    if reader is not None:
                        out.append(row())
                    reader, current, valid = Reader(template), conv, True
                reader.feed(segment, loss)
                valid, role = valid and ok, said
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if reader is not None:
            yield row()

    schema = pa.schema(
        [
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()),
        ]
    )
    rows = segments.select(*_SEGMENT.names)
    if not arranged:
        rows = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "place", "part")
    return rows.mapInArrow(run, READ_SCHEMA)
