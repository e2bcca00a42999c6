"""Chat formatting: a finite-state machine over roles and a declarative template.

Rows are dealt by conversation and sorted by turn; a task then reads them in order
and emits text segments with a loss flag, holding one turn at a time however long a
conversation is. Control strings inside texts are escaped reversibly, so the output
can be read back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Segments in one Arrow batch.
BATCH_ROWS = 5_000


@dataclass(frozen=True)
class Template:
    """How a turn is written: ``open`` role ``after_role`` text ``close``."""

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    #: Roles whose texts the loss counts.
    trained: tuple[str, ...] = ("assistant",)
    #: Strings that must not stand in a text as they are.
    controls: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )
    #: Allowed steps: the roles that may follow a state; a state is the role just read.
    steps: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )

    def escape(self, text: str) -> str:
        """A backslash doubled, and one put after the first character of each control string."""
        controls = "|".join(map(re.escape, self.controls))
        return re.sub(rf"(\\)|({controls})", lambda m: "\\\\" if m[1] else m[2][0] + "\\" + m[2][1:], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


CHAT = Template()

_SEGMENTS = "turn_no long, role string, violation string, text string, loss boolean"
_NAMES = [x.split()[0] for x in _SEGMENTS.split(", ")]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _formatting(template: Template, id_type: pa.DataType):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        last, state, n = object(), "", 0
        for batch in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != last:
                    last, state, n = conv, "", 0
                role, text = role or "", text or ""
                allowed = template.steps.get(state, ())
                violation = None if role in allowed else f"{role or 'no role'} after {state or 'the start'}"
                state = role
                trained = role in template.trained
                yield conv, n, role, violation, template.open + template.escape(role) + template.after_role, False
                if text:
                    yield conv, n, role, violation, template.escape(text), trained
                yield conv, n, role, violation, template.close, False
                n += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(segments(batches), ["id", *_NAMES], [id_type, *_TYPES], BATCH_ROWS)

    return run


def format_chats(
    turns: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    template: Template = CHAT,
) -> DataFrame:
    """Segments of every conversation, those of one in order within their partition.

    Columns: the conversation id under its own name, ``turn_no`` (from 0), ``role``,
    ``violation`` (what the role may not follow, else null), ``text`` and ``loss``. The
    formatted conversation is its segments joined. Turns are ordered by number, nulls
    first; equal numbers by role and text; repeated rows are turns each. A null role
    is an empty one and allowed nowhere; a null text is empty and has no segment
    between its markers. Rows without a conversation id are one conversation. Invalid
    conversations are formatted all the same. Other columns are not read, and no rows
    give no segments.
    """
    kind = turns.schema[id_col].dataType
    rows = turns.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    dealt = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
    made = dealt.mapInArrow(_formatting(template, to_arrow_type(kind)), f"id {kind.simpleString()}, {_SEGMENTS}")
    return made.withColumnRenamed("id", id_col)


def _reading(template: Template, id_type: pa.DataType):
    import hashlib

    turn = re.compile(
        re.escape(template.open) + "(.*?)" + re.escape(template.after_role) + "(.*)" + re.escape(template.close), re.DOTALL
    )
    names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        last, state = None, None
        for batch in batches:
            for conv, text, loss, valid in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != last:
                    if state is not None:
                        yield last, *done(state)
                    last, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True, [], []]
                state[4] += len(text)
                state[5] &= valid
                state[6].append(text)
                if loss:
                    state[7].append(text)
                if text == template.close:  # no text holds it, escaped as they are
                    role, body = turn.fullmatch("".join(state[6])).groups()
                    read = f"{template.unescape(role)}\n{template.unescape(body)}\n"
                    trained = template.unescape("".join(state[7]))
                    state[0] += 1
                    state[1].update(read.encode())
                    state[2] += len(trained)
                    state[3].update(trained.encode())
                    state[6], state[7] = [], []
        if state is not None:
            yield last, *done(state)

    def done(s) -> tuple:
        return s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(conversations(batches), names, types, BATCH_ROWS)

    return run


def read_chats(segments: DataFrame, *, id_col: str = "conv_id", template: Template = CHAT) -> DataFrame:
    """What the segments of ``format_chats`` say, read back from their text and flags alone.

    Per conversation: its id, ``n_turns``, ``turns_sha256`` (of role, newline, text,
    newline for each turn, unescaped), ``loss_chars`` and ``loss_sha256`` (of the text
    under the loss flags, unescaped), ``formatted_chars`` and ``valid``. Lengths are in
    code points. Reads the segments where they are, without another shuffle.
    """
    kind = segments.schema[id_col].dataType
    schema = (
        f"id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean"
    )
    source = segments.select(id_col, "text", "loss", F.col("violation").isNull())
    return source.mapInArrow(_reading(template, to_arrow_type(kind)), schema).withColumnRenamed("id", id_col)
