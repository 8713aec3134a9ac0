"""Chat formatting: turns become marked text whose own parser gives the same turns back.

A turn is a header, its text and a footer::

    ### Assistant: the text
    </turn>

The grammar is deterministic. A header opens a turn at the start or after a footer; roles other than
the usual four are JSON strings in it (``### "judge": ``, ``### null: ``). In a text, a header or
``</turn>`` after a run of backslashes stands for itself with one backslash less; without one it
ends the turn. Other backslashes are plain.

A turn is rendered as it is and parsed. If the parser gives other turns back, the content that it took
for control strings gets a backslash, until what comes back is identical. A rendered turn that parses to itself
does so after any others, for its end is found without looking further; so turns are rendered
apart, in any number of tasks, and only reading a conversation back needs its turns in order.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.llm.common import map_rows

NAMES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
ROLES = {name: role for role, name in NAMES.items()}
LEARNED = "assistant"
FOOTER = "</turn>"
#: A quoted role ends at its first quote without a backslash; JSON leaves only printable ASCII in it.
HEADER = re.compile(r'### (?:(System|User|Assistant|Tool|null)|("(?:[ !#-\[\]-~]|\\.)*+")): ')
#: Backslashes, then a control string. Runs are entered at their start only.
CONTROL = re.compile(r'(?<!\\)(\\*+)(' + HEADER.pattern.replace("(System", "(?:System").replace('|("', '|(?:"') + "|" + FOOTER + ")")


class NotParsed(ValueError):
    """A text that the grammar doesn't have."""


def header(role: str | None) -> str:
    name = NAMES.get(role) if role is not None else "null"
    return f"### {name or json.dumps(role)}: "


def escaped(text: str) -> str:
    """The text with one more backslash before each control string."""
    return CONTROL.sub(r"\\\g<1>\g<2>", text)


def unescaped(text: str) -> str:
    """Undoes :func:`escaped`; without control strings that have no backslash."""
    return CONTROL.sub(lambda m: m[1][1:] + m[2], text)


def parse_turn(text: str, at: int = 0) -> tuple[str | None, str, int, int, int]:
    """(role, text, begin, end, next): the turn that opens at ``at``, and the place of its text as it stands."""
    opened = HEADER.match(text, at)
    if not opened:
        raise NotParsed(f"no header at {at}")
    name, quoted = opened.groups()
    try:
        role = json.loads(quoted) if quoted else ROLES.get(name)
    except ValueError as fault:
        raise NotParsed(f"no role at {at}") from fault
    begin = opened.end()
    for control in CONTROL.finditer(text, begin):
        if control[1]:
            continue
        end = control.start(2)
        if control[2] == FOOTER and text[end - 1 : end] == "\n" and end > begin and text.startswith("\n", control.end()):
            return role, unescaped(text[begin : end - 1]), begin, end - 1, control.end() + 1
        raise NotParsed(f"a bare control string at {end}")
    raise NotParsed(f"the turn at {at} does not end")


def parse(text: str) -> list[tuple[str | None, str]]:
    """The turns of a whole formatted text."""
    at, out = 0, []
    while at < len(text):
        role, said, _, _, at = parse_turn(text, at)
        out.append((role, said))
    return out


def render(role: str | None, text: str) -> tuple[str, int, int]:
    """A turn that parses to (role, text) alone, and where its text begins and ends."""
    opened, body = header(role), text
    while not comes_back(piece := f"{opened}{body}\n{FOOTER}\n", role, text):
        if body != text:  # one backslash each is enough, by the grammar
            raise NotParsed(f"no rendering of {text[:80]!r} parses back")
        body = escaped(body)
    return piece, len(opened), len(opened) + len(body)


def comes_back(piece: str, role: str | None, text: str) -> bool:
    """Whether a rendered turn parses to this role and text and nothing else."""
    try:
        return parse(piece) == [(role, text)]
    except NotParsed:
        return False


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, piece, begin, end) for every row: its rendered turn.

    ``piece`` is what a conversation's text has for this turn; the whole text is the conversation's
    pieces by turn, nulls first, joined by nothing. Pieces that share a turn stand in their own order, as
    texts. Of turns with the role ``assistant`` the loss covers piece[begin:end], which is the
    text with its escapes, in code points; other turns have no begin and end. A null text is empty;
    a null role is a role of its own, as is any other role. Null conv_ids are one conversation;
    repeated rows are turns like others. An empty table gives no rows. Other columns are not
    looked at. Texts may be as long as a string can.
    """

    def make():
        def give(conv_id, turn, role, text):
            piece, begin, end = render(role, text or "")
            return [(conv_id, turn, piece, *((begin, end) if role == LEARNED else (None, None)))]

        return give

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return map_rows(rows, make, "conv_id long, turn long, piece string, begin long, end long", flush=512)


def in_order(turns: DataFrame) -> DataFrame:
    """The pieces of a conversation one after the other, in one task; the task streams them."""
    order = ["conv_id", "turn", "piece"]
    return turns.repartition("conv_id").sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in order))


class _Read:
    """What comes back from a conversation, piece by piece: digests, not texts."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss = conv_id, 0, 0, 0
        self.said, self.learned = sha256(), sha256()

    def take(self, piece: str, begin: int | None, end: int | None) -> None:
        for role, text in parse(piece):
            self.turns += 1
            self.said.update(f"{role or ''}\n{text}\n".encode())
        self.chars += len(piece)
        if begin is not None:
            masked = unescaped(piece[begin:end])
            self.loss += len(masked)
            self.learned.update(masked.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.said.hexdigest(), self.loss, self.learned.hexdigest(), self.chars


def read_back(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of formatted turns.

    Parsed from the pieces and their loss places alone. Conversations are read piece by piece in
    order, so a task holds no conversation, however long it is.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv_id, *piece in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    if now:
                        done.append(now.row())
                    now = _Read(conv_id)
                now.take(*piece)
            if len(done) >= 2048:
                yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r)) for r in done], arrow)
                done = []
        if now:
            done.append(now.row())
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r)) for r in done], arrow)

    return in_order(turns).select("conv_id", "piece", "begin", "end").mapInArrow(run, schema)
