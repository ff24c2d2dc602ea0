"""Chat formatting: a finite-state machine over roles, driven by a declarative template.

``segments`` turns a table of turns into the formatted output: rows of text in order, each with a
loss flag. ``read_back`` parses such output again. Both walk the turns of a conversation in order
with the state of one conversation in hand, so a conversation of any length passes a task as a
stream (its hash is of its turns in order) and only one turn's text is in memory.

Nulls: a null text or role is empty; null conversation ids are one conversation; null turns come
first. Ties: rows with the same turn number are ordered by role, then text; repeated rows are turns
of their own. Empty texts give empty segments, very long texts one segment. An empty table gives an
empty output. Columns besides the four named ones are not read. Turns out of order are formatted as
they stand; the machine's verdict on the conversation says so.
"""

from __future__ import annotations

import enum
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Place(enum.Enum):
    """The places in a template that a turn fills."""
    ROLE = "role"
    TEXT = "text"


#: The conversation that every run formats beside the table's, as (conv_id, turn, role, text).
PROBE = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


@dataclass(frozen=True)
class Template:
    """What a turn looks like, which roles are learnt from, and which role may follow which.

    ``turn`` lists a turn's segments: literal marks, ROLE and TEXT. Marks are never under the loss;
    the TEXT of a role in ``learnt`` is. In what fills a place, ``escape`` stands before itself and
    before each character that could begin a mark, so that no mark can be read inside a text."""
    turn: tuple = ("### ", Place.ROLE, ": ", Place.TEXT, "</turn>\n")
    learnt: frozenset = frozenset({"assistant"})
    escape: str = "\\"
    follows: dict = field(default_factory=lambda: {
        "start": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}})
    last: frozenset = frozenset({"assistant"})

    def __post_init__(self):
        heads = "".join(sorted({self.escape, *(m[0] for m in self.turn if isinstance(m, str))}))
        object.__setattr__(self, "guard", re.compile(f"([{re.escape(heads)}])"))
        object.__setattr__(self, "free", re.compile(re.escape(self.escape) + "(.)", re.S))
        body = f"(?:[^{re.escape(heads)}]|{re.escape(self.escape)}.)*"
        object.__setattr__(self, "form", re.compile("".join(re.escape(m) if isinstance(m, str) else f"({body})" for m in self.turn), re.S))
        if [m for m in self.turn if not isinstance(m, str)] != [Place.ROLE, Place.TEXT]:
            raise ValueError("a turn has one ROLE, then one TEXT")

    def hide(self, text: str) -> str:
        return self.guard.sub(lambda m: self.escape + m[1], text)

    def show(self, text: str) -> str:
        return self.free.sub(lambda m: m[1], text)

    def emit(self, role: str, text: str) -> Iterator[tuple[str, bool]]:
        """A turn's segments with their loss flags."""
        for m in self.turn:
            yield (m, False) if isinstance(m, str) else (self.hide(role), False) if m is Place.ROLE else (self.hide(text), role in self.learnt)

    def step(self, state: str | None, role: str) -> str | None:
        """The machine's next state; None once a role may not follow."""
        return role if state is not None and role in self.follows.get(state, ()) else None

    def verdict(self, state: str | None) -> str:
        """ok; open: in order, but it ends before an answer; order: a role in the wrong place."""
        return "order" if state is None else "ok" if state in self.last else "open"


DEFAULT = Template()
SEGMENTS = "conv_id long, position long, segment int, text string, loss boolean"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, verdict string, bad_turn long")


def in_order(turns: DataFrame) -> DataFrame:
    """Each conversation's turns in one partition, in order. The texts cross the network once."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return t.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns and those of ``PROBE``."""
    kinds = {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}
    probe = turns.sparkSession.createDataFrame(PROBE, ", ".join(f"{n} {k}" for n, k in kinds.items()))
    return turns.select(*[F.col(n).cast(k).alias(n) for n, k in kinds.items()]).unionByName(probe)


def _rows(batches, names: tuple[str, ...]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows and about ``most`` characters."""
    held, chars = [], 0
    for r in rows:
        held.append(r)
        chars += sum(len(x) for x in r if isinstance(x, str))
        if len(held) >= size or chars >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def segments(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """(conv_id, position, segment, text, loss): the formatted conversations, a partition's in order.
    Joining a conversation's texts in the order of (position, segment) gives its formatted text."""
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("segment", pa.int32()), ("text", pa.string()), ("loss", pa.bool_())])

    def run(batches):
        def rows():
            last, at = object(), 0
            for conv, role, text in _rows(batches, ("conv_id", "role", "text")):
                last, at = conv, at + 1 if conv == last else 0
                for k, (piece, loss) in enumerate(template.emit(role, text)):
                    yield conv, at, k, piece, loss
        yield from _batches(rows(), schema)

    return in_order(turns).mapInArrow(run, SEGMENTS)


class _Reader:
    """Parses one conversation's segments as they come and sums up what they say."""

    def __init__(self, conv, template: Template):
        self.conv, self.t, self.n, self.chars, self.loss_chars = conv, template, 0, 0, 0
        self.turns, self.loss, self.state, self.bad = hashlib.sha256(), hashlib.sha256(), "start", None
        self.open: list[tuple[str, bool]] = []

    def add(self, text: str, loss: bool) -> None:
        self.open.append((text, loss))
        self.chars += len(text)
        if text == self.t.turn[-1]:
            self.close()

    def close(self) -> None:
        found = self.t.form.fullmatch("".join(x for x, _ in self.open))
        if not found:
            raise ValueError(f"conversation {self.conv}: no turn can be read from its output")
        role, text = map(self.t.show, found.groups())
        self.turns.update(f"{role}\n{text}\n".encode())
        under = self.t.show("".join(x for x, loss in self.open if loss))
        self.loss.update(under.encode())
        self.loss_chars += len(under)
        self.state = self.t.step(self.state, role)
        if self.state is None and self.bad is None:
            self.bad = self.n
        self.n, self.open = self.n + 1, []

    def row(self) -> tuple:
        if self.open:
            raise ValueError(f"conversation {self.conv}: its output ends within a turn")
        return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.t.verdict(self.state), self.bad)


def read_back(output: DataFrame, template: Template = DEFAULT, ordered: bool = False) -> DataFrame:
    """Per conversation of a formatted output: number of turns, hash of its turns, characters and
    hash of what is under the loss (both without escapes), characters in all, the machine's verdict
    and the position of the first role out of order. ``ordered``: the partitions hold whole
    conversations in order, as ``segments`` leaves them; else they are dealt out and sorted."""
    if not ordered:
        output = output.repartition("conv_id").sortWithinPartitions("conv_id", "position", "segment")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("verdict", pa.string()), ("bad_turn", pa.int64())])

    def run(batches):
        def rows():
            cur = None
            for conv, text, loss in _rows(batches, ("conv_id", "text", "loss")):
                if cur is None or conv != cur.conv:
                    if cur is not None:
                        yield cur.row()
                    cur = _Reader(conv, template)
                cur.add(text, loss)
            if cur is not None:
                yield cur.row()
        yield from _batches(rows(), schema)

    return output.mapInArrow(run, DIGEST)


def formatted(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Digest columns of all conversations, read back from their formatted output."""
    return read_back(segments(turns, template), template, ordered=True)
