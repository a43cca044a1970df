"""Chat formatting: a finite-state machine over roles and a declarative template.

Each turn becomes three segments (prefix, text, suffix); only the text of a loss
role is under the loss mask.  Control strings inside a text or role are escaped
reversibly, so the turns can be read back from the formatted output.

One conversation is a sequence: its turns are sorted and streamed through the
state machine one by one, with constant memory however long it is.

Nulls: a null text or role is empty; a null turn sorts first; a null conversation
id is one conversation of its own.  Equal turn numbers follow role, then text;
repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from recordlens.llm.common import batches, bounded_batches

#: Invisible character put behind the first character of a control string.
ESCAPE = "⁠"


@dataclass(frozen=True)
class Template:
    """How turns are marked, which roles may follow which, and what is learned."""

    prefix: str = "<|im_start|>{role}\n"
    suffix: str = "<|im_end|>\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    #: Strings with a meaning in this or another common template (none starts inside another).
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    #: State machine: roles that may follow a state; the state after a turn is its role.
    follows: dict[str, frozenset[str]] = field(default_factory=lambda: {
        "": frozenset({"system", "user"}), "system": frozenset({"user"}),
        "user": frozenset({"assistant"}), "assistant": frozenset({"user"})})
    accepting: frozenset[str] = frozenset({"assistant"})

    def _match(self, least: str) -> re.Pattern[str]:
        return re.compile("|".join(f"{re.escape(c[0])}{ESCAPE}{least}{re.escape(c[1:])}" for c in self.controls))

    def escape(self, text: str) -> str:
        """Put one more ESCAPE into every control string, escaped or not."""
        return _cached(self, "*").sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return _cached(self, "+").sub(lambda m: m[0][0] + m[0][2:], text)

    def escape_role(self, role: str) -> str:
        return self.escape(role.replace("%", "%25").replace("\n", "%0A"))

    def unescape_role(self, role: str) -> str:
        return self.unescape(role).replace("%0A", "\n").replace("%25", "%")

    def turn(self) -> re.Pattern[str]:
        """One formatted turn: role and text, still escaped."""
        head, tail = self.prefix.split("{role}")
        return re.compile(f"{re.escape(head)}(?P<role>[^\n]*?){re.escape(tail)}(?P<text>.*?){re.escape(self.suffix)}", re.DOTALL)


_PATTERNS: dict[tuple[tuple[str, ...], str], re.Pattern[str]] = {}


def _cached(template: Template, least: str) -> re.Pattern[str]:
    key = (template.controls, least)
    if key not in _PATTERNS:
        _PATTERNS[key] = template._match(least)
    return _PATTERNS[key]


class Machine:
    """Steps over the roles of one conversation."""

    def __init__(self, template: Template):
        self.template, self.state, self.valid = template, "", True

    def step(self, role: str) -> bool:
        """Whether the turn was allowed; a wrong turn leaves the machine invalid for good."""
        self.valid = self.valid and role in self.template.follows.get(self.state, frozenset())
        self.state = role
        return self.valid


def format_chat(conversations: DataFrame, template: Template = Template(), *, id_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Segments in order: conv_id, segment (from 0), text, loss, valid.

    ``valid`` is false from the first turn on that the state machine does not allow.
    """
    bounded_batches(conversations.sparkSession)
    own = conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                               F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                               F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    placed = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, machine, count, begun = None, Machine(template), 0, False
        for b in batches(rows):
            ids, segment, text, loss, valid = [], [], [], [], []
            for k, (i, role, said) in enumerate(zip(*(b.column(c).to_pylist() for c in (0, 2, 3)))):
                if not begun or i != conv:
                    conv, machine, count, begun = i, Machine(template), 0, True
                ok = machine.step(role)
                text += [template.prefix.replace("{role}", template.escape_role(role)), template.escape(said), template.suffix]
                loss += [False, role in template.loss_roles, False]
                ids += [k] * 3
                segment += [count, count + 1, count + 2]
                valid += [ok] * 3
                count += 3
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(ids, pa.int64())), pa.array(segment, pa.int64()), pa.array(text, pa.string()),
                 pa.array(loss, pa.bool_()), pa.array(valid, pa.bool_())], names=["conv_id", "segment", "text", "loss", "valid"])

    return placed.mapInArrow(run, StructType([
        StructField("conv_id", own.schema["conv_id"].dataType), StructField("segment", LongType()), StructField("text", StringType()),
        StructField("loss", BooleanType()), StructField("valid", BooleanType())]))


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, parsed from the formatted segments alone: counts and digests of turns and loss text."""
    bounded_batches(segments.sparkSession)
    placed = segments.select("conv_id", "segment", "text", "loss", "valid").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    turn = template.turn()

    class Reader:
        def __init__(self, conv):
            self.conv, self.turns, self.loss_chars, self.chars, self.rest = conv, 0, 0, 0, ""
            self.said, self.learned = hashlib.sha256(), hashlib.sha256()
            self.valid, self.last = True, ""

        def take(self, text: str, loss: bool, valid: bool) -> None:
            self.chars += len(text)
            self.valid = self.valid and valid
            if loss:
                plain = template.unescape(text)
                self.loss_chars += len(plain)
                self.learned.update(plain.encode())
            self.rest += text
            while m := turn.match(self.rest):
                self.last = template.unescape_role(m["role"])
                self.said.update(f"{self.last}\n{template.unescape(m['text'])}\n".encode())
                self.turns += 1
                self.rest = self.rest[m.end():]

        def row(self):
            return (self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars,
                    self.valid and self.last in template.accepting)

    fields = [pa.field("n_turns", pa.int64()), pa.field("turns_sha256", pa.string()), pa.field("loss_chars", pa.int64()),
              pa.field("loss_sha256", pa.string()), pa.field("formatted_chars", pa.int64()), pa.field("valid", pa.bool_())]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, kind = None, None

        def batch(done):
            cols = list(zip(*(r.row() for r in done)))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(c, f.type) for c, f in zip(cols[1:], fields))],
                                              names=["conv_id", *(f.name for f in fields)])

        for b in batches(rows):
            kind, done = b.column(0).type, []
            for i, text, loss, valid in zip(*(b.column(c).to_pylist() for c in (0, 2, 3, 4))):
                if reader is None or reader.conv != i:
                    done += [reader] if reader else []
                    reader = Reader(i)
                reader.take(text, loss, valid)
            if done:
                yield batch(done)
        if reader:
            yield batch([reader])

    return placed.mapInArrow(run, StructType([
        StructField("conv_id", segments.schema["conv_id"].dataType), StructField("n_turns", LongType()), StructField("turns_sha256", StringType()),
        StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType()),
        StructField("valid", BooleanType())]))
