"""Chat formatting: a state machine over roles, a declarative template, loss flags, reading back.

A template says which role may follow which, what stands before and after a turn of each role,
and in which roles the loss is taken.  Every turn becomes three segments (text, loss): the opening mark, the
escaped text and the closing mark; only the text of a loss role is under the mask.

Control strings inside texts are escaped: a backslash becomes two, and a control string gets a
backslash before it.  Control strings contain no backslash, and none has '[' or '<' but in front,
so none can come about across the edge of a text and a mark, and ``parse`` finds exactly the marks.

Defined results: turns are taken by turn number, then role and text, nulls first; repeated rows
are turns of their own.  A null text or role counts as empty.  A role that the template does
not know is kept by name and is never under the mask.  A null conv_id is a conversation of its own.
A conversation that breaks the turn order is formatted all the same, with ``allowed`` false at the
turns that may not follow.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START = "start"


@dataclass(frozen=True)
class Template:
    """``follows``: the roles that may come after a role, or at the start.  ``ends``: where a conversation may end."""

    follows: dict[str, tuple[str, ...]]
    ends: tuple[str, ...]
    marks: dict[str, tuple[str, str]]
    loss: tuple[str, ...]
    # Of roles without marks of their own: before the role, between role and text, after the text.
    other: tuple[str, str, str]
    control: tuple[str, ...] = field(default=())

    def __post_init__(self):
        strings = {m.strip() for pair in (*self.marks.values(), self.other) for m in pair}
        for s in strings:
            if s[0] not in "[<" or re.search(r"[\[<\\]", s[1:]):
                raise ValueError(f"a mark begins with [ or < and has none, and no backslash, inside: {s}")
        object.__setattr__(self, "control", tuple(sorted(strings, key=lambda s: (-len(s), s))))


INSTRUCT = Template(
    follows={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("user", "assistant"),
    marks={"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")},
    loss=("assistant",),
    other=("[TURN] ", " [TEXT] ", " [/TURN]"),
)


def _alternatives(template: Template) -> str:
    return "|".join(re.escape(c) for c in template.control)


def escape(text: Column, template: Template) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    # Every character of a control string that means something in a pattern is quoted.
    return F.regexp_replace(doubled, f"({_alternatives(template)})", r"\\$1")


def unescape(text: str, template: Template) -> str:
    return re.sub(rf"\\(\\|{_alternatives(template)})", r"\1", text)


def format_turns(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, turn, place, allowed, segments): one row per turn, place counting from 0.

    The state after a turn is its role, so whether a turn may follow depends on the turn before it.
    """
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    state = F.coalesce(F.lag("role").over(order), F.lit(START))
    placed = rows.withColumns(
        {"state": state, "first": F.lag("role").over(order).isNull(), "place": F.row_number().over(order) - 1}
    )
    allowed = F.lit(False)
    for before, after in template.follows.items():
        here = F.col("first") if before == START else (~F.col("first") & (F.col("state") == before))
        allowed = allowed | (here & F.col("role").isin(*after))
    begin, middle, end = template.other
    opening = F.concat(F.lit(begin), escape(F.col("role"), template), F.lit(middle))
    closing = F.lit(end)
    for role, (left, right) in template.marks.items():
        opening = F.when(F.col("role") == role, F.lit(left)).otherwise(opening)
        closing = F.when(F.col("role") == role, F.lit(right)).otherwise(closing)

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    return placed.select(
        "conv_id",
        "turn",
        "place",
        allowed.alias("allowed"),
        F.array(
            segment(opening, F.lit(False)),
            segment(escape(F.col("text"), template), F.col("role").isin(*template.loss)),
            segment(closing, F.lit(False)),
        ).alias("segments"),
    )


def parse(text: str, template: Template = INSTRUCT) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    by_opening = {left.strip(): (role, left, right) for role, (left, right) in template.marks.items()}
    begin, middle, end = template.other
    controls = _alternatives(template)
    marks = re.compile(rf"\\(?:\\|{controls})|({controls})")

    def next_mark(at: int, wanted: str) -> int:
        for found in marks.finditer(text, at):
            if found.group(1) is not None:
                if found.group(1) != wanted:
                    break
                return found.start()
        raise ValueError(f"{wanted} is missing after {at}")

    turns, at = [], 0
    while at < len(text):
        found = marks.match(text, at)
        opening = found.group(1) if found else None
        if opening in by_opening:
            role, left, right = by_opening[opening]
            start = at + len(left)
        elif opening == begin.strip():
            name_at = at + len(begin)
            stop = next_mark(name_at, middle.strip())
            gap = len(middle) - len(middle.lstrip())
            role = unescape(text[name_at : stop - gap], template)
            start, right = stop - gap + len(middle), end
        else:
            raise ValueError(f"no turn begins at {at}")
        stop = next_mark(start, right.strip())
        gap = len(right) - len(right.lstrip())
        turns.append((role, unescape(text[start : stop - gap], template)))
        at = stop - gap + len(right)
    return turns


def read_back(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation: turns, digests of what is read back, characters, and whether the order held.

    Reads the rows of ``format_turns`` in order and holds one turn at a time, however long the
    conversation is.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, in_order boolean"
    )
    names = [part.split()[0] for part in schema.split(",")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        key, state = None, None

        def close() -> None:
            if state is not None:
                n, turn_hash, loss_chars, loss_hash, chars, in_order, last = state
                done.append(
                    (key, n, turn_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars, in_order and last in template.ends)
                )

        for batch in batches:
            for conv, allowed, segments in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if state is None or conv != key:
                    close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True, None]
                text = "".join(s["text"] for s in segments)
                for role, content in parse(text, template):
                    state[0] += 1
                    state[1].update(f"{role}\n{content}\n".encode())
                    state[6] = role
                for s in segments:
                    if s["loss"]:
                        learned = unescape(s["text"], template)
                        state[2] += len(learned)
                        state[3].update(learned.encode())
                state[4] += len(text)
                state[5] = state[5] and allowed
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
                done.clear()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    ordered = turns.select("conv_id", "place", "allowed", "segments")
    return ordered.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(read, schema)
