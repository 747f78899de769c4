"""Delimited sheets whose headers differ from file to file.

Spark's reader maps CSV columns by position, so files with different headers must not share
one typed read.  Here files are scanned as text lines, split into blocks like any text, and each
record is paired with the header of its own file (by full path) in the task that reads it.

A quoted cell may hold line breaks, so a block may begin inside one.  In a first pass every block
reports how it changes the state "inside quotes": where its lines end if it begins inside, and if
outside.  Composing these small maps in block order gives the state at each block's
start, and with it the header and the rest of a record that goes on in the next block.  Only files of
several blocks need any of this; blocks that are the whole of their file are read on their own.

Rules, the same however a file is split: the first ``skip`` lines are preamble and are not looked at;
blank lines are no records; the first record is the header; a record with fewer cells than the
header has nulls; cells beyond the header go to ``rejects``, and so does a record whose
quote is never closed, with its first ``RECORD_BYTES`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotloom.functions.domain import file_name_parts
from plotloom.functions.scalar import missing_to_null
from plotloom.session import cut_lineage, shuffle_partitions
from plotloom.sources.quoting import cells as cells_of
from plotloom.sources.quoting import ends_inside

NAME_PATTERN = "*csv*"

# Text up to which a block reports how a record goes on in it; longer ones are read in a pass of their own.
HEAD_BYTES = 1 << 16
# The longest record.
RECORD_BYTES = 1 << 26
# Rows and letters after which a task passes on what it has found, be it of one block or of many.
BATCH_ROWS, BATCH_LETTERS = 8192, 4 << 20
# What is known of blocks travels with the tasks up to this size, and to the lines by shuffle beyond it.
KNOWN_BYTES = 8 << 20

OPEN_QUOTE, SURPLUS, HEADER = "open quote", "surplus cells", "header"


# Lines -----------------------------------------------------------------------------


def discover(spark: SparkSession, folder: str, pattern: str = NAME_PATTERN) -> DataFrame:
    """Files whose name matches, with year, site, trial and datatype; contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return file_name_parts(listed.select("path", "length", F.element_at(F.split("path", "/"), -1).alias("file")))


def scan(spark: SparkSession, folder: str | Sequence[str], pattern: str = NAME_PATTERN) -> DataFrame:
    """The lines of all files whose name matches: path, file, its name parts, block and value.

    A filter on path, file or the name parts leaves whole files unread.
    """
    folders = [folder] if isinstance(folder, str) else list(folder)
    raw = spark.read.options(lineSep="\n", pathGlobFilter=pattern).text(folders)
    plain = lambda name: F.url_decode(F.replace(F.col(f"_metadata.{name}"), F.lit("+"), F.lit("%2B")))
    lines = raw.select(
        plain("file_path").alias("path"),
        plain("file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )
    return file_name_parts(lines)


def _in_order(lines: DataFrame) -> DataFrame:
    """Path, file, block and value, the lines of a block one after another.

    A text scan reads them so; lines from elsewhere have a column ``line`` to be sorted by.
    """
    names = ["path", "file", "block", "value"]
    if "line" not in lines.columns:
        return lines.select(*names)
    dealt = lines.repartition(shuffle_partitions(lines.sparkSession), "path", "block")
    return dealt.sortWithinPartitions("path", "block", "line").select(*names)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, str, int, int, int]]:
    """(path, file, block, begin, end) of the stretches of a batch that are of one block."""
    if not batch.num_rows:
        return
    paths = batch.column(0).dictionary_encode()
    codes = paths.indices.to_numpy(zero_copy_only=False)
    blocks = batch.column(2).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), len(codes)]
    for begin, end in zip(edges, edges[1:]):
        path = paths.dictionary[int(codes[begin])].as_py()
        yield path, batch.column(1)[begin].as_py(), int(blocks[begin]), begin, end


def _values(batch: pa.RecordBatch) -> list[str]:
    return pc.fill_null(batch.column(3), "").to_pylist()


def _gathered(rows: Iterable[tuple[dict, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, given with the letters of their texts, in batches: blocks may be many and short."""
    found, size = [], 0
    for row, letters in rows:
        found.append(row)
        size += letters
        if len(found) >= BATCH_ROWS or size >= BATCH_LETTERS:
            yield pa.RecordBatch.from_pylist(found, schema)
            found, size = [], 0
    if found:
        yield pa.RecordBatch.from_pylist(found, schema)


def _first_value(value: str, block: int) -> str:
    return value[1:] if block == 0 and value.startswith("﻿") else value


# First pass: what blocks report ----------------------------------------------------

REPORT = (
    "path string, block long, n long, outside array<boolean>, inside array<boolean>, "
    "firsts array<string>, first_open array<boolean>, head string, closes boolean"
)
_REPORT = pa.schema(
    [
        ("path", pa.string()),
        ("block", pa.int64()),
        ("n", pa.int64()),
        ("outside", pa.list_(pa.bool_())),
        ("inside", pa.list_(pa.bool_())),
        ("firsts", pa.list_(pa.string())),
        ("first_open", pa.list_(pa.bool_())),
        ("head", pa.string()),
        ("closes", pa.bool_()),
    ]
)


class _Report:
    """How a block changes the state, for each number of preamble lines that it may begin with."""

    def __init__(self, path: str, block: int, skip: int, head_bytes: int):
        self.path, self.block, self.n, self.head_bytes = path, block, 0, head_bytes
        # States after the lines from place j on, begun outside and inside.
        self.after = [[False, True] for _ in range(skip + 1)]
        self.firsts: list[list[str]] = [[] for _ in range(skip + 1)]
        self.first_open = [True] * (skip + 1)
        self.head: list[str] = []
        self.head_size, self.closes = 0, False

    def add(self, values: list[str]) -> None:
        for line in values:
            quoted = '"' in line
            for j in range(min(self.n, len(self.after) - 1) + 1):
                if self.first_open[j] and (self.firsts[j] or line.strip()):
                    open_ = bool(self.firsts[j])
                    self.firsts[j].append(line)
                    self.first_open[j] = ends_inside(line, open_) if quoted else open_
                if quoted:
                    self.after[j] = [ends_inside(line, state) for state in self.after[j]]
            if not self.closes and self.head_size <= self.head_bytes:
                self.head.append(line)
                self.head_size += len(line) + 1
                self.closes = quoted and not ends_inside(line, True)
            self.n += 1

    def letters(self) -> int:
        return self.head_size + sum(len(line) for lines in self.firsts for line in lines)

    def row(self) -> dict:
        whole = self.closes or self.head_size <= self.head_bytes
        return {
            "path": self.path,
            "block": self.block,
            "n": self.n,
            "outside": [a for a, _ in self.after],
            "inside": [b for _, b in self.after],
            "firsts": ["\n".join(lines) if lines else None for lines in self.firsts],
            "first_open": self.first_open,
            "head": "\n".join(self.head) if whole else None,
            "closes": self.closes,
        }


def _reports(lines: DataFrame, skip: int, head_bytes: int) -> DataFrame:
    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        now = None
        for batch in batches:
            texts = _values(batch)
            for path, _, block, begin, end in _runs(batch):
                if now is None or (now.path, now.block) != (path, block):
                    if now is not None:
                        yield now.row(), now.letters()
                    now = _Report(path, block, skip, head_bytes)
                values = texts[begin:end]
                if now.n == 0:
                    values[0] = _first_value(values[0], block)
                now.add(values)
        if now is not None:
            yield now.row(), now.letters()

    return lines.mapInArrow(lambda batches: _gathered(blocks(batches), _REPORT), REPORT)


# Composition in block order --------------------------------------------------------

KNOWN = "before long, inside boolean, header string, rest string, closed boolean"
INFO = f"path string, block long, {KNOWN}, gap boolean"
_KNOWN = [
    ("before", pa.int64()),
    ("inside", pa.bool_()),
    ("header", pa.string()),
    ("rest", pa.string()),
    ("closed", pa.bool_()),
]
_INFO = pa.schema([("path", pa.string()), ("block", pa.int64()), *_KNOWN, ("gap", pa.bool_())])


def _composed(reports: Iterable[dict], skip: int) -> Iterator[dict]:
    """What is known of each block of one file, from its reports in order.

    ``rest`` is how the last record of a block goes on in the next ones.  A gap is a block whose
    text is part of such a record and was too long to be reported.
    """
    before, inside, header, header_open = 0, False, None, False
    waiting: dict | None = None
    rest: list[str] = []
    for report in reports:
        j = min(max(skip - before, 0), report["n"])
        row = {"path": report["path"], "block": report["block"], "before": before, "inside": inside, "gap": False}
        row |= {"rest": None, "closed": True}
        if inside:
            row["gap"] = report["head"] is None
            rest.append(report["head"] or "")
            if report["closes"]:
                waiting["rest"] = "\n".join(rest)
                yield waiting
                if header_open:
                    header, header_open = f"{header}\n{waiting['rest']}", False
                waiting, rest = None, []
        row["header"] = header
        if header is None and not inside and report["firsts"][j] is not None and j < max(report["n"], 1):
            header, header_open = report["firsts"][j], report["first_open"][j]
        after = report["inside" if inside else "outside"][j] if j < report["n"] else inside
        if after and waiting is None:
            waiting = row
        else:
            yield row
        before, inside = before + report["n"], after
    if waiting is not None:
        yield waiting | {"rest": "\n".join(rest) if rest else None, "closed": False}


def _known_blocks(lines: DataFrame, skip: int) -> DataFrame:
    """What tasks cannot see in their own block; blocks that are a whole file are left out."""
    reports = cut_lineage(_reports(lines, skip, HEAD_BYTES))

    def compose(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for _, group in groupby(rows, key=lambda row: row["path"]):
            for row in _composed(group, skip):
                if row["block"] > 0 or row["rest"] is not None:
                    yield row, len(row["header"] or "") + len(row["rest"] or "")

    def composed(table: DataFrame) -> DataFrame:
        dealt = table.repartition("path").sortWithinPartitions("path", "block")
        return cut_lineage(dealt.mapInArrow(lambda batches: _gathered(compose(batches), _INFO), INFO))

    known = composed(reports)
    gaps = known.where("gap").select("path", "block")
    if gaps.isEmpty():
        return known
    # A record as long as a block: its text is read in one more pass over the lines.
    placed = lines.withColumn("line", F.monotonically_increasing_id())
    whole = _reports(_in_order(placed.join(gaps, ["path", "block"], "left_semi")), 0, RECORD_BYTES)
    heads = whole.select("path", "block", F.col("head").alias("whole"), F.col("closes").alias("ends"))
    filled = reports.join(heads, ["path", "block"], "left").withColumns(
        {"head": F.coalesce("head", "whole"), "closes": F.coalesce("ends", "closes")}
    )
    return composed(filled.select(reports.columns))


# Second pass: records --------------------------------------------------------------

ROW = (
    "path string, file string, block_start long, line long, header array<string>, cells array<string>, "
    "surplus array<string>, problem string"
)


class _Block:
    """The records of one block, one line after another."""

    def __init__(self, path: str, file: str, block: int, skip: int, known: dict | None):
        known = known or {"before": 0, "inside": False, "header": None, "rest": None, "closed": False}
        self.path, self.file, self.block = path, file, block
        self.line, self.preamble = 0, max(skip - known["before"], 0)
        self.inside = known["inside"]  # of a record that another block reads
        self.header = None if known["header"] is None else cells_of(known["header"])
        self.rest, self.closed = known["rest"], known["closed"]
        self.open: list[str] = []
        self.first = 0
        self.found: list[tuple[int, list[str], list[str] | None, str | None]] = []

    def add(self, values: list[str]) -> None:
        for line in values:
            place = self.line
            self.line += 1
            if place < self.preamble:
                continue
            if self.inside:
                self.inside = ends_inside(line, True)
            elif self.open:
                self.open.append(line)
                if not ends_inside(line, True):
                    self._record(self.first, "\n".join(self.open))
                    self.open = []
            elif line.strip():
                if '"' in line and ends_inside(line, False):
                    self.open, self.first = [line], place
                else:
                    self._record(place, line)

    def end(self) -> None:
        if not self.open:
            return
        text = "\n".join(self.open if self.rest is None else [*self.open, self.rest])
        if self.rest is not None and self.closed:
            self._record(self.first, text)
        else:
            self.found.append((self.first, [], [text[:RECORD_BYTES]], OPEN_QUOTE))
        self.open = []

    def _record(self, place: int, text: str) -> None:
        found = cells_of(text.removesuffix("\r"))
        if self.header is None:
            self.header = found
            self.found.append((place, found, None, HEADER))
            return
        surplus = [cell for cell in found[len(self.header) :] if cell]
        self.found.append((place, found, surplus or None, SURPLUS if surplus else None))

    def taken(self) -> tuple[str, str, int, list[str], list] | None:
        """The records so far, with the path, file, block and header that they share."""
        if not self.found:
            return None
        found, self.found = self.found, []
        return self.path, self.file, self.block, self.header or [], found


def _record_batch(parts: list[tuple[str, str, int, list[str], list]]) -> pa.RecordBatch:
    """Records of one block or of many as one batch."""
    sizes = [len(found) for *_, found in parts]
    of_part = pa.array(np.repeat(np.arange(len(parts)), sizes))
    widths = np.repeat([len(header) for *_, header, _ in parts], sizes)
    flat = [
        cell
        for *_, header, found in parts
        for _, cells, _, _ in found
        for cell in (cells if len(cells) == len(header) else (cells + [None] * (len(header) - len(cells)))[: len(header)])
    ]
    ends = pa.array(np.concatenate(([0], np.cumsum(widths))).astype(np.int32))
    records = [record for *_, found in parts for record in found]
    values = [
        pa.array([path for path, *_ in parts], pa.string()).take(of_part),
        pa.array([file for _, file, *_ in parts], pa.string()).take(of_part),
        pa.array([block for _, _, block, *_ in parts], pa.int64()).take(of_part),
        pa.array([place for place, *_ in records], pa.int64()),
        pa.array([header for *_, header, _ in parts], pa.list_(pa.string())).take(of_part),
        pa.ListArray.from_arrays(ends, pa.array(flat, pa.string())),
        pa.array([surplus for _, _, surplus, _ in records], pa.list_(pa.string())),
        pa.array([problem for *_, problem in records], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(values, [part.split()[0] for part in ROW.split(", ")])


def _records(batches: Iterable[pa.RecordBatch], skip: int, known: dict) -> Iterator[pa.RecordBatch]:
    """Records of lines in order.  A block's line with a filled column ``known`` tells what is known of it."""
    now, parts, rows, letters = None, [], 0, 0

    def take() -> None:
        nonlocal rows
        if (part := now.taken()) is not None:
            parts.append(part)
            rows += len(part[-1])

    for batch in batches:
        told = batch.num_columns > 4
        texts = _values(batch)
        for path, file, block, begin, end in _runs(batch):
            if now is None or (now.path, now.block) != (path, block):
                if now is not None:
                    now.end()
                    take()
                    letters += len(now.rest or "")
                info = batch.column(4)[begin].as_py() if told else known.get((path, block))
                now = _Block(path, file, block, skip, info)
                begin += bool(told and info)
            if begin < end:
                values = texts[begin:end]
                if now.line == 0:
                    values[0] = _first_value(values[0], block)
                now.add(values)
                take()
                # Headers are repeated in every record.
                letters += sum(map(len, values)) + (end - begin) * sum(map(len, now.header or ()))
            if rows >= BATCH_ROWS or letters >= BATCH_LETTERS:
                if parts:
                    yield _record_batch(parts)
                parts, rows, letters = [], 0, 0
    if now is not None:
        now.end()
        take()
    if parts:
        yield _record_batch(parts)


def _all_records(lines: DataFrame, skip: int) -> DataFrame:
    ordered = _in_order(lines)
    info = _known_blocks(ordered, skip)
    size = F.sum(F.octet_length("path") + F.octet_length(F.concat_ws("", "header", "rest")) + 64)
    if (info.agg(size.alias("size")).first()["size"] or 0) <= KNOWN_BYTES:
        known = {(row["path"], row["block"]): row.asDict() for row in info.collect()}
        return ordered.mapInArrow(lambda batches: _records(batches, skip, known), ROW)
    # Too much to travel with every task: a row that tells it goes ahead of the lines of its block.
    numbered = ordered.withColumns({"known": F.lit(None).cast(f"struct<{KNOWN}>"), "line": F.monotonically_increasing_id()})
    names = [part.split()[0] for part in KNOWN.split(", ")]
    ahead = info.select(
        "path",
        F.lit(None).cast("string").alias("file"),
        "block",
        F.lit(None).cast("string").alias("value"),
        F.struct(*names).alias("known"),
        F.lit(-1).cast("long").alias("line"),
    )
    dealt = numbered.unionByName(ahead).repartition(shuffle_partitions(lines.sparkSession), "path", "block")
    together = dealt.sortWithinPartitions("path", "block", "line").select("path", "file", "block", "value", "known")
    read = together.mapInArrow(lambda batches: _records(batches, skip, {}), ROW)
    return read.withColumn("file", F.element_at(F.split("path", "/"), -1))


def read_rows(lines: DataFrame, skip: int = 0) -> DataFrame:
    """Every record below the header: path, file, block_start, line, header, cells, surplus, problem.

    ``lines`` comes from ``scan``, or has path, file, block, value and line.  The pass over the block states
    runs at once; the records are read when the result is used.
    """
    return _all_records(lines, skip).where(F.col("problem").isNull() | (F.col("problem") != HEADER))


def headers(lines: DataFrame, skip: int = 0) -> DataFrame:
    """(path, file, header) of every file."""
    return _all_records(lines, skip).where(F.col("problem") == HEADER).select("path", "file", "header")


def rejects(rows: DataFrame) -> DataFrame:
    """Records with cells beyond the header, or with a quote that is never closed (its text)."""
    return rows.where("problem is not null").select("path", "file", "block_start", "line", "problem", "surplus")


# Cells -----------------------------------------------------------------------------


def _filled(rows: DataFrame, order: str) -> DataFrame:
    """The rows that have cells, with missing ones as null."""
    return rows.where(F.col("problem").isNull() | (F.col("problem") != OPEN_QUOTE)).select(
        "file",
        F.struct("block_start", "line").alias(order),
        "header",
        F.transform("cells", lambda cell: missing_to_null(cell)).alias("cells"),
    )


def _cell(name: str):
    return F.get("cells", F.array_position("header", F.lit(name)).cast("int") - 1)


def long_cells(rows: DataFrame, ids: Sequence[str] = (), drop_nulls: bool = True, order: str = "order") -> DataFrame:
    """Every cell of records from ``read_rows`` as (file, order, ids..., name, value).

    ``order`` is (block, line) and follows the rows of a file; id columns a file lacks are null.
    """
    with_ids = _filled(rows, order).select("file", order, *[_cell(name).alias(name) for name in ids], "header", "cells")
    pairs = F.arrays_zip(F.col("header").alias("n"), F.col("cells").alias("v"))
    if ids:
        pairs = F.filter(pairs, lambda c: ~c["n"].isin(list(ids)))
    if drop_nulls:
        pairs = F.filter(pairs, lambda c: c["v"].isNotNull())
    long = with_ids.select("file", order, *ids, F.explode(pairs).alias("c"))
    return long.select("file", order, *ids, F.col("c.n").alias("name"), F.col("c.v").alias("value"))


def read_long(
    lines: DataFrame, ids: Sequence[str] = (), skip: int = 0, drop_nulls: bool = True, order: str = "order"
) -> DataFrame:
    """Every cell of every file, see ``long_cells``."""
    return long_cells(read_rows(lines, skip), ids, drop_nulls, order)


def read_columns(lines: DataFrame, columns: Sequence[str], skip: int = 0, order: str = "order") -> DataFrame:
    """The named columns of every file, aligned by name; a column a file lacks is null."""
    rows = _filled(read_rows(lines, skip), order)
    return rows.select("file", order, *[_cell(name).alias(name) for name in columns])


def read_sheet(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """One sheet, or several with the same header, as text columns under their own names."""
    records = _all_records(scan(spark, path, "*"), skip)
    top = records.where(F.col("problem") == HEADER).select("header").distinct().limit(2).collect()
    if len(top) != 1:
        raise ValueError("no header, or files with different headers: use read_long or read_columns")
    rows = _filled(records.where(F.col("problem").isNull() | (F.col("problem") != HEADER)), "order")
    return rows.select(*[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(top[0]["header"])])


def later_first(df: DataFrame, file: str = "file", order: str = "order", out: str = "place") -> DataFrame:
    """Add the place of a row when stacked files are searched last file first, each from
    its top: the largest place is searched first."""
    return df.withColumn(out, F.struct(F.col(file), -F.col(f"{order}.block_start"), -F.col(f"{order}.line")))
