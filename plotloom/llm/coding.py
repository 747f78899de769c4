"""Documents as codes into chunk-wise word lists, for work that is done once per distinct word.

``coded`` reads every text once and cuts it into words.  A task gathers documents into chunks of
some megabytes; within a chunk every distinct word has a number, the most frequent the least.
One row comes out per chunk: its documents, the numbers of their words in order, its distinct
words, and how often each occurs in flagged documents.

So what is shuffled later is each chunk's distinct words rather than every word of every text,
and a word that is everywhere costs one entry per chunk.  The rows are dealt out by chunk in
one exchange, which every user of the result shares as long as it takes whole rows; nothing is
read or cut twice.  Numbers are kept as varints and all is deflated, since this exchange holds the
corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.llm.arrow_text import text_slices
from plotloom.session import shuffle_partitions

# Bytes of text gathered into one chunk; one longer text is a chunk of its own.
CHUNK_BYTES = 16 << 20
# Numbers, or bytes of them, that are packed or unpacked at once.
BLOCK = 1 << 17

SCHEMA = (
    "chunk long, doc_ids array<long>, flags array<boolean>, sizes array<long>, codes binary, words binary, amounts binary"
)
NAMES = ["chunk", "doc_ids", "flags", "sizes", "codes", "words", "amounts"]
_TYPES = [
    pa.int64(),
    pa.list_(pa.int64()),
    pa.list_(pa.bool_()),
    pa.list_(pa.int64()),
    pa.binary(),
    pa.binary(),
    pa.binary(),
]

Tokenise = Callable[[list[bytes]], list[list]]


class Numbers(dict):
    """Gives a new word the next number."""

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def _varints(numbers: np.ndarray) -> bytes:
    numbers = numbers.astype(np.uint64)
    width = np.ones(len(numbers), dtype=np.int64)
    for bits in range(7, 64, 7):
        more = numbers >= np.uint64(1) << np.uint64(bits)
        if not more.any():
            break
        width += more
    ends = np.cumsum(width)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    starts = ends - width
    for j in range(int(width.max()) if len(width) else 0):
        has = np.flatnonzero(width > j)
        part = ((numbers[has] >> np.uint64(7 * j)) & np.uint64(127)).astype(np.uint8)
        out[starts[has] + j] = part | np.where(width[has] > j + 1, 128, 0).astype(np.uint8)
    return out.tobytes()


def pack(numbers: np.ndarray) -> bytes:
    """Deflated varints: seven bits a byte, low ones first, the top bit set on all bytes but the last."""
    deflate = zlib.compressobj(1)
    parts = [deflate.compress(_varints(numbers[at : at + BLOCK])) for at in range(0, len(numbers), BLOCK)]
    return b"".join([*parts, deflate.flush()])


def _numbers(raw: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(raw < 128)
    starts = np.concatenate(([0], last[:-1] + 1))
    values = (raw[starts] & 127).astype(np.int64)
    width = last - starts + 1
    for j in range(1, int(width.max())):
        has = np.flatnonzero(width > j)
        values[has] |= (raw[starts[has] + j] & 127).astype(np.int64) << (7 * j)
    return values


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), dtype=np.uint8)
    out = np.empty(np.count_nonzero(raw < 128), dtype=np.int64)
    begin = done = 0
    while begin < len(raw):
        # A block ends with the last byte of a number; none has more than ten.
        end = min(begin + BLOCK, len(raw))
        while raw[end - 1] >= 128:
            end += 1
        values = _numbers(raw[begin:end])
        out[done : done + len(values)] = values
        begin, done = end, done + len(values)
    return out


def pack_words(words: list[bytes]) -> bytes:
    """Lengths and letters of a list of words, deflated."""
    sizes = pack(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
    return len(sizes).to_bytes(4, "little") + sizes + zlib.compress(b"".join(words), 1)


def unpack_words(data: bytes) -> list[bytes]:
    middle = 4 + int.from_bytes(data[:4], "little")
    ends = np.cumsum(unpack(data[4:middle])).tolist()
    letters = zlib.decompress(data[middle:])
    return [letters[a:b] for a, b in zip([0, *ends], ends)]


class _Chunk:
    """Documents gathered so far."""

    def __init__(self):
        self.numbers, self.size = Numbers(), 0
        self.ids: list[int | None] = []
        self.flags: list[bool] = []
        self.codes: list[np.ndarray] = []

    def add(self, doc_id: int | None, flag: bool, words: list, size: int) -> None:
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int32, count=len(words)))
        self.ids.append(doc_id)
        self.flags.append(flag)
        self.size += size

    def row(self, name: int) -> pa.RecordBatch:
        words = [w.encode() if isinstance(w, str) else w for w in self.numbers]
        codes = np.concatenate(self.codes)
        sizes = [len(c) for c in self.codes]
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), dtype=np.int32)
        rank[order] = np.arange(len(words))
        flagged = np.repeat(np.array(self.flags, dtype=bool), sizes)
        amounts = np.bincount(rank[codes[flagged]], minlength=len(words))
        values = (
            name,
            self.ids,
            self.flags,
            sizes,
            pack(rank[codes]),
            pack_words([words[i] for i in order]),
            pack(amounts),
        )
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _TYPES)], NAMES)


def coded(
    docs: DataFrame, tokenise: Tokenise, flag: Column | None = None, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """The rows described above, dealt out by chunk.

    ``tokenise`` turns a list of texts (UTF-8; null is empty) into lists of words.  ``flag`` says
    which documents count in ``amounts``; null is no.
    """
    flag = F.lit(False) if flag is None else F.coalesce(flag, F.lit(False))
    partitions = shuffle_partitions(docs.sparkSession)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0
        chunk = _Chunk()
        for part, texts in text_slices(batches):
            ids, flags = part.column(0).to_pylist(), part.column(2).to_pylist()
            for doc_id, flagged, text in zip(ids, flags, texts):
                if chunk.size and chunk.size + len(text) > chunk_bytes:
                    yield chunk.row(task + made)
                    made += 1
                    chunk = _Chunk()
                chunk.add(doc_id, flagged, tokenise([text])[0], len(text))
        if chunk.ids:
            yield chunk.row(task + made)

    rows = docs.select("doc_id", "text", flag.alias("flag")).mapInArrow(cut, SCHEMA)
    return rows.repartition(partitions, "chunk")
