"""Byte-level BPE encoding and decoding: every distinct word of the corpus is encoded once.

Texts are cut by the tokenizer's pattern (``coding.coded``), the chunks' distinct words are
shuffled by word, each distinct word is encoded by merge ranks in the one task that
gets it, the ids go back to the chunks, and the texts are put together again by position.
Decoding looks up every id in the token-byte table.

The rank table has one entry per token of a fixed vocabulary (50,256 here) and is checked
against ``MAX_TOKENS`` before it is broadcast; it does not grow with the data.

Defined results: null and empty texts have no ids and decode to nothing.  Rows are kept as
they are, repeated ones too.  Very long words take time in proportion to n log n.  Further columns
are not read; ``encode`` returns doc_id and ids.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from plotloom.llm.coding import coded, pack, pack_words, unpack, unpack_words
from plotloom.llm.words import slices
from plotloom.session import shuffle_partitions

MAX_TOKENS = 1_000_000
# Distinct words whose ids a task remembers; beyond it the memory is emptied.
REMEMBERED = 1_000_000
# Bytes of text per chunk; a task holds a few times as much.
CHUNK_BYTES = 8 << 20
# Words of whole texts that are put together at once.
BATCH_WORDS = 1 << 17
# Ids of whole texts that are decoded at once.
BATCH_IDS = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base-64 token and its rank per line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    if len(ranks) > MAX_TOKENS:
        raise ValueError(f"{len(ranks)} tokens are too many to broadcast")
    return ranks


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: always join the neighbouring parts of least rank, leftmost first."""
    if word in ranks:
        return [ranks[word]]
    size = len(word)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    end = list(range(1, size + 1))
    get = ranks.get
    waiting = []
    for i in range(size - 1):
        rank = get(word[i : i + 2])
        if rank is not None:
            waiting.append((rank, i, i + 2))
    heapq.heapify(waiting)
    alive = [True] * size
    while waiting:
        _, left, stop = heapq.heappop(waiting)
        right = after[left] if alive[left] else size
        # Out of date if either part has been merged since.
        if right >= size or end[right] != stop or not alive[right]:
            continue
        end[left] = stop
        alive[right] = False
        following = after[left] = after[right]
        if following < size:
            before[following] = left
            rank = get(word[left : end[following]])
            if rank is not None:
                heapq.heappush(waiting, (rank, left, end[following]))
        previous = before[left]
        if previous >= 0:
            rank = get(word[previous:stop])
            if rank is not None:
                heapq.heappush(waiting, (rank, previous, stop))
    return [ranks[word[i : end[i]]] for i in range(size) if alive[i]]


@lru_cache(maxsize=4)
def word_pattern(pattern: str):
    """The pattern with white space as Unicode defines it, which leaves out U+001C to U+001F."""
    import regex

    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def splitter(pattern: str) -> Callable[[list[bytes]], list[list[str]]]:
    def split(texts: list[bytes]) -> list[list[str]]:
        find = word_pattern(pattern).findall
        return [find(text.decode()) for text in texts]

    return split


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, ids) of every row."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(ranks)
    partitions = shuffle_partitions(spark)
    rows = coded(docs, splitter(pattern), chunk_bytes=CHUNK_BYTES)

    def by_word(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The word lists, cut by hash of the word."""
        for batch in batches:
            for chunk, words in zip(batch.column(0).to_pylist(), batch.column(5).to_pylist()):
                parts: dict[int, list[bytes]] = {}
                for word in unpack_words(words):
                    parts.setdefault(zlib.crc32(word) % partitions, []).append(word)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(parts), pa.int32()),
                        pa.array([chunk] * len(parts), pa.int64()),
                        pa.array([pack_words(own) for own in parts.values()], pa.binary()),
                    ],
                    ["part", "word_chunk", "words"],
                )

    lists = rows.mapInArrow(by_word, "part int, word_chunk long, words binary").repartition(partitions, "part")

    def encode_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = table.value
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            all_ids, all_sizes = [], []
            for packed in batch.column(2).to_pylist():
                ids, sizes = [], []
                for word in unpack_words(packed):
                    found = known.get(word)
                    if found is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        found = known[word] = merge(word, ranks)
                    ids += found
                    sizes.append(len(found))
                all_ids.append(pack(np.array(ids, dtype=np.int64)))
                all_sizes.append(pack(np.array(sizes, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(all_sizes, pa.binary()), pa.array(all_ids, pa.binary())],
                ["part", "word_chunk", "word_sizes", "ids"],
            )

    def put_together(rows: pa.Table, words: pa.Table) -> Iterator[pa.RecordBatch]:
        """The ids of a chunk's documents from its codes and the ids of its words."""
        row = rows.to_pylist()[0]
        # The words of a part came in the order of their numbers.
        place = np.fromiter((zlib.crc32(w) % partitions for w in unpack_words(row["words"])), dtype=np.int64)
        order = np.argsort(place, kind="stable")
        parts = sorted(words.select(["part", "word_sizes", "ids"]).to_pylist(), key=lambda p: p["part"])
        nothing = [np.empty(0, dtype=np.int64)]
        sizes = np.concatenate([unpack(p["word_sizes"]) for p in parts] or nothing)
        ids = np.concatenate([unpack(p["ids"]) for p in parts] or nothing).astype(np.int32)
        size_of, start_of = np.zeros(len(order), dtype=np.int64), np.zeros(len(order), dtype=np.int64)
        size_of[order], start_of[order] = sizes, np.cumsum(sizes) - sizes
        ends = np.cumsum(row["sizes"])
        codes = unpack(row["codes"])
        begin = 0
        while begin < len(ends):
            # Some documents at a time, one at least.
            first = int(ends[begin - 1]) if begin else 0
            stop = max(int(np.searchsorted(ends, first + BATCH_WORDS, side="right")), begin + 1)
            own = codes[first : ends[stop - 1]]
            length = size_of[own]
            total = np.concatenate(([0], np.cumsum(length)))
            at = np.repeat(start_of[own] - total[:-1], length) + np.arange(total[-1])
            bounds = total[np.concatenate(([0], ends[begin:stop] - first))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"][begin:stop], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids[at], pa.int32())),
                ],
                ["doc_id", "ids"],
            )
            begin = stop

    words = lists.mapInArrow(encode_words, "part int, word_chunk long, word_sizes binary, ids binary")

    def gather(rows: pa.Table, words: pa.Table) -> pa.Table:
        return pa.Table.from_batches(
            list(put_together(rows, words)), pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
        )

    return rows.groupBy("chunk").cogroup(words.groupBy("word_chunk")).applyInArrow(gather, "doc_id long, ids array<int>")


class TokenTable:
    """The bytes of every id."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        length = self.sizes[ids]
        before = np.cumsum(length) - length
        at = np.repeat(self.starts[ids] - before, length) + np.arange(length.sum())
        return self.letters[at].tobytes()


def _id_slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each batch cut into slices of at most ``BATCH_IDS`` ids, one row at least, with the ids of each row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        place = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_pylist()
        for begin, end in slices(sizes, BATCH_IDS):
            part = batch.slice(begin, end - begin)
            none = np.empty(0, dtype=np.int32)
            yield part, [np.asarray(ids.values) if ids.is_valid else none for ids in part.column(place)]


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Adds ``decoded``, the bytes of the ids, to a table with ``ids``."""
    table = encoded.sparkSession.sparkContext.broadcast(TokenTable(ranks))
    others = [f.name for f in encoded.schema.fields if f.name != "decoded"]

    def join_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, arrays in _id_slices(batches, "ids"):
            values = [table.value.join(ids) for ids in arrays]
            columns = [part.column(part.schema.get_field_index(name)) for name in others]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.binary())], [*others, "decoded"])

    schema = encoded.drop("decoded").schema.add("decoded", "binary")
    return encoded.mapInArrow(join_tokens, schema)


def digests(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digest of the ids and of what they decode to."""
    import hashlib

    table = encoded.sparkSession.sparkContext.broadcast(TokenTable(ranks))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, arrays in _id_slices(batches, "ids"):
            rows = []
            for ids in arrays:
                own = hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest()
                rows.append((len(ids), own, hashlib.sha256(table.value.join(ids)).hexdigest()))
            n, own, decoded = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def default_tokenizer() -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
