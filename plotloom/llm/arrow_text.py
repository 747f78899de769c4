"""Reading texts from Arrow batches in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from plotloom.llm.words import slices

# Bytes of text that a task handles at once, with some forty times as much in arrays; one longer
# text is handled alone.
SLICE_BYTES = 1 << 20


def byte_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(column), 0))


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch cut into slices, with the texts as bytes (null: empty)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        place = batch.schema.get_field_index(column)
        for begin, end in slices(byte_lengths(batch.column(place)).tolist(), limit):
            part = batch.slice(begin, end - begin)
            values = part.column(place).cast(pa.large_binary()).to_pylist()
            yield part, [v or b"" for v in values]
