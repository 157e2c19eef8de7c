"""Arrow batches inside Python tasks, in pieces of few rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

PIECE_ROWS = 256


def pieces(batches: Iterable[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows, in order; empty batches give none.

    A batch of long texts is large, and workers are used again: each batch is
    let go before the next is read, and its memory given back.
    """
    source = iter(batches)
    while (batch := next(source, None)) is not None:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        pa.default_memory_pool().release_unused()
