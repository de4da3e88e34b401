"""Small pieces of Arrow batches, so that a worker never holds a whole batch as Python objects."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

ROWS = 256


def pieces(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
