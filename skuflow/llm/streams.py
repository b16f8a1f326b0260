"""Arrow batches as streams of rows, for workers that read sorted partitions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

ROWS = 4096
CHARS = 8 << 20


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def batches_of(rows: Iterable[tuple], names: list[str], types: list[pa.DataType], text: int | None = None
               ) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded length; with ``text``, the place of a long
    string, also of bounded size."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    for row in rows:
        held.append(row)
        size += len(row[text] or "") if text is not None else 0
        if len(held) >= ROWS or size >= CHARS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()
