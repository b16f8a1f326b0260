"""Tables cut into slices of one total order, with what each slice must know of
the others.

Filling gaps and running sums read rows in order across the whole table.  Here
the rows are range-partitioned by the order (keys of any type; a hot value of
the first key is cut by the next ones) and sorted, each slice is read once, and
its summary, a row or two, is sent to the slices that need it.  The summaries
arrive as rows of the same table, tagged, so that a window over a slice sees
them before or after the slice's own rows.  The input is read by one plan
branch, nothing runs before an action, and no task holds more than a slice.

A slice gets at most a few summary rows from each other slice, so their number
is bounded by the square of ``MAX_SLICES``, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import IntegerType, StructField, StructType

MAX_SLICES = 2048
SLICE, KIND, SOURCE = "_os_slice", "_os_kind", "_os_source"
BEFORE, ROW, AFTER = 0, 1, 2  # kinds, in the order in which a window meets them


class Summary:
    """What a slice tells the others: ``add`` sees its rows in order, ``rows``
    gives (kind, rows for slices after or before this one)."""

    def add(self, batch: pa.RecordBatch) -> None:
        raise NotImplementedError

    def rows(self) -> Iterable[tuple[int, pa.RecordBatch]]:
        """A batch of kind BEFORE goes to all later slices, one of kind AFTER
        to this and all earlier ones."""
        raise NotImplementedError


def slices_for(df: DataFrame) -> int:
    return min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_SLICES)


def in_slices(df: DataFrame, order: list[Column], summary: Callable[[], Summary],
              slices: int | None = None) -> DataFrame:
    """``df`` with slice number, kind and source, and the summary rows.  All
    columns become nullable.  ``order`` should tell all rows apart, as rows that
    agree in it share a slice."""
    n = slices or slices_for(df)
    tags = [StructField(c, IntegerType()) for c in (SLICE, KIND, SOURCE)]
    schema = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields] + tags)
    names = schema.names

    def tagged(batch: pa.RecordBatch, slice_, kind: int, source: int) -> pa.RecordBatch:
        rows = batch.num_rows
        numbers = [np.broadcast_to(np.int32(x), rows) if np.isscalar(x) else x for x in (slice_, kind, source)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *[pa.array(x, pa.int32()) for x in numbers]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        me, told = TaskContext.get().partitionId(), summary()
        seen = False
        for batch in batches:
            if batch.num_rows:
                seen = True
                told.add(batch)
                yield tagged(batch, me, ROW, me)
        for kind, rows in told.rows() if seen else ():
            to = np.arange(me + 1, n, dtype=np.int32) if kind == BEFORE else np.arange(me + 1, dtype=np.int32)
            if len(to):
                yield tagged(rows.take(np.tile(np.arange(rows.num_rows), len(to))),
                             np.repeat(to, rows.num_rows), kind, me)

    return df.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(run, schema)


def one_row(schema: pa.Schema, values: dict[str, pa.Scalar]) -> pa.RecordBatch:
    """A row with the given values, all others NULL."""
    return pa.RecordBatch.from_arrays(
        [pa.array([values[f.name].as_py()], f.type) if f.name in values else pa.nulls(1, f.type) for f in schema],
        names=schema.names)
