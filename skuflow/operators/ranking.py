"""Running sums within groups that may be too large for one task.

A plain ``sum().over(Window.partitionBy(g).orderBy(v))`` puts every row of a
group into one task.  ``running_sum_by_group`` sorts the rows of all groups by
(group, value from the largest down, tie key) into slices, so that a hot group,
and within it any number of equal values, lies over many tasks.  A slice tells
the others the sums of its first and its last group, the only ones that it can
share; a window over (slice, group) adds what came before to the running sum,
and all of it to the group's total.  The input is read once.

DECIMAL sums are exact.  DOUBLE sums depend on the order of addition in their
last digits, so compare them with thresholds only after rounding.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, LongType

from skuflow.operators.ordered import AFTER, BEFORE, KIND, ROW, SLICE, SOURCE, Summary, in_slices, one_row

STEPS = 32          # slices per doubling of the value

_VALUE = "_rs_value"


def value_slice(value: Column) -> Column:
    """A whole number that never falls as the value rises; NULL is lowest."""
    v = value.cast("double")
    size = F.floor(F.log2(F.abs(v)) * STEPS) + 2_000 * STEPS  # doubles reach down to 2^-1074
    return (F.when(v.isNull(), F.lit(-(10 ** 9))).when(v > 0, size).when(v < 0, -size)
            .otherwise(F.lit(0)).cast("long"))


def _sum_type(kind: DataType) -> DataType:
    """The type that Spark gives to the sum of a column."""
    if isinstance(kind, DecimalType):
        return DecimalType(min(38, kind.precision + 10), kind.scale)
    return DoubleType() if isinstance(kind, (DoubleType, FloatType)) else LongType()


class _EndGroups(Summary):
    """Sums of the first and the last group of a slice."""

    def __init__(self, group_cols: list[str]):
        self.group_cols = group_cols
        self.found: list[list] = []  # [group, sum]: the first group and the latest one
        self.schema: pa.Schema | None = None

    def add(self, batch: pa.RecordBatch) -> None:
        self.schema = batch.schema
        keys = [batch.column(batch.schema.get_field_index(c)) for c in self.group_cols]
        values = batch.column(batch.schema.get_field_index(_VALUE))
        new = np.zeros(batch.num_rows, dtype=bool)
        new[0] = True
        for key in keys:
            new[1:] |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        ends = np.r_[starts[1:], batch.num_rows]
        # only the batch's first group can go on from the batch before; those between are whole
        for k in sorted({0, len(starts) - 1}):
            at, end = int(starts[k]), int(ends[k])
            group = tuple(key[at].as_py() for key in keys)
            own = pc.sum(values[at:end]).as_py()  # None if no value is known
            if self.found and self.found[-1][0] == group:
                known = [x for x in (self.found[-1][1], own) if x is not None]
                self.found[-1][1] = sum(known[1:], known[0]) if known else None
            else:
                self.found = self.found[:1] + [[group, own]]

    def rows(self):
        def row(group, total):
            return one_row(self.schema, {**{c: pa.scalar(v) for c, v in zip(self.group_cols, group)},
                                         _VALUE: pa.scalar(total)})
        ends = [row(*x) for x in self.found]
        yield BEFORE, ends[-1]
        yield AFTER, ends[0]


def running_sum_by_group(df: DataFrame, group_cols: list[str], value_col: str, tie_col: str,
                         cum_col: str, total_col: str) -> DataFrame:
    """Add ``cum_col``, the inclusive running sum of ``value_col`` within
    ``group_cols`` from the largest value down (ties by ascending ``tie_col``),
    and ``total_col``, the group's sum.  Group keys must be non-NULL."""
    kind = _sum_type(df.schema[value_col].dataType)
    keyed = df.withColumn(_VALUE, F.col(value_col).cast(kind))
    order = [*[F.col(g) for g in group_cols], F.col(value_col).desc(), F.col(tie_col).asc()]
    rows = in_slices(keyed, order, partial(_EndGroups, list(group_cols)))
    # the groups of earlier slices come first, those of later ones after the slice's own rows
    inside = Window.partitionBy(SLICE, *group_cols)
    upto = (inside.orderBy(KIND, F.col(value_col).desc(), F.col(tie_col).asc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = inside.orderBy(KIND, F.col(value_col).desc(), F.col(tie_col).asc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    own = (F.col(KIND) == AFTER) & (F.col(SOURCE) == F.col(SLICE))
    return (rows.where(~own)  # a slice's message to itself
            .select("*", F.coalesce(F.sum(_VALUE).over(upto), F.lit(0)).cast(kind).alias(cum_col),
                    F.sum(_VALUE).over(whole).cast(kind).alias(total_col))
            .where(F.col(KIND) == ROW).select(*df.columns, cum_col, total_col))
