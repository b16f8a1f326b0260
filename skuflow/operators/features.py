"""Forecast inputs: feature joins, feature selection and gap filling
(J8, J9, S2 hand-over, P9, W8, W9).

Gap filling has two forms:

* ``fill_missing`` (default): forward then backward fill per batch in time
  order, features only.  A batch holds one row per period, so a window
  partition is bounded by the calendar.
* ``fill_missing_global``: the reference's whole-table fill in one row order
  (Q5: it crosses batch borders and reaches the target), over slices of that
  order (``ordered.in_slices``): the input is read once, and no task holds more
  than a slice and one row for each other slice.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.operators.ordered import (AFTER, BEFORE, KIND, ROW, SLICE, SOURCE, Summary, in_slices,
                                       one_row)


def as_list(keys) -> list[str]:
    """Q15: a single key may be given as a string."""
    return [keys] if isinstance(keys, str) else list(keys)


def _check_clash(left: DataFrame, right: DataFrame, keys: list[str]) -> None:
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"feature columns already present: {sorted(clash)} (Q21)")


def join_time_features(target: DataFrame, features: list[DataFrame], keys_time) -> DataFrame:
    """Left join each time feature table on the time keys, in list order.

    A time feature has one row per period, so adaptive execution broadcasts it
    from its measured size.
    """
    keys = as_list(keys_time)

    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        _check_clash(left, right, keys)
        return left.join(right, keys, "left")
    return reduce(step, features, target)


def join_category_features(target: DataFrame, features: list[DataFrame], keys_group, keys_time) -> DataFrame:
    """Left join each category feature table on group + time keys.

    Build the features as one wide table (``discount_features``) and pass it
    as a single element: one join instead of nineteen.
    """
    keys = as_list(keys_group) + as_list(keys_time)

    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        _check_clash(left, right, keys)
        return left.join(right, keys, "left")
    return reduce(step, features, target)


def feature_columns(all_columns: list[str], keys_time, keys_batch, target_column: str,
                    feature_columns: list[str] | None = None,
                    feature_rm_columns: list[str] | None = None) -> list[str]:
    """The explicit list if non-empty, else every column except time keys,
    batch keys, the target and ``feature_rm_columns`` (input order kept)."""
    if feature_columns:
        return list(feature_columns)
    removed = set(as_list(keys_time)) | set(as_list(keys_batch)) | {target_column}
    removed |= set(feature_rm_columns or [])
    return [c for c in all_columns if c not in removed]


def _fill_sql(column: str, partition: list[str], order: list[str], backward: bool = True) -> str:
    """Forward (then backward) fill of one column as a SQL window expression."""
    over = (f"PARTITION BY {', '.join(partition)} " if partition else "") + f"ORDER BY {', '.join(order)}"
    out = (f"last({column}) IGNORE NULLS OVER ({over} "
           f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    if backward:
        out = (f"coalesce({out}, first({column}) IGNORE NULLS OVER ({over} "
               f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")
    return out


def fill_missing(df: DataFrame, order_cols, partition_cols, columns: list[str]) -> DataFrame:
    """W8+W9 per batch: forward fill, then backward fill what is still missing."""
    part, order = as_list(partition_cols), as_list(order_cols)
    wanted = set(columns)
    return df.selectExpr(*[f"{_fill_sql(c, part, order)} AS {c}" if c in wanted else c
                           for c in df.columns])


class _Ends(Summary):
    """First and last non-missing value of each column in a slice."""

    def __init__(self, columns: list[str], backward: bool):
        self.columns, self.backward = columns, backward
        self.first: dict[str, pa.Scalar] = {}
        self.last: dict[str, pa.Scalar] = {}
        self.schema: pa.Schema | None = None

    def add(self, batch: pa.RecordBatch) -> None:
        self.schema = batch.schema
        for c in self.columns:
            column = batch.column(batch.schema.get_field_index(c))
            known = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            if len(known):
                self.first.setdefault(c, column[int(known[0])])
                self.last[c] = column[int(known[-1])]

    def rows(self):
        if self.last:
            yield BEFORE, one_row(self.schema, self.last)
            if self.backward:
                yield AFTER, one_row(self.schema, self.first)


def fill_missing_global(df: DataFrame, order_cols, columns: list[str], backward: bool = True) -> DataFrame:
    """W8+W9 over the whole table in one total row order, by any number of tasks.

    Order keys may be of any type.  Rows that agree in all of them follow a hash
    of the row.  Each slice of the order is told the last known values of the
    slices before it.  A row that is still empty stands before the first known
    value of the whole table and takes that one, from the slices after it.
    ``backward=False`` gives the forward fill alone (pad)."""
    order = [F.col(c) for c in as_list(order_cols)]
    tie = "_os_tie"
    keyed = df.withColumn(tie, F.xxhash64(*df.columns))
    rows = in_slices(keyed, [*order, F.col(tie)], partial(_Ends, list(columns), backward))
    ahead = (f"PARTITION BY {SLICE} ORDER BY {KIND} % {AFTER}, {KIND}, {SOURCE}, "
             f"{', '.join(as_list(order_cols))}, {tie} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")

    def filled(c: str) -> str:
        own = f"last(CASE WHEN {KIND} < {AFTER} THEN {c} END) IGNORE NULLS OVER ({ahead})"
        if backward:
            own = f"coalesce({own}, first(CASE WHEN {KIND} = {AFTER} THEN {c} END) IGNORE NULLS OVER ({ahead}))"
        return f"{own} AS {c}"
    wanted = set(columns)
    return (rows.selectExpr(KIND, *[filled(c) if c in wanted else c for c in df.columns])
            .where(F.col(KIND) == ROW).drop(KIND))
