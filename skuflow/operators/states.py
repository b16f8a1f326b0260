"""Models fitted in parts: one state per batch, merged in a tree.

A mergeable model turns any piece of a batch's rows into a state of bounded size
and two states into one.  Pieces are fitted where their rows are (before any
shuffle), states are merged in two rounds, (batch, piece) and batch, so that a
batch holding a third of all rows is no hot key and no task holds a batch.
Predictions stream a batch's rows past its state, large batches in several pieces.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from itertools import groupby
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StringType, StructField, StructType

PIECES = 64            # pieces of a batch in the first round of merges
HELD = 512             # states that a task holds before it passes them on
ROWS_A_PIECE = 200_000 # rows of a batch that one task predicts
X, Y, STATE, PIECE = "_st_x", "_st_y", "_st_state", "_st_piece"
FITTED, NO_TARGET, NOT_SOLVED = "fitted", "no usable train row", "not solved"


class Mergeable(Protocol):
    """A user model that is fitted in parts.  States must pickle and stay small."""

    def partial_fit(self, state: Any, x: np.ndarray, y: np.ndarray) -> Any:
        """The state (None at first) after more rows."""

    def merge(self, a: Any, b: Any) -> Any:
        """One state for the rows of both."""

    def predict(self, state: Any, x: np.ndarray) -> np.ndarray:
        """One prediction a row."""


def is_mergeable(model: Any) -> bool:
    return all(callable(getattr(model, m, None)) for m in ("partial_fit", "merge", "predict"))


class LeastSquares:
    """Least squares (``alpha == 0``: minimum norm on standardised features) or
    ridge with a free intercept.

    The state is an orthogonal summary: the R factor of the rows [1, x, y].  Two
    factors merge by factoring one above the other.  Unlike sums of products it
    does not square the condition number, so nearly collinear features keep
    their digits."""

    def __init__(self, alpha: float = 0.0):
        self.alpha = alpha

    def partial_fit(self, state, x, y):
        rows = np.column_stack([np.ones(len(x)), x, y])
        return self._compressed(rows if state is None else np.vstack([state, rows]))

    def merge(self, a, b):
        return self._compressed(np.vstack([a, b]))

    @staticmethod
    def _compressed(rows):
        return np.linalg.qr(rows, mode="r") if len(rows) > 4 * rows.shape[1] else rows

    def solve(self, state) -> tuple[float, np.ndarray]:
        """Intercept and slopes."""
        r = np.linalg.qr(state, mode="r")
        k = r.shape[1] - 2
        if len(r) < k + 2:
            r = np.vstack([r, np.zeros((k + 2 - len(r), k + 2))])
        whole = np.sqrt((r[:, 1:-1] ** 2).sum(axis=0))
        own, target = r[1:, 1:-1], r[1:, -1]  # the mean is taken out by the first column
        scale = np.sqrt((own ** 2).sum(axis=0))
        constant = scale <= 1e-13 * whole
        own = np.where(constant, 0.0, own)
        if self.alpha > 0:
            a = np.vstack([own, np.sqrt(self.alpha) * np.eye(k)])
            beta, *_ = np.linalg.lstsq(a, np.r_[target, np.zeros(k)], rcond=None)
        else:
            scale = np.where(constant, 1.0, scale)
            z, *_ = np.linalg.lstsq(own / scale, target, rcond=1e-12)
            beta = z / scale
        return float((r[0, -1] - r[0, 1:-1] @ beta) / r[0, 0]), beta

    def predict(self, state, x):
        b0, beta = self.solve(state)
        return b0 + x @ beta


def _rows_of(batch: pa.RecordBatch, name: str, k: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _keys_of(batch: pa.RecordBatch, n: int) -> list[tuple]:
    return list(zip(*[batch.column(i).to_pylist() for i in range(n)]))


def fit_states(train: DataFrame, keys: list[str], x: list[Column], y: Column, model: Mergeable) -> DataFrame:
    """``keys`` and the model's state per batch.  ``x`` and ``y`` are finite
    doubles; rows where one is NULL are left out."""
    n, k = len(keys), len(x)
    rows = (train.select(*keys, F.array(*x).alias(X), y.alias(Y))
            .where(F.col(Y).isNotNull() & ~F.exists(X, lambda v: v.isNull())))
    key_fields = [f for f in rows.schema.fields if f.name in keys]
    schema = StructType([*key_fields, StructField(PIECE, IntegerType()), StructField(STATE, BinaryType())])

    def written(states: dict, types: list[pa.DataType], piece: int) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*states), types)]
        blobs = pa.array([pickle.dumps(s) for s in states.values()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([piece] * len(states), pa.int32()), blobs], schema.names)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        piece = TaskContext.get().partitionId() % PIECES
        states: dict[tuple, Any] = {}
        types: list[pa.DataType] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            types = [f.type for f in batch.schema][:n]
            code: dict[tuple, int] = {}
            codes = np.array([code.setdefault(key, len(code)) for key in _keys_of(batch, n)])
            xs, ys = _rows_of(batch, X, k), batch.column(n + 1).to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            ends = np.searchsorted(codes[order], np.arange(len(code) + 1))
            for key, c in code.items():
                at = order[ends[c]:ends[c + 1]]
                states[key] = model.partial_fit(states.get(key), xs[at], ys[at])
            if len(states) >= HELD:
                yield written(states, types, piece)
                states = {}
        if states:
            yield written(states, types, piece)

    def merge(by: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            types: list[pa.DataType] = []

            def rows():
                for batch in batches:
                    types[:] = [f.type for f in batch.schema][:n]
                    yield from zip(*[c.to_pylist() for c in batch.columns])
            for key, same in groupby(rows(), key=lambda r: r[:by]):
                state = None
                for *_, blob in same:
                    part = pickle.loads(blob)
                    state = part if state is None else model.merge(state, part)
                yield written({key[:n]: state}, types, key[n] if by > n else 0)
        return run

    states = rows.mapInArrow(fit, schema)
    for by in ([*keys, PIECE], keys):
        states = states.repartition(*by).sortWithinPartitions(*by).mapInArrow(merge(len(by)), schema)
    return states.drop(PIECE)


def map_states(states: DataFrame, keys: list[str], fields: list[StructField],
               result: Callable[[Any], tuple]) -> DataFrame:
    """``keys`` and what ``result(state)`` gives, a row per batch."""
    n = len(keys)
    key_fields = [f for f in states.schema.fields if f.name in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [result(pickle.loads(blob)) for blob in batch.column(n).to_pylist()]
            columns = zip(*found) if found else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *[pa.array(list(c)) for c in columns]],
                                             [*keys, *[f.name for f in fields]])
    return states.select(*keys, STATE).mapInArrow(run, StructType([*key_fields, *fields]))


def predict_states(rows: DataFrame, keys: list[str], x: list[Column], states: DataFrame, model: Mergeable,
                   pred: str, status: str) -> DataFrame:
    """``rows`` with the prediction of their batch's state, and its status.  Rows
    with a NULL in ``x``, or in a batch without a state, have none."""
    n, k, names = len(keys), len(x), rows.columns
    kind = "_st_kind"
    sizes = rows.groupBy(*keys).agg((F.count(F.lit(1)) / ROWS_A_PIECE).cast("int").alias("_st_more"))
    placed = rows.join(sizes, keys, "left").withColumn(
        PIECE, F.pmod(F.xxhash64(*names), F.coalesce("_st_more", F.lit(0)) + 1).cast("int"))
    own = placed.select(*keys, PIECE, F.lit(1).alias(kind), F.lit(None).cast("binary").alias(STATE),
                        F.array(*x).alias(X), F.struct(*names).alias("_st_row"))
    heads = states.join(sizes, keys).select(
        *keys, F.explode(F.sequence(F.lit(0), F.col("_st_more"))).alias(PIECE), F.lit(0).alias(kind), STATE,
        F.lit(None).cast(own.schema[X].dataType).alias(X), F.lit(None).cast(own.schema["_st_row"].dataType).alias("_st_row"))
    schema = StructType([own.schema["_st_row"], StructField(pred, DoubleType()), StructField(status, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            groups = _keys_of(batch, n + 1)
            kinds = batch.column(n + 1).to_pylist()
            at = 0
            while at < len(groups):
                if groups[at] != now:
                    now, state = groups[at], None
                if kinds[at] == 0:
                    state = pickle.loads(batch.column(n + 2)[at].as_py())
                    at += 1
                    continue
                end = at
                while end < len(groups) and groups[end] == now and kinds[end] == 1:
                    end += 1
                part = batch.slice(at, end - at)
                found = np.full(end - at, np.nan)
                if state is not None:
                    values = np.array([[np.nan if v is None else v for v in r] for r in part.column(n + 3).to_pylist()],
                                      dtype=float).reshape(-1, k)
                    whole = np.isfinite(values).all(axis=1)
                    if whole.any():
                        found[whole] = model.predict(state, values[whole])
                known = np.isfinite(found)
                yield pa.RecordBatch.from_arrays(
                    [part.column(n + 4), pa.array(found, mask=~known),
                     pa.array([NO_TARGET if state is None else FITTED] * len(found), pa.string())], schema.names)
                at = end

    return (heads.unionByName(own).repartition(*keys, PIECE).sortWithinPartitions(*keys, PIECE, kind)
            .mapInArrow(run, schema).select("_st_row.*", pred, status))
