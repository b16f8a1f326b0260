"""Rolling-origin evaluation (D1): one fit per batch and origin, scored on the
next periods.

Each period of a batch is summarised once, before any shuffle, by a mergeable
state; states are cumulated over a batch's periods, and an origin's model is the
state of all periods up to it.  Six origins cost one pass over the rows and one
solve each.  A batch has one state per period, so a task holds at most the
calendar.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from skuflow.operators import metrics, states
from skuflow.operators.features import as_list
from skuflow.operators.forecast import PRED, SPLIT, STATUS, _feature_value

ORIGIN, PERIOD = "origin", "_ro_period"


def origin_states(rows: DataFrame, keys: list[str], period: Column, x: list[Column], y: Column,
                  origins: list[int], model: states.Mergeable) -> DataFrame:
    """``keys``, ``origin`` and the state of the periods up to it; none where a
    batch has no usable row by then."""
    at = sorted(set(origins))
    n = len(keys)
    by_period = states.fit_states(rows.withColumn(PERIOD, period.cast("long")).where(F.col(PERIOD) <= at[-1]),
                                  [*keys, PERIOD], x, y, model)
    key_fields = [f for f in by_period.schema.fields if f.name in keys]
    schema = StructType([*key_fields, StructField(ORIGIN, LongType()), StructField(states.STATE, BinaryType())])

    def cumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch_keys, same, types in _batches(batches, n):
            found, state, left = [], None, list(at)
            for *_, now, blob in same:
                while left and left[0] < now:
                    found.append((left.pop(0), state))
                part = pickle.loads(blob)
                state = part if state is None else model.merge(state, part)
            found = [(o, pickle.dumps(s)) for o, s in [*found, *[(o, state) for o in left]] if s is not None]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([v] * len(found), t) for v, t in zip(batch_keys, types)],
                 pa.array([o for o, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())], schema.names)

    return (by_period.select(*keys, PERIOD, states.STATE).repartition(*keys)
            .sortWithinPartitions(*keys, PERIOD).mapInArrow(cumulate, schema))


def _batches(batches: Iterator[pa.RecordBatch], n: int):
    types: list[pa.DataType] = []

    def rows():
        for batch in batches:
            types[:] = [f.type for f in batch.schema][:n]
            yield from zip(*[c.to_pylist() for c in batch.columns])
    for key, same in groupby(rows(), key=lambda r: r[:n]):
        yield key, same, types


def rolling_forecast(rows: DataFrame, keys_batch, period: Column, features: list[str], target: str,
                     origins: list[int], span: int, model: states.Mergeable | None = None,
                     missing: str = "zero") -> DataFrame:
    """The rows of the ``span`` periods after each origin, with ``origin``, the
    prediction of the model fitted up to it, and its status.  ``period`` is a
    whole number that rises by one a period.  A batch without a usable row up to
    an origin has no rows for it (P8)."""
    keys, model = as_list(keys_batch), model or states.LeastSquares()
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    x = [_feature_value(c, missing) for c in features]
    fitted = origin_states(rows, keys, period, x, _feature_value(target, "drop"), origins, model)
    p = period.cast("long")
    ahead = F.filter(F.array(*[F.lit(o).cast("long") for o in sorted(set(origins))]),
                     lambda o: (p > o) & (p <= o + span))
    tested = rows.withColumn(ORIGIN, F.explode(ahead))
    eligible = tested.join(fitted.select(*keys, ORIGIN), [*keys, ORIGIN], "left_semi")
    return states.predict_states(eligible.select(*rows.columns, ORIGIN), [*keys, ORIGIN], x, fitted, model, PRED, STATUS)


def rolling_scores(predicted: DataFrame, actual: str, keys_batch) -> DataFrame:
    """M6 by origin: n_batches, n_rows, hit_rate and total_error of clipped predictions."""
    clipped = metrics.clip_predictions(predicted).withColumn(SPLIT, F.col(ORIGIN))
    counts = clipped.groupBy(SPLIT).agg(F.countDistinct(*as_list(keys_batch)).alias("n_batches"),
                                        F.count(F.lit(1)).alias("n_rows"))
    return (counts.join(metrics.hit_rate(clipped, actual), SPLIT).join(metrics.total_error(clipped, actual), SPLIT)
            .withColumnRenamed(SPLIT, ORIGIN))
