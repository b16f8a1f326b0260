"""Post-processing and scoring of forecasts.

``hit_rate``: share of rows whose absolute percentage error is at most 0.15;
``total_error``: ``|sum(actual) - sum(pred)| / sum(actual)``.  Both divide by
the signed actual (Q22).  An undefined error (actual 0) counts as a miss by
default; ``undefined="pad"`` takes the previous defined error in the given row
order, as the reference's replace does (Q4), by the whole-table forward fill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from skuflow.functions.numeric import clip_at_zero, pdiv
from skuflow.operators.features import as_list, fill_missing_global
from skuflow.operators.forecast import PRED, SPLIT

# Fixed value of the reference's accuracy score.
HIT_THRESHOLD = 0.15


def clip_predictions(df: DataFrame, pred: str = PRED) -> DataFrame:
    """F16 default: a negative prediction becomes 0."""
    return df.withColumn(pred, clip_at_zero(pred))


def zero_negative_rows(df: DataFrame, pred: str = PRED, keep=(SPLIT,)) -> DataFrame:
    """F16 parity (Q3): where the prediction is negative every column becomes 0.

    Columns in ``keep`` are left alone: the ``split`` label is ours (the
    reference zeroes its train and test frames separately)."""
    neg = F.col(pred) < 0
    cols = []
    for f in df.schema.fields:
        if f.name in keep:
            cols.append(F.col(f.name))
            continue
        zero = F.lit("0") if isinstance(f.dataType, StringType) else F.lit(0).cast(f.dataType)
        cols.append(F.when(neg, zero).otherwise(F.col(f.name)).alias(f.name))
    return df.select(*cols)


def absolute_percentage_error(actual: str, pred: str = PRED, abs_denominator: bool = False):
    """``abs(actual - pred) / actual``; +-inf for actual 0, NULL for 0/0.

    The signed actual is the reference's rule: a negative one makes the error
    negative, which counts as a hit.  ``abs_denominator`` divides by its size."""
    a = F.col(actual).cast("double")
    return pdiv(F.abs(a - F.col(pred).cast("double")), F.abs(a) if abs_denominator else a)


def with_errors(df: DataFrame, actual: str, pred: str = PRED, undefined: str = "miss",
                order_cols=None, abs_denominator: bool = False) -> DataFrame:
    """Add ``_ape``: defined errors, undefined ones NULL, or padded."""
    err = absolute_percentage_error(actual, pred, abs_denominator)
    defined = F.when(F.abs(err) != F.lit(float("inf")), err)
    out = df.withColumn("_ape", defined)
    if undefined == "miss":
        return out
    if undefined != "pad":
        raise ValueError("undefined must be 'miss' or 'pad'")
    if not order_cols:
        raise ValueError("undefined='pad' needs order_cols (row order of each split)")
    # The reference pads train and test frames separately.  One forward fill
    # over (split, order) of the pair (split, error) does the same: a value
    # carried over from another split means this split had no defined error
    # yet, so it is dropped again.
    tagged = out.withColumn("_ape", F.when(F.col("_ape").isNotNull(),
                                           F.struct(F.col(SPLIT).alias("s"), F.col("_ape").alias("e"))))
    padded = fill_missing_global(tagged, [SPLIT, *as_list(order_cols)], ["_ape"], backward=False)
    return padded.withColumn("_ape", F.when(F.col("_ape.s") == F.col(SPLIT), F.col("_ape.e")))


def hit_rate(df: DataFrame, actual: str, pred: str = PRED, undefined: str = "miss",
             order_cols=None, abs_denominator: bool = False) -> DataFrame:
    """A14 per split: ``split, hit_rate``."""
    scored = with_errors(df, actual, pred, undefined, order_cols, abs_denominator)
    hit = F.when(F.col("_ape") <= F.lit(HIT_THRESHOLD), 1.0).otherwise(0.0)
    return scored.groupBy(SPLIT).agg(F.avg(hit).alias("hit_rate"))


def total_error(df: DataFrame, actual: str, pred: str = PRED) -> DataFrame:
    """A15 per split: ``split, total_error``; NULL where an actual or a
    prediction is missing, since a sum over a part of the rows would mislead
    (the reference's plain sums are missing then, too)."""
    a, y = F.col(actual).cast("double"), F.col(pred).cast("double")
    whole = F.count_if(a.isNull() | y.isNull()) == 0
    error = pdiv(F.abs(F.sum(a) - F.sum(y)), F.sum(a))
    return df.groupBy(SPLIT).agg(F.when(whole, error).alias("total_error"))


def score(df: DataFrame, actual: str, pred: str = PRED, undefined: str = "miss",
          order_cols=None) -> DataFrame:
    """M6: ``split, hit_rate, total_error`` after clipping negative predictions."""
    clipped = clip_predictions(df, pred)
    return hit_rate(clipped, actual, pred, undefined, order_cols).join(
        total_error(clipped, actual, pred), SPLIT)


def write_and_score(predictions: DataFrame, actual: str, path: str, pred: str = PRED, splits=("train", "test")) -> DataFrame:
    """M6 while the clipped predictions are written (S6): the metrics are observed
    on the rows that pass to the writer, so nothing is read twice.  The driver
    gets four numbers a split."""
    clipped = clip_predictions(predictions, pred)
    a, y = F.col(actual).cast("double"), F.col(pred).cast("double")
    err = absolute_percentage_error(actual, pred)
    hit = F.when((F.abs(err) != F.lit(float("inf"))) & (err <= F.lit(HIT_THRESHOLD)), 1.0).otherwise(0.0)
    observed = []
    for i, split in enumerate(splits):
        own = F.col(SPLIT) == split
        observed += [F.avg(F.when(own, hit)).alias(f"hit_{i}"), F.sum(F.when(own, a)).alias(f"actual_{i}"),
                     F.sum(F.when(own, y)).alias(f"pred_{i}"), F.count_if(own).alias(f"rows_{i}"),
                     F.count_if(own & (a.isNull() | y.isNull())).alias(f"missing_{i}")]
    seen = Observation()
    clipped.observe(seen, *observed).write.mode("overwrite").parquet(path)
    found = seen.get
    rows = [(split, found[f"hit_{i}"], found[f"actual_{i}"], found[f"pred_{i}"], found[f"missing_{i}"])
            for i, split in enumerate(splits) if found[f"rows_{i}"]]
    sums = predictions.sparkSession.createDataFrame(rows, "split string, hit_rate double, a double, y double, missing long")
    error = pdiv(F.abs(F.col("a") - F.col("y")), F.col("a"))
    return sums.select(SPLIT, "hit_rate", F.when(F.col("missing") == 0, error).alias("total_error"))
