"""Gradient-boosted trees, one model per batch, all batches together (M3).

Every feature is cut into bins of equal width between its least and greatest
train value in the batch.  A tree grows level by level: sums of residuals by
(batch, node, feature, bin) combine map-side, a window over a feature's bins
gives every split's gain, and the best split of each node is written to a small
table.  A level of all batches' trees is one job, and no task holds a batch.
Rows are written once a tree, in the shared folder.

Missing and infinite features count as 0, rows without a target are not fitted
and a batch without any has no predictions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.operators.features import as_list
from skuflow.session import materialize

BINS, TREES, DEPTH, RATE, LEAST = 32, 10, 2, 0.3, 2
ROWS, BIN, NODE, SCORE, LABEL, USED = "_gb_row", "_gb_bins", "_gb_node", "_gb_score", "_gb_y", "_gb_used"


def _binned(rows: DataFrame, keys: list[str], x: list[Column], y: Column, used: Column, bins: int) -> DataFrame:
    """Keys, the row, its bins, target and first score (the train mean)."""
    made = rows.select(*keys, F.struct(*rows.columns).alias(ROWS), F.array(*x).alias("_gb_x"), y.alias(LABEL),
                       used.alias(USED)).withColumn(USED, F.col(USED) & F.col(LABEL).isNotNull())
    at = range(len(x))
    own = [F.when(F.col(USED), F.col("_gb_x")[i]) for i in at]
    ends = made.groupBy(*keys).agg(F.array(*[F.min(v) for v in own]).alias("_gb_low"),
                                   F.array(*[F.max(v) for v in own]).alias("_gb_high"),
                                   F.avg(F.when(F.col(USED), F.col(LABEL))).alias(SCORE))
    cut = F.transform(F.arrays_zip("_gb_x", "_gb_low", "_gb_high"), lambda z: F.when(
        z["_gb_high"] > z["_gb_low"],
        F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(
            (z["_gb_x"] - z["_gb_low"]) / (z["_gb_high"] - z["_gb_low"]) * bins).cast("int")))).otherwise(F.lit(0)))
    return made.join(ends, keys, "left").select(*keys, ROWS, LABEL, USED, SCORE, cut.alias(BIN))


def _next_nodes(rows: DataFrame, keys: list[str], splits: list[DataFrame]) -> DataFrame:
    """Rows at their nodes after the tree's splits so far."""
    rows = rows.withColumn(NODE, F.lit(1))
    for split in splits:
        own = F.col("_gb_splits")[F.col(NODE)]
        right = (F.col(BIN)[own["feature"]] > own["bin"]).cast("int")
        rows = rows.join(split, keys, "left").withColumn(
            NODE, F.when(own.isNull(), F.col(NODE)).otherwise(F.col(NODE) * 2 + right)).drop("_gb_splits")
    return rows


def _best_splits(rows: DataFrame, keys: list[str], level: int, least: int) -> DataFrame:
    """Keys and a map of node -> (feature, bin), for the nodes of this level that
    a split improves.  Equal gains go to the first feature and bin."""
    residual = F.col(LABEL) - F.col(SCORE)
    sums = (rows.where(F.col(USED) & (F.col(NODE) >= 2 ** level))
            .select(*keys, NODE, residual.alias("r"), F.posexplode(BIN).alias("feature", "bin"))
            .groupBy(*keys, NODE, "feature", "bin").agg(F.sum("r").alias("g"), F.count(F.lit(1)).alias("n"),
                                                        F.sum(F.col("r") * F.col("r")).alias("q")))
    feature = Window.partitionBy(*keys, NODE, "feature")  # one row a bin
    upto = feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = sums.select(*keys, NODE, "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("n").over(upto).alias("nl"),
                      F.sum("g").over(feature).alias("gt"), F.sum("n").over(feature).alias("nt"), F.sum("q").over(feature).alias("q"))
    right, left = F.col("nt") - F.col("nl"), F.col("nl")
    gain = (F.col("gl") ** 2 / left + (F.col("gt") - F.col("gl")) ** 2 / right - F.col("gt") ** 2 / F.col("nt")) / F.col("q")
    return (cut.where((left >= least) & (right >= least) & (F.col("q") > 0))
            .withColumn("gain", F.round(gain, 9)).where("gain > 0")  # rounded: sums have no fixed order
            .groupBy(*keys, NODE).agg(F.max_by(F.struct("feature", "bin"), F.struct(
                "gain", -F.col("feature"), -F.col("bin"))).alias("split"))
            .groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(NODE, "split"))).alias("_gb_splits")))


def boosted_trees(rows: DataFrame, keys_batch, x: list[Column], y: Column, used: Column, pred: str,
                  trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS,
                  least: int = LEAST) -> DataFrame:
    """``rows`` with the prediction of their batch's model, fitted on the rows
    where ``used`` holds.  Fitting runs at once.  ``x`` and ``y`` are doubles,
    ``x`` without NULLs."""
    keys = as_list(keys_batch)
    now = materialize(_binned(rows, keys, x, y, used, bins), "boosted")
    for _ in range(trees):
        splits: list[DataFrame] = []
        for level in range(depth):
            splits.append(materialize(_best_splits(_next_nodes(now, keys, splits), keys, level, least), "splits"))
        at = _next_nodes(now, keys, splits)
        value = F.avg(F.when(F.col(USED), F.col(LABEL) - F.col(SCORE))) * rate
        leaves = at.groupBy(*keys, NODE).agg(value.alias("_gb_value"))
        now = materialize(at.join(leaves, [*keys, NODE], "left")
                          .withColumn(SCORE, F.col(SCORE) + F.coalesce("_gb_value", F.lit(0.0)))
                          .select(*now.columns), "boosted")
    return now.select(f"{ROWS}.*", F.col(SCORE).alias(pred))
