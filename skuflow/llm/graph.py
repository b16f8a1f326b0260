"""Connected components: of an edge table by alternating star contraction, and
of one task's rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.session import materialize


def _pointed_at_least(edges: DataFrame) -> DataFrame:
    """u, v and the least of u and u's neighbours.  The minimum is combined
    before its shuffle; the join back is one that AQE splits at hot nodes."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of
    ``edges`` (u, v; any direction, repeats and loops allowed).

    Each round writes its edges to the shared folder, so that a lost executor
    costs one round.  Rounds stop when a round leaves the edge set as it was;
    their number grows with the logarithm of the longest path.
    """
    now = materialize(
        edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges")

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = mark(now)
    while seen[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pointed_at_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        small = _pointed_at_least(large)
        now = materialize(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(small.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "edges")
        after = mark(now)
        if after == seen:
            break
        seen = after
    stars = now.groupBy("u").agg(F.min("v").alias("c"))
    return (stars.select(F.col("u").alias("node"), F.col("c").alias("component"))
            .unionAll(stars.select(F.col("c").alias("node"), F.col("c").alias("component")).distinct()))


def linked_rows(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest row reachable, for rows 0..n-1 and links a-b."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            break
    return label
