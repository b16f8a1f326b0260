"""Reproducible shuffle into shards by a Feistel permutation (op 2).

Every row gets a global row number, the permutation maps the number to a
position, and ``position % shards`` / ``position // shards`` are its shard and
slot.  Shard sizes are therefore at most one apart, slots have no gaps, and
the place of any row can be computed from its row number, the row count and
the seed alone (``permuted``).

Row numbers do not need a global sort: rows are hashed into a fixed number of
buckets, bucket counts give each bucket's first number (a table of at most
``buckets`` rows), and rows are numbered inside their bucket.  Documents that
repeat in all that the result shows are counted first and numbered as one, so
that one document in any number of copies is no hot bucket; ``assign_shards``,
which carries whole rows, numbers equal rows in one bucket.

Defined results: null ids and null texts are values like any other; repeated
rows each get a position of their own; texts of any length are hashed whole; an
empty table gives an empty result; ``assign_shards`` carries all other columns
along, whatever their names (only ``shard`` and ``slot`` are replaced), and
``shard_documents`` ignores them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096  # a bucket is sorted by one task: give more of them to tables above some TB
ROUNDS = 4
SEED = 20_17
WALK_STEPS = 16


def _numbered(df: DataFrame, keys: Sequence[str], buckets: int, weight: str | None = None) -> DataFrame:
    """``row`` (the caller's columns, kept apart from the names here), ``number``
    and ``total``."""
    size = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    keyed = df.select(F.struct(*df.columns).alias("row"),
                      F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket"), size.alias("size"))
    counts = keyed.groupBy("bucket").agg(F.sum("size").alias("n"))
    # at most `buckets` rows, so one task and a broadcast are bounded
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "bucket",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.sum("n").over(whole).alias("total"))
    inside = (Window.partitionBy("bucket").orderBy(*[F.col("row")[k] for k in keys])
              .rowsBetween(Window.unboundedPreceding, -1))
    return (keyed.withColumn("at", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(F.broadcast(starts), "bucket")
            .select("row", "total", (F.col("first") + F.col("at")).cast("long").alias("number")))


def row_numbers(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, number: str = "row_number",
                total: str = "row_total") -> DataFrame:
    """Dense numbers 0..N-1 in an order fixed by the values of ``keys``; rows
    that agree in all keys are numbered in any order.  ``total`` is N."""
    return _numbered(df, keys, buckets).select(
        "row.*", F.col("total").alias(total), F.col("number").alias(number))


def _root(n: Column) -> Column:
    """The smallest whole a with a * a >= n."""
    near = F.floor(F.sqrt(n.cast("double"))).cast("long")
    return (F.when((near - 1) * (near - 1) >= n, near - 1).when(near * near >= n, near)
            .when((near + 1) * (near + 1) >= n, near + 1).otherwise(near + 2))


def _feistel(x: Column, a: Column, seed: int, rounds: int) -> Column:
    """One pass over the a x a grid: a balanced Feistel network whose halves
    are added modulo a, so that it permutes 0..a*a-1 for every a."""
    left, right = F.floor(x / a).cast("long"), x % a
    for k in range(rounds):
        mixed = F.pmod(F.xxhash64(right, F.lit(seed), F.lit(k)), a)
        left, right = right, (left + mixed) % a
    return left * a + right


def _onward(x: Column, total: Column, a: Column, steps: Column, seed: int, rounds: int) -> Column:
    """Up to ``steps`` passes over the grid, until the cell is one of a row."""
    return F.aggregate(F.sequence(F.lit(1).cast("long"), steps), x,
                       lambda at, _: F.when(at < total, at).otherwise(_feistel(at, a, seed, rounds)))


def _walk(once: Column, total: Column, a: Column, seed: int, rounds: int) -> Column:
    return F.when(once < total, once).otherwise(_onward(once, total, a, F.lit(WALK_STEPS).cast("long"), seed, rounds))


def _walk_out(walked: Column, total: Column, a: Column, seed: int, rounds: int) -> Column:
    return F.when(walked < total, walked).otherwise(
        _onward(walked, total, a, F.greatest(a * a - total, F.lit(1)).cast("long"), seed, rounds))


def permuted(number: Column, total: Column, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """The position of row ``number`` under the permutation of 0..total-1.

    The grid has at most 2 * sqrt(total) + 1 cells beyond ``total``; a row that
    lands there walks on along its cycle.  The cycle holds the row's own number,
    so the walk ends after at most as many steps as there are such cells.
    """
    a = _root(total)
    return _walk_out(_walk(_feistel(number, a, seed, rounds), total, a, seed, rounds), total, a, seed, rounds)


def _placed(numbered: DataFrame, shards: int, seed: int, rounds: int = ROUNDS) -> DataFrame:
    """Rows with ``number`` and ``total``, and ``permuted`` cut into ``shard`` and
    ``slot``.  Each step is a column of its own: an expression is a tree, with a
    copy of all below it wherever it is used, and the whole walk as one makes a
    plan that takes much of the driver's memory."""
    a, at, total = F.col("_grid"), F.col("_at"), F.col("total")
    return (numbered.withColumn("_grid", _root(total))
            .withColumn("_at", _feistel(F.col("number"), a, seed, rounds))
            .withColumn("_at", _walk(at, total, a, seed, rounds))
            .withColumn("_at", _walk_out(at, total, a, seed, rounds))
            .withColumn("shard", (at % shards).cast("int"))
            .withColumn("slot", F.floor(at / shards).cast("long")))


def assign_shards(df: DataFrame, keys: Sequence[str], shards: int, seed: int = SEED,
                  buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``shard`` (0..shards-1) and ``slot`` (gapless from 0)."""
    own = df.select([c for c in df.columns if c not in ("shard", "slot")])
    return _placed(_numbered(own, keys, buckets), shards, seed).select("row.*", "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard per document.

    Only ids, sizes and hashes are shuffled, not the texts.  ``law`` is
    ``rows``; ``grown_shard`` is null, as it belongs to the law ``key``.
    """
    octets = F.encode("text", "UTF-8")
    thin = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(octets).cast("long").alias("text_crc32"),
        F.xxhash64("text").alias("text_key"))
    counted = thin.groupBy(*thin.columns).agg(F.count(F.lit(1)).alias("copies"))
    numbered = _numbered(counted, ["doc_id", "text_key", "size", "text_crc32"], BUCKETS, "copies")
    each = numbered.select("row.*", "total", F.explode(F.sequence(
        F.col("number"), F.col("number") + F.col("row.copies") - 1)).alias("number"))
    return _placed(each, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
