"""Mixing sources to target weights by a splitting tree (op 9).

Sources get target word counts from their weights.  Each source is cut into
blocks of documents by a hash.  A target below the source's size takes part of
it once; one above takes all of it once and part of it a second time.  These
two passes are dealt alike: the source's blocks are met in a permuted order,
taken while they fit into the pass's words, and the first that did not fit
gives single documents up to the border.  The exact number of blocks
that each source gives to a pass is then split among the output shards by a
binary tree, whose nodes draw multivariate-hypergeometric counts for their left
half.  Each shard takes its disjoint run of each source's permuted blocks and
puts their documents in a hashed order.

The driver sees one row per source (``MAX_SOURCES``), never blocks or documents.

Defined results: a null source is a source of its own, last in order; a null
or empty text has size 0, and so has its taken count; repeated rows are
documents of their own with an equal fate; targets
of sources without words are 0, and none of their documents is taken; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuflow.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
LIMIT = 2.0
BLOCKS = 1024
SHARDS = 16
SEED = 909
MAX_SOURCES = 1_000_000
MAX_BROADCAST = 500_000


def target_words(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE,
                 limit: float = LIMIT) -> list[float]:
    """Targets by weight that sum to ``share`` of all words, none above
    ``limit`` times its source's words; what is above is dealt again."""
    targets = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), set(range(len(sizes)))
    while open_:
        each = left / sum(weights[k] for k in open_)
        over = {k for k in open_ if each * weights[k] > limit * sizes[k]}
        if not over:
            for k in open_:
                targets[k] = each * weights[k]
            break
        for k in over:
            targets[k] = limit * sizes[k]
        left -= sum(targets[k] for k in over)
        open_ -= over
    return targets


def split_quotas(blocks: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """shards x sources: how many of each source's blocks each shard takes.
    Rows differ by at most the rounding of the halvings, columns sum exactly."""
    out = np.zeros((shards, len(blocks)), dtype=np.int64)

    def node(quota: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[lo] = quota
            return
        mid = (lo + hi) // 2
        draws = int(quota.sum()) * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(quota, draws, method="marginals") if len(quota) else quota
        node(left, lo, mid)
        node(quota - left, mid, hi)

    node(np.asarray(blocks, dtype=np.int64), 0, shards)
    return out


def word_count(text: Column) -> Column:
    """Number of runs free of the six ASCII white-space characters; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def deal_blocks(words: np.ndarray, quota: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For one source's blocks: taken in full, words to take from the block at
    the border, and the rank of each block that gives something (from 1).

    Blocks are met in a permuted order and taken while they fit into what is
    left of the quota; the first that did not fit gives single documents."""
    order = rng.permutation(len(words))
    full, border, rank = np.zeros(len(words), bool), np.zeros(len(words)), np.zeros(len(words), np.int64)
    left, missed = float(quota), -1
    if quota > 0:
        for k in order:
            if words[k] <= left:
                full[k] = True
                left -= words[k]
            elif missed < 0:
                missed = k
    if missed >= 0 and left > 0:
        border[missed] = left
    giving = [k for k in order if full[k] or border[k] > 0]
    rank[giving] = np.arange(1, len(giving) + 1)
    return full, border, rank


def _plan(thin: DataFrame, weights: Sequence[float], share: float, limit: float, shards: int,
          seed: int) -> DataFrame:
    """Per block: source_size, target, and for both passes whether it is taken
    in full, the last order hash taken at the border, and its shard."""
    spark: SparkSession = thin.sparkSession
    blocks = materialize(thin.groupBy("__key", "__block").agg(F.sum("size").alias("words")), "mix-sizes")
    per = blocks.groupBy("__key").agg(F.sum("words").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per = sorted(per, key=lambda r: (r["__key"] == "", r["__key"]))
    sizes = [r["words"] for r in per]
    targets = target_words(sizes, [weights[k % len(weights)] for k in range(len(per))], share, limit)
    sources = spark.createDataFrame(
        [(r["__key"], n, t) for r, n, t in zip(per, sizes, targets)],
        "__key string, source_size long, target double")

    def deal(block: pd.DataFrame) -> pd.DataFrame:  # one source: at most `blocks` rows
        block = block.sort_values("__block", ignore_index=True)
        words = block["words"].to_numpy()
        size, target = float(block["source_size"][0]), block["target"][0]
        out = block[["__key", "__block", "source_size", "target"]].copy()
        for p, quota in ((1, min(size, target)), (2, max(0.0, target - size))):
            rng = np.random.default_rng([seed, p, zlib.crc32(block["__key"][0].encode())])
            out[f"full{p}"], out[f"left{p}"], out[f"rank{p}"] = deal_blocks(words, quota, rng)
        return out

    ranked = materialize(blocks.join(sources, "__key").groupBy("__key").applyInPandas(
        deal, "__key string, __block int, source_size long, target double, "
              "full1 boolean, left1 double, rank1 long, full2 boolean, left2 double, rank2 long"), "mix-blocks")
    quotas = {}
    for p in (1, 2):
        given = dict(ranked.groupBy("__key").agg(F.max(f"rank{p}")).collect())
        quotas[p] = split_quotas([given[r["__key"]] for r in per], shards, seed + p)
    stops = [(r["__key"], *[np.cumsum(quotas[p][:, k]).tolist() for p in (1, 2)]) for k, r in enumerate(per)]
    runs = spark.createDataFrame(stops, "__key string, stops1 array<long>, stops2 array<long>")
    # documents of border blocks, in hashed order, up to the words left
    border = thin.join(_small(ranked.where("left1 > 0 or left2 > 0").select(
        "__key", "__block", "left1", "left2")), ["__key", "__block"])
    inside = Window.partitionBy("__key", "__block").orderBy("__order").rangeBetween(Window.unboundedPreceding, 0)
    cuts = (border.withColumn("__upto", F.sum("size").over(inside)).groupBy("__key", "__block")
            .agg(*[F.max(F.when((F.col(f"left{p}") > 0) & (F.col("__upto") <= F.col(f"left{p}")), F.col("__order")))
                   .alias(f"cut{p}") for p in (1, 2)]))
    dealt = ranked.join(runs, "__key").join(cuts, ["__key", "__block"], "left")
    for p in (1, 2):
        dealt = dealt.withColumn(f"shard{p}", F.size(F.filter(
            F.col(f"stops{p}"), lambda stop: stop < F.col(f"rank{p}"))))
    return materialize(dealt.drop("stops1", "stops2", "rank1", "rank2", "left1", "left2"), "mix-plan")


def _small(plan: DataFrame) -> DataFrame:
    """Broadcast if counted to be small: it has ``blocks`` rows a source at most."""
    return F.broadcast(plan) if plan.count() <= MAX_BROADCAST else plan


def _keyed(docs: DataFrame, blocks: int, seed: int) -> DataFrame:
    """``docs`` with its source's key, an order hash and a block."""
    text = F.xxhash64(F.col("text"))
    return (docs.withColumn("__key", _source_key(F.col("source")))
            .withColumn("__order", F.xxhash64(F.lit(seed), F.col("doc_id"), text))
            .withColumn("__block", F.pmod(F.xxhash64("__order"), F.lit(blocks)).cast("int")))


def _taken(p: int) -> Column:
    return F.col(f"full{p}") | F.coalesce(F.col("__order") <= F.col(f"cut{p}"), F.lit(False))


def _decided(docs: DataFrame, weights: Sequence[float], share: float, limit: float, blocks: int, shards: int,
             seed: int) -> tuple[DataFrame, DataFrame]:
    """Thin rows (doc_id, size, keys) and the plan of their blocks."""
    if not 0 < limit <= 2:
        raise ValueError("two passes take a document at most twice")
    thin = materialize(_keyed(docs, blocks, seed).select(
        "doc_id", "__key", "__order", "__block", word_count(F.col("text")).alias("size")), "mix-documents")
    return thin, _plan(thin, weights, share, limit, shards, seed)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
        blocks: int = BLOCKS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, copies (0 to 2), taken (size * copies)
    and shards (those that take it) per row of ``docs``; no text is shuffled."""
    thin, plan = _decided(docs, weights, share, limit, blocks, shards, seed)
    dealt = thin.join(_small(plan), ["__key", "__block"])
    copies = _taken(1).cast("int") + _taken(2).cast("int")
    return dealt.select("doc_id", "size", "source_size", "target", copies.alias("copies"),
                        (F.col("size") * copies).cast("long").alias("taken"), _shards().alias("shards"))


def _shards() -> Column:
    return F.filter(F.array(*[F.when(_taken(p), F.col(f"shard{p}")) for p in (1, 2)]), lambda s: s.isNotNull())


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
                    blocks: int = BLOCKS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own
    columns, dealt to the mix's shards and in hashed order inside each."""
    _, plan = _decided(docs, weights, share, limit, blocks, shards, seed)
    row = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", "source")
    keyed = _keyed(row, blocks, seed).select("row", "__key", "__order", "__block")
    copies = keyed.join(_small(plan), ["__key", "__block"]).select(F.explode(_shards()).alias("__shard"), "__order", "row")
    at = F.xxhash64("__order", F.lit(seed), "__shard")
    # a shard is put in order by several tasks, each with a range of its hashes
    return (copies.withColumn("__at", at).withColumn("__range", F.shiftrightunsigned("__at", 58))
            .repartition("__shard", "__range").sortWithinPartitions("__shard", "__range", "__at").select("row.*"))
