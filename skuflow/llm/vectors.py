"""Embedding near-duplicates by a robust-pruned flat graph (op 4).

1. Equal vectors are one node with a number of copies.
2. Centroids are fitted on a bounded sample; every node goes to its
   ``overlap`` nearest ones.  A cluster of more than ``shard_rows`` nodes is cut
   into blocks and its shards are the pairs of blocks, so a shard is bounded
   and every pair of a cluster shares one.
3. Each shard builds a graph of its nodes: nearest and random candidates are
   pruned robustly (a candidate goes if a kept neighbour is nearer to it by the
   factor ``alpha``), edges are made mutual and parts are joined.
4. Adjacency lists are united by node over all shards.
5. Each shard searches its part of the united graph for each of its nodes: a
   greedy beam search from medoids and the node's own list, then a range expansion through all nodes
   whose cosine is near the threshold.  Pairs found are verified in double
   precision and counted in the first shard that both share; a shard emits
   counts and stars of its components, never its pairs.
6. Sampled nodes, drawn from all, from those with few and from those with no
   links found, are compared with a scan of all vectors.  The recall is the mean
   over nodes, the least of the three draws, so that one group of near copies
   hides no losses elsewhere.  Below ``TARGET`` the work is redone with twice
   the overlap, then four times; if that is not enough, all pairs of blocks are
   compared exactly.  The recall is a column of the result.

Vectors of different lengths never link; centroids, shards and audits are kept
by length, and a length that the sample does not hold is one cluster.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without a vec_id link with nothing and are their own
component; equal rows are copies of one another; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.graph import connected_components, linked_rows
from skuflow.session import materialize

THRESHOLD = 0.95
OVERLAP = 3
SHARD_ROWS = 2000
SAMPLE = 20_000
DEGREE = 24
CANDIDATES = 48
BEAM = 16
MEDOIDS = 8
ALPHA = 1.2
SLACK = 0.03
APART = 0.8
AUDIT = 200
TARGET = 0.95
SEED = 404
PAIRS_AT_ONCE = 400_000


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def matrix(column: pd.Series) -> np.ndarray:
    return unit(np.stack(column.to_list()).astype(np.float64))


# ---- one shard's graph ------------------------------------------------------

def candidates(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """n x c rows: nearest others and some random ones, -1 where there are none."""
    n = len(x)
    near = min(CANDIDATES, n - 1)
    out = np.full((n, near + 16), -1, dtype=np.int64)
    for at in range(0, n, 512):
        sim = x[at:at + 512] @ x.T
        sim[np.arange(len(sim)), np.arange(at, at + len(sim))] = -np.inf
        out[at:at + len(sim), :near] = np.argpartition(-sim, near - 1, axis=1)[:, :near]
    out[:, near:] = rng.integers(0, n, (n, 16))
    out[out == np.arange(n)[:, None]] = -1
    return out


def robust_prune(x: np.ndarray, cand: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """n x degree rows: kept candidates, nearest first, filled up with -1."""
    n, c = cand.shape
    out = np.full((n, degree), -1, dtype=np.int64)
    for at in range(0, n, 256):
        own = cand[at:at + 256]
        there = x[own]
        far = 1.0 - np.einsum("bcd,bd->bc", there, x[at:at + 256])
        far[own < 0] = np.inf
        order = np.argsort(far, axis=1, kind="stable")
        own, far = np.take_along_axis(own, order, 1), np.take_along_axis(far, order, 1)
        there = x[own]
        apart = 1.0 - np.matmul(there, there.transpose(0, 2, 1))
        alive, taken = np.isfinite(far), np.zeros(len(own), dtype=np.int64)
        for j in range(c):
            take = alive[:, j] & (taken < degree)
            rows = np.flatnonzero(take)
            out[at + rows, taken[rows]] = own[rows, j]
            taken[rows] += 1
            alive &= ~(take[:, None] & (alpha * apart[:, j, :] <= far))
            if not alive[:, j + 1:].any():
                break
    return out


def build_graph(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Mutual edges (a, b) of one shard's rows."""
    if len(x) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kept = robust_prune(x, candidates(x, np.random.default_rng(seed)))
    a, k = np.nonzero(kept >= 0)
    b = kept[a, k]
    while True:  # pruning may part the graph: join each part to its nearest other
        part = linked_rows(a, b, len(x))
        tips = np.unique(part)
        if len(tips) == 1:
            break
        for at in range(0, len(tips), 512):
            tip = tips[at:at + 512]
            sim = x[tip] @ x.T
            sim[part[tip][:, None] == part[None, :]] = -np.inf
            a, b = np.r_[a, tip], np.r_[b, sim.argmax(axis=1)]
    both = np.unique(np.r_[a * len(x) + b, b * len(x) + a])
    return both // len(x), both % len(x)


def medoids(x: np.ndarray, count: int = MEDOIDS) -> np.ndarray:
    """The row nearest to the mean, then rows far from those chosen."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    best = x @ x[chosen[0]]
    while len(chosen) < min(count, len(x)):
        chosen.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[chosen[-1]])
    return np.unique(chosen)


def padded(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Adjacency lists as an n x degree table, -1 where a list ends."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    degree = np.bincount(a, minlength=n)
    table = np.full((n, max(1, degree.max(initial=0))), -1, dtype=np.int64)
    table[a, np.arange(len(a)) - np.repeat(np.cumsum(degree) - degree, degree)] = b
    return table


def range_search(x: np.ndarray, adjacent: np.ndarray, threshold: float, beam: int = BEAM,
                 slack: float = SLACK) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, other) with a cosine >= threshold that the graph leads to,
    for every row as query.  Memory: two n x n tables of bits' bytes."""
    n = len(x)
    x32 = x.astype(np.float32)
    seen = np.zeros((n, n), dtype=bool)
    seen[np.arange(n), np.arange(n)] = True
    close = np.zeros((n, n), dtype=bool)  # cosine at or above threshold - slack
    start = medoids(x)
    width = max(beam, len(start) + 1)
    ids = np.full((n, width), -1, dtype=np.int64)
    sims = np.full((n, width), -np.inf, dtype=np.float32)
    ids[:, :len(start)] = start
    sims[:, :len(start)] = x32 @ x32[start].T
    ids[:, len(start)], sims[:, len(start)] = np.arange(n), 1.0  # a query is in the graph
    done = ids < 0
    seen[:, start] = True
    q, k = np.nonzero(sims >= threshold - slack)
    close[q, ids[q, k]] = True
    np.fill_diagonal(close, False)
    active = np.arange(n)
    while len(active):
        open_ = np.where(done[active], -np.inf, sims[active])
        best = open_.argmax(axis=1)
        go = np.isfinite(open_[np.arange(len(active)), best])
        active, best = active[go], best[go]
        if not len(active):
            break
        node = ids[active, best]
        done[active, best] = True
        near = adjacent[node]
        new = (near >= 0) & ~seen[active[:, None], near]
        sim = np.full(near.shape, -np.inf, dtype=np.float32)
        r, c = np.nonzero(new)
        rows, others = active[r], near[r, c]
        got = np.einsum("ij,ij->i", x32[rows], x32[others])
        sim[r, c] = got
        seen[rows, others] = True
        hit = got >= threshold - slack
        close[rows[hit], others[hit]] = True
        all_ids = np.hstack([ids[active], np.where(new, near, -1)])
        all_sims = np.hstack([sims[active], sim])
        all_done = np.hstack([done[active], ~new])
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[active] = np.take_along_axis(all_ids, top, 1)
        sims[active] = np.take_along_axis(all_sims, top, 1)
        done[active] = np.take_along_axis(all_done, top, 1)
    # through what is close to a query, as long as that leads to something new
    q, v = np.nonzero(close)
    step = max(1, PAIRS_AT_ONCE // adjacent.shape[1])
    while len(q):
        next_q, next_v = [], []
        for at in range(0, len(q), step):
            near = adjacent[v[at:at + step]]
            rows = np.repeat(q[at:at + step], near.shape[1])
            others = near.ravel()
            new = (others >= 0) & ~seen[rows, others]
            key = np.unique(rows[new] * n + others[new])
            rows, others = key // n, key % n
            seen[rows, others] = True
            hit = np.einsum("ij,ij->i", x32[rows], x32[others]) >= threshold - slack
            close[rows[hit], others[hit]] = True
            next_q.append(rows[hit])
            next_v.append(others[hit])
        q, v = np.concatenate(next_q), np.concatenate(next_v)
    close |= close.T
    a, b = np.nonzero(np.triu(close, 1))
    kept = [np.zeros(0, bool)]
    for at in range(0, len(a), PAIRS_AT_ONCE):  # verified in double precision
        kept.append(np.einsum("ij,ij->i", x[a[at:at + PAIRS_AT_ONCE]], x[b[at:at + PAIRS_AT_ONCE]]) >= threshold)
    keep = np.concatenate(kept)
    return a[keep], b[keep]


def first_shared(member: np.ndarray, a: np.ndarray, b: np.ndarray, cluster: int) -> np.ndarray:
    """Whether no smaller cluster holds both rows of a pair; member: n x overlap."""
    own = np.ones(len(a), dtype=bool)
    for i in range(member.shape[1]):
        low = member[a, i]
        own &= ~((low < cluster) & (member[b] == low[:, None]).any(axis=1))
    return own


# ---- Spark ------------------------------------------------------------------

def fit_centroids(sample: np.ndarray, count: int, seed: int, rounds: int = 10, apart: float = APART) -> np.ndarray:
    """Unit centroids of a spherical k-means on the sample.  Of centroids with
    a cosine above ``apart`` only the fullest stays: several inside one group of
    near copies would part it, while one large cluster is cut into blocks
    without losing a pair."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(count, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(sample[at:at + 4096] @ centres.T).argmax(axis=1)
                                  for at in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centres)
    kept: list[int] = []
    for k in np.argsort(-np.bincount(nearest, minlength=len(centres)), kind="stable"):
        if not kept or (centres[kept] @ centres[k]).max() <= apart:
            kept.append(k)
    return centres[kept]


def _nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows (vec_id, embedding, ok) and distinct sound vectors
    (node, embedding, first_id, copies)."""
    e = F.col("embedding")
    sound = F.coalesce(
        F.col("vec_id").isNotNull() & (F.size(e) > 0)
        & ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == math.inf))
        & F.exists(e, lambda v: v != 0), F.lit(False))
    rows = vectors.select("vec_id", e.alias("embedding"), sound.alias("ok"))
    nodes = (rows.where("ok").groupBy("embedding")
             .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
             .withColumn("node", F.monotonically_increasing_id()))
    return rows, materialize(nodes, "vectors")  # written once, so that node numbers stay


def fit_by_length(sample: pd.Series, count: int, wide: int, shard_rows: int, seed: int) -> dict[int, tuple[int, np.ndarray]]:
    """Length -> (number of its first cluster, centroids), from sampled vectors."""
    out, first = {}, 0
    for length, own in sample.groupby(sample.str.len()):
        wanted = math.ceil(count * len(own) / len(sample) * wide / shard_rows)
        centres = fit_centroids(matrix(own), wanted, seed)
        out[int(length)] = first, centres
        first += len(centres)
    return out


def assign_clusters(nodes: DataFrame, centres: dict[int, tuple[int, np.ndarray]], overlap: int) -> DataFrame:
    """node, embedding, copies, member (the nearest clusters, ascending; one
    negative cluster for a length without centroids)."""
    def members(embedding: pd.Series, length: int) -> np.ndarray:
        if length not in centres:
            return np.full((len(embedding), 1), -length, dtype=np.int32)
        first, own = centres[length]
        take = min(overlap, len(own))
        found, x = np.zeros((len(embedding), take), dtype=np.int32), matrix(embedding)
        for at in range(0, len(x), 1024):
            found[at:at + 1024] = np.argpartition(-(x[at:at + 1024] @ own.T), take - 1, axis=1)[:, :take]
        found.sort(axis=1)
        return found + first

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, part in batch.groupby(batch["embedding"].str.len()):
                found = pd.Series(members(part["embedding"], int(length)).tolist(), index=part.index, dtype=object)
                yield part.assign(member=found)

    kind = nodes.schema["embedding"].dataType.simpleString()
    return nodes.select("node", "embedding", "copies").mapInPandas(
        run, f"node long, embedding {kind}, copies long, member array<int>")


def to_shards(assigned: DataFrame, shard_rows: int) -> DataFrame:
    """A row per node and shard: cluster, lo, hi (the shard's blocks), block."""
    each = assigned.withColumn("cluster", F.explode("member"))
    sizes = each.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    # one row per centroid, of which there are at most as many as sampled rows
    blocks = sizes.select("cluster", F.when(F.col("n") <= shard_rows, F.lit(1)).otherwise(
        F.ceil(F.col("n") / (shard_rows // 2))).cast("int").alias("blocks"))
    return (each.join(F.broadcast(blocks), "cluster")
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
            .drop("other", "blocks"))


def shard_edges(shards: DataFrame, seed: int) -> DataFrame:
    """node, near: each shard's adjacency lists."""
    def build(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("node", ignore_index=True)
        ids = shard["node"].to_numpy()
        a, b = build_graph(matrix(shard["embedding"]), seed)
        lists = np.split(ids[b], np.flatnonzero(np.diff(a)) + 1) if len(a) else []
        return pd.DataFrame({"node": ids[np.unique(a)], "near": pd.Series([x.tolist() for x in lists], dtype=object)})

    return (shards.select("cluster", "lo", "hi", "node", "embedding").groupBy("cluster", "lo", "hi")
            .applyInPandas(build, "node long, near array<long>"))


def all_pairs(x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of rows with a cosine >= threshold."""
    found = [np.nonzero(np.triu(x[at:at + 512] @ x.T >= threshold, at + 1)) for at in range(0, len(x), 512)]
    a = [r + 512 * k for k, (r, _) in enumerate(found)]
    return np.concatenate(a), np.concatenate([c for _, c in found])


def search_shards(shards: DataFrame, lists: DataFrame | None, threshold: float) -> DataFrame:
    """node, links (rows linked, found in this shard), root (smallest node of
    its component there).  Without ``lists`` all pairs of a shard are compared."""
    without_lists = lists is None

    def search(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("node", ignore_index=True)
        ids, n = shard["node"].to_numpy(), len(shard)
        lo, hi, cluster = int(shard["lo"][0]), int(shard["hi"][0]), int(shard["cluster"][0])
        x = matrix(shard["embedding"])
        if without_lists:
            a, b = all_pairs(x, threshold)
        else:
            near = [np.asarray(v if v is not None else [], dtype=np.int64) for v in shard["near"]]
            a = np.repeat(np.arange(n), [len(v) for v in near])
            to = np.concatenate(near) if near else np.zeros(0, np.int64)
            at = np.minimum(np.searchsorted(ids, to), n - 1)
            here = ids[at] == to  # the united lists also name nodes of other shards
            a, b = range_search(x, padded(a[here], at[here], n), threshold)
        block = shard["block"].to_numpy()
        if lo != hi:  # pairs within a block belong to the block's own shard
            between = block[a] != block[b]
            a, b = a[between], b[between]
        own = first_shared(np.stack(shard["member"].to_list()), a, b, cluster)
        a, b = a[own], b[own]
        copies = shard["copies"].to_numpy()
        links = np.zeros(n, dtype=np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        root = linked_rows(a, b, n)
        some = np.flatnonzero(links)
        return pd.DataFrame({"node": ids[some], "links": links[some], "root": ids[root[some]]})

    listed = shards if without_lists else shards.join(lists, "node", "left")
    return (listed.groupBy("cluster", "lo", "hi")
            .applyInPandas(search, "node long, links long, root long"))


FEW = 8  # links


def audit_recall(nodes: DataFrame, links: DataFrame, threshold: float, queries: int, seed: int) -> float:
    """Share of a node's links that were found, as the mean over sampled nodes
    that have any: the least of three draws of ``queries`` nodes each, from all
    nodes, those with up to ``FEW`` links found, and those with none.  The drawn
    nodes are compared with all vectors, in blocks."""
    found = nodes.join(links, "node", "left").select("node", "embedding", F.coalesce("links", F.lit(0)).alias("links"))
    draws = [found.where(which).orderBy(F.xxhash64(F.lit(seed), "embedding"), "node").limit(queries)
             .withColumn("draw", F.lit(k)).toPandas() for k, which in enumerate(("true", f"links <= {FEW}", "links = 0"))]
    picked = pd.concat(draws, ignore_index=True)
    if not len(picked):
        return 1.0
    once = picked.drop_duplicates("node").sort_values("node", ignore_index=True)
    asked = {int(n): (own["node"].to_numpy(), matrix(own["embedding"]))
             for n, own in once.groupby(once["embedding"].str.len())}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {n: np.zeros(len(ids), dtype=np.int64) for n, (ids, _) in asked.items()}
        for batch in batches:
            for n, part in batch.groupby(batch["embedding"].str.len()):
                if n in asked:
                    ids, q = asked[n]
                    hit = matrix(part["embedding"]) @ q.T >= threshold
                    hit &= part["node"].to_numpy()[:, None] != ids[None, :]
                    total[n] += (hit * part["copies"].to_numpy()[:, None]).sum(axis=0)
        for n, (ids, _) in asked.items():
            yield pd.DataFrame({"node": ids, "true_links": total[n]})

    true = (nodes.select("node", "embedding", "copies").mapInPandas(run, "node long, true_links long")
            .groupBy("node").agg(F.sum("true_links").alias("n")).toPandas().set_index("node")["n"])
    picked["true"] = true.reindex(picked["node"]).to_numpy()
    linked = picked[picked["true"] > 0]
    shares = np.minimum(linked["links"], linked["true"]) / linked["true"]
    # a draw of nodes without links found counts those that should have some among all its nodes
    means = [shares[linked["draw"] == 0].mean(), shares[linked["draw"] == 1].mean()]
    nothing = picked["draw"] == 2
    means.append(1 - (picked.loc[nothing, "true"] > 0).mean() if nothing.any() else 1.0)
    return float(min([m for m in means if not math.isnan(m)], default=1.0))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP,
                    shard_rows: int = SHARD_ROWS, sample: int = SAMPLE, seed: int = SEED,
                    target: float = TARGET) -> DataFrame:
    """vec_id, n_links, component_id, kept and audit_recall per row of
    ``vectors`` (vec_id, embedding)."""
    rows, nodes = _nodes(vectors)
    count = nodes.count()
    links, recall = None, 1.0
    if count:
        fitted = (nodes.orderBy(F.xxhash64(F.lit(seed), "embedding"), "node").limit(sample)
                  .select("embedding").toPandas()["embedding"])
        for wide in (overlap, 2 * overlap, 4 * overlap):
            centres = fit_by_length(fitted, count, wide, shard_rows, seed)
            shards = materialize(to_shards(assign_clusters(nodes, centres, wide), shard_rows), "vector-shards")
            lists = shard_edges(shards, seed).groupBy("node").agg(
                F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
            links = materialize(search_shards(shards, lists, threshold), "vector-links")
            summed = links.groupBy("node").agg(F.sum("links").alias("links"))
            recall = audit_recall(nodes, summed, threshold, AUDIT, seed)
            if recall >= target:
                break
        else:  # one cluster a length, all pairs of its blocks
            shards = materialize(to_shards(assign_clusters(nodes, {}, 1), shard_rows), "vector-shards")
            links, recall = materialize(search_shards(shards, None, threshold), "vector-links"), 1.0
    if links is None:
        links = nodes.select("node", F.lit(0).cast("long").alias("links"), F.col("node").alias("root")).limit(0)
    summed = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = (nodes.join(summed, "node", "left").join(roots, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    done = named.join(least, "component").select(
        F.col("embedding").alias("vector"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = (rows.where("ok").join(done, F.col("embedding") == F.col("vector"))
             .select("vec_id", "n_links", "component_id"))
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    return found.unionAll(alone).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.lit(recall).alias("audit_recall"))
