"""SimHash near-duplicates by anchor-point covering (op 10).

A document's fingerprint has 64 bits over its 3-word shingles.  Fingerprints
that differ in at most 3 bits differ in at most 1 bit in one of their two
32-bit halves.  Anchors are the 2^26 words of the Hamming code on 31 bits of a
half: a perfect code, whose words cover the space with radius 1.  A
fingerprint goes to every anchor within the covering radius plus the half's
threshold, 1 + 1: that is 1 anchor where it is a code word and 16 otherwise.
Of two fingerprints within the threshold, the anchor that covers one of them
is within reach of the other, so each such pair meets at an anchor, where all
64 bits are compared.

Only distinct fingerprints are compared.  An anchor with more than ``BLOCK`` of
them is split into blocks and each pair of blocks is compared on its own, so
no task holds an unbounded group and no pair is lost.  A comparison emits the
local components as stars (at most one edge per row), never all pairs.

Defined results: null and empty texts have fingerprint zero, which links like
any other; a null doc_id is never the smallest unless its whole group has
none; ids may be of any type that sorts; repeated rows give repeated rows
(``one_per_group`` keeps one of them); texts of any length are read whole; an
empty table gives an empty result; other columns are ignored or, by
``one_per_group``, carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.graph import connected_components, linked_rows
from skuflow.session import materialize

SHINGLE = 3
MAX_BITS = 3
HASH_SEED = 42
BLOCK = 4096
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = HASH_SEED) -> int:
    """The unsigned 64-bit fingerprint; zero for a text without words.

    ``bytes.lower`` changes A-Z alone and ``bytes.split`` cuts at the six
    ASCII white-space bytes alone, as the definition asks.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    parts = [words[k:len(words) - shingle + 1 + k] for k in range(shingle)]
    join, total = b" ".join, len(parts[0])
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, total, CHUNK):
        pieces = zip(*[p[at:at + CHUNK] for p in parts])
        hashes = np.array([digest(join(p), seed) for p in pieces], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = HASH_SEED) -> DataFrame:
    """doc_id, text_key (the text's hash) and fp (the fingerprint's bits as a
    signed long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")]
            fp = np.array(got, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(fp)], ["doc_id", "text_key", "fp"])

    thin = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("string"))
    return thin.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key long, fp long")


def anchor_masks() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome s: the 16 bit patterns that lead to the anchors within
    distance 2, and which of them count.  Bit i-1 stands for place i of the
    code, so the syndrome is the exclusive or of the places that are set."""
    masks = np.zeros((32, 16), dtype=np.int64)
    valid = np.zeros((32, 16), dtype=bool)
    valid[0, 0] = True
    for s in range(1, 32):
        pairs = [(i, i ^ s) for i in range(1, 32) if 0 < i < (i ^ s)]
        found = [1 << (s - 1)] + [1 << (i - 1) | 1 << (j - 1) for i, j in pairs]
        masks[s, :len(found)], valid[s, :len(found)] = found, True
    return masks, valid


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and anchors (31 bits) for an array of 31-bit numbers."""
    masks, valid = anchor_masks()
    syndrome = np.zeros(len(half), dtype=np.int64)
    for k in range(5):
        places = sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1)
        syndrome |= (np.bitwise_count(half & places).astype(np.int64) & 1) << k
    use = valid[syndrome]
    rows = np.repeat(np.arange(len(half)), use.sum(axis=1))
    return rows, (half[:, None] ^ masks[syndrome])[use]


def at_anchors(fps: DataFrame) -> DataFrame:
    """anchor, fp: each fingerprint at every anchor in reach, for both halves."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                fp = batch["fp"].to_numpy()[at:at + CHUNK]
                bits = fp.view(np.uint64)
                for side, shift in enumerate((0, 32)):
                    half = (bits >> np.uint64(shift) & np.uint64(0x7FFFFFFF)).astype(np.int64)
                    rows, anchor = anchors(half)
                    yield pd.DataFrame({"anchor": anchor | side << 31, "fp": fp[rows]})

    return fps.mapInPandas(run, "anchor long, fp long")


def _dense_components(fp: np.ndarray, max_bits: int) -> np.ndarray:
    """The same for one group of at most a few thousand fingerprints, without
    keeping its pairs: labels sweep over the compared rows until they rest."""
    label = np.arange(len(fp))
    while True:
        before = label.copy()
        for at in range(0, len(fp), 256):
            near = np.bitwise_count(fp[at:at + 256, None] ^ fp[None, :]) <= max_bits
            label[at:at + 256] = np.where(near, label[None, :], len(fp)).min(axis=1)
        label = label[label]
        if (label == before).all():
            return label


def _stars(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges fp -> smallest linked fp for whole groups of consecutive rows."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    label = np.arange(len(group))
    small = np.repeat(sizes <= 64, sizes)
    a, b = [], []
    for step in range(1, int(min(sizes.max(), 64))):
        same = (group[step:] == group[:-step]) & small[step:]
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= max_bits]
        a.append(at)
        b.append(at + step)
    if a:
        label = linked_rows(np.concatenate(a), np.concatenate(b), len(group))
    for k in np.flatnonzero(sizes > 64):
        s, n = starts[k], sizes[k]
        label[s:s + n] = s + _dense_components(fp[s:s + n], max_bits)
    moved = np.flatnonzero(label != np.arange(len(group)))
    return fp[moved], fp[label[moved]]


def compare_at_anchors(reach: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Star edges u, v between fingerprints that meet at an anchor and differ
    in at most ``max_bits`` bits."""
    crowded = (reach.groupBy("anchor").count().where(F.col("count") > block)
               .select("anchor", F.ceil(F.col("count") / (block // 2)).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    placed = (reach.join(crowded, "anchor", "left")
              .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
              .withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("anchor", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = held.iloc[-1]
            open_ = ((held["anchor"] == last["anchor"]) & (held["lo"] == last["lo"])
                     & (held["hi"] == last["hi"])).to_numpy()
            done, held = held[~open_], held[open_]
            yield from links(done)
        if held is not None:
            yield from links(held)

    def links(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if len(rows) < 2:
            return
        keys = rows[["anchor", "lo", "hi"]].to_numpy()
        group = np.cumsum(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        u, v = _stars(group, rows["fp"].to_numpy().view(np.uint64), max_bits)
        if len(u):
            found = pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})
            yield found.drop_duplicates()

    return (placed.repartition("anchor", "lo", "hi").sortWithinPartitions("anchor", "lo", "hi", "fp")
            .mapInPandas(run, "u long, v long"))


def _groups(docs: DataFrame, shingle: int, max_bits: int, seed: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints by document, and by distinct fingerprint its group's root
    (the smallest linked fingerprint) and smallest doc_id."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with threshold 1 each reach all pairs up to 3 bits apart")
    by_doc = materialize(fingerprints(docs, shingle, seed), "simhash")
    first = by_doc.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    edges = compare_at_anchors(at_anchors(first.select("fp")), max_bits, block)
    linked = connected_components(edges)
    roots = first.join(linked, first["fp"] == linked["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("root"), "first_id")
    return by_doc, materialize(roots, "simhash-roots")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                   seed: int = HASH_SEED, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id per document."""
    by_doc, roots = _groups(docs, shingle, max_bits, seed, block)
    least = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return (by_doc.join(roots.join(least, "root").select("fp", "component_id"), "fp", "left")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = HASH_SEED,
                  block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, with their own columns, that have the smallest
    doc_id of their group (null last); of rows equal in id and text one stays."""
    by_doc, roots = _groups(docs, shingle, max_bits, seed, block)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    counted = by_doc.groupBy("doc_id", "text_key", "fp").agg(F.count(F.lit(1)).alias("copies"))
    kept = materialize(
        counted.join(roots.select("fp", "root"), "fp").groupBy("root").agg(
            F.min(order).alias("k"), F.min_by("copies", order).alias("copies"))
        .select(F.col("k.doc_id").alias("id"), F.col("k.text_key").alias("key"), "copies"), "simhash-kept")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own_id"),
                        F.xxhash64("text").alias("own_key"))
    found = keyed.join(kept, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key")))
    # texts are shuffled only for rows that repeat an id and text
    repeated = found.where("copies > 1").groupBy("own_id", "own_key").agg(F.first("row").alias("row"))
    return found.where("copies = 1").select("row.*").unionByName(repeated.select("row.*"))
