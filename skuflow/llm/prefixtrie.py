"""Prefix trie of conversations by burst tries (op 13).

A turn is known by 128 bits of a hash of role and text.  All conversations start
in one container under the root.  A container that holds more than ``LIMIT``
turns is burst: the prefix that all its suffixes share becomes a chain of trie
heads, suffixes that end there are its ends, and the others move to child
containers by their next turn id.  Bursting goes on, a round for all oversized
containers at once, until none is left.  The containers that remain are dealt to
shards, sorted, and swept into nodes, each by one task.

What a container shares is found from its least and greatest suffix, and its
size, smallest member and so on by aggregates that combine before their shuffle,
so that one first turn or one conversation in any number of copies is no hot
key.  Sums over subtrees need no walk: a swept container gives its totals to each
burst head above it (a conversation's path holds one entry a burst, not one a
turn), in one aggregate.  Rounds end with the deepest burst.  Each round's thin
rows (turn ids and text lengths, no texts) are written to the shared folder.

The members that end at a burst head are streamed in order into its SHA-256, in
one task a head, as that hash is of one sequence; nothing is held.  A
conversation's turn ids are one row: 24 bytes a turn.

Defined results: null roles and texts are empty; rows without a conv_id belong to
no conversation; a null turn comes first, and rows of one turn stand by a hash of
role and text; repeated rows are turns like any other; an empty table gives an
empty result (no root); texts of any length are hashed whole; other columns of
the table are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.llm.streams import batches_of, rows_of
from skuflow.session import materialize

LIMIT = 4096  # turns in a container
HEAD_TURNS = 8  # most turns that a conversation takes over
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _id(data: Column) -> Column:
    return F.substring(F.unhex(F.sha2(data, 256)), 1, 16)


def turn_ids(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (id, bytes of the text) in order."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    size = F.octet_length(text).cast("long")
    # the role's length comes first, so that no two turns are written alike
    made = _id(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), made.alias("id"), size.alias("bytes"))
    ordered = F.sort_array(F.collect_list(turn))
    return (conversations.where(F.col("conv_id").isNotNull())
            .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
            .agg(F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes"))).alias("turns")))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversation c with its first h turns taken from conversation c - c % 5,
    where h is fixed by a checksum of c."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD_TURNS + 1)).cast("int")
    bases = turns.where("conv_id % 5 = 0").select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD_TURNS).alias("head"))
    none = F.slice("turns", 1, 0)
    return (turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(bases, "base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h),
                                        F.slice("turns", h + 1, F.size("turns"))).alias("turns")))


# ---- bursting --------------------------------------------------------------------

ROW = ["box", "depth", "bytes", "path", "up", "conv_id", "suffix"]


def _shared(low: Column, high: Column) -> Column:
    """How many leading elements two arrays share."""
    n = F.least(F.size(low), F.size(high))
    differ = F.array_position(F.zip_with(F.slice(low, F.lit(1), n), F.slice(high, F.lit(1), n),
                                         lambda a, b: a == b), False)
    return F.when(differ > 0, differ - 1).otherwise(n).cast("int")


def _burst(rows: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """Containers left, burst heads and the members that end at heads, by round."""
    left, heads, ends = [], [], []
    while True:
        boxes = rows.groupBy("box").agg(
            F.sum(F.size("suffix") + 1).alias("turns"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"),
            F.min("suffix").alias("low"), F.max("suffix").alias("high"),
            *[F.min(c).alias(c) for c in ("depth", "bytes", "path", "up")])  # one value a container
        shared = _shared(F.col("low"), F.col("high"))
        head = materialize(boxes.where(F.col("turns") > limit).withColumn("shared", shared).select(
            "box", "depth", "path", "up", "n", "first", "shared", (F.size("high") == F.col("shared")).alias("childless"),
            F.concat(F.array("bytes"), F.transform(F.slice("low", F.lit(1), F.col("shared")), lambda t: t["bytes"]))
            .alias("lengths")), "trie-heads")
        if head.isEmpty():
            return [*left, rows], heads, ends
        burst = head.select("box", "first", "shared")
        left.append(rows.join(burst.select("box"), "box", "left_anti").select(ROW))
        inside = rows.join(burst, "box")
        ends.append(inside.where(F.size("suffix") == F.col("shared")).select("box", "conv_id"))
        heads.append(head)
        following = F.element_at("suffix", F.col("shared") + 1)
        moved = inside.where(F.size("suffix") > F.col("shared")).select(
            _id(F.concat("box", following["id"])).alias("box"),
            (F.col("depth") + F.col("shared") + 1).alias("depth"), following["bytes"].alias("bytes"),
            F.concat("path", F.array("box")).alias("path"), F.col("first").alias("up"), "conv_id",
            F.slice("suffix", F.col("shared") + 2, F.size("suffix")).alias("suffix"))
        rows = materialize(moved, "trie-rows")


# ---- sweeping --------------------------------------------------------------------

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, path array<binary>")


def _digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def _box_nodes(rows) -> Iterator[tuple]:
    """Nodes of one container from its sorted suffixes; its top has the path."""
    # per node: depth, bytes, parent, members, smallest member, members that end here
    nodes: list[list] = []
    stack: list[list] = []
    before: list[bytes] = []
    path = up = None
    for _, depth, size, path, up, conv, ids, lengths in rows:
        if not nodes:
            nodes.append([depth, size, None, 0, conv, []])
            stack.append(nodes[0])
        same = 0
        while same < min(len(before), len(ids)) and before[same] == ids[same]:
            same += 1
        del stack[same + 1:]
        for k in range(same, len(ids)):
            nodes.append([depth + k + 1, lengths[k], stack[-1], 0, conv, []])
            stack.append(nodes[-1])
        for node in stack:
            node[3] += 1
            node[4] = min(node[4], conv)
        stack[-1][5].append(conv)
        before = ids
    children, leaves, saved = ({id(n): 0 for n in nodes} for _ in range(3))
    for node in reversed(nodes):  # children come after their parents
        me, parent = id(node), node[2]
        if not children[me]:
            leaves[me] = 1
        saved[me] += (node[3] - 1) * node[1]
        if parent is not None:
            children[id(parent)] += 1
            leaves[id(parent)] += leaves[me]
            saved[id(parent)] += saved[me]
    for node in nodes:
        me, parent = id(node), node[2]
        yield (node[4], node[0], up if parent is None else parent[4], node[3], children[me], leaves[me], saved[me],
               _digest(node[5]), path if parent is None else None)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nodes = (node for _, rows in groupby(rows_of(batches), key=lambda r: r[0]) for node in _box_nodes(rows))
    yield from batches_of(nodes, [c.split()[0] for c in NODE.split(", ")],
                          [*[pa.int64()] * 7, pa.string(), pa.list_(pa.binary())])


def _stream_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digests():
        for box, rows in groupby(rows_of(batches), key=lambda r: r[0]):
            digest = hashlib.sha256()
            for at, (_, conv) in enumerate(rows):
                digest.update(f"{',' if at else ''}{conv}".encode())
            yield box, digest.hexdigest()
    yield from batches_of(digests(), ["box", "ends_sha256"], [pa.binary(), pa.string()])


# ---- the trie ---------------------------------------------------------------------

def _head_nodes(heads: DataFrame, ends: DataFrame, swept: DataFrame) -> DataFrame:
    """The nodes of the burst heads' chains."""
    own = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b) * (F.col("n") - 1)
    below = (swept.where("path IS NOT NULL").select("path", "n_leaves", "saved_tokens")
             .unionAll(heads.select("path", F.col("childless").cast("long"), own)))
    totals = (below.select("path", "n_leaves", "saved_tokens", F.explode("path").alias("box"))
              .groupBy("box").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
                                  F.sum((F.col("box") == F.element_at("path", -1)).cast("long")).alias("children")))
    hashes = (ends.repartition("box").sortWithinPartitions("box", "conv_id")
              .mapInArrow(_stream_ends, "box binary, ends_sha256 string"))
    whole = heads.join(totals, "box", "left").join(hashes, "box", "left")
    from_here = Window.partitionBy("box").orderBy(F.col("k").desc())  # a chain is one conversation's turns at most
    last = F.col("k") == F.col("shared")
    return (whole.select("*", F.posexplode("lengths").alias("k", "size"))
            .withColumn("chain", F.sum(F.col("size") * (F.col("n") - 1)).over(from_here))
            .select(F.col("first").alias("conv_id"), (F.col("depth") + F.col("k")).cast("long").alias("depth"),
                    F.when(F.col("k") == 0, F.col("up")).otherwise(F.col("first")).alias("parent_conv_id"),
                    F.col("n").alias("n_convs"),
                    F.when(last, F.coalesce("children", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
                    F.when(F.col("childless"), 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
                    (F.col("chain") + F.coalesce("saved", F.lit(0))).cast("long").alias("saved_tokens"),
                    F.when(last, F.coalesce("ends_sha256", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256")))


def prefix_trie(sequences: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The trie's nodes from conv_id (unique) and turns (id, bytes) per
    conversation: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256."""
    rows = materialize(sequences.select(
        F.lit(b"").alias("box"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"),
        F.expr("cast(array() as array<binary>)").alias("path"), F.lit(None).cast("long").alias("up"), "conv_id",
        F.col("turns").alias("suffix")), "trie-rows")
    left, heads, ends = _burst(rows, limit)
    swept = materialize(
        reduce(DataFrame.unionByName, left).repartition("box").sortWithinPartitions("box", "suffix", "conv_id")
        .select(*ROW[:6], F.transform("suffix", lambda t: t["id"]).alias("ids"),
                F.transform("suffix", lambda t: t["bytes"]).alias("lengths"))
        .mapInArrow(_sweep, NODE), "trie-nodes")
    nodes = swept.drop("path")
    if heads:
        nodes = nodes.unionByName(_head_nodes(reduce(DataFrame.unionByName, heads),
                                              reduce(DataFrame.unionByName, ends), swept))
    return nodes


def conversation_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(rebuilt(materialize(turn_ids(conversations), "turn-ids")), limit)
