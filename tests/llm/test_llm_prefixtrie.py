"""The burst trie against a plain one."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from skuflow.llm import prefixtrie as P

CONV = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    members = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 9
        turns = own.get(conv - conv % 5, [])[:h] + own[conv][h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append((conv, d == len(turns)))
    first = {node: min(c for c, _ in m) for node, m in members.items()}
    out = set()
    for node, m in members.items():
        under = [n for n in members if n[:len(node)] == node]
        children = [n for n in under if len(n) == len(node) + 1]
        leaves = [n for n in under if not any(k[:len(n)] == n and len(k) == len(n) + 1 for k in under)]
        saved = sum((len(members[n]) - 1) * (len(n[-1][1].encode()) if n else 0) for n in under)
        ends = ",".join(map(str, sorted(c for c, end in m if end)))
        out.add((first[node], len(node), first[node[:-1]] if node else None, len(m), len(children), len(leaves),
                 saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def got(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def table(spark, rows):
    df = spark.createDataFrame(rows, CONV)
    for name in ("box", "path", "suffix", "turns", "base", "head", "first", "n"):
        df = df.withColumn(name, F.lit("x"))
    return df


def like(n, same):
    """Conversations of which many share first turns, and ``same`` are equal."""
    rows = []
    for c in range(n):
        words = [0, 0, 0] if c < same else [c % 2, c % 3, c % 7, c % 11][:1 + c % 4]
        rows += [(c, t, ("user", "assistant")[t % 2], f"é{w}") for t, w in enumerate(words)]
    return rows


@pytest.mark.parametrize("limit", [1, 4, 30, 4096])
def test_equals_the_plain_trie_at_every_container_size(spark, limit):
    rows = like(70, 25)
    assert got(P.conversation_trie(table(spark, rows), limit)) == plain(rows)


@pytest.mark.parametrize("limit", [2, 4096])
def test_odd_rows(spark, limit):
    rows = [(1, None, None, None), (1, None, "", ""), (1, 3, "user", "a"), (2, 0, "use", "ra"), (2, 1, "user", "b " * 200_000),
            (None, 0, "user", "lost"), (12, 5, "user", "a"), (12, 5, "user", "a"), (10, 0, "user", "a"), (10, 1, "tool", "z"),
            (11, 0, "user", "a"), (10**12, 0, "user", "a")]
    assert got(P.conversation_trie(table(spark, rows), limit)) == plain(rows)
    assert P.conversation_trie(table(spark, rows).limit(0), limit).count() == 0


def test_the_root_is_a_leaf_if_all_conversations_are_turnless(spark):
    conv = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    rows = [(conv, 0, "user", "replaced by the turns of an absent conversation")]
    for limit in (0, 4096):
        assert got(P.conversation_trie(table(spark, rows), limit)) == plain(rows) == {
            (conv, 0, None, 1, 0, 1, 0, hashlib.sha256(str(conv).encode()).hexdigest())}


def test_long_conversations_burst_as_chains(spark):
    rows = [(c, t, "user", f"{t if t < 300 else c}") for c in (0, 5) for t in range(301)]
    assert got(P.conversation_trie(table(spark, rows), 50)) == plain(rows)


def test_equals_the_plain_trie_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert got(P.conversation_trie(df, 20)) == plain([tuple(r) for r in df.collect()])
