import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skuflow.llm import simhash as S
from skuflow.llm.graph import connected_components


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    pieces = [words] if 0 < len(words) < 3 else [words[k:k + 3] for k in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) > len(hashes) / 2)


def brute(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [r[0] for r, g in zip(rows, group) if g == group[k] and r[0] is not None]
        out.append((i, f"{fps[k]:016x}", min(ids) if ids else None))
    return sorted(out, key=str), group


def texts(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(50)]
    rows = []
    for k in range(n):
        t = " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 4, 40, 400])))
        rows.append((k, t))
        if rng.random() < 0.5:
            cut = t.split()
            cut[rng.randrange(len(cut))] = "NEW"
            rows.append((1000 + k, "  ".join(cut)))
    return rows


ODD = [(5, ""), (2, None), (9, " \t\n"), (3, "one"), (4, "ONE"), (4, "ONE"), (None, "one"), (None, None), (None, "lone words x"),
       (8, "É\u00a0é a b c"), (7, "é\u00a0é a b c"), (11, "word " * 60_000)]


@pytest.mark.parametrize("text", [t for _, t in ODD + texts(0, 20)])
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(t for _, t in texts(3))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "CHUNK", 7)
    assert S.fingerprint(text) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("rows", [texts(1), texts(2), ODD, []])
def test_groups_equal_brute_force(make_docs, rows):
    docs = make_docs(rows).withColumnRenamed("lang", "fp").withColumnRenamed("source", "component_id")
    got = sorted(map(tuple, S.simhash_groups(docs).collect()), key=str)
    assert got == brute(rows)[0]


@pytest.mark.parametrize("rows", [texts(1), ODD, []])
def test_one_row_of_each_group_stays(make_docs, rows):
    docs = make_docs(rows)
    kept = S.one_per_group(docs)
    assert kept.columns == docs.columns
    _, group = brute(rows)
    want = {}
    for k, (i, t) in enumerate(rows):
        want.setdefault(group[k], []).append(i)
    least = [min([i for i in ids if i is not None], default=None) for ids in want.values()]
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == sorted(least, key=str)


def test_every_close_pair_meets_at_an_anchor():
    rng = np.random.default_rng(1)
    for _ in range(400):
        a = int(rng.integers(0, 2**63))
        b = a
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b ^= 1 << int(bit)
        meets = False
        for shift in (0, 32):
            half = np.array([a >> shift & 0x7FFFFFFF, b >> shift & 0x7FFFFFFF])
            rows, anchor = S.anchors(half)
            meets |= bool(set(anchor[rows == 0]) & set(anchor[rows == 1]))
        assert meets


def test_anchors_are_the_code_words_in_reach():
    half = np.array([0, 1, 0b110, 12345678, 2**31 - 1])
    rows, anchor = S.anchors(half)
    own, again = S.anchors(anchor)
    assert (np.bincount(own) == 1).all() and (again == anchor).all()  # anchors are code words
    assert (np.bitwise_count(half[rows] ^ anchor) <= 2).all()
    counts = np.bincount(rows).tolist()
    assert counts[:3] == [1, 16, 16] and counts[3] in (1, 16) and counts[4] == 1


def test_crowded_anchors_lose_no_pair(spark):
    rng = np.random.default_rng(7)
    base = int(rng.integers(0, 2**62))
    fps = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (300, 2))})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    whole, cut = (connected_components(S.compare_at_anchors(S.at_anchors(df), block=block))
                  .groupBy("component").agg(F.sort_array(F.collect_list("node"))).collect() for block in (4096, 8))
    assert sorted(map(tuple, whole)) == sorted(map(tuple, cut))
    dense = S._dense_components(np.array(fps, dtype=np.uint64), 3)
    assert len(set(dense[np.bincount(dense, minlength=len(fps))[dense] > 1])) == len(whole)


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 99), (99, 100), (7, 7)]
    got = dict(connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{k: 0 for k in range(61)}, 99: 99, 100: 99}


def test_more_bits_are_refused(make_docs):
    with pytest.raises(ValueError):
        S.simhash_groups(make_docs([]), max_bits=4)
