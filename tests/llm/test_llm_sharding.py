import math
import zlib

import pytest
from pyspark.sql import functions as F

from skuflow.llm import sharding as S


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 100, 1000, 4097])
def test_permutation_is_one_to_one(spark, total):
    df = spark.range(total).select(S.permuted(F.col("id"), F.lit(total).cast("long")).alias("at"))
    at = [r[0] for r in df.collect()]
    assert sorted(at) == list(range(total))
    if total > 100:
        assert sum(a == k for k, a in enumerate(at)) < 20


def test_seed_changes_the_order_and_reruns_agree(spark):
    def order(seed):
        return [r[0] for r in spark.range(500).select(S.permuted(F.col("id"), F.lit(500), seed)).collect()]
    assert order(1) == order(1) != order(2)


def test_long_walks_end(spark):
    """A walk limit of one step leaves the rest to the exact bound."""
    steps, S.WALK_STEPS = S.WALK_STEPS, 1
    try:
        at = [r[0] for r in spark.range(37).select(S.permuted(F.col("id"), F.lit(37))).collect()]
    finally:
        S.WALK_STEPS = steps
    assert sorted(at) == list(range(37))


ROWS = [(1, "abc"), (1, "abc"), (1, "abd"), (None, "x"), (None, None), (7, ""), (8, "é" * 40_000)] + [
    (100 + k, f"text {k % 5}") for k in range(90)]


def test_shards_are_even_and_slots_gapless(make_docs):
    docs = make_docs(ROWS).withColumn("shard", F.lit("clash")).withColumn("__bucket", F.lit(1))
    got = S.shard_documents(docs.drop("__bucket")).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(k, [])) for k in range(24)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(ROWS)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    want = sorted(((i, len((t or "").encode()) + 8, None if t is None else zlib.crc32(t.encode())) for i, t in ROWS), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == want
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_empty_table_and_order_of_input(make_docs):
    assert S.shard_documents(make_docs([])).collect() == []
    one = sorted(S.shard_documents(make_docs(ROWS)).collect(), key=str)
    two = sorted(S.shard_documents(make_docs(ROWS[::-1]).repartition(3)).collect(), key=str)
    assert one == two


def test_whole_rows_are_carried(make_docs):
    docs = make_docs(ROWS)
    got = S.assign_shards(docs, ["doc_id", "text"], 4)
    assert got.columns == [*docs.columns, "shard", "slot"]
    assert sorted(got.drop("shard", "slot").collect(), key=str) == sorted(docs.collect(), key=str)
    assert math.ceil(len(ROWS) / 4) == max(r["slot"] for r in got.collect()) + 1


def test_columns_with_inner_names_are_carried(make_docs):
    docs = make_docs(ROWS)
    for name in ("__first", "__total", "__bucket", "__in", "__number", "__at", "__n", "row", "bucket", "first", "total", "number",
                 "at", "size", "key0", "copies", "slot"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    got = S.assign_shards(docs, ["doc_id", "text"], 4)
    assert got.columns == [*[c for c in docs.columns if c != "slot"], "shard", "slot"]
    assert sorted(map(str, got.drop("shard", "slot").collect())) == sorted(map(str, docs.drop("slot").collect()))
    numbered = S.row_numbers(docs, ["doc_id", "text"])
    assert sorted(r["row_number"] for r in numbered.collect()) == list(range(len(ROWS)))
    assert S.shard_documents(docs).count() == len(ROWS)


def spark_hash(*values):
    """Spark's xxhash64 of longs and ints (as ("int", value)), by the public hash."""
    import xxhash
    h = 42
    for v in values:
        data = v[1].to_bytes(4, "little", signed=True) if isinstance(v, tuple) else v.to_bytes(8, "little", signed=True)
        h = xxhash.xxh64_intdigest(data, h)
    return h - (1 << 64) if h >> 63 else h


def plain_position(number, total, seed):
    """The Feistel walk of one row number."""
    a = math.isqrt(total - 1) + 1 if total > 1 else 1
    at = number
    while True:
        left, right = divmod(at, a)
        for k in range(S.ROUNDS):
            left, right = right, (left + spark_hash(right, ("int", seed), ("int", k)) % a) % a
        at = left * a + right
        if at < total:
            return at


def test_shard_and_slot_follow_from_the_row_number_alone(spark, make_docs):
    docs = make_docs([(k % 70, f"text {k % 50}") for k in range(211)])
    thin = docs.select("doc_id", F.xxhash64("text").alias("t"), (F.octet_length("text") + 8).cast("long").alias("size"),
                       F.crc32(F.encode("text", "UTF-8")).cast("long").alias("crc"))
    rows = [tuple(r) for r in thin.collect()]
    order = sorted(rows, key=lambda r: (spark_hash(*r) % S.BUCKETS, r))
    want = sorted((r[0], r[3], (at := plain_position(n, len(rows), S.SEED)) % 24, at // 24) for n, r in enumerate(order))
    got = sorted((r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in S.shard_documents(docs).collect())
    assert got == want


def test_one_document_in_many_copies_is_one_row_to_number(make_docs):
    docs = make_docs([(1, "same")] * 400 + [(2, "other")])
    got = S.shard_documents(docs).collect()
    assert len({(r["shard"], r["slot"]) for r in got}) == 401
    sizes = [sum(r["shard"] == s for r in got) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1


def test_the_plan_stays_small(make_docs):
    docs = make_docs([(i, f"text {i}") for i in range(50)])
    for out in (S.assign_shards(docs, ["doc_id", "text"], 24), S.shard_documents(docs)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("xxhash64") < 80  # one expression for the whole walk held 200
