"""Conversation structure repair by a lightest-derivation agenda (op 11).

A conversation's rows, by turn, are edited until their role initials read
``(s?(ua)+)?``.  Keep costs 0, rerole (to user or assistant) 1, delete 2, insert
(an empty user or assistant turn, anywhere) 5.  Blank rows and repeats of an
earlier role and text must go; a truncated row that stays costs 5 more.  Of the
cheapest repairs, the one whose edits' initials are least in ASCII is taken.

The repairs are derivations of a weighted hypergraph.  Its items are stretches
of rows that lead from one state of the role pattern to another; hyperedges join
two neighbouring stretches, the halves of a balanced tree over the rows, and at
the leaves an insertion gap and a row's edit.  Weights are (cost, height,
audit): costs add up, audits are joined.  Both only grow along a hyperedge,
and an item's derivations all have one height, so the functions are superior and
monotone (of two audits of one item at one cost neither begins the other: they
hold a letter for each row, and each insertion costs).  So the agenda of Knuth
(1977) finalises every item when it is first popped, and ends at the goal.  A
conversation of n rows has 16 items a node, O(n) in all, and the agenda pops
those that are no dearer than the goal.

On Spark: faults that a row shows by itself are found by column expressions.
Thin rows (turn, initial, flags and hashes; no text) are shuffled by
conversation and sorted, and a worker reads them in order and gives one row a
conversation.  That row is sorted before the conversation's texts in a second
shuffle, in which a worker walks along the edits and hashes one text at a time.
A worker holds about 100 bytes a row of one conversation, never its texts.  A
conversation is read by one task in either pass: its SHA-256 and its audit are
single values in the order of its rows.

Defined results: a null role or text counts as one space (such a text is
blank); a null conv_id is a conversation of its own; rows of one turn stand by
role and then a hash of the text; an empty table gives an empty result; a
conversation of no rows is unchanged; texts of any length are streamed; other
columns of the table are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.streams import batches_of, rows_of

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States of the pattern: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = {"s": [(START, AFTER_S)], "u": [(START, AFTER_U), (AFTER_S, AFTER_U), (AFTER_A, AFTER_U)],
        "a": [(AFTER_U, AFTER_A)]}
FINAL = (START, AFTER_A)
LEGAL = ("su", "ua", "au")
WHITE = " \t\n\v\f\r"
STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

Weight = tuple[int, int, str]  # cost, height of the derivation, audit


# ---- the agenda ---------------------------------------------------------------

def lightest(axioms: Iterable[tuple], edges: Callable, goal=None) -> dict:
    """Knuth's agenda: items by weight, each final when first popped.
    ``edges(item, final)`` gives (head, weight) of the hyperedges whose tails are
    all final now that ``item`` is.  Ends when ``goal`` is final, or empty."""
    agenda, final = [(weight, item) for item, weight in axioms], {}
    heapq.heapify(agenda)
    while agenda:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if item == goal:
            break
        for head, derived in edges(item, final):
            if head not in final:
                heapq.heappush(agenda, (derived, head))
    return final


def _join(a: Weight, b: Weight, height: int) -> Weight:
    return a[0] + b[0], height, a[2] + b[2]


def _edits(code: str) -> list[tuple]:
    """Axioms of a row: ("edit", from, to) and its weight.  ``x`` must be deleted,
    a capital is a truncated row, ``$`` is the end of the conversation."""
    stay = [(p, p) for p in range(4)]
    if code == "$":
        return [(("edit", *pq), (0, 0, "")) for pq in stay]
    out = [(("edit", *pq), (DELETE, 0, "D")) for pq in stay]
    if code != "x":
        more = TRUNCATED if code.isupper() else 0
        out += [(("edit", *pq), (KEEP + more, 0, "K")) for pq in STEP.get(code.lower(), [])]
        out += [(("edit", *pq), (REROLE + more, 0, "R")) for r in "ua" for pq in STEP[r]]
    return out


def _leaf(code: str) -> list[tuple[int, int, Weight]]:
    """(from, to, weight) of a row with any insertions before it."""
    axioms = _edits(code) + [(("gap", p, p), (0, 0, "")) for p in range(4)]
    insert = [pq for r in "ua" for pq in STEP[r]]

    def edges(item, final):
        kind, p, q = item
        if kind == "gap":
            for at, to in insert:
                if at == q:
                    yield ("gap", p, to), _join(final[item], (INSERT, 0, "I"), 0)
            for r in range(4):
                if ("edit", q, r) in final:
                    yield ("leaf", p, r), _join(final[item], final["edit", q, r], 1)
        elif kind == "edit":
            for m in range(4):
                if ("gap", m, p) in final:
                    yield ("leaf", m, q), _join(final["gap", m, p], final[item], 1)

    return [(p, q, w) for (kind, p, q), w in lightest(axioms, edges).items() if kind == "leaf"]


LEAVES = {code: _leaf(code) for code in "xsuaoSUAO$"}


def repair(codes: str) -> tuple[int, str]:
    """Cost and audit of the lightest repair of rows given by their codes."""
    leaves = codes + "$"
    up: dict[int, tuple[int, int, bool]] = {}  # child -> parent, sibling, whether the child is left
    height = [1] * len(leaves)
    level = list(range(len(leaves)))
    while len(level) > 1:
        above = []
        for k in range(0, len(level) - 1, 2):
            left, right = level[k:k + 2]
            node = len(height)
            height.append(max(height[left], height[right]) + 1)
            up[left], up[right] = (node, right, True), (node, left, False)
            above.append(node)
        level = above + (level[-1:] if len(level) % 2 else [])
    root = level[0]
    axioms = [((k, p, q), w) for k, code in enumerate(leaves) for p, q, w in LEAVES[code] if k or p == START]
    goal = (-1, START, START)

    def edges(item, final):
        node, p, q = item
        if node == root:
            if p == START and q in FINAL:
                yield goal, (final[item][0], height[root] + 1, final[item][2])
            return
        parent, sibling, is_left = up[node]
        for m in range(4):
            if is_left and (sibling, q, m) in final:
                yield (parent, p, m), _join(final[item], final[sibling, q, m], height[parent])
            elif not is_left and (sibling, m, p) in final:
                yield (parent, m, q), _join(final[sibling, m, p], final[item], height[parent])

    cost, _, audit = lightest(axioms, edges, goal)[goal]
    return cost, audit


# ---- rows ---------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``live`` after the damage fixed by the
    checksum of ``conv_id:turn``; a dropped row stays, with ``live`` false, so that
    its conversation is known."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return (conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("live"), F.when(kind == 3, 2).otherwise(1).alias("times"))
        .withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times"))


def _ordered(turns: DataFrame) -> DataFrame:
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    live = F.col("live") if "live" in turns.columns else F.lit(True)
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        text.alias("text"), F.coalesce(live, F.lit(True)).alias("live"),
                        F.xxhash64(role, text).alias("hash"))


ORDER = ("conv_id", "turn", "role", "hash")  # Spark sorts nulls first


def audits(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit per
    conversation of ``turns`` (conv_id, turn, role, text, and perhaps ``live``)."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    second = F.xxhash64("text", "role", F.lit(1))  # with ``hash``, 128 bits
    thin = _ordered(turns).select(
        "conv_id", "turn", "role", "hash", "live", second.alias("hash2"), (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"))
    conv_id = turns.schema["conv_id"].dataType.simpleString()
    return (thin.repartition("conv_id").sortWithinPartitions(*ORDER)
            .mapInArrow(partial(_with_key, _audit_rows), f"conv_id {conv_id}, {', '.join(f'{c} long' for c in STATS)}, audit string"))


def _audit(rows: Iterable[tuple], short: Callable) -> tuple:
    seen, codes, faults = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    low = high = before = at = None
    distinct = illegal = 0
    for _, turn, role, one, live, two, blank, cut in rows:
        if not live:
            continue
        if turn is not None:
            if turn != at:
                distinct += 1
            low, high, at = turn if low is None else low, turn, turn
        initial = role[:1]
        illegal += before is not None and before + initial not in LEGAL
        before = initial
        fault = "blank" if blank else "duplicate" if (one, two) in seen else "truncated" if cut else None
        seen.add((one, two))
        if fault:
            faults[fault] += 1
        code = initial if initial in ("s", "u", "a") else "o"
        codes.append("x" if fault in ("blank", "duplicate") else code.upper() if fault else code)
    cost, audit = (short if len(codes) <= 64 else repair)("".join(codes))
    gaps = 0 if low is None else high - low + 1 - distinct
    return gaps, *faults.values(), illegal, cost, audit


def _audit_rows(batches: Iterator[pa.RecordBatch], key: pa.DataType) -> Iterator[pa.RecordBatch]:
    short = lru_cache(maxsize=1 << 16)(repair)  # most conversations are short and look alike
    out = ((conv, *_audit(rows, short)) for conv, rows in groupby(rows_of(batches), key=lambda r: r[0]))
    yield from batches_of(out, ["conv_id", *STATS, "audit"],
                          [key, *[pa.int64()] * len(STATS), pa.string()], text=-1)


def _walk(audit: str, rows: Iterator[tuple]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired rows; ``rows`` gives (role, text)."""
    state = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == AFTER_U else "user"
        state = next(q for p, q in STEP[role[:1]] if p == state)
        yield edit, role, text


def _second_pass(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan row, then its rows in order."""
    none = [F.lit(None).cast("long").alias(c) for c in STATS]
    rows = _ordered(turns).where("live").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "hash", "text", *none, F.lit(None).cast("string").alias("audit"))
    heads = plans.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("long").alias("hash"), F.lit(None).cast("string").alias("text"), *STATS, "audit")
    return (heads.unionByName(rows).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", *ORDER[1:]))


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(plan row, its repaired rows) by conversation."""
    for _, rows in groupby(rows_of(batches), key=lambda r: r[0]):
        head = next(rows)
        yield head, _walk(head[-1], ((r[3], r[5]) for r in rows))


def repaired_turns(turns: DataFrame, plans: DataFrame | None = None) -> DataFrame:
    """conv_id, position (from 0), role, text and edit (K, R or I) of every
    repaired row."""
    plans = audits(turns) if plans is None else plans
    conv_id = turns.schema["conv_id"].dataType.simpleString()
    return _second_pass(turns, plans).mapInArrow(
        partial(_with_key, _turn_rows), f"conv_id {conv_id}, position long, role string, text string, edit string")


def repaired_digests(turns: DataFrame, plans: DataFrame | None = None) -> DataFrame:
    """The columns of ``audits`` and the SHA-256 of the repaired rows as
    ``role:text`` joined by newlines."""
    plans = audits(turns) if plans is None else plans
    conv_id = turns.schema["conv_id"].dataType.simpleString()
    return _second_pass(turns, plans).mapInArrow(
        partial(_with_key, _digest_rows),
        f"conv_id {conv_id}, {', '.join(f'{c} long' for c in STATS)}, audit string, repaired_sha256 string")


def _with_key(run: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(batches, None)
    if first is not None:
        def again():
            yield first
            yield from batches
        yield from run(again(), first.schema.field(0).type)


def _turn_rows(batches, key: pa.DataType) -> Iterator[pa.RecordBatch]:
    rows = ((head[0], at, role, text, edit) for head, walked in _walked(batches)
            for at, (edit, role, text) in enumerate(walked))
    yield from batches_of(rows, ["conv_id", "position", "role", "text", "edit"],
                          [key, pa.int64(), pa.string(), pa.string(), pa.string()], text=3)


def _digest_rows(batches, key: pa.DataType) -> Iterator[pa.RecordBatch]:
    def digests():
        for head, walked in _walked(batches):
            digest = hashlib.sha256()
            for at, (_, role, text) in enumerate(walked):
                digest.update(f"{chr(10) if at else ''}{role}:{text}".encode())
            yield head[0], *head[6:], digest.hexdigest()
    yield from batches_of(digests(), ["conv_id", *STATS, "audit", "repaired_sha256"],
                          [key, *[pa.int64()] * len(STATS), pa.string(), pa.string()], text=-2)
