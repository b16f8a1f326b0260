"""Greedy word-piece token counts by a longest-match automaton (op 3).

The vocabulary is a trie.  Each node knows how many tokens longest-match-first
pops when the text stops fitting there, and the node at which matching goes on
(its failure link), so that a word is counted in one pass over its symbols,
without building a piece or going back.  Counts equal those of greedy
longest-match word-piece splitting.

Symbols may be bytes or characters: pieces and words are sequences of one kind.
Pieces that start with ``prefix`` go on inside a word; without a prefix every
piece may stand anywhere.  A word that cannot be split counts as one unknown.

``count_tokens`` cuts texts at ASCII white space; words carry a leading space
as in byte-level vocabularies.  The driver reads the vocabulary file (its size
is checked against ``MAX_PIECES``), and its flat automaton is broadcast.

Defined results: null and empty texts have no words and no tokens; repeated
rows give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PIECES = 2_000_000
CACHED = 400_000
SHORT = 48


class Automaton:
    """Nodes are numbers; ``edges`` maps (node, symbol) to a node."""

    def __init__(self, pieces: Iterable, prefix=None):
        self.edges: dict = {}
        self.start = 0
        self.inside = 1 if prefix else 0
        count = self.inside + 1
        ends: set[int] = set()
        for piece in pieces:
            at = self.start
            if prefix and piece.startswith(prefix):
                at, piece = self.inside, piece[len(prefix):]
            if not piece:
                continue
            for symbol in piece:
                to = self.edges.get((at, symbol))
                if to is None:
                    to = self.edges[(at, symbol)] = count
                    count += 1
                at = to
            ends.add(at)
        # breadth first: the links of shorter strings are known before longer ones need them
        children: dict[int, list] = {}
        for (at, symbol), to in self.edges.items():
            children.setdefault(at, []).append((symbol, to))
        self.fail = [-1] * count
        self.pops = [0] * count
        queue = deque({self.start, self.inside})
        while queue:
            at = queue.popleft()
            for symbol, to in children.get(at, ()):
                queue.append(to)
                if to in ends:
                    self.fail[to], self.pops[to] = self.inside, 1
                    continue
                z, n = self.fail[at], self.pops[at]
                while z >= 0 and (z, symbol) not in self.edges:
                    n += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[to], self.pops[to] = self.edges[z, symbol], n

    def count(self, word) -> int:
        """Tokens of one word; 1 for a word that cannot be split, 0 for none."""
        if not word:
            return 0
        edges, fail, pops = self.edges, self.fail, self.pops
        at, n = self.start, 0
        for symbol in word:
            to = edges.get((at, symbol))
            while to is None:
                n += pops[at]
                at = fail[at]
                if at < 0:
                    return 1
                to = edges.get((at, symbol))
            at = to
        while at != self.inside:
            n += pops[at]
            at = fail[at]
            if at < 0:
                return 1
        return n


def read_ranked_vocabulary(path: str) -> list[bytes]:
    """Byte pieces of a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        pieces = [base64.b64decode(x.split()[0]) for x in lines if x.strip()]
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"{len(pieces)} pieces; the automaton is broadcast and takes {MAX_PIECES}")
    return pieces


class _Counts(dict):
    """Token counts by word; long words are counted without being kept."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(b" " + word)
        if len(word) <= SHORT:
            if len(self) >= CACHED:
                self.clear()
            self[word] = n
        return n


def count_tokens(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """doc_id, n_words, n_tokens and max_word_tokens per document."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(shared.value)
        for batch in batches:
            out = np.zeros((3, len(batch)), dtype=np.int64)
            for k, text in enumerate(batch.column("text")):
                each = [counts[w] for w in (text.as_py() or "").encode().split()]
                out[:, k] = len(each), sum(each), max(each, default=0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x) for x in out]],
                                             ["doc_id", "n_words", "n_tokens", "max_word_tokens"])

    thin = docs.select("doc_id", F.col("text").cast("string"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return thin.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, max_word_tokens long")
