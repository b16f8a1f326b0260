import random

import pytest
from tokenizers import Tokenizer
from tokenizers.models import WordPiece

from skuflow.llm import tokencount as T


def word_piece(pieces, prefix):
    vocabulary = {v: k for k, v in enumerate([*pieces, "[UNK]"])}
    return Tokenizer(WordPiece(vocabulary, unk_token="[UNK]", continuing_subword_prefix=prefix,
                               max_input_chars_per_word=10**6))


@pytest.mark.parametrize("prefix", ["##", ""])
def test_counts_equal_longest_match_splitting(prefix):
    rng = random.Random(4)

    def some(n, before=""):
        return {before + "".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(n)}

    for _ in range(150):
        pieces = sorted(some(rng.randint(2, 12)) | (some(rng.randint(2, 12), prefix) if prefix else set()))
        ours, theirs = T.Automaton(pieces, prefix or None), word_piece(pieces, prefix)
        for w in ["".join(rng.choices("abcd", [9, 9, 9, 1], k=rng.randint(1, 16))) for _ in range(40)]:
            assert ours.count(w) == len(theirs.encode(w).ids), (pieces, w)


def test_long_words_take_one_pass():
    a = T.Automaton(["a", "##a", "##aaaa"], "##")
    assert a.count("a" * 1_000_001) == 1 + 250_000 and a.count("") == 0
    assert T.Automaton(["a", "##a"], "##").count("a" * 1000 + "b") == 1  # unknown


BYTES = [bytes([k]) for k in range(256)] + [b" th", b" the", b"he", b"ing", b" a"]


def greedy(word):
    n = 0
    while word:
        cut = next(k for k in range(len(word), 0, -1) if word[:k] in BYTES)
        word, n = word[cut:], n + 1
    return n


def test_documents(make_docs):
    rows = [(1, "the thing a"), (2, ""), (3, None), (4, " \t\n"), (5, "the"), (5, "the"), (None, "é\u00a0x"),
            (6, "thing " * 5000)]
    docs = make_docs(rows).withColumnRenamed("lang", "n_words")
    got = T.count_tokens(docs, T.Automaton(BYTES)).collect()
    want = []
    for i, t in rows:
        each = [greedy(b" " + w) for w in (t or "").encode().split()]
        want.append((i, len(each), sum(each), max(each, default=0)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert T.count_tokens(make_docs([]), T.Automaton(BYTES)).collect() == []


def test_the_table_of_words_may_be_emptied(make_docs, monkeypatch):
    counts = T._Counts(T.Automaton(BYTES))
    monkeypatch.setattr(T, "CACHED", 3)
    words = [b"the", b"a", b"thing", b"zz", b"the", b"q"]
    assert [counts[w] for w in words] == [greedy(b" " + w) for w in words] and len(counts) <= 3
