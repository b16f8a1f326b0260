"""Toxicity categories by a classifier chain (op 8).

Categories are predicted one after another by linear models over the words of
a text; each later model also sees the earlier categories' probabilities.  For
training these are out-of-fold predictions, so that a later model learns from
probabilities as uncertain as those it will meet.  Features are chosen inside
each fold as well.  A text is toxic from the probability on that has the best
F1 on out-of-fold rows.

A feature is a word or its beginning (``PREFIXES`` letters, for inflected and
made-up forms), hashed to ``HASHED`` places; its value is log2(1 + count).  Of
those a model keeps the ``FEATURES`` whose shares of toxic and other training
rows lie furthest apart.  The fit uses at most ``MAX_TOXIC`` toxic and
``MAX_CLEAN`` other labelled rows, those of the smallest hash of their id;
feature counts are made in Spark and only rows of chosen features reach the
driver.  Scoring reads every whole text and shuffles nothing.

Where labels name only ``toxic``, ``weak_categories`` adds two categories from
how much of a text the tell-tale features of toxic rows make up.

Defined results: texts without words (null, empty) have probability 0 in all
categories and are not toxic; repeated rows get equal results; without labels
of both values every probability is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from skuflow.llm.learning import logistic_fit, sigmoid

HASHED = 1 << 22
PREFIXES = (3, 4, 5, 6, 7, 8)
FEATURES = 300
LEAST_TOXIC = 3
MAX_TOXIC = 2500
MAX_CLEAN = 5000
FOLDS = 3
PENALTY = 0.5       # of a fit on FULL_ROWS rows or more; less on fewer
FULL_ROWS = 3000
LEAST_CUT = 0.3     # the threshold comes from out-of-fold rows, but is never lower
SEED = 88
CACHED = 400_000
CATEGORIES = ("severe", "frequent", "toxic")

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def places(word: str) -> set[int]:
    """Hashed features of one word."""
    raw = [word, *(f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n)]
    return {zlib.crc32(x.encode()) % HASHED for x in raw}


def feature_counts(text: str | None) -> Counter:
    found: Counter = Counter()
    for word, n in words_of(text).items():
        for p in places(word):
            found[p] += n
    return found


def choose(hot: np.ndarray, cold: np.ndarray, toxic: int, clean: int, features: int = FEATURES,
           least: int = LEAST_TOXIC) -> np.ndarray:
    """Positions of the features whose shares lie furthest apart, in standard
    errors; ``hot`` and ``cold`` count the rows that hold each feature."""
    p, q = hot / max(1, toxic), cold / max(1, clean)
    pooled = (hot + cold + 1) / (toxic + clean + 2)
    apart = np.abs(p - q) / np.sqrt(pooled * (1 - pooled))
    apart[hot < least] = -1
    best = np.argsort(-apart, kind="stable")[:features]
    return np.sort(best[apart[best] > 0])


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold with the best F1, in the middle of the gap that it may lie
    in, but not above 0.5."""
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    f1[:-1][p[1:] == p[:-1]] = -1  # equal probabilities cannot be parted
    k = len(f1) - 1 - int(np.argmax(f1[::-1]))
    below = p[k + 1] if k + 1 < len(p) else 0.0
    return float(min(0.5, (p[k] + below) / 2))


class Chain:
    """Linear links in the order of ``categories`` over the features ``chosen``.

    Each link's weights are those of the features, of the earlier
    probabilities, and the intercept."""

    def __init__(self, categories: Sequence[str], chosen: Sequence[int], links: Sequence[np.ndarray],
                 threshold: float):
        self.categories, self.chosen, self.links = tuple(categories), list(chosen), list(links)
        self.threshold = threshold

    @staticmethod
    def fit_link(x: np.ndarray, before: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
        width = x.shape[1] + before.shape[1] + 1
        if y.min() == y.max():
            w = np.zeros(width)
            w[-1] = 20.0 if y[0] > 0 else -20.0
            return w
        return logistic_fit(np.hstack([x, before, np.ones((len(x), 1))]), y,
                            penalty * min(1.0, (len(x) / FULL_ROWS) ** 0.5), steps=10)

    @staticmethod
    def predict(w: np.ndarray, x: np.ndarray, before: np.ndarray) -> np.ndarray:
        n = x.shape[1]
        return sigmoid(x @ w[:n] + before @ w[n:-1] + w[-1])

    @classmethod
    def fit(cls, categories: Sequence[str], x: np.ndarray, labels: np.ndarray, folds: np.ndarray,
            chosen: np.ndarray, by_fold: dict[int, np.ndarray], places_of: Sequence[int],
            penalty: float = PENALTY) -> Chain:
        """x: rows x places; ``chosen`` and ``by_fold`` select columns for the
        final links and for those that leave a fold out."""
        before = np.zeros((len(x), 0))
        links = []
        for c in range(len(categories)):
            y = labels[:, c]
            links.append(cls.fit_link(x[:, chosen], before, y, penalty))
            out = np.zeros(len(x))
            for f in np.unique(folds):
                away, use = folds == f, by_fold[int(f)]
                rest = ~away if not away.all() else away
                w = cls.fit_link(x[rest][:, use], before[rest], y[rest], penalty)
                out[away] = cls.predict(w, x[away][:, use], before[away])
            before = np.hstack([before, out[:, None]])
        return cls(categories, [places_of[k] for k in chosen], links, best_cut(before[:, -1], labels[:, -1]))

    def scorer(self):
        """text -> probabilities.  The chosen features of words are kept in a
        table, emptied when it holds ``CACHED`` words."""
        at = {p: k for k, p in enumerate(self.chosen)}
        n = len(self.chosen)
        weights = np.stack([w[:n] for w in self.links])
        kept: dict[str, tuple[int, ...]] = {}

        def score(text: str | None) -> list[float]:
            words = words_of(text)
            if not words:
                return [0.0] * len(self.links)
            x = np.zeros(n)
            for word, count in words.items():
                hit = kept.get(word)
                if hit is None:
                    if len(kept) >= CACHED:
                        kept.clear()
                    hit = kept[word] = tuple(at[p] for p in places(word) if p in at)
                for k in hit:
                    x[k] += count
            z = weights @ np.log2(1 + x)
            out: list[float] = []
            for c, w in enumerate(self.links):
                total = z[c] + sum(w[n + j] * p for j, p in enumerate(out)) + w[-1]
                out.append(round(float(sigmoid(total)), 6))
            return out

        return score


def weak_categories(x: np.ndarray, words: np.ndarray, toxic: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Columns severe, frequent and toxic: toxic rows whose tell-tale features,
    against their number of words, reach the upper quartile, and those that
    hold at least the median's number of them."""
    w = Chain.fit_link(x, np.zeros((len(x), 0)), toxic, penalty)
    hits = (x[:, np.flatnonzero(w[:-1] > 0.1)] > 0).sum(axis=1)
    part, bad = hits / np.maximum(1, words), toxic == 1
    severe = bad & (part >= np.quantile(part[bad], 0.75))
    frequent = bad & (hits >= np.median(hits[bad]))
    return np.stack([severe, frequent, bad], axis=1).astype(float)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_toxic: int, max_clean: int, folds: int,
                    seed: int) -> DataFrame:
    """id, y, fold and text of the rows to learn from."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y")).distinct()
    order: Column = F.xxhash64(F.lit(seed), "id")
    picks = [known.where(F.col("y") == y).orderBy(order, "id").limit(most)
             for y, most in ((1, max_toxic), (0, max_clean))]
    sample = picks[0].unionAll(picks[1]).withColumn("fold", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(folds)).cast("int"))
    return docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select(
        F.col("id").cast("string").alias("id"), "y", "fold", F.col("text").cast("string").alias("text"))


def fit_chain(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN,
              folds: int = FOLDS, seed: int = SEED, features: int = FEATURES) -> Chain | None:
    """The chain for ``labels`` (doc_id, toxic); None without both values."""
    sample = labelled_sample(docs, labels, max_toxic, max_clean, folds, seed)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held: dict[tuple[int, int], Counter] = {}
            for y, fold, text in zip(batch["y"], batch["fold"], batch["text"]):
                held.setdefault((y, fold), Counter()).update(feature_counts(text).keys())
            for (y, fold), c in held.items():
                yield pd.DataFrame({"place": list(c), "n": list(c.values()), "y": y, "fold": fold})

    sums = [F.sum(F.when((F.col("y") == y) & (F.col("fold") == f), F.col("n")).otherwise(0)).alias(f"n{y}_{f}")
            for y in (1, 0) for f in range(folds)]
    hot = sum(F.col(f"n1_{f}") for f in range(folds))
    counted = (sample.mapInPandas(count, "place int, n long, y int, fold int").groupBy("place").agg(*sums)
               .where(hot >= LEAST_TOXIC).toPandas().sort_values("place"))
    sizes = {(r["y"], r["fold"]): r["n"] for r in sample.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = {y: sum(n for (t, _), n in sizes.items() if t == y) for y in (0, 1)}
    if not totals[0] or not totals[1]:
        return None
    held = {y: np.stack([counted[f"n{y}_{f}"].to_numpy() for f in range(folds)]) for y in (0, 1)}
    every = choose(held[1].sum(axis=0), held[0].sum(axis=0), totals[1], totals[0], features)
    fold_choice = {f: choose(held[1].sum(axis=0) - held[1][f], held[0].sum(axis=0) - held[0][f],
                             totals[1] - sizes.get((1, f), 0), totals[0] - sizes.get((0, f), 0), features)
                   for f in range(folds)}
    union = np.unique(np.concatenate([every, *fold_choice.values()]))
    names = counted["place"].to_numpy()[union].tolist()
    at = {p: k for k, p in enumerate(names)}

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            each = [feature_counts(t) for t in batch["text"]]
            yield pd.DataFrame({
                "id": batch["id"], "y": batch["y"], "fold": batch["fold"],
                "words": [len(words_of(t)) for t in batch["text"]],
                "k": [[at[p] for p in c if p in at] for c in each],
                "v": [[float(n) for p, n in c.items() if p in at] for c in each]})

    got = sample.mapInPandas(rows, "id string, y int, fold int, words int, k array<int>, v array<double>").toPandas()
    got = got.assign(n=got["k"].map(len)).sort_values(["id", "y", "words", "n"], kind="stable", ignore_index=True)
    x = np.zeros((len(got), len(names)))
    for r, (k, v) in enumerate(zip(got["k"], got["v"])):
        x[r, np.asarray(k, dtype=int)] = np.log2(1 + np.asarray(v, dtype=float))
    toxic = got["y"].to_numpy(dtype=float)
    chosen = np.searchsorted(union, every)
    categories = weak_categories(x[:, chosen], got["words"].to_numpy(), toxic)
    return Chain.fit(CATEGORIES, x, categories, got["fold"].to_numpy(), chosen,
                     {f: np.searchsorted(union, c) for f, c in fold_choice.items()}, names)


def _scored(docs: DataFrame, chain: Chain | None, carry: Sequence[str]) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, so that no name can clash)
    and a probability per category."""
    kinds = [f"p_{c}" for c in CATEGORIES]
    inside = "text" in carry  # then it need not travel twice
    row = docs.select(F.struct(*carry).alias("row"), *([] if inside else [F.col("text").cast("string")]))
    if chain is None:
        return row.select("row", *[F.lit(0.0).alias(n) for n in kinds])
    schema = StructType([row.schema["row"], *[StructField(n, DoubleType()) for n in kinds]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = chain.scorer()
        for batch in batches:
            rows = batch.column("row")
            texts = pc.struct_field(rows, "text") if inside else batch.column("text")
            p = np.array([score(t.as_py()) for t in texts], dtype=float).reshape(-1, len(kinds))
            yield pa.RecordBatch.from_arrays([rows, *[pa.array(x) for x in p.T]], ["row", *kinds])

    return row.mapInArrow(run, schema)


def _is_toxic(chain: Chain | None) -> Column:
    return F.lit(False) if chain is None else F.col("p_toxic") >= max(chain.threshold, LEAST_CUT)


def score_toxicity(docs: DataFrame, chain: Chain | None, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry`` columns of ``docs``, p_severe, p_frequent, p_toxic and toxic."""
    return _scored(docs, chain, carry).select(
        "row.*", *[f"p_{c}" for c in CATEGORIES], _is_toxic(chain).alias("toxic"))


def clean_documents(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their own columns."""
    return _scored(docs, chain, docs.columns).where(~_is_toxic(chain)).select("row.*")
