"""Document quality by Bradley-Terry pairwise ranking (op 5).

Every labelled document of label 1 is preferred to every one of label 0; a
logistic loss on the differences of their features gives weights, and a
document's score is its features' weighted sum.  The threshold is the quantile
of all labelled documents' scores at the share of label 0 among them.  Scores
are then mapped to 0..1 so that the threshold falls on ``CUT``.

Features are counts and shares over the whole text: case, symbols, repeated
words and lines, variety of words and characters.  Label, language, source and
id are never features.  The fit uses all labelled rows that are not held out and
all their pairs, in time linear in the rows: the loss depends on a pair by its
two scores only, so powers of the scores, summed per bin of width ``BIN`` and
label, give the sum over all pairs by a Taylor series (relative error below
1e-8).  A Newton step is two passes over the written features; the driver gets
sums per bin, and no rows.  Features are made once per document and shared by
fit and scoring.

Defined results: null and empty texts have all features 0 and get the score
that follows from them; repeated rows get equal scores; with labels of one
value only, or none, every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.learning import sigmoid
from skuflow.session import materialize

PAIRS = 40_000      # weight of the mean loss of all pairs against the penalty
PENALTY = 1.0
CUT = 0.7
NARROW = 16
BIN = 0.125
ORDER = 6           # of the last derivative of the loss in the series
STEPS = 60
SPLITS = 1024       # parts of an interval that one pass of the quantile search counts

_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTER = re.compile(r"[^\W\d_]")
_DIGIT = re.compile(r"\d")
_PLAIN_MARK = re.compile(r"[.,;:?'\"()-]")
_SYMBOL = re.compile(r"[^\w\s.,;:?'\"()-]")


def text_features(text: str | None) -> np.ndarray:
    """Features of one whole text, in time linear in its length."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(NARROW)
    chars = sum(map(len, words))
    letters = max(1, len(_LETTER.findall(text)))
    upper = len(_UPPER.findall(text)) / letters
    symbols = _SYMBOL.findall(text)
    seen = Counter(words)
    top = max(seen.values()) / n
    repeats = sum(map(str.__eq__, words, words[1:])) / n
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    triples = len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2)
    lines = [x for x in text.split("\n") if x.strip()]
    lines_new = len(set(lines)) / max(1, len(lines))
    return np.array([
        math.log1p(n), chars / n, math.log1p(max(map(len, seen))), upper,
        len(symbols) / chars, len(_DIGIT.findall(text)) / chars, len(_PLAIN_MARK.findall(text)) / chars,
        len(seen) / n, top, repeats, pairs, triples, lines_new, math.log1p(n / max(1, len(lines))),
        len(set(symbols)) / (1 + math.log1p(n)), letters / chars])


def _wide(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -6, 6)
    return np.hstack([z, z * z])


class Ranking:
    """A fitted scorer; small, shipped to the tasks with their function.
    Without weights every score is 0.5."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray | None, threshold: float = 0.0,
                 cut: float = CUT):
        self.mean, self.scale, self.weights, self.threshold = mean, scale, weights, threshold
        self.shift = math.log(cut / (1 - cut))

    def wide(self, x: np.ndarray) -> np.ndarray:
        return _wide(x, self.mean, self.scale)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.round(sigmoid(self.wide(x) @ self.weights - self.threshold + self.shift), 9)


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; false for a null id."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _matrix(x: pd.Series) -> np.ndarray:
    return np.array(x.tolist(), dtype=float).reshape(-1, NARROW)


def document_features(docs: DataFrame) -> DataFrame:
    """doc_id and x, the features of its whole text; written once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [text_features(t) for t in batch["text"]]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialize(docs.select("doc_id", F.col("text").cast("string")).mapInPandas(
        run, f"doc_id {kind}, x array<double>"), "quality-features")


Sums = dict[int, np.ndarray]


def _summed(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray]]],
            width: int) -> Sums:
    """The vectors of ``width`` numbers that ``part`` gives for x and y, summed by
    their key, first within a task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: Sums = {}
        for batch in batches:
            for key, v in part(_matrix(batch["x"]), batch["y"].to_numpy(dtype=float)):
                sums[key] = sums[key] + v if key in sums else v
        yield pd.DataFrame({"key": np.array(list(sums), dtype=np.int64), "v": [v.tolist() for v in sums.values()]})

    got = (rows.mapInPandas(run, "key long, v array<double>").groupBy("key")
           .agg(F.array(*[F.sum(F.col("v")[i]) for i in range(width)]).alias("v")).collect())
    return {r["key"]: np.array(r["v"]) for r in sorted(got, key=lambda r: r["key"])}


def _loss_slopes(t: np.ndarray) -> list[np.ndarray]:
    """log(1 + exp(t)) and its derivatives up to ``ORDER``."""
    p, found = sigmoid(t), [np.logaddexp(0.0, t)]
    of = np.polynomial.Polynomial([0, 1])
    for _ in range(ORDER):
        found.append(of(p))
        of = of.deriv() * np.polynomial.Polynomial([0, 1, -1])
    return found


class PairSums:
    """Sums over all pairs of a document of label 1 (score s) and one of label 0
    (score t) of the loss log(1 + exp(t - s)), from powers of the scores' distances
    to the centres of their bins."""

    def __init__(self, moments: Sums):
        self.bins = [np.array([k >> 1 for k in moments if k & 1 == y], dtype=np.int64) for y in (0, 1)]
        held = [np.array([v for k, v in moments.items() if k & 1 == y]) for y in (0, 1)]
        sign = (-1.0) ** np.arange(ORDER + 1)
        #: per label, bin and order: the loss' derivatives at the bin's centre, summed over the other label's rows
        self.table = [np.zeros((len(b), ORDER + 1)) for b in self.bins]
        for y in (0, 1):
            other = held[1 - y] * (sign if y == 0 else 1.0)
            for at in range(0, len(self.bins[y]), 256):
                gap = (self.bins[y][at:at + 256, None] - self.bins[1 - y][None, :]) * BIN
                slopes = _loss_slopes(gap if y == 0 else -gap)
                for q in range(ORDER + 1):
                    self.table[y][at:at + 256, q] = sum(slopes[q + k] @ other[:, k] for k in range(ORDER + 1 - q))
        self.counts = [h[:, 0] for h in held]
        self.pairs = self.counts[0].sum() * self.counts[1].sum()
        self.loss = float((self.table[1] * held[1] * sign).sum() / self.pairs)

    @staticmethod
    def placed(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A score's bin, and its distance to the bin's centre."""
        bins = np.rint(scores / BIN).astype(np.int64)
        return bins, scores - bins * BIN

    def weights(self, y: int, scores: np.ndarray) -> np.ndarray:
        """Per document of label ``y`` the loss' first derivatives, summed over its
        pairs."""
        bins, off = self.placed(scores)
        table = self.table[y][np.searchsorted(self.bins[y], bins)]
        off = off if y == 0 else -off
        return sum(table[:, 1 + k] * off ** k / math.factorial(k) for k in range(ORDER))

    def curves(self) -> list[np.ndarray]:
        """Per label and bin the second derivatives at its centre, summed over the
        other label's rows."""
        return [self._curve(y) @ self.counts[1 - y] for y in (0, 1)]

    def _curve(self, y: int) -> np.ndarray:
        p = sigmoid((self.bins[y][:, None] - self.bins[1 - y][None, :]) * BIN)
        return p * (1 - p)

    def crossed(self, of: list[np.ndarray]) -> np.ndarray:
        """Sum over pairs of second derivatives times the outer product of the
        rows' vectors, given as sums per label and bin."""
        return of[0].T @ self._curve(0) @ of[1]


def _fit_weights(rows: DataFrame, model: Ranking, pairs: int, penalty: float) -> np.ndarray:
    """Newton's method with halving on the mean loss of all pairs."""
    width = 2 * NARROW
    wide = model.wide

    def sums_at(w: np.ndarray) -> PairSums:
        def part(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            bins, off = PairSums.placed(wide(x) @ w)
            keys, at = np.unique(bins * 2 + (y > 0), return_inverse=True)
            powers = [np.bincount(at, off ** k / math.factorial(k), len(keys)) for k in range(ORDER + 1)]
            yield from zip(keys.tolist(), np.stack(powers, axis=1))
        return PairSums(_summed(rows, part, ORDER + 1))

    def slope_and_curve(w: np.ndarray, sums: PairSums) -> tuple[np.ndarray, np.ndarray]:
        first = -4 * (int(max(np.abs(b).max() for b in sums.bins)) + 2)  # below any bin's key
        curves = sums.curves()

        def part(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            z = wide(x)
            scores = z @ w
            for label in (0, 1):
                mine = (y > 0) == bool(label)
                if not mine.any():
                    continue
                own, bins = z[mine], sums.placed(scores[mine])[0]
                at = np.searchsorted(sums.bins[label], bins)
                slope = sums.weights(label, scores[mine])
                yield first, own.T @ slope * (1 if label == 0 else -1)
                yield from zip(range(first + 1, first + 1 + width), (own * curves[label][at, None]).T @ own)
                used, at = np.unique(bins, return_inverse=True)
                total = np.stack([np.bincount(at, column, len(used)) for column in own.T], axis=1)
                yield from zip((used * 2 + label).tolist(), total)

        got = _summed(rows, part, width)
        crossed = sums.crossed([np.stack([got[int(b) * 2 + y] for b in sums.bins[y]]) for y in (0, 1)])
        curve = np.stack([got[first + 1 + k] for k in range(width)]) - crossed - crossed.T
        return got[first] / sums.pairs, curve / sums.pairs

    w = np.zeros(width)
    sums = sums_at(w)
    now = pairs * sums.loss
    for _ in range(STEPS):
        slope, curve = slope_and_curve(w, sums)
        step = np.linalg.solve(pairs * curve + penalty * np.eye(width), pairs * slope + penalty * w)
        size, before = 1.0, now
        while size > 1e-6:
            there = w - size * step
            sums = sums_at(there)
            now = pairs * sums.loss + 0.5 * penalty * float(there @ there)
            if now <= before:
                break
            size /= 2
        else:
            break
        w = there
        if before - now < 1e-7 * max(1.0, before):
            break
    return w


def ranked_value(scores: DataFrame, rank: int) -> float:
    """The value of 0-based ``rank`` in the column ``s``, exactly: each pass counts
    the parts of an interval and goes on in the one that holds the rank."""
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    while low < high:
        part = F.least(F.floor((F.col("s") - low) / (high - low) * SPLITS), F.lit(SPLITS - 1))
        parts = (scores.where(F.col("s").between(low, high)).groupBy(part.alias("part"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("low"), F.max("s").alias("high"))
                 .orderBy("part").collect())
        for p in parts:
            if rank < p["n"]:
                break
            rank -= p["n"]
        low, high = p["low"], p["high"]
    return low


def fit_features(features: DataFrame, labels: DataFrame, label: str = "quality", pairs: int = PAIRS,
                 penalty: float = PENALTY, cut: float = CUT) -> Ranking:
    """Learn from all labelled rows that are not held out."""
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
             .select("doc_id", F.col(label).cast("double").alias("y")))
    rows = materialize(features.join(known, "doc_id").select("x", "y"), "quality-labelled")
    x = [F.col("x")[i] for i in range(NARROW)]
    sums = rows.agg(F.count_if(F.col("y") > 0).alias("good"), F.count_if(F.col("y") <= 0).alias("bad"),
                    F.array(*map(F.avg, x)).alias("mean"), F.array(*map(F.stddev_pop, x)).alias("scale")).first()
    if not sums["good"] or not sums["bad"]:
        return Ranking(np.zeros(NARROW), np.ones(NARROW), None)
    model = Ranking(np.array(sums["mean"]), np.maximum(np.array(sums["scale"]), 1e-6), None, cut=cut)
    weights = _fit_weights(rows, model, pairs, penalty)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"s": model.wide(_matrix(batch["x"])) @ weights})

    scores = materialize(rows.select("x").mapInPandas(score, "s double"), "quality-scores")
    n = sums["good"] + sums["bad"]
    place = sums["bad"] / n * (n - 1)
    below = ranked_value(scores, int(place))
    above = ranked_value(scores, min(int(place) + 1, n - 1)) if place > int(place) else below
    return Ranking(model.mean, model.scale, weights, below + (place - int(place)) * (above - below), cut)


def fit_ranking(docs: DataFrame, labels: DataFrame, label: str = "quality", pairs: int = PAIRS,
                penalty: float = PENALTY, cut: float = CUT) -> Ranking:
    return fit_features(document_features(docs), labels, label, pairs, penalty, cut)


def score_features(features: DataFrame, model: Ranking, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted per row of ``document_features``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.scores(_matrix(batch["x"]))})

    schema = f"doc_id {features.schema['doc_id'].dataType.simpleString()}, score double"
    return (features.mapInPandas(run, schema)
            .select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= cut).cast("int").alias("predicted")))


def score_documents(docs: DataFrame, model: Ranking, cut: float = CUT) -> DataFrame:
    return score_features(document_features(docs), model, cut)


def rank_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labels and score every document, from one pass over the texts."""
    features = document_features(docs)
    return score_features(features, fit_features(features, labels))
