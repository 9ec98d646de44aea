"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positive class; all other text is unlabelled, never taken for clean. With the
class prior p, the risk of a scorer z under the logistic loss is p E_pos[loss(z)] plus the negative part
E_unl[loss(-z)] - p E_pos[loss(-z)]; when that part falls below zero the step goes the other way, so the scorer
can't overfit it. The scorer is linear over the words and word beginnings that a document holds (beginnings, as
an inflected or compounded insult shares its stem alone; also whether two, three or five of its words share one), trained in numpy on the driver. Near copies in a training
sample, told by equal triples of least hashes of their long words, count once, else the words of a much copied toxic document look toxic.

Bounds, all parameters: at most ``POSITIVES`` toxic and ``UNLABELLED`` documents of any kind are read for training (those
of least hash of the doc_id; one row of each, and none of more than ``LONGEST`` characters, so the driver holds 80 million at most), and ``FEATURES`` features stay, those whose shares in the two samples differ most for
their standard error, of those whose documents are toxic in half the cases or more by the prior and the two shares. Scoring reads every whole text.

Defined results: null and empty texts are scored too (by the bias alone); repeated rows score alike; without labelled
positives every score is 0; nulls in labels and rows without a document are left out of training; an empty table gives no
rows. Only the id, text and label columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, table

POSITIVES = 1000
UNLABELLED = 3000
FEATURES = 400
#: Characters of a document that is trained on, at most.
LONGEST = 20_000
#: Standard errors by which a feature's shares must differ, and toxic documents that must hold it.
DIFFERENCE, LEAST = 5.0, 4
#: Lengths of the word beginnings that are features.
STEMS = (4, 5, 6, 7)
#: Words sharing a beginning that make a feature of their own.
COUNTS = (2, 3, 5)
#: Words whose features a worker remembers.
KNOWN = 100_000
#: Words of so many letters tell copies.
LONG = 9
FOLDS, HELD_OUT = 5, 0

_word = re.compile(r"[^\W\d_]+")


def vocabulary(text: str | None) -> set[str]:
    return set(_word.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """A word and its beginnings; these carry a mark."""
    return [word, *("^" + word[:k] for k in STEMS if len(word) >= k)]


def with_counts(found: Iterable[Iterable[str]]) -> set[str]:
    """Features of a document from those of its words: each, and marked by the counts that it reaches."""
    counts = Counter(f for x in found for f in x)
    return set(counts) | {f"{f}#{k}" for f, n in counts.items() if n > 1 for k in COUNTS if n >= k}


def first_copies(texts: Iterable[str | None]) -> list[str | None]:
    """The texts without those that share the three least hashes of their long words with an earlier one, by either of two hashes."""
    seen: set[tuple[int, ...]] = set()
    out = []
    for t in texts:
        x = vocabulary(t)
        long = [w.encode() for w in x if len(w) >= LONG] or [" ".join(sorted(x)).encode()]
        keys = [(seed, *heapq.nsmallest(3, (zlib.crc32(w, seed) for w in long))) for seed in (0, 1)]
        if seen.isdisjoint(keys):
            out.append(t)
        seen.update(keys)
    return out


def fold(id_col: str = "doc_id", folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


class Model:
    """Weights by feature and a bias; ``score`` is the chance that a text is toxic."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self.known = weights, bias, {}
        self.bases = {f.partition("#")[0] for f in weights}

    def held(self, words: set[str]) -> set[str]:
        """The model's features that the words have."""
        found = []
        if len(self.known) > KNOWN:
            self.known.clear()
        for word in words:
            own = self.known.get(word)
            if own is None:
                own = self.known[word] = tuple(f for f in features_of(word) if f in self.bases)
            if own:
                found.append(own)
        return with_counts(found) & self.weights.keys() if found else set()

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[f] for f in sorted(self.held(vocabulary(text))))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


NEVER = Model({}, -30.0)


def direction(w: np.ndarray, a: np.ndarray, b: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """(negative part of the risk, gradient to descend) at weights w for rows a of positives and b of unlabelled."""
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    za, zb, n, m = a @ w, b @ w, len(a), len(b)
    # gradients of the mean losses: positives as positive, positives as negative, unlabelled as negative
    as_pos, as_neg, unl_neg = a.T @ (sigmoid(za) - 1) / n, a.T @ sigmoid(za) / n, b.T @ sigmoid(zb) / m
    negative = float(np.logaddexp(0, zb).mean() - prior * np.logaddexp(0, za).mean())
    return negative, prior * as_pos + unl_neg - prior * as_neg if negative >= 0 else prior * as_neg - unl_neg


def train(positive: Iterable[str | None], unlabelled: Iterable[str | None], prior: float, features: int = FEATURES, steps: int = 400, rate: float = 0.1, decay: float = 2e-4) -> Model:
    """Fit the linear scorer by the non-negative risk, with Adam over all rows at a time.

    A prior above the true share would push every score up, so it is lowered to what the samples themselves allow.
    """
    held = lambda text: with_counts(features_of(w) for w in vocabulary(text))
    pos, unl = first_copies(positive), first_copies(unlabelled)
    if not pos or not unl:
        return NEVER
    # features are made anew for each count: memory is that of the texts and of one document's features
    in_pos = Counter(f for t in pos for f in held(t))
    candidates = {f for f, k in in_pos.items() if k >= LEAST}
    in_unl = Counter(f for t in unl for f in held(t) & candidates)
    n, m = len(pos), len(unl)
    ranked = []
    for f in sorted(candidates):
        both = (in_pos[f] + in_unl[f] + 1) / (n + m + 2)
        difference = (in_pos[f] / n - in_unl[f] / m) / np.sqrt(both * (1 - both) * (1 / n + 1 / m))
        if difference >= DIFFERENCE and prior * in_pos[f] / n >= 0.5 * in_unl[f] / m:
            ranked.append((-difference, f))
    chosen = {f: i for i, (_, f) in enumerate(sorted(ranked)[:features])}

    def matrix(texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), len(chosen) + 1))
        out[:, -1] = 1
        for r, t in enumerate(texts):
            out[r, [chosen[f] for f in chosen.keys() & held(t)]] = 1
        return out

    a, b = matrix(pos), matrix(unl)
    # no more of the unlabelled text can be toxic than holds a feature as often as the toxic text does
    in_a, in_b = (x[:, :-1].any(1).mean() if chosen else 0.0 for x in (a, b))
    prior = min(prior, max(in_b / in_a, 1e-3)) if in_a else prior
    w = np.zeros(a.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        gradient = direction(w, a, b, prior)[1] + decay * np.r_[w[:-1], 0]
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model({f: float(w[i]) for f, i in chosen.items()}, float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Train on rows outside the held-out fold. The prior is the share of toxic rows among the labelled ones there."""
    known = labels.where(F.col(id_col).isNotNull() & (fold(id_col) != HELD_OUT)).select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic"))
    counts = known.agg(F.count(F.when(F.col("toxic") == 1, 1)).alias("pos"), F.count("toxic").alias("all")).first()
    if not counts["pos"]:
        return NEVER
    prior = min(max(counts["pos"] / counts["all"], 1e-3), 0.9)
    texts = docs.where(F.col(id_col).isNotNull() & (fold(id_col) != HELD_OUT)).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    first = F.xxhash64("doc_id")
    toxic = known.where("toxic = 1").select("doc_id").distinct().orderBy(first, "doc_id").limit(positives)
    texts = texts.where(F.coalesce(F.length("text"), F.lit(0)) <= LONGEST)
    one = lambda ids: texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").select("text")
    chosen = one(toxic)  # ``positives`` ids at most
    some = texts.select("doc_id").distinct().orderBy(first, "doc_id").limit(unlabelled)  # all text, toxic or not: the risk needs the whole mix
    others = one(some)  # ``unlabelled`` ids at most
    return train([r[0] for r in chosen.collect()], [r[0] for r in others.collect()], prior)


def score_column(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def toxicity(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)

    return toxicity(text)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    bounded_batches(docs.sparkSession)
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold(id_col) == HELD_OUT, F.lit(False)).alias("held_out"), score_column(F.col(text_col), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    bounded_batches(docs.sparkSession)
    return docs.where(score_column(F.col(text_col), model) < 0.5)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))
