"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are words, pairs of neighbours and pairs with one word between; the stems of words (their first characters)
are features as well, and so is a stem that a text has several times, as many toxic words are forms of one stem. Labelled
rows are hashed and dealt to learners; each runs FTRL-proximal over its rows (a learning rate per coordinate, L1 and L2
in the proximal step), and the non-zero weights are averaged in Spark. L1 leaves a compact list of weights, bounded by
the sample learnt from, which goes to every scorer.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.llm.common import bounded_batches, text_of
from lapstack.session import stage

_WORD = re.compile(r"[^\W_]+")
_SHARES = 1_000_003
_WORDS_KEPT = 100_000  # whose hashes a task keeps
_COUNTERS = np.uint64(40)  # leading 24 bits of a feature pick its counter
_KINDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@dataclass(frozen=True)
class Settings:
    stems: tuple[int, ...] = (4, 6)  # leading characters of longer words
    repeats: tuple[int, ...] = (2, 3, 4, 6)  # a stem that a text has so many times is a feature of its own
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.3  # times the root of a learner's rows with label 1, 2 to 5 in all
    l2: float = 0.1
    epochs: int = 4
    refit_alpha: float = 1.0
    refit_epochs: int = 15  # over the features that L1 has left, without L1
    learner_rows: int = 8_000  # of one learner, at most
    max_rows: int = 16_000  # labelled rows that are learnt from, chosen by a hash of doc_id
    max_bytes: int = 128 << 20  # of their texts; a text of over an eighth of it is not learnt from
    min_docs: int = 3  # rows of a learner that must hold a feature
    agree: float = 0.5  # over so large a share of the learners must have a weight for a feature


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes with their weights, and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    settings: Settings = Settings()


class Words:
    """The hashes of words and of their stems, kept for the words met last; a word without a stem has 0 for it."""

    def __init__(self, settings: Settings) -> None:
        self.stems, self.known = settings.stems, {}
        self.table = np.empty((1 << 12, 1 + len(self.stems)), np.uint64)

    def hashes(self, text: str) -> np.ndarray:
        """A row for each word of the text."""
        words = _WORD.findall(text.lower())
        if len(self.known) > _WORDS_KEPT:
            self.known.clear()
        known = self.known
        out = np.empty(len(words), np.int64)
        for i, w in enumerate(words):
            at = known.get(w)
            if at is None:
                at = known[w] = len(known)
                if at == len(self.table):
                    self.table = np.concatenate([self.table, np.empty_like(self.table)])
                self.table[at, 0] = xxhash.xxh64_intdigest(w)
                for j, n in enumerate(self.stems, 1):
                    self.table[at, j] = xxhash.xxh64_intdigest(w[:n], seed=n) if len(w) > n else 0
            out[i] = at
        return self.table[out]


def features(words: np.ndarray, repeats: tuple[int, ...] = Settings.repeats) -> np.ndarray:
    """Hashes of the words, of pairs of neighbours, of pairs with one word between and of the stems, each once."""
    w = words[:, 0]
    two = (w[:-1] * _KINDS[1]) ^ (w[1:] + _KINDS[0])
    skip = (w[:-2] * _KINDS[2]) ^ (w[2:] + _KINDS[1])
    found = [w * _KINDS[0], two * _KINDS[0], skip * _KINDS[0]]
    for stems in words.T[1:]:
        stem, count = np.unique(stems[stems != 0], return_counts=True)
        found.append(stem)
        found += [(stem[count >= r] + np.uint64(r)) * _KINDS[0] for r in repeats]
    return np.unique(np.concatenate(found))


def learn(rows: list[tuple[np.ndarray, int]], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over (features, label) rows: the features with a weight, and the weights; feature 0 is the bias."""
    sizes = np.array([len(f) for f, _ in rows], np.int64)
    labels = np.array([y for _, y in rows], np.float64)
    flat = np.concatenate([f for f, _ in rows])
    rows.clear()  # the caller's list is not needed any more, and is large
    keys, index, count = np.unique(flat, return_inverse=True, return_counts=True)
    del flat
    often = count >= settings.min_docs
    slot = np.where(often, np.cumsum(often), 0)  # slot 0 is the bias; rare features are left out
    index = slot[index].astype(np.int32)
    at = [x[x > 0] for x in np.split(index, np.cumsum(sizes)[:-1])]
    l1 = min(5.0, max(2.0, settings.l1 * np.sqrt(labels.sum())))
    weights = _descend(at, labels, int(often.sum()) + 1, l1, settings.alpha, settings.epochs, settings)
    # the features that are left, fitted again: L1 has chosen them but also shrunk their weights; rows of the rarer
    # label 1 count more, by the root of the ratio
    lift = max(1.0, np.sqrt((len(labels) - labels.sum()) / max(labels.sum(), 1)))
    chosen = weights != 0
    chosen[0] = False
    slot = np.where(chosen, np.cumsum(chosen), 0)
    left = [x[x > 0] for x in (slot[i] for i in at)]
    refit = _descend(left, labels, int(chosen.sum()) + 1, 0.0, settings.refit_alpha, settings.refit_epochs, settings, lift)
    return np.append(np.uint64(0), keys[often][chosen[1:]]), refit


def _descend(
    at: list[np.ndarray], labels: np.ndarray, slots: int, l1: float, alpha: float, epochs: int, settings: Settings, lift: float = 1.0
) -> np.ndarray:
    """Weights by FTRL-proximal; ``at`` has the slots of each row's features, slot 0 is the bias and free of L1."""
    z, n, bound = np.zeros(slots), np.zeros(slots), np.full(slots, l1)
    bound[0] = 0.0
    order = np.random.default_rng(7)

    def weights_at(i):
        zi, root = z[i], np.sqrt(n[i])
        shrunk = (np.sign(zi) * bound[i] - zi) / ((settings.beta + root) / alpha + settings.l2)
        return np.where(np.abs(zi) <= bound[i], 0.0, shrunk)

    for _ in range(epochs):
        for r in order.permutation(len(at)):
            i = np.append(0, at[r])
            w = weights_at(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - labels[r]
            g = g * lift if labels[r] else g
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights_at(np.arange(slots))


def _learner(settings: Settings):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        words = Words(settings)
        texts, labels = pdf["text"].tolist(), pdf["label"].tolist()
        order = sorted(range(len(texts)), key=list(zip(pdf["_order"].tolist(), texts)).__getitem__)
        # most features are in one row only; small counters find them before any are gathered
        seen = np.zeros(1 << 24, np.uint8)
        for t in texts:
            at = features(words.hashes(t), settings.repeats) >> _COUNTERS
            seen[at] = np.minimum(seen[at], 254) + 1
        rows = []
        for i in order:
            f = features(words.hashes(texts[i]), settings.repeats)
            rows.append((f[seen[f >> _COUNTERS] >= settings.min_docs], int(labels[i])))
        keys, weights = learn(rows, settings)
        return pd.DataFrame({"key": keys.view(np.int64), "weight": weights})

    return run


def train(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from rows of ``text`` and ``label`` (0 or 1), with any ``doc_id`` as the order of the sample.

    At most ``settings.max_rows`` rows and ``settings.max_bytes`` bytes of text are learnt from, chosen by a hash of
    ``doc_id``; rows with a NULL label are left out, a NULL text counts as empty. Without rows of both labels the model has no features and gives
    every text the share of label 1 (0 when there are no rows).
    """
    spark = labelled.sparkSession
    bounded_batches(spark)
    rows = labelled.filter("label IS NOT NULL").select(
        F.xxhash64(F.col("doc_id").cast("string")).alias("_order"), "doc_id", text_of().alias("text"), F.col("label").cast("int").alias("label")
    )
    rows = _sampled(rows, rows.count(), settings.max_rows).withColumn("bytes", F.octet_length("text"))
    rows = stage(rows.filter(F.col("bytes") <= settings.max_bytes // 8), "sample")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    if total > settings.max_bytes:
        rows = _sampled(rows, total, settings.max_bytes, 12)
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    n, ones = counted["n"], counted["ones"] or 0
    if not n or ones in (0, n):
        p = min(max(ones / n if n else 0.0, 1e-6), 1 - 1e-6)
        return Model(np.empty(0, np.uint64), np.empty(0), float(np.log(p / (1 - p))), settings)
    learners = max(1, math.ceil(n / settings.learner_rows))
    sample = rows.withColumn("learner", F.pmod(F.xxhash64("_order", F.lit(1)), F.lit(learners)).cast("int"))
    weights = (
        sample.drop("doc_id", "bytes").groupBy("learner")
        .applyInPandas(_learner(settings), "key bigint, weight double")
        .groupBy("key")
        .agg((F.sum("weight") / learners).alias("weight"), F.count(F.lit(1)).alias("votes"))
        # a feature that few learners agree on is noise
        .filter((F.col("votes") > settings.agree * learners) | (F.col("key") == 0))
    )
    got = weights.toPandas()  # features of the bounded sample that L1 has left
    keys = got["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, values = keys[order], got["weight"].to_numpy()[order]
    bias = float(values[keys == 0].sum())
    return Model(keys[keys != 0], values[keys != 0], bias, settings)


def score_text(words: np.ndarray, model: Model) -> float:
    total = model.bias
    if len(model.keys) and len(words):
        f = features(words, model.settings.repeats)
        at = np.minimum(np.searchsorted(model.keys, f), len(model.keys) - 1)
        total += float(model.weights[at[model.keys[at] == f]].sum())
    return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def score_column(column: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Words(model.settings)
        for batch in texts:
            yield pd.Series([score_text(words.hashes(t), model) for t in batch], dtype="float64")

    return scores(column)


def held_out(column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(5)) == 0


def labelled_rows(docs: DataFrame, labels: DataFrame, max_rows: int = Settings.max_rows) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of labelled documents, without the held-out fifth.

    Documents with the smallest hashes of their id are taken where more than ``max_rows`` are labelled, so the ids are
    bounded and broadcast, and no text is shuffled that is not learnt from. One label and one text per document (the
    larger ones where they differ).
    """
    marks = labels.filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("label")).filter("label IS NOT NULL")
    marks = stage(_sampled(marks, marks.count(), max_rows), "marks")
    chosen = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(marks), "doc_id")
    return chosen.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label"))


def _sampled(rows: DataFrame, n: int, most: int, seed: int = 11) -> DataFrame:
    """A share of the rows by a hash of ``doc_id``, a little under ``most`` of ``n``."""
    share = int(0.95 * most / max(n, 1) * _SHARES)
    return rows if n <= most else rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(_SHARES)) < share)


def with_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents with ``score`` (0 to 1) and ``predicted`` (1 from 0.5); a score depends on the text alone.

    Every row is scored over its whole text, NULL as empty; labels of documents that are missing are left out; a
    column of the documents named ``score`` or ``predicted`` is replaced.
    """
    model = train(labelled_rows(docs, labels, settings.max_rows), settings)
    scored = docs.drop("score", "predicted").withColumn("score", score_column(text_of(), model))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
