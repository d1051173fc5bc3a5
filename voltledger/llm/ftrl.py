"""Logistic regression over hashed binary features, trained by follow the regularised leader.

Each coordinate has a learning rate of its own, and an L1 term that leaves most weights at 0, so
that the trained model is a short list of (feature, weight) pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.llm.memory import giving_back
from voltledger.llm.words import chunked

# (texts, bits) -> (number of each feature, number of the text it stands in), repeats included.
Features = Callable[[Sequence[str], int], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Training:
    """What a model is trained with.

    ``sample`` bounds the labelled rows that are used: those with the lowest hash of the id, as
    many of either label as there are, up to it. ``rare_weight`` multiplies the updates of the
    rarer label.
    """

    bits: int = 20
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 4
    sample: int = 6000
    rare_weight: float = 1.0


def fit(rows: Sequence[np.ndarray], labels: np.ndarray, how: Training) -> np.ndarray:
    """Weights by feature, the bias last."""
    bias = 1 << how.bits
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    positive = labels.mean() if len(labels) else 0.5
    rare = 1.0 if positive < 0.5 else 0.0
    for _ in range(how.epochs):
        for features, label in zip(rows, labels):
            at = np.append(features, bias)
            zs, root = z[at], np.sqrt(n[at])
            w = weights(zs, root, how)
            w[-1] = -zs[-1] / ((how.beta + root[-1]) / how.alpha + how.l2)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = (p - label) * (how.rare_weight if label == rare else 1.0)
            grown = np.sqrt(root * root + g * g)
            z[at] = zs + g - (grown - root) / how.alpha * w
            n[at] += g * g
    w = weights(z, np.sqrt(n), how)
    w[-1] = -z[-1] / ((how.beta + np.sqrt(n[-1])) / how.alpha + how.l2)
    return w


def weights(z: np.ndarray, root: np.ndarray, how: Training) -> np.ndarray:
    free = np.sign(z) * np.maximum(np.abs(z) - how.l1, 0)
    return -free / ((how.beta + root) / how.alpha + how.l2)


def train(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, features: Features, how: Training
) -> np.ndarray:
    """Weights learned from at most ``how.sample`` labelled rows, in one task.

    ``usable`` is a condition on ``doc_id``. Ids with a null label or with two different labels
    are not used; of rows that repeat an id, the greatest text is. Without any labelled row all
    weights are 0, and every score is one half.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & usable)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where(F.col("label") == F.col("most"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(how.sample)
        .select("doc_id", "label")
    )
    texts = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.max("text").alias("text"))
        .repartition(1)
        .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    )

    @giving_back
    def learn(frames):
        rows, marks = [], []
        for frame in frames:
            marks.append(frame["label"].to_numpy(np.float64))
            for part in chunked(frame["text"]):
                at, offsets = distinct(*features(part, how.bits), len(part), how.bits)
                rows += [at[a:b].copy() for a, b in zip(offsets[:-1], offsets[1:])]
        w = fit(rows, np.concatenate(marks) if marks else np.zeros(0), how)
        used = np.flatnonzero(w)
        yield pd.DataFrame({"feature": used.astype(np.int64), "weight": w[used]})

    learned = texts.mapInPandas(learn, "feature long, weight double").toPandas()
    w = np.zeros((1 << how.bits) + 1, np.float64)
    w[learned["feature"].to_numpy(np.int64)] = learned["weight"].to_numpy(np.float64)
    return w


def scores(texts: Sequence[str], w: np.ndarray, features: Features, how: Training) -> np.ndarray:
    """Sparse dot products of the texts' features with the weights, as probabilities."""
    feature, text = features(texts, how.bits)
    weighty = w[feature] != 0
    at, offsets = distinct(feature[weighty], text[weighty], len(texts), how.bits)
    sums = np.concatenate([[0.0], np.cumsum(w[at])])
    total = sums[offsets[1:]] - sums[offsets[:-1]] + w[-1]
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def score_column(text: Column, w: np.ndarray, features: Features, how: Training, spark) -> Column:
    """The score of each text; null scores as empty. The weights go out as one broadcast."""
    used = np.flatnonzero(w)
    sent = spark.sparkContext.broadcast((used, w[used]))

    @F.pandas_udf("double")
    @giving_back
    def score(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros((1 << how.bits) + 1)
        dense[sent.value[0]] = sent.value[1]
        for column in columns:
            parts = [scores(part, dense, features, how) for part in chunked(column)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)


def distinct(
    feature: np.ndarray, text: np.ndarray, n_texts: int, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Each text's features sorted and without repeats, and where each text's begin."""
    key = np.unique((text.astype(np.uint64) << np.uint64(bits)) | feature)
    offsets = np.searchsorted(key, np.arange(n_texts + 1, dtype=np.uint64) << np.uint64(bits))
    return (key & np.uint64((1 << bits) - 1)).astype(np.int64), offsets
