"""Toxicity scores: logistic regression over hashed word n-grams and skip-grams.

Features say whether an n-gram occurs, not how often, so that a few abusive words count as much in
a long text as in a short one. The L1 term leaves only the n-grams that tell the labels apart,
and the weights that go to the tasks are a short list.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.llm.ftrl import Training, score_column, train
from voltledger.llm.words import ngrams, owner, salted, word_hashes

HOW = Training(bits=20, alpha=1.0, l1=8.0, l2=0.5, epochs=4, sample=12000, rare_weight=3.0)

# Words at these distances make one feature: single words, pairs, and pairs over one or two words.
GRAMS = ((0,), (0, 1), (0, 2), (0, 3))

# A word also counts by its first bytes, so that other endings of an abusive word are known.
STEMS = (4, 6)


def features(texts: Sequence[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of every n-gram and skip-gram, and the text it stands in."""
    hashes, offsets, stems = word_hashes(texts, STEMS)
    text = owner(offsets)
    last = np.uint64((1 << bits) - 1)
    grams = [(salted(h, gaps[-1]), t) for gaps in GRAMS for h, t in [ngrams(hashes, text, gaps)]]
    grams += [(salted(stem, 16 + k), text) for k, stem in enumerate(stems)]
    every, whose = (np.concatenate(part) for part in zip(*grams))
    return every & last, whose


def held_out() -> Column:
    """Rows that no label is learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def with_toxicity(
    docs: DataFrame, labels: DataFrame, how: Training = HOW, name: str = "score"
) -> DataFrame:
    """``docs`` with the probability of label 1 in a new column."""
    w = train(docs, labels, "toxic", ~held_out(), features, how)
    return docs.withColumn(name, score_column(F.col("text"), w, features, how, docs.sparkSession))
