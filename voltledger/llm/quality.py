"""Quality scores: logistic regression over hashed word n-grams.

N-grams are taken from two readings of a text. One has the words as they stand between white
space, in lower case. The other has their shapes: runs of small letters, capitals and digits
shrink to one mark each, other signs stay, and a word that repeats the one before it gets a mark
of its own. Shapes make list debris, shouting, symbol noise and loops visible in any language.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.llm.ftrl import Training, score_column, train
from voltledger.llm.words import joined_bytes, ngrams, owner, run_hashes, runs, salted

HOW = Training(bits=18, alpha=0.2, l1=1.0, l2=0.5)

_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[97:123] = 97
_SHAPES[128:] = 97
_SHAPES[65:91] = 65
_SHAPES[48:58] = 48
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0, 9, 10, 11, 12, 13, 32]] = True


def features(texts: Sequence[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Word n-grams of one and two words and shape n-grams of one to three: number, text."""
    data, breaks = joined_bytes(texts)
    starts, ends = runs(~_SPACE[data])
    offsets = np.concatenate([[0], np.searchsorted(starts, breaks), [len(starts)]])
    text = owner(offsets)
    word = run_hashes(_LOWER[data], starts, ends)
    shape_bytes = _SHAPES[data]
    kept = np.ones(len(data), bool)
    kept[1:] = shape_bytes[1:] != shape_bytes[:-1]
    kept[starts] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    shape = run_hashes(shape_bytes[kept], place[starts], place[ends])
    loop = np.zeros(len(word), bool)
    loop[1:] = (word[1:] == word[:-1]) & (text[1:] == text[:-1])
    shape[loop] = np.uint64(1)
    last = np.uint64((1 << bits) - 1)
    grams = [(salted(h, 1), t) for n in (1, 2) for h, t in [ngrams(word, text, range(n))]]
    grams += [(salted(h, 2), t) for n in (1, 2, 3) for h, t in [ngrams(shape, text, range(n))]]
    every, whose = (np.concatenate(part) for part in zip(*grams))
    return every & last, whose


def held_out() -> Column:
    """Rows that no label is learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def with_quality(
    docs: DataFrame, labels: DataFrame, how: Training = HOW, name: str = "score"
) -> DataFrame:
    """``docs`` with the probability of label 1 in a new column."""
    w = train(docs, labels, "quality", ~held_out(), features, how)
    return docs.withColumn(name, score_column(F.col("text"), w, features, how, docs.sparkSession))
