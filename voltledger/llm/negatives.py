"""Hard negatives of anchor vectors, by the threshold algorithm over sorted lists per dimension.

Components become whole numbers, and a score is the whole-number inner product with the anchor. The
candidates are dealt into blocks. A block sorts its rows once per dimension; an anchor then walks
all lists at once, from the top where its own component is positive and from the bottom where it is
negative. Every row met for the first time is scored in full. No row that has not been met can
score more than the sum of the anchor's components times those at the present depth. The walk ends
when that threshold is strictly below the score of the k-th best row found, so that no tie is lost.
Some anchors walk side by side: a row that one of them meets is scored for all of them at once.

It is done twice. The first walk finds an anchor's positives, the best rows of its own label. The
second finds, for every positive score, the best rows of other labels with a score between a share
of it and itself; there the walk of a window with too few rows ends below the window. Each block
gives its best rows, and the best of those are the result.

Anchors are all rows that a condition holds for, and they grow with the table. They are dealt into
groups, and each block meets each group once, as rows of a shuffle: nothing is broadcast, and a task
holds one block and one group.

Rows with a null label, a null vector or a null or non-finite component take no part, and vectors
of different lengths do not meet. An empty vector scores 0. Repeated rows are rows of their own; a
null key stands behind all others. Other columns take no part. Components whose whole number is
beyond 32 bits, and vectors whose scores could be beyond 56 bits, are refused with an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltledger.llm.groups import dealt, grouped
from voltledger.session import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# A negative scores at least this many hundredths of its positive, and no more than it.
LEAST_SHARE = 80
# Candidates whose lists are walked together, and anchors that meet them in one task.
BLOCK = 8192
GROUP = 1024
# Anchors that walk side by side, the share of a list that they take first, and how it grows.
TOGETHER = 64
FIRST_SHARE = 64
GROWTH = 4


def finite(vector: Column) -> Column:
    """Whether a vector is there and none of its components is null, infinite or NaN."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(fine, F.lit(False))


def exact_rows(vectors: list, anchors: list) -> tuple[np.ndarray, np.ndarray]:
    """Both as arrays of the shortest kind that holds all products and their sums exactly."""
    rows = np.array(vectors, np.int64).reshape(len(vectors), -1)
    others = np.array(anchors, np.int64).reshape(len(anchors), -1)
    bound = rows.shape[1] * int(np.abs(rows).max(initial=0)) * int(np.abs(others).max(initial=0))
    # A hundred times a score has to fit as well.
    if bound >= 1 << 56:
        raise OverflowError("the components are too large for scores of 64 bits")
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return rows.astype(kind), others.astype(kind)


# A score below all others: of rows not met yet, or not wanted. A hundred times it fits 64 bits.
NOTHING = -(1 << 56)


class Lists:
    """A block of rows, sorted by each of its dimensions."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        order = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(rows, order, axis=0).T.astype(np.int64)
        self.order = order.T.astype(np.int32)

    def walk(self, anchors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows not met before, each anchor's scores of them, and what none still unmet can exceed,
        for each anchor."""
        n = len(self.rows)
        whole = anchors.astype(np.int64)
        rising, falling = np.maximum(whole, 0), np.minimum(whole, 0)
        up, down = np.flatnonzero(rising.any(axis=0)), np.flatnonzero(falling.any(axis=0))
        met = np.zeros(n, bool)
        depth, step = 0, max(1, n // FIRST_SHARE)
        while not met.all():
            stop = min(n, depth + step)
            now = np.zeros(n, bool)
            if stop == n:
                now[:] = True
            now[self.order[:, n - stop : n - depth][up].ravel()] = True
            now[self.order[:, depth:stop][down].ravel()] = True
            new = np.flatnonzero(now & ~met)
            met |= now
            if met.all():
                ceiling = np.full(len(anchors), NOTHING)
            else:
                ceiling = rising @ self.values[:, n - stop] + falling @ self.values[:, stop - 1]
            yield new, anchors @ self.rows[new].T, ceiling
            depth, step = stop, GROWTH * step


def best(scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray, rows: np.ndarray, k: int):
    """Places of the k best: by score downwards, then by id with unknown ones last, then by row."""
    places = np.flatnonzero(scores >= kth_best(scores, k))
    order = np.lexsort((rows[places], ids[places], unknown[places], -scores[places]))
    return places[order[:k]]


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest score of each row of scores, or nothing where there are fewer."""
    n = scores.shape[-1]
    if n < k:
        return np.full(scores.shape[:-1], NOTHING)
    return np.partition(scores, n - k, axis=-1)[..., n - k].astype(np.int64)


def alike(lists: Lists, anchors: np.ndarray, wanted: np.ndarray, k: int) -> np.ndarray:
    """Scores per anchor and row with the k best wanted rows of each anchor among them."""
    found = np.full(wanted.shape, NOTHING, anchors.dtype)
    for new, scores, ceiling in lists.walk(anchors):
        found[:, new] = np.where(wanted[:, new], scores, NOTHING)
        if (ceiling < kth_best(found, k)).all():
            break
    return found


def inside(scores: np.ndarray, top: int, share: int) -> np.ndarray:
    """Which scores are in the window of a positive that scores ``top``."""
    whole = scores.astype(np.int64)
    return (100 * whole >= share * top) & (whole <= top)


def windowed(
    lists: Lists, anchors: np.ndarray, wanted: np.ndarray, tops: list[list[int]], k: int, share: int
) -> np.ndarray:
    """Scores per anchor and row with the k best wanted rows of every window among them."""
    found = np.full(wanted.shape, NOTHING, anchors.dtype)

    def ended(scores: np.ndarray, ceiling: int, top: int) -> bool:
        # A window below zero is empty, since a share of its top lies above the top.
        if 100 * ceiling < share * top or share * top > 100 * top:
            return True
        return ceiling < kth_best(scores[inside(scores, top, share)], k)

    for new, scores, ceilings in lists.walk(anchors):
        found[:, new] = np.where(wanted[:, new], scores, NOTHING)
        each = zip(found, ceilings.tolist(), tops)
        if all(ended(row, ceiling, top) for row, ceiling, windows in each for top in windows):
            break
    return found


def meetings(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, pd.DataFrame, Lists, np.ndarray]]:
    """Some anchors, the candidates of a block, these as lists, and the anchors' vectors."""
    for part in grouped(frames, ("length", "group", "block")):
        anchors, rows = part[part["asks"]], part[~part["asks"]]
        if len(anchors) and len(rows):
            vectors, asking = exact_rows(list(rows["vector"]), list(anchors["vector"]))
            lists = Lists(vectors)
            for start in range(0, len(anchors), TOGETHER):
                some = slice(start, start + TOGETHER)
                yield anchors[some], rows, lists, asking[some]


class Chosen:
    """The rows found for some anchors, to be given out as one frame."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.row, self.id, self.unknown = (rows[c].to_numpy() for c in ("row", "id", "unknown"))
        self.parts: list[tuple] = []

    def add(self, anchor: int, top: int, scores: np.ndarray, places: np.ndarray, k: int) -> None:
        """The k best of the rows at ``places``, which have these scores."""
        first = best(scores, self.id[places], self.unknown[places], self.row[places], k)
        self.parts.append((anchor, top, scores[first], places[first]))

    def frame(self) -> pd.DataFrame:
        sizes = [len(places) for _, _, _, places in self.parts]
        places = np.concatenate([places for _, _, _, places in self.parts] or [np.zeros(0, int)])
        scores = np.concatenate([scores for _, _, scores, _ in self.parts] or [np.zeros(0)])
        return pd.DataFrame(
            {
                "anchor": np.repeat(np.array([one[0] for one in self.parts], np.int64), sizes),
                "top": np.repeat(np.array([one[1] for one in self.parts], np.int64), sizes),
                "score": scores.astype(np.int64),
                "row": self.row[places],
                "id": self.id[places],
                "unknown": self.unknown[places],
            }
        )


def compared(anchors: pd.DataFrame, rows: pd.DataFrame) -> np.ndarray:
    """Whether the label of each anchor is that of each row."""
    return anchors["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]


def positive_rows(frames: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for anchors, rows, lists, asking in meetings(frames):
        own = anchors["row"].to_numpy()[:, None] == rows["row"].to_numpy()[None, :]
        found = alike(lists, asking, compared(anchors, rows) & ~own, k)
        least = kth_best(found, k)
        chosen = Chosen(rows)
        for anchor, scores, enough in zip(anchors["row"], found, least):
            places = np.flatnonzero((scores >= enough) & (scores > NOTHING))
            chosen.add(anchor, 0, scores[places], places, k)
        yield chosen.frame()


def negative_rows(frames: Iterator[pd.DataFrame], k: int, share: int) -> Iterator[pd.DataFrame]:
    for anchors, rows, lists, asking in meetings(frames):
        tops = [[int(top) for top in one] for one in anchors["tops"]]
        found = windowed(lists, asking, ~compared(anchors, rows), tops, k, share)
        chosen = Chosen(rows)
        for anchor, scores, windows in zip(anchors["row"], found, tops):
            high = 100 * scores.astype(np.int64) >= share * min(windows)
            lowest = np.flatnonzero(high & (scores > NOTHING))
            for top in windows:
                places = lowest[inside(scores[lowest], top, share)]
                chosen.add(anchor, top, scores[places], places, k)
        yield chosen.frame()


FOUND = "anchor long, top long, score long, row long, id long, unknown boolean"


def met(kept: DataFrame, anchors: DataFrame, blocks: int, groups: int) -> DataFrame:
    """Candidates and anchors together, once for every block and group."""

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def place(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    columns = ["length", "group", "block", "asks", "row", "id", "unknown", "label", "vector", "tops"]
    rows = (
        kept.withColumn("block", place(blocks))
        .withColumn("group", numbers(groups))
        .withColumn("asks", F.lit(False))
        .withColumn("tops", F.lit(None).cast("array<long>"))
    )
    asking = (
        anchors.withColumn("group", place(groups))
        .withColumn("block", numbers(blocks))
        .withColumn("asks", F.lit(True))
    )
    return dealt(rows.select(columns).unionAll(asking.select(columns)), ("length", "group", "block"))


def best_rows(found: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor and window over all blocks, with their ``rank`` from 1."""
    order = Window.partitionBy("anchor", "top").orderBy(F.desc("score"), "unknown", "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    asks: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_share: int = LEAST_SHARE,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``asks`` is the condition on ``rows`` that makes a row an anchor; ``key`` is a whole number.
    """
    values = F.col(f"`{vector}`")
    known = F.col(f"`{key}`").cast("long")
    kept = rows.where(finite(values) & F.col(f"`{label}`").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(known, F.lit(0)).alias("id"),
        known.isNull().alias("unknown"),
        F.col(f"`{label}`").alias("label"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
        F.size(values).alias("length"),
        F.transform(values, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("vector"),
    )
    kept = written(kept, "negatives-rows")
    n, asking = kept.agg(F.count("*"), F.count_if("asks")).first()
    blocks, groups = max(1, math.ceil(n / BLOCK)), max(1, math.ceil(asking / GROUP))
    anchors = kept.where("asks").withColumn("tops", F.lit(None).cast("array<long>"))
    near = met(kept, anchors, blocks, groups).mapInPandas(
        lambda frames: positive_rows(frames, positives), FOUND
    )
    near = written(best_rows(near, positives), "negatives-positives")
    tops = near.groupBy("anchor").agg(F.collect_set("score").alias("tops"))
    anchors = anchors.drop("tops").join(tops, F.col("row") == F.col("anchor"))
    far = met(kept, anchors, blocks, groups).mapInPandas(
        lambda frames: negative_rows(frames, negatives, least_share), FOUND
    )
    far = best_rows(far, negatives).select(
        "anchor",
        F.col("top").alias("positive_score"),
        F.col("rank"),
        F.when(~F.col("unknown"), F.col("id")).alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    pairs = near.select(
        "anchor",
        F.when(~F.col("unknown"), F.col("id")).alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    names = kept.where("asks").select(
        F.col("row").alias("anchor"), F.when(~F.col("unknown"), F.col("id")).alias("anchor_id")
    )
    return (
        pairs.join(far, ["anchor", "positive_score"])
        .join(names, "anchor")
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
    )
