"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Every vector is projected onto many random lines. Two vectors collide on a line when each lies in
the window around the other, the window being as wide as two standard errors of a pair at the
threshold. Pairs that collide often enough are compared exactly, in double precision. On a plain
line the windows hold a fixed part of all vectors, since a pair at 0.9 is only three times as close
as an unrelated one; so each line is first cut into cells by the signs of some further
projections, as many as keep cells at some hundred vectors, and sorted and swept cell by cell. The
number of lines follows from the number of signs: a pair at the threshold reaches the count with
the stated recall. So it is the cells that leave few pairs to look at; within a cell the window and
the count of two then leave out what does not collide.

A pair is looked at where it collides first, so every link is counted once and no pair leaves a
task. Cells above a bound are dealt out as pairs of blocks.

Equal vectors are one node. Vectors that are null, empty or zero, or hold a null or a non-finite
component, link with nothing, not even their like; nor do vectors of different lengths.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.llm.graph import components
from voltledger.llm.groups import dealt, grouped
from voltledger.session import written

THRESHOLD = 0.9
RECALL = 0.999
COLLISIONS = 2
WINDOW_ERRORS = 2.0
WINDOW_CHANCE = 0.9545
CELL = 512
# Vectors on either side of one comparison within a task, and rows compared at once.
BLOCK = 1000
STRIPE = 256


@dataclass(frozen=True)
class Lines:
    """How many lines, with how many signs each, at which threshold."""

    count: int
    signs: int
    threshold: float

    @property
    def window(self) -> float:
        return WINDOW_ERRORS * math.sqrt(2 - 2 * self.threshold)

    def directions(self, length: int) -> np.ndarray:
        """For vectors of this length: a column per line, then a column per line and sign."""
        made = np.random.default_rng(20_000 + length)
        return made.standard_normal((length, self.count * (1 + self.signs)))

    def project(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place on each line, and the number of the cell by its signs, per vector and line."""
        all_ = unit @ self.directions(unit.shape[1])
        bits = all_[:, self.count :].reshape(len(unit), self.count, self.signs) > 0
        return all_[:, : self.count], bits @ (1 << np.arange(self.signs, dtype=np.int64))


def lines_for(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> Lines:
    """Signs by the number of vectors; lines so that a pair at the threshold is found with
    ``recall``."""
    signs = max(0, math.ceil(math.log2(max(1, n) / CELL)))
    same = 1 - math.acos(threshold) / math.pi
    chance = same**signs * WINDOW_CHANCE
    count = COLLISIONS
    while True:
        missed = sum(
            math.comb(count, k) * chance**k * (1 - chance) ** (count - k) for k in range(COLLISIONS)
        )
        if missed <= 1 - recall:
            return Lines(count, signs, threshold)
        count += 1


def unit_rows(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors of one length, in double precision, scaled to length 1 without overflow."""
    rows = np.array(vectors, np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def cell_rows(nodes: DataFrame, lines: Lines) -> DataFrame:
    """``node, cell`` for each line; the cell's number holds the vector's length and the line."""

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lengths = frame["vector"].map(len)
            for length, part in frame.groupby(lengths):
                _, codes = lines.project(unit_rows(list(part["vector"])))
                line = (length * 4096 + np.arange(lines.count)) << 32
                yield pd.DataFrame(
                    {
                        "node": np.repeat(part["node"].to_numpy(), lines.count),
                        "line": np.tile(np.arange(lines.count, dtype=np.int32), len(part)),
                        "cell": (codes + line[None, :]).ravel(),
                    }
                )

    return nodes.select("node", "vector").mapInPandas(place, "node long, line int, cell long")


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest place that each of n places is connected to by the links a-b."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def sweep(frames: Iterator[pd.DataFrame], lines: Lines) -> Iterator[pd.DataFrame]:
    """Per block of a cell: for each linked vector, how many it links to, and a smaller node of
    those it is connected with there."""
    for group in grouped(frames, ("cell", "low", "high")):
        unit = unit_rows(list(group["vector"]))
        place, code = lines.project(unit)
        line = int(group["line"].iloc[0])
        order = np.argsort(place[:, line], kind="stable")
        unit, place, code = unit[order], place[order], code[order]
        node, copies, chunk = (group[c].to_numpy()[order] for c in ("node", "copies", "chunk"))
        crossing = group["low"].iloc[0] != group["high"].iloc[0]
        left, right = [], []
        here = place[:, line]
        for start in range(0, len(unit), STRIPE):
            stop = min(start + STRIPE, len(unit))
            end = int(np.searchsorted(here, here[stop - 1] + lines.window, side="right"))
            rows, columns = np.arange(start, stop), np.arange(start, end)
            wanted = columns[None, :] > rows[:, None]
            if crossing:
                wanted &= chunk[rows][:, None] != chunk[columns][None, :]
            count = np.zeros(wanted.shape, np.int16)
            for k in range(lines.count):
                meet = code[rows, k][:, None] == code[columns, k][None, :]
                meet &= np.abs(place[rows, k][:, None] - place[columns, k][None, :]) <= lines.window
                if k < line:
                    wanted &= ~meet
                elif k == line:
                    wanted &= meet
                count += meet
            a, b = np.nonzero(wanted & (count >= COLLISIONS))
            near = np.einsum("ij,ij->i", unit[rows[a]], unit[columns[b]]) >= lines.threshold
            left.append(rows[a[near]])
            right.append(columns[b[near]])
        a, b = np.concatenate(left), np.concatenate(right)
        if len(a):
            links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
            some = np.flatnonzero(links)
            root = local_roots(a, b, len(node))
            yield pd.DataFrame(
                {"node": node[some], "links": links[some].astype(np.int64), "other": node[root[some]]}
            )


def links_of(nodes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """``node, links, other`` from each block: links counted there, and one connected node.

    ``nodes`` has ``node, vector, copies``.
    """
    lines = lines_for(nodes.count(), threshold, recall)
    cells = written(cell_rows(nodes, lines), "vector-cells")
    large = written(
        cells.groupBy("cell").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK),
        "vector-large-cells",
    )
    blocks = F.ceil(F.coalesce("size", F.lit(1)) / BLOCK).cast("int")
    chunk, other = F.col("chunk"), F.col("other")
    rows = (
        cells.join(large, "cell", "left")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "cell",
            "line",
            F.least(chunk, other).alias("low"),
            F.greatest(chunk, other).alias("high"),
            "chunk",
            "node",
        )
        .join(nodes, "node")
    )
    found = dealt(rows, ("cell", "low", "high")).mapInPandas(
        lambda frames: sweep(frames, lines), "node long, links long, other long"
    )
    return written(found, "vector-links")


def near_vectors(
    rows: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``key, n_links, component_id, kept`` per row.

    ``n_links`` counts the other rows that are linked directly, ``component_id`` is the smallest
    key that links lead to, and ``kept`` says whether it is the row's own. A null key is nobody's
    smallest while there is another.
    """
    ok = usable(F.col(vector))
    own = rows.select(
        F.col(key).alias("key"),
        F.when(ok, F.xxhash64(vector)).alias("node"),
        F.col(vector).alias("vector"),
    )
    nodes = written(
        own.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.count("*").alias("copies"),
            F.min("key").alias("least"),
            F.first("vector").alias("vector"),
        ),
        "vector-nodes",
    )
    found = links_of(nodes.select("node", "vector", "copies"), threshold, recall)
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    per_node = (
        nodes.select("node", "copies", "least")
        .join(totals, "node", "left")
        .join(comps, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    smallest = per_node.groupBy("component").agg(F.min("least").alias("component_id"))
    per_node = written(
        per_node.join(smallest, "component").select(
            "node",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            "component_id",
        ),
        "vector-components",
    )
    joined = own.select("key", "node").join(per_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"),
    )
