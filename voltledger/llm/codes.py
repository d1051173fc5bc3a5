"""Product codes of vectors, by whole-number k-means over metric trees.

Components become whole numbers, vectors are cut into equal parts, and each part position has a
codebook. Rows are dealt into blocks, and every block keeps one metric tree per part position, made
once by the anchors hierarchy: anchors are chosen one after another, each the point farthest from
the anchors so far, and take over the points that are nearer to them, where only points farther
from their anchor than half the way to the new one need be looked at. The balls of the anchors are
merged pair by pair up to one root, and divided in the same way down to leaves. Each ball keeps its
centre, radius, and the sum and count of its points.

A round sends the codebooks down the trees. A ball takes over the list of entries that may be
nearest to a point of its parent and strikes those that cannot be for any of its own: another entry
is nearer to all points of the ball. When one entry is left, the ball is wholly its own, and the
cached sum and count are added to it; in a leaf, points are compared with the entries left. Ties
are never struck, so that they reach a leaf and go to the lower index. Distances there, sums and
means are exact whole numbers. A task gives one sum and count per entry, and the totals of all
tasks, which are as many as the codebooks have components, make the next codebooks.

Rows with a null vector or a null or non-finite component are dropped. Vectors must have one length
that the number of parts divides, the commonest such length (the longest of several); rows of
another length are dropped too. Null keys come last among the first entries, repeated rows are rows
of their own, null labels are one label. With fewer rows than entries the codebooks are shorter.
Other columns take no part. Components whose whole number is beyond 2**24 are refused.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.llm.negatives import finite
from voltledger.session import written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Rows whose parts make one tree, and points that are not divided further.
BLOCK = 2048
LEAF = 24
LARGEST = 1 << 24
# Labels whose totals are sent to every task; more are joined by a shuffle.
FEW_LABELS = 100_000


def anchor_owners(points: np.ndarray, count: int) -> np.ndarray:
    """The anchor that owns each point, with at most ``count`` anchors."""
    pivots = [0]
    owner = np.zeros(len(points), np.int64)
    away = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    while len(pivots) < count:
        far = int(away.argmax())
        if away[far] == 0:
            break
        half = np.sqrt(((points[pivots] - points[far]) ** 2).sum(axis=1)) / 2
        near = np.flatnonzero(away > half[owner])
        distance = np.sqrt(((points[near] - points[far]) ** 2).sum(axis=1))
        taken = near[distance < away[near]]
        away[taken] = distance[distance < away[near]]
        owner[taken] = len(pivots)
        owner[far], away[far] = len(pivots), 0
        pivots.append(far)
    return owner


def merged(balls: list[tuple]) -> tuple:
    """One ball of all: the two whose common ball is smallest become one, again and again.

    A ball is ``(centre, radius, count, its two balls or its rows)``.
    """
    n = len(balls)
    balls = balls + [None] * (n - 1)
    centres = np.zeros((2 * n - 1, len(balls[0][0])))
    radii = np.zeros(2 * n - 1)
    common = np.full((2 * n - 1, 2 * n - 1), np.inf)
    alive = np.zeros(2 * n - 1, bool)
    for new in range(2 * n - 1):
        if new >= n:
            a, b = divmod(int(common.argmin()), 2 * n - 1)
            radius, (one, other) = float(common[a, b]), (balls[a], balls[b])
            count = one[2] + other[2]
            centre = (one[0] * one[2] + other[0] * other[2]) / count
            balls[new] = centre, radius, count, (one, other)
            alive[[a, b]] = False
            common[[a, b]] = common[:, [a, b]] = np.inf
        centres[new], radii[new] = balls[new][:2]
        others = np.flatnonzero(alive)
        gaps = np.sqrt(((centres[others] - centres[new]) ** 2).sum(axis=1))
        enclosing = np.maximum(radii[others], radii[new])
        common[new, others] = np.maximum(enclosing, (gaps + radii[others] + radii[new]) / 2)
        alive[new] = True
    return balls[-1]


def hierarchy(points: np.ndarray, rows: np.ndarray) -> tuple:
    """The ball of these rows of ``points`` with all balls below it."""
    own = points[rows]
    centre = own.mean(axis=0)
    radius = float(np.sqrt(((own - centre) ** 2).sum(axis=1).max(initial=0)))
    if len(rows) > LEAF and radius > 0:
        owner = anchor_owners(own, math.isqrt(len(rows) - 1) + 1)
        parts = [rows[owner == k] for k in range(owner.max() + 1)]
        if len(parts) > 1:
            return merged([hierarchy(points, part) for part in parts])
    return centre, radius, len(rows), rows


class Tree:
    """A metric tree as flat arrays; the points of every ball stand next to each other."""

    FIELDS = {
        "points": np.int32, "order": np.int32, "centre": np.float64, "radius": np.float64,
        "start": np.int32, "end": np.int32, "sums": np.int64, "left": np.int32, "right": np.int32,
    }
    WIDE = ("points", "centre", "sums")

    def __init__(self, **arrays: np.ndarray) -> None:
        self.__dict__.update(arrays)

    @classmethod
    def made(cls, points: np.ndarray) -> Tree:
        """The tree of at least one point."""
        values = points.astype(np.float64)
        balls, rows, at = [], [], 0
        stack = [(hierarchy(values, np.arange(len(points))), None, 0)]
        while stack:
            (centre, _, count, below), parent, side = stack.pop()
            if parent is not None:
                balls[parent][side] = len(balls)
            if isinstance(below, tuple):
                stack += [(below[1], len(balls), 4), (below[0], len(balls), 3)]
            balls.append([centre, at, at + count, -1, -1])
            if not isinstance(below, tuple):
                rows.append(below)
                at += count
        order = np.concatenate(rows)
        placed = points[order].astype(np.int32)
        start, end, left, right = (np.array([b[k] for b in balls], np.int32) for k in (1, 2, 3, 4))
        centre = np.array([ball[0] for ball in balls]).reshape(len(balls), -1)
        away = [
            ((placed[s:e] - c) ** 2).sum(axis=1).max() for s, e, c in zip(start, end, centre)
        ]
        running = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(placed, axis=0, dtype=np.int64, out=running[1:])
        return cls(
            points=placed,
            order=order.astype(np.int32),
            centre=centre,
            radius=np.sqrt(np.array(away)),
            start=start,
            end=end,
            sums=running[end] - running[start],
            left=left,
            right=right,
        )

    def packed(self) -> dict[str, bytes]:
        return {
            name: np.ascontiguousarray(getattr(self, name), kind).tobytes()
            for name, kind in self.FIELDS.items()
        }

    @classmethod
    def unpacked(cls, width: int, packed: dict[str, bytes]) -> Tree:
        arrays = {name: np.frombuffer(packed[name], kind) for name, kind in cls.FIELDS.items()}
        for name in cls.WIDE:
            rows = len(arrays["order" if name == "points" else "radius"])
            arrays[name] = arrays[name].reshape(rows, width)
        return cls(**arrays)

    def owners(self, entries: np.ndarray) -> Iterator[tuple[int, int | np.ndarray]]:
        """Balls that cover all points once: one entry for a whole ball, or one for each point."""
        own = entries.astype(np.float64)
        apart = np.sqrt(((own[:, None, :] - own[None, :, :]) ** 2).sum(axis=2))
        largest = max(int(np.abs(x.astype(np.int64)).max(initial=0)) for x in (self.points, entries))
        # Doubles hold products and distances of the usual components exactly.
        exact = np.float64 if largest**2 * 4 * max(1, entries.shape[1]) < 1 << 52 else np.int64
        whole = entries.astype(exact)
        lengths = (whole * whole).sum(axis=1)
        stack = [(0, np.arange(len(entries)))]
        while stack:
            ball, listed = stack.pop()
            if len(listed) > 1:
                squares = ((own[listed] - self.centre[ball]) ** 2).sum(axis=1)
                first = int(squares.argmin())
                # An entry is farther than the first from every point of the ball if its squared
                # distance to the centre is larger by more than twice the radius times the way
                # between the two. Rounding is far below the slack, so ties stay listed.
                reach = 2 * self.radius[ball] * apart[listed[first], listed]
                slack = 1e-9 * (1 + squares + reach)
                listed = listed[squares - squares[first] <= reach + slack]
            if len(listed) == 1:
                yield ball, int(listed[0])
            elif self.left[ball] >= 0:
                stack += [(int(self.left[ball]), listed), (int(self.right[ball]), listed)]
            else:
                points = self.points[self.start[ball] : self.end[ball]].astype(exact)
                squares = lengths[listed] - 2 * (points @ whole[listed].T)
                yield ball, listed[squares.argmin(axis=1)]

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum and the count of the points that each entry is nearest to."""
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
        for ball, entry in self.owners(entries):
            start, end = self.start[ball], self.end[ball]
            if isinstance(entry, int):
                sums[entry] += self.sums[ball]
                counts[entry] += end - start
            else:
                np.add.at(sums, entry, self.points[start:end].astype(np.int64))
                counts += np.bincount(entry, minlength=len(entries))
        return sums, counts

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row and its squared distance."""
        placed = np.zeros(len(self.order), np.int64)
        for ball, entry in self.owners(entries):
            placed[self.start[ball] : self.end[ball]] = entry
        gaps = self.points.astype(np.int64) - entries[placed]
        code, error = np.empty_like(placed), np.empty_like(placed)
        code[self.order], error[self.order] = placed, (gaps * gaps).sum(axis=1)
        return code, error


def checked(points: np.ndarray) -> np.ndarray:
    largest = int(np.abs(points).max(initial=0))
    if largest > LARGEST or largest**2 * 4 * points.shape[1] >= 1 << 62:
        raise OverflowError("the components are too large for squared distances of 64 bits")
    return points


def block_of(keys: list, labels: list, vectors: list, types: tuple, parts: int) -> pa.RecordBatch:
    """One row: the keys and labels of a block and its tree for each part."""
    points = checked(np.array(vectors, np.int64).reshape(len(vectors), -1))
    trees = [Tree.made(part).packed() for part in np.split(points, parts, axis=1)]
    columns = {"key": pa.array([keys], pa.list_(types[0])), "label": pa.array([labels], pa.list_(types[1]))}
    for name in Tree.FIELDS:
        columns[name] = pa.array([[tree[name] for tree in trees]], pa.list_(pa.binary()))
    return pa.RecordBatch.from_pydict(columns)


def blocks_of(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the rows ``key, label, vector`` of one task, each of at most ``BLOCK``."""
    keys: list = []
    labels: list = []
    vectors: list = []
    types: tuple = ()
    for batch in batches:
        types = batch.column(0).type, batch.column(1).type
        for start in range(0, len(batch), BLOCK):
            piece = batch.slice(start, BLOCK)
            keys += piece.column(0).to_pylist()
            labels += piece.column(1).to_pylist()
            vectors += piece.column(2).to_pylist()
            if len(keys) >= BLOCK:
                yield block_of(keys[:BLOCK], labels[:BLOCK], vectors[:BLOCK], types, parts)
                keys, labels, vectors = keys[BLOCK:], labels[BLOCK:], vectors[BLOCK:]
    if keys:
        yield block_of(keys, labels, vectors, types, parts)


def trees_in(batch: pa.RecordBatch, row: int, width: int, parts: int) -> Iterator[Tree]:
    for part in range(parts):
        packed = {name: batch.column(name)[row][part].as_py() for name in Tree.FIELDS}
        yield Tree.unpacked(width, packed)


def totals_of(
    batches: Iterable[pa.RecordBatch], codebooks: list[np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """``slot, total`` over all blocks of one task: for every part and entry the sums of its points'
    components and, behind them, their count."""
    width = codebooks[0].shape[1]
    all_ = [np.zeros((len(book), width + 1), np.int64) for book in codebooks]
    for batch in batches:
        for row in range(len(batch)):
            for book, total, tree in zip(codebooks, all_, trees_in(batch, row, width, len(all_))):
                sums, counts = tree.totals(book)
                total[:, :width] += sums
                total[:, width] += counts
    totals = np.concatenate([total.ravel() for total in all_])
    slots = np.flatnonzero(totals)
    yield pa.RecordBatch.from_pydict({"slot": slots, "total": totals[slots]})


def coded(
    batches: Iterable[pa.RecordBatch], codebooks: list[np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """``key, label, code, error`` of every row of the blocks."""
    width, parts = codebooks[0].shape[1], len(codebooks)
    for batch in batches:
        for row in range(len(batch)):
            found = [
                tree.codes(book)
                for book, tree in zip(codebooks, trees_in(batch, row, width, parts))
            ]
            codes = np.stack([code for code, _ in found], axis=1).tolist()
            errors = np.sum([error for _, error in found], axis=0)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key")[row].values,
                    "label": batch.column("label")[row].values,
                    "code": ["".join(f"{one:02x}" for one in code) for code in codes],
                    "error": errors,
                }
            )


def next_codebooks(blocks: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """The means of the points nearest to each entry, rounded down; unused entries stay."""
    found = blocks.mapInArrow(lambda batches: totals_of(batches, codebooks), "slot long, total long")
    # As many sums as the codebooks have components, whatever the number of rows.
    totals = found.groupBy("slot").agg(F.sum("total").alias("total")).collect()
    width, at, books = codebooks[0].shape[1], 0, []
    flat = np.zeros(sum(len(book) * (width + 1) for book in codebooks), np.int64)
    flat[[row.slot for row in totals]] = [row.total for row in totals]
    for book in codebooks:
        sums = flat[at : at + len(book) * (width + 1)].reshape(len(book), width + 1)
        at += sums.size
        count = sums[:, width:]
        books.append(np.where(count > 0, sums[:, :width] // np.maximum(count, 1), book))
    return books


def digest(codebooks: list[np.ndarray]) -> str:
    """The SHA-256 of all components by part, entry and place, as decimals with commas between."""
    text = ",".join(str(x) for book in codebooks for x in book.ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def whole_rows(rows: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """``key, label, vector`` of the rows that take part, components as whole numbers."""
    values = F.col(f"`{vector}`")
    return rows.where(finite(values)).select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{label}`").alias("label"),
        F.transform(values, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("vector"),
    )


def with_label_errors(errors: DataFrame) -> DataFrame:
    """Rows of ``key, label, code, error`` with the sum of errors of their label. Sums combine before
    the shuffle; a hot label's rows are joined where they are, or split by adaptive execution."""
    sums = written(
        errors.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")),
        "codes-labels",
    )
    if sums.count() <= FEW_LABELS:
        sums = F.broadcast(sums)
    return errors.join(sums, F.col("label").eqNullSafe(F.col("same")))


def product_codes(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``key, code, error, label_error`` per row that takes part, and the codebook of each part.

    ``code`` has two hexadecimal digits per part, ``error`` is the squared distance to the entries,
    ``label_error`` its sum over the rows with the same label.
    """
    kept = whole_rows(rows, key, vector, label, scale)
    size = F.size("vector")
    lengths = kept.where(size % parts == 0).groupBy(size.alias("length")).count()
    commonest = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    length = commonest.length if commonest else 0
    kept = kept.where(size == length)
    starts = kept.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).collect()
    points = np.array([row.vector for row in starts], np.int64).reshape(len(starts), length)
    codebooks = np.split(checked(points), parts, axis=1)
    packed = ", ".join(f"{name} array<binary>" for name in Tree.FIELDS)
    types = {name: kept.schema[name].dataType.simpleString() for name in ("key", "label")}
    blocks = written(
        kept.mapInArrow(
            lambda batches: blocks_of(batches, parts),
            f"key array<{types['key']}>, label array<{types['label']}>, {packed}",
        ),
        "codes-trees",
    )
    for _ in range(rounds if starts else 0):
        codebooks = next_codebooks(blocks, codebooks)
    errors = written(
        blocks.mapInArrow(
            lambda batches: coded(batches, codebooks),
            f"key {types['key']}, label {types['label']}, code string, error long",
        ),
        "codes-errors",
    )
    found = with_label_errors(errors)
    return found.select(F.col("key").alias(key), "code", "error", "label_error"), codebooks
