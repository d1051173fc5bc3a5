"""Benchmark passages in documents, by SimHash over windows as long as the item.

Every benchmark item has a 64-bit SimHash of its word shingles; the second occurrence of a shingle
is an element of its own, and so on, so that fingerprints follow the weighted similarity also where
shingles repeat. A document's windows of the item's length get theirs from running sums: a window
that moves on by one loses the last occurrence of one shingle and gains one of another, and how
many it held is counted beforehand for every place. An index over blocks of the items' fingerprints
gives every item within the radius of a window: two fingerprints that differ in at most ``RADIUS``
bits differ in at most ``RADIUS // BLOCKS`` bits of some block, and all such block values are
listed. Candidates are then compared exactly: the weighted Jaccard similarity of the two multisets
of shingles must reach the threshold.

To reach a similarity t, a window of m shingles must share t / (1 + t) of its m + n with an item of
n. Windows with fewer shingles of any items get no fingerprint; this loses nothing, and leaves few
windows, so that it matters little that the index by itself would propose 71 % of unrelated items.
Two multisets of shingles that reach 0.8 differ by more than the radius with a chance of about 2 in
100,000, whether their shingles repeat or not.

The index is sent to all executors, in parts, and a benchmark of more than ``MAX_CHARS`` is refused.

Items shorter than a shingle are compared whole; a document shorter than the item is one window.
Null and empty texts and items hold and match nothing. Rows are taken one by one, so repeated rows
give repeated results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.llm.memory import giving_back
from voltledger.llm.words import BASE, chunked, salted, shingles, word_hashes

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 22
BLOCKS, BLOCK_BITS = 8, 8
# The benchmark is taken in parts of about this many characters, so that what is sent to the
# executors is bounded; each part is compared with all documents.
PART_CHARS = 8_000_000
MAX_CHARS = 64_000_000
# Windows are worked on together as long as they have no more places and pairs than this.
PLACES_AT_ONCE = 1 << 14
PAIRS_AT_ONCE = 1 << 20
FILTER_BITS = 20

HITS = "array<struct<item_id:bigint,start:int,n_words:int,similarity:double,distance:int>>"


@dataclass(frozen=True)
class Group:
    """Items with as many shingles of the same size, and the index over their fingerprints."""

    size: int
    n_shingles: int
    items: np.ndarray
    prints: np.ndarray
    anchors: np.ndarray
    begin: list[np.ndarray]
    listed: list[np.ndarray]


@dataclass(frozen=True)
class Benchmark:
    ids: list[int | None]
    bags: list[tuple[np.ndarray, np.ndarray]]
    groups: list[Group]


def counts_within(
    values: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each place p, how many of values[low[p]:p + 1] and of values[p:high[p]] equal values[p]."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if new.all():
        return np.ones(n, np.int64), np.ones(n, np.int64)
    kind = np.cumsum(new)
    number, rank = np.empty(n, np.int64), np.empty(n, np.int64)
    number[order], rank[order] = kind, np.arange(n)
    keys = kind * (n + 1) + order
    before = rank + 1 - np.searchsorted(keys, number * (n + 1) + low)
    after = np.searchsorted(keys, number * (n + 1) + high) - rank
    return before, after


def running(values: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """Running sums, bit by bit, of the signs of each place's element."""
    elements = salted(values + (occurrence - 1).astype(np.uint64) * np.uint64(BASE), 77)
    signs = np.unpackbits(elements.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    sums = np.zeros((len(values) + 1, 64), np.int32)
    np.cumsum(signs, axis=0, out=sums[1:])
    return sums


def prints(
    values: np.ndarray, region: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int
) -> np.ndarray:
    """The SimHash of values[start:end] for each window.

    ``region`` is where the run of windows that each place belongs to begins; windows have ``n``
    places, or are a whole shorter region.
    """
    place = np.arange(len(values))
    gained, lost = counts_within(
        values, np.maximum(place - n + 1, region), np.minimum(place + n, len(values))
    )
    adding = running(values, gained)
    taking = running(values, lost) if (gained != lost).any() else adding
    first = region[starts]
    sums = adding[ends] - adding[first] - taking[starts] + taking[first]
    return np.packbits(sums > 0, axis=1).view(np.uint64).ravel()


def blocks_of(prints_: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(prints_).view(np.uint8).reshape(-1, BLOCKS)


def index(items: Sequence[tuple[int | None, str | None]]) -> Benchmark:
    """Bags of shingles, fingerprints and the block index of benchmark items."""
    ids, bags, members = [], [], {}
    for item_id, text in items:
        hashes, offsets = word_hashes([text or ""])
        if not len(hashes):
            continue
        size = min(SHINGLE_WORDS, len(hashes))
        made, _ = shingles(hashes, offsets, size)
        members.setdefault((size, len(made)), []).append((len(ids), made))
        ids.append(item_id)
        bags.append(np.unique(made, return_counts=True))
    every = np.arange(1 << BLOCK_BITS, dtype=np.uint8)
    near = [np.flatnonzero(np.bitwise_count(every ^ v) <= RADIUS // BLOCKS) for v in every]
    groups = []
    for (size, n_shingles), own in sorted(members.items()):
        flat = np.concatenate([made for _, made in own])
        at = np.arange(len(own)) * n_shingles
        fingerprints = prints(flat, np.repeat(at, n_shingles), at, at + n_shingles, n_shingles)
        begin, listed = [], []
        for column in blocks_of(fingerprints).T:
            values = np.concatenate([near[v] for v in column])
            item = np.repeat(np.arange(len(own)), [len(near[v]) for v in column])
            order = np.argsort(values, kind="stable")
            begin.append(np.searchsorted(values[order], np.arange(257)))
            listed.append(item[order])
        numbers = np.array([number for number, _ in own])
        groups.append(Group(size, n_shingles, numbers, fingerprints, np.unique(flat), begin, listed))
    return Benchmark(ids, bags, groups)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of the values that are in the sorted array; a small table screens most of them."""
    low = np.uint64((1 << FILTER_BITS) - 1)
    screen = np.zeros(1 << FILTER_BITS, bool)
    screen[known & low] = True
    maybe = np.flatnonzero(screen[values & low])
    at = np.minimum(np.searchsorted(known, values[maybe]), len(known) - 1)
    return maybe[known[at] == values[maybe]]


def candidates(fingerprints: np.ndarray, group: Group) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of window and item of the group within the radius."""
    found = []
    for column, begin, listed in zip(blocks_of(fingerprints).T, group.begin, group.listed):
        first, count = begin[column], begin[column.astype(np.int64) + 1] - begin[column]
        ends = np.cumsum(count)
        at = np.arange(ends[-1]) - np.repeat(ends - count - first, count)
        window = np.repeat(np.arange(len(column)), count)
        found.append(window * len(group.items) + listed[at])
    pairs = np.unique(np.concatenate(found))
    window, item = pairs // len(group.items), pairs % len(group.items)
    close = np.bitwise_count(fingerprints[window] ^ group.prints[item]) <= RADIUS
    return window[close], item[close]


def similarity(window: np.ndarray, bag: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of a window's shingles and an item's, by their counts."""
    values, counts = np.unique(window, return_counts=True)
    at = np.minimum(np.searchsorted(bag[0], values), len(bag[0]) - 1)
    shared = np.minimum(counts, bag[1][at])[bag[0][at] == values].sum()
    return float(shared / (len(window) + bag[1].sum() - shared))


def search(texts: Sequence[str], benchmark: Benchmark, threshold: float) -> list[list[tuple]]:
    """Per text and item that it holds: id, first word, words, similarity, distance of the best
    window, the first of equals."""
    hashes, offsets = word_hashes(texts)
    best: list[dict[int, tuple]] = [{} for _ in texts]
    made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    anchored: dict[int, np.ndarray] = {}
    for size in {group.size for group in benchmark.groups}:
        made[size] = shingles(hashes, offsets, size)
        known = np.unique(np.concatenate([g.anchors for g in benchmark.groups if g.size == size]))
        anchored[size] = among(made[size][0], known)
    for group in benchmark.groups:
        values, begins = made[group.size]
        hit = anchored[group.size]
        hit = hit[among(values[hit], group.anchors)] if len(hit) else hit
        starts = dense(hit, begins, group.n_shingles, threshold)
        step = max(1, min(PLACES_AT_ONCE // group.n_shingles, PAIRS_AT_ONCE // len(group.items)))
        for k in range(0, len(starts), step):
            look(starts[k : k + step], values, begins, group, benchmark, threshold, best)
    return [
        [(benchmark.ids[item], *row) for item, row in sorted(found.items())] for found in best
    ]


def needed(places: np.ndarray | int, n: int, threshold: float) -> np.ndarray:
    """How many shingles a window must share with an item of ``n`` to reach the threshold."""
    return np.ceil(threshold / (1 + threshold) * (places + n) - 1e-9).astype(np.int64)


def dense(hit: np.ndarray, begins: np.ndarray, n: int, threshold: float) -> np.ndarray:
    """Starts of the windows with enough of the places ``hit``, in texts that begin as said."""
    if not len(hit):
        return hit
    text = np.searchsorted(begins, hit, side="right") - 1
    size = begins[text + 1] - begins[text]
    # A text shorter than the item is one window.
    short, count = np.unique(text[size < n], return_counts=True)
    whole = begins[short][count >= needed(begins[short + 1] - begins[short], n, threshold)]
    hit, text = hit[size >= n], text[size >= n]
    least = max(1, int(needed(n, n, threshold)))
    if len(hit) < least:
        return whole
    first, last = hit[: len(hit) - least + 1], hit[least - 1 :]
    close = (last - first < n) & (text[: len(first)] == text[least - 1 :])
    text = text[: len(first)][close]
    low = np.maximum(last[close] - n + 1, begins[text])
    high = np.minimum(first[close], begins[text + 1] - n)
    # Each range begins behind the one before, since places and texts come in order.
    low = np.maximum(low, np.concatenate([[0], np.maximum.accumulate(high)[:-1] + 1])) if len(low) else low
    count = np.maximum(high - low + 1, 0)
    ends = np.cumsum(count)
    made = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - count), count)
    return np.sort(np.concatenate([whole, made]))


def look(starts, values, begins, group, benchmark, threshold, best) -> None:
    """Fingerprint the windows at ``starts``, and keep the best match by text."""
    n = group.n_shingles
    text = np.searchsorted(begins, starts, side="right") - 1
    ends = np.minimum(starts + n, begins[text + 1])
    used = np.zeros(ends.max() - starts[0] + 1, np.int32)
    np.add.at(used, starts - starts[0], 1)
    np.add.at(used, ends - starts[0], -1)
    inside = np.cumsum(used) > 0
    place = np.concatenate([[0], np.cumsum(inside)])
    at = np.flatnonzero(inside) + starts[0]
    owner = np.searchsorted(begins, at, side="right")
    opens = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(owner) > 0)])
    region = np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
    fingerprints = prints(
        values[at], region, place[starts - starts[0]], place[ends - starts[0]], n
    )
    for window, item in zip(*candidates(fingerprints, group)):
        number = int(group.items[item])
        a, b = starts[window], ends[window]
        score = similarity(values[a:b], benchmark.bags[number])
        found = best[text[window]]
        if score >= threshold and (number not in found or score > found[number][2]):
            distance = int(np.bitwise_count(fingerprints[window] ^ group.prints[item]))
            first = int(a - begins[text[window]])
            found[number] = (first, int(b - a) + group.size - 1, score, distance)


def hits_column(text: Column, benchmark: Benchmark, threshold: float, spark) -> Column:
    sent = spark.sparkContext.broadcast(benchmark)
    names = ("item_id", "start", "n_words", "similarity", "distance")

    @F.pandas_udf(HITS)
    @giving_back
    def hits(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in columns:
            rows = [
                [dict(zip(names, row)) for row in found]
                for part in chunked(column)
                for found in search(part, sent.value, threshold)
            ]
            yield pd.Series(rows, dtype="object")

    return hits(text)


def parts_of(benchmark: DataFrame) -> list[Benchmark]:
    """The benchmark's index, in parts of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    if chars > MAX_CHARS:
        raise ValueError(f"the benchmark has {chars} characters, more than the {MAX_CHARS} allowed")
    n = max(1, math.ceil(chars / PART_CHARS))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [
        index([(row["item_id"], row["text"]) for row in items.where(part == k).collect()])
        for k in range(n)
    ]


def with_hits(
    docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, name: str = "hits"
) -> DataFrame:
    """``docs`` with an array of the benchmark items that each text holds, empty if none."""
    columns = [
        hits_column(F.col("text"), part, threshold, docs.sparkSession)
        for part in parts_of(benchmark)
    ]
    return docs.withColumn(name, F.concat(*columns) if len(columns) > 1 else columns[0])


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row per document and item that it holds, with the best window."""
    rows = with_hits(docs.select("doc_id", "text"), benchmark, threshold)
    return rows.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")
