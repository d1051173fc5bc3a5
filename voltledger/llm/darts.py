"""DartMinHash: weighted min-wise signatures from darts thrown at weighted regions.

Every element has a plane of weight and rank. Over each band of weights ([0, 1), [1, 2), [2, 4),
...) darts fall along the rank axis as a Poisson process that depends on the element and the band
only. A dart hits a set if its weight is below the element's weight in that set. It also names one
of the signature's coordinates, and the coordinate keeps its earliest dart. Two sets agree in a
coordinate with a chance of their weighted Jaccard similarity. Darts are thrown only up to the
rank by which all coordinates are expected to be hit; where one is not, up to twice that.
"""

from __future__ import annotations

import numpy as np

from voltledger.llm.words import mix, salted

# So many darts are gathered in one sweep at most, but for one region's.
SWEEP = 1 << 16
# So many coordinates are filled together at most, but for one set's. Each takes about eight darts,
# so that many small sets at once need no more memory than few.
CELLS = 1 << 16
# Ranks are compared to this many bits of the limit; sets times size must fit in the others.
RANK_BITS = 34


def uniform(x: np.ndarray) -> np.ndarray:
    """Above 0 and below 1, from the upper bits."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def throw(key, width, low, weight, limit, owner, size):
    """Darts of all regions up to each one's rank limit: set, coordinate, rank, name."""
    found = []
    rank = np.zeros(len(key))
    thrown = 0
    live = np.arange(len(key))
    while len(live):
        sweep = max(1, min(256, SWEEP // len(live)))
        number = np.arange(thrown, thrown + sweep, dtype=np.uint64)
        name = mix(key[live, None] + mix(number + np.uint64(1))[None, :])
        gaps = -np.log(uniform(name)) / width[live, None]
        ranks = rank[live, None] + np.cumsum(gaps, axis=1)
        height = low[live, None] + width[live, None] * uniform(salted(name, 3))
        hit = (ranks < limit[live, None]) & (height < weight[live, None])
        row, _ = np.nonzero(hit)
        name = name[hit]
        coordinate = (salted(name, 5) >> np.uint64(32)).astype(np.int64) * size >> 32
        found.append((owner[live[row]], coordinate, ranks[hit], name))
        rank[live] = ranks[:, -1]
        live = live[ranks[:, -1] < limit[live]]
        thrown += sweep
    return [np.concatenate(part) for part in zip(*found)]


def signatures(
    elements: np.ndarray, weights: np.ndarray, offsets: np.ndarray, size: int
) -> np.ndarray:
    """One row of ``size`` dart names per set; a set without weight has a row of zeros.

    ``elements`` are 64-bit hashes, none twice in a set; set k has those from offsets[k] on.
    """
    n, step = len(offsets) - 1, max(1, CELLS // size)
    made = np.zeros((n, size), np.uint64)
    for start in range(0, n, step):
        ends = offsets[start : start + step + 1]
        own = slice(ends[0], ends[-1])
        made[start : start + step] = filled(elements[own], weights[own], ends - ends[0], size)
    return made


def filled(
    elements: np.ndarray, weights: np.ndarray, offsets: np.ndarray, size: int
) -> np.ndarray:
    """The signatures of sets that are worked on together."""
    n = len(offsets) - 1
    made = np.zeros(n * size, np.uint64)
    if not len(elements):
        return made.reshape(n, size)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    bands = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))), 0).astype(np.int64) + 1
    at = np.repeat(np.arange(len(elements)), bands)
    band = np.arange(len(at)) - np.repeat(np.cumsum(bands) - bands, bands)
    low = np.where(band > 0, 2.0 ** (band - 1), 0.0)
    width = np.where(band > 0, low, 1.0)
    key = salted(elements[at], 11) + mix(band.astype(np.uint64))
    total = np.bincount(owner, weights, n)
    limit = size * (np.log(size) + 2) / np.maximum(total, 1e-300)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        mine = np.zeros(n, bool)
        mine[todo] = True
        use = mine[owner[at]]
        whose, coordinate, rank, name = throw(
            key[use], width[use], low[use], weights[at[use]], limit[owner[at[use]]],
            owner[at[use]], size,
        )
        cell = (whose * size + coordinate).astype(np.uint64)
        scaled = (rank / limit[whose] * (1 << RANK_BITS)).astype(np.uint64)
        order = np.argsort(cell << np.uint64(RANK_BITS) | scaled)
        cells = cell[order]
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        made[cells[first]] = name[order[first]] | np.uint64(1)
        todo = todo[(made.reshape(n, size)[todo] == 0).any(axis=1)]
        made.reshape(n, size)[todo] = 0
        limit[todo] *= 2
    return made.reshape(n, size)
