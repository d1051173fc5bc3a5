import numpy as np
import pytest

from voltledger.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node long, `links` string"


def made(seed, n=300, length=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, length))
    noise = rng.uniform(0.02, 0.2, (n, 1)) * rng.standard_normal((n, length))
    rows = (centres[rng.integers(0, 12, n)] + noise).astype(np.float32)
    rows[:40] = rng.standard_normal((40, length))
    rows[50:60] = rows[50]
    rows[60:65] = 3 * rows[50]
    return rows


def plain(rows):
    unit = rows.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    root = np.arange(len(rows))
    while True:
        new = np.array([root[near[k]].min() for k in range(len(rows))])
        if (new == root).all():
            return near.sum(axis=1) - 1, root
        root = new


def frame(spark, rows):
    data = [(k, None if v is None else [x if x is None else float(x) for x in v], 1, 2, "x") for k, v in rows]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("seed, block, cell", [(1, 1000, 512), (2, 20, 512), (3, 1000, 8)])
def test_against_all_pairs(spark, monkeypatch, seed, block, cell):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "STRIPE", 32)
    rows = made(seed)
    degree, root = plain(rows)
    found = vectors.near_vectors(frame(spark, enumerate(rows)), recall=0.99999).collect()
    assert {r.vec_id: r.n_links for r in found} == dict(enumerate(degree))
    assert {r.vec_id: r.component_id for r in found} == dict(enumerate(root))
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_recall_on_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(9)
    a = rng.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((400, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    pairs = np.concatenate([a, 0.9005 * a + np.sqrt(1 - 0.9005**2) * b])
    found = vectors.near_vectors(frame(spark, enumerate(pairs))).collect()
    assert sum(row.n_links for row in found) >= 0.99 * 800


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1, 0]), (2, [2, 0]), (2, [2, 0]), (None, [1, 0]), (3, None), (4, []), (5, [0, 0]),
        (6, [0, 0]), (7, [nan, 1]), (8, [inf, 1]), (9, [None, 1]), (10, [1, 0, 0]), (11, [-1, 0]),
        (12, [1e-38, 0]), (13, [3e38, 1e30]), (None, [5, 5, 5]),
    ]
    found = vectors.near_vectors(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in found)
    assert got == [
        (0, 0, None, True), (0, 5, 1, False), (1, 5, 1, True), (2, 5, 1, False), (2, 5, 1, False),
        *[(k, 0, k, True) for k in range(3, 12)], (12, 5, 1, False), (13, 5, 1, False),
    ]


def test_no_vectors(spark):
    assert vectors.near_vectors(frame(spark, [])).collect() == []


def test_lines_grow_slowly_with_the_vectors():
    counts = [vectors.lines_for(n).count for n in (10, 10**4, 10**6, 10**9)]
    assert counts == sorted(counts) and counts[0] < 10 and counts[-1] < 400
