import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.odd import no_documents, odd_documents, prose
from voltledger.llm import darts, neardup
from voltledger.llm.graph import components
from voltledger.llm.words import split_words


def bag(text):
    words = split_words(text)
    runs = [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else []
    return Counter(runs)


def similar(a, b):
    shared = sum((a & b).values())
    return shared >= 0.8 * (sum(a.values()) + sum(b.values()) - shared) and shared > 0


def plain_components(rows):
    """Smallest id by id, for ids that are not null and not repeated with another text."""
    texts = list({text or "" for _, text in rows})
    root = {text: text for text in texts}

    def find(text):
        while root[text] != text:
            text = root[text]
        return text

    bags = [(text, bag(text)) for text in texts]
    for k, (a, bag_a) in enumerate(bags):
        for b, bag_b in bags[k + 1 :]:
            if similar(bag_a, bag_b):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for doc_id, text in rows:
        if doc_id is not None:
            least[find(text or "")].append(doc_id)
    return {i: min(least[find(text or "")]) for i, text in rows if i is not None}


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def copies(seed, groups=12, size=8):
    rng = random.Random(seed)
    rows = []
    for group in range(groups):
        base = prose(1000 * seed + group, rng.choice([3, 20, 60, 150]))
        rows += [base, base.upper() + "!"]
        rows += [edited(base, rng, rng.choice([0, 1, 1, 2, 3, 4])) for _ in range(size)]
        rows.append(base + " " + base)
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, seed):
    rows = copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {row.doc_id: row.component_id for row in neardup.classes(docs).collect()}
    assert got == plain_components(rows)


def test_blocks_and_leaders_leave_no_link_out(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rows = copies(3, groups=2, size=60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {row.doc_id: row.component_id for row in neardup.classes(docs).collect()}
    assert got == plain_components(rows)


def test_a_large_group_stays_linear(spark):
    """A group with most of the rows: one comparison per member and leader, no more."""
    rng = random.Random(5)
    base = prose(5, 200)
    rows = [(k, edited(base, rng, 1)) for k in range(400)] + [(1000 + k, base) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shared = neardup.company(neardup.keys_of(docs))
    assert neardup.pairs_with_leaders(shared).count() < 401 * neardup.BANDS
    assert {row.component_id for row in neardup.classes(docs).collect()} == {0}
    assert neardup.survivors(docs).count() == 1


def test_given_table_keeps_one_of_equal_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    found = neardup.classes(docs).collect()
    assert {row.doc_id: row.component_id for row in found} == plain_components(rows)
    assert all(row.kept == (row.doc_id == row.component_id) for row in found)
    kept = neardup.survivors(docs)
    assert kept.columns == docs.columns
    assert sorted(row.doc_id for row in kept.collect()) == sorted(r.doc_id for r in found if r.kept)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = neardup.classes(docs).collect()
    assert len(rows) == docs.count()
    got = {(row.doc_id, row.class_id, row.component_id) for row in rows}
    assert {(1, 1, 1), (2, 1, 1), (3, 3, 3), (5, 5, 5), (6, 5, 5), (7, 7, 5)} <= got
    assert (None, None, None) in got and (10, 10, 10) in got and (12, 12, 12) in got
    kept = neardup.survivors(docs)
    assert kept.columns == docs.columns
    ids = [row.doc_id for row in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 9, 9, 10, 11, 12]
    assert ids.count(None) == 1
    assert neardup.classes(no_documents(spark)).collect() == []
    assert neardup.survivors(no_documents(spark)).collect() == []


@pytest.mark.parametrize("n, share", [(1, 1.0), (30, 0.8), (300, 0.9), (300, 0.3)])
def test_signatures_agree_by_weighted_similarity(n, share):
    rng = np.random.default_rng(n)
    names = rng.integers(1, 2**62, 2 * n).astype(np.uint64)
    names[n : n + int(n * share)] = names[: int(n * share)]
    weights = rng.integers(1, 9, 2 * n).astype(float)
    a, b = (dict(zip(names[s].tolist(), weights[s])) for s in (slice(n), slice(n, None)))
    less = sum(min(a[k], b[k]) for k in a.keys() & b.keys())
    want = less / (weights.sum() - less)
    made = darts.signatures(names, weights, np.array([0, n, 2 * n, 2 * n]), 8192)
    assert abs((made[0] == made[1]).mean() - want) < 0.025
    assert not made[2].any() and made[:2].all()


def test_a_signature_does_not_depend_on_its_batch():
    rng = np.random.default_rng(7)
    names = rng.integers(1, 2**62, 500).astype(np.uint64)
    offsets = np.array([0, 1, 20, 20, 500])
    weights = rng.integers(1, 4, 500).astype(float)
    together = darts.signatures(names, weights, offsets, 64)
    for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        alone = darts.signatures(names[a:b], weights[a:b], np.array([0, b - a]), 64)
        assert (alone[0] == together[k]).all()


def test_components_of_paths_hubs_and_loops(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 200)] + [(300, 300)]
    links += [(205, 203), (203, 201), (201, 205), (100, 150), (None, 100)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {k: 0 for k in range(61)} | {k: 100 for k in range(100, 200)}
    want |= {k: 201 for k in (201, 203, 205)}
    assert {row.node: row.component for row in found} == want and len(found) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_large_group_with_few_strays_is_sent_once(spark):
    """50,000 texts of one component and three others in a bucket: rows grow with the texts."""
    n, block = 50_000, neardup.BLOCK
    rows = spark.range(n + 3).select(
        F.lit(7).cast("long").alias("bucket"),
        F.col("id").alias("node"),
        F.when(F.col("id") < n, 0).otherwise(F.col("id")).cast("long").alias("component"),
    )
    rows = rows.unionAll(spark.range(9).select(F.lit(8).cast("long"), "id", F.lit(1).cast("long")))
    made = neardup.block_rows(rows)
    count = made.groupBy("bucket").count().collect()
    assert [(r.bucket, r["count"]) for r in count] == [(7, n + 3 * (n // block + 1))]
    largest = made.groupBy("low", "high").count().agg(F.max("count")).first()[0]
    assert largest < 2 * block


@pytest.mark.parametrize("seed", range(3))
def test_blocks_hold_every_pair_of_two_components(spark, monkeypatch, seed):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(seed)
    data = [(b, 100 * b + k, rng.choice([1, 1, 1, 2, 100 + k])) for b in range(4) for k in range(25)]
    rows = spark.createDataFrame(data, "bucket long, node long, component long")
    met = {}
    for r in neardup.block_rows(rows).collect():
        met.setdefault((r.bucket, r.low, r.high), []).append(r)
    pairs = set()
    for (_, low, high), block in met.items():
        for a in block:
            for b in block:
                ordered = a.chunk == low and b.chunk == high and (low < high or a.node < b.node)
                if ordered and a.component != b.component:
                    pair = frozenset((a.node, b.node))
                    assert pair not in pairs
                    pairs.add(pair)
    assert pairs == {
        frozenset((n, m)) for b, n, c in data for d, m, e in data if b == d and n < m and c != e
    }


def test_many_short_texts_need_little_memory_at_once():
    """Darts of 6,000 short texts thrown together took 463 MB for buckets, 961 MB for sketches."""
    texts = [f"word{k} is number {k % 7} ok" for k in range(6_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6_000)), pa.array(texts)], ["node", "text"])
    neardup.bucket_keys(texts[:10])
    for rows in (neardup.bag_rows, neardup.key_rows):
        tracemalloc.start()
        (made,) = rows(iter([batch]))
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert made.num_rows == 6_000 and peak < 100e6, (rows, peak)


@pytest.mark.parametrize("cells", [1, 64, 200, 1 << 16])
def test_a_signature_does_not_depend_on_how_many_are_filled_together(monkeypatch, cells):
    rng = np.random.default_rng(11)
    names = rng.integers(1, 2**62, 400).astype(np.uint64)
    offsets = np.array([0, 0, 1, 20, 20, 21, 390, 400, 400])
    weights = rng.integers(1, 4, 400).astype(float)
    want = darts.signatures(names, weights, offsets, 64)
    monkeypatch.setattr(darts, "CELLS", cells)
    assert (darts.signatures(names, weights, offsets, 64) == want).all()
    assert darts.signatures(names[:0], weights[:0], offsets[:1], 64).shape == (0, 64)
