import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.odd import no_documents, odd_documents, prose
from voltledger.llm import decontaminate
from voltledger.llm.words import split_words


def plain(text, items):
    """Items with a window of their length that reaches 0.8, with the best similarity."""
    words, made = split_words(text), {}
    for item_id, item in items:
        own = split_words(item)
        if not own or not words:
            continue
        size = min(5, len(own))
        bag = Counter(tuple(own[k : k + size]) for k in range(len(own) - size + 1))
        runs = [tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
        n = len(own) - size + 1
        for start in range(max(1, len(runs) - n + 1)):
            window = Counter(runs[start : start + n])
            shared = sum((bag & window).values())
            score = shared / (sum(bag.values()) + sum(window.values()) - shared)
            if score >= 0.8:
                made[item_id] = max(made.get(item_id, 0), score)
    return made


def cases(seed):
    rng = random.Random(seed)
    items = [(k, prose(100 + k, rng.randint(1, 60))) for k in range(25)]
    items += [(50, items[3][1].upper()), (51, "loop " * 30)]
    docs = []
    for k in range(250):
        words = rng.choice(items)[1].split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([["other"], [], ["two", "words"]])
        words = words[rng.choice([0, 0, 1, 3]) :]
        docs.append(prose(k, rng.choice([0, 30])) + " " + ", ".join(words) + prose(k, rng.choice([0, 9])))
    return items, docs


def test_against_every_window():
    items, docs = cases(1)
    index = decontaminate.index(items)
    found = decontaminate.search(docs, index, 0.8)
    want = [plain(text, items) for text in docs]
    assert sum(map(len, want)) > 100
    assert [{row[0]: row[3] for row in rows} for rows in found] == want


def test_windows_are_cut_into_steps(monkeypatch):
    items, docs = cases(2)
    index = decontaminate.index(items)
    whole = decontaminate.search(docs, index, 0.8)
    monkeypatch.setattr(decontaminate, "PLACES_AT_ONCE", 1)
    assert decontaminate.search(docs, index, 0.8) == whole


def test_passages_with_repeated_runs_are_found():
    """Items of shared words and a run of one word, with a run of another word in the document."""
    rng = random.Random(6)
    items, docs = [], []
    for k in range(300):
        shared, run = prose(1000 + k, 130).split(), rng.randint(9, 15)
        at = rng.choice([0, 40, 130])
        items.append((k, " ".join(shared[:at] + ["same"] * run + shared[at:])))
        changed = " ".join(shared[:at] + ["other"] * run + shared[at:])
        docs.append(prose(k, 20) + " " + changed + " " + prose(k + 1, 20))
    found = decontaminate.search(docs, decontaminate.index(items), 0.8)
    want = [plain(text, [items[k]]) for k, text in enumerate(docs)]
    assert sum(map(len, want)) >= 230
    assert all(k in {row[0] for row in found[k]} for k, one in enumerate(want) if one)


def test_repeated_shingles_against_every_window():
    rng = random.Random(9)
    words = ["a", "b", "c"]
    items = [(k, " ".join(rng.choices(words, [8, 1, 1], k=rng.randint(4, 25)))) for k in range(30)]
    docs = [" ".join(rng.choices(words, [8, 1, 1], k=rng.randint(0, 60))) for _ in range(150)]
    found = decontaminate.search(docs, decontaminate.index(items), 0.8)
    want = [plain(text, items) for text in docs]
    got = [{row[0]: row[3] for row in rows} for rows in found]
    assert sum(map(len, want)) > 500 and got == want


def test_fingerprints_are_those_of_the_multiset():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 6, 300).astype(np.uint64)
    region = np.where(np.arange(300) < 120, 0, 120)
    n = 25
    starts = np.concatenate([np.arange(0, 96), np.arange(120, 276)])
    got = decontaminate.prints(values, region, starts, starts + n, n)
    for start, print_ in zip(starts, got):
        window = np.sort(values[start : start + n])
        alone = decontaminate.prints(window, np.zeros(n, np.int64), np.array([0]), np.array([n]), n)
        assert print_ == alone[0]


def test_few_pairs_are_compared(monkeypatch):
    items, docs = [(k, prose(k, 60)) for k in range(100)], [prose(500 + k, 3_000) for k in range(20)]
    docs[3] += " " + items[7][1]
    seen = []
    real = decontaminate.candidates
    monkeypatch.setattr(decontaminate, "candidates", lambda f, g: seen.append(len(f) * len(g.items)) or real(f, g))
    found = decontaminate.search(docs, decontaminate.index(items), 0.8)
    assert [[row[0] for row in rows] for rows in found] == [[7] if k == 3 else [] for k in range(20)]
    assert sum(seen) < 0.001 * 20 * 3_000 * 100


def test_a_large_benchmark_is_refused(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_CHARS", 10)
    items = spark.createDataFrame([(1, "more than ten signs")], "item_id long, text string")
    with pytest.raises(ValueError, match="more than the 10"):
        decontaminate.parts_of(items)


def test_blocks_list_everything_within_the_radius():
    rng = np.random.default_rng(0)
    index = decontaminate.index([(k, prose(k, 30)) for k in range(200)])
    (group,) = index.groups
    flips = np.zeros(len(group.prints), np.uint64)
    for k in range(len(flips)):
        for bit in rng.choice(64, rng.integers(0, 30), replace=False):
            flips[k] |= np.uint64(1) << np.uint64(bit)
    seen = group.prints ^ flips
    window, item = decontaminate.candidates(seen, group)
    near = np.bitwise_count(seen[:, None] ^ group.prints[None, :]) <= decontaminate.RADIUS
    assert set(zip(window.tolist(), item.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_rows_odd_rows_and_parts(spark, monkeypatch):
    items, docs = cases(3)
    table = spark.createDataFrame([(k, t, "x") for k, t in enumerate(docs)], "doc_id long, text string, hits string")
    benchmark = spark.createDataFrame([*items, (None, items[0][1]), (90, None), (91, " !")], "item_id long, text string")
    want = {(k, i) for k, t in enumerate(docs) for i in plain(t, items)}
    want |= {(k, None) for k, i in want if i == 0}
    got = decontaminate.matches(table, benchmark).collect()
    assert {(row.doc_id, row.item_id) for row in got} == want and len(got) == len(want)
    monkeypatch.setattr(decontaminate, "PART_CHARS", 1500)
    assert len(decontaminate.parts_of(benchmark)) > 2
    got = decontaminate.matches(table, benchmark).collect()
    assert {(row.doc_id, row.item_id) for row in got} == want and len(got) == len(want)
    odd = decontaminate.with_hits(odd_documents(spark), benchmark).collect()
    assert len(odd) == odd_documents(spark).count()
    assert all({hit.item_id for hit in row.hits} - {None} == set(plain(row.text, items)) for row in odd)
    assert decontaminate.matches(no_documents(spark), benchmark).collect() == []
    none = benchmark.where("false")
    assert decontaminate.matches(table, none).collect() == []
