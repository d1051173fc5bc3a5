import zlib

import numpy as np
import pytest

from tests.llm.odd import no_documents, odd_documents
from voltledger.llm import ftrl, quality, toxicity

LABELS = "doc_id long, quality int, toxic int, score string"
SF_DIR = "/root/testdata/sf0.1"


def both(spark, docs, labels):
    yield quality.with_quality(docs, labels)
    yield toxicity.with_toxicity(docs, labels)


def test_odd_rows_keep_their_number_and_have_scores(spark):
    labels = spark.createDataFrame(
        [(k, k % 2, (k + 1) % 2, "x") for k in range(12)]
        + [(5, 0, 0, "x"), (None, 1, 1, None), (4, None, None, None), (3, 7, -1, None)],
        LABELS,
    )
    docs = odd_documents(spark)
    for scored in both(spark, docs, labels):
        rows = scored.collect()
        assert len(rows) == docs.count() and scored.columns == docs.columns
        assert all(0 <= row.score <= 1 for row in rows)


def test_without_labels_every_score_is_one_half(spark):
    for scored in both(spark, odd_documents(spark), spark.createDataFrame([], LABELS)):
        assert {row.score for row in scored.collect()} == {0.5}


def test_no_documents(spark):
    labels = spark.createDataFrame([(1, 1, 0, "x")], LABELS)
    for scored in both(spark, no_documents(spark), labels):
        assert scored.collect() == []


def test_null_and_empty_texts_score_alike(spark):
    labels = spark.createDataFrame([(k, 1, 0, "x") for k in range(12)], LABELS)
    for scored in both(spark, odd_documents(spark), labels):
        found = {row.doc_id: row.score for row in scored.where("doc_id in (1, 2)").collect()}
        assert found[1] == found[2]


def test_no_more_rows_are_used_than_the_bound(spark):
    docs = spark.createDataFrame([(k, f"w{k}") for k in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0, "x") for k in range(300)], LABELS)
    how = ftrl.Training(bits=18, l1=0.0, sample=20, epochs=1)
    w = ftrl.train(docs, labels, "quality", ~quality.held_out(), quality.features, how)
    shapes, bias = 1, 1
    assert 20 <= np.count_nonzero(w) <= 20 + shapes + bias


def test_held_out_rows_follow_the_checksum(spark):
    docs = odd_documents(spark).where("doc_id is not null").select("doc_id")
    rows = docs.select("doc_id", quality.held_out().alias("q"), toxicity.held_out().alias("t"))
    for row in rows.collect():
        crc = zlib.crc32(str(row.doc_id).encode())
        assert (row.q, row.t) == (crc % 3 == 1, crc % 5 == 0)


def test_the_update_is_the_published_one():
    """A step for step run over one coordinate at a time."""
    how = ftrl.Training(bits=3, alpha=0.5, beta=1.0, l1=0.1, l2=0.3, epochs=2)
    rows = [np.array([1, 4]), np.array([4]), np.array([2, 5, 6])]
    labels = np.array([1.0, 0.0, 1.0])
    z, n = [0.0] * 9, [0.0] * 9

    def weight(k):
        free = 0.0 if k < 8 and abs(z[k]) <= 0.1 else z[k] - (0.1 * np.sign(z[k]) if k < 8 else 0)
        return -free / ((1.0 + n[k] ** 0.5) / 0.5 + 0.3)

    for _ in range(2):
        for row, y in zip(rows, labels):
            at = [*row, 8]
            w = [weight(k) for k in at]
            g = 1 / (1 + np.exp(-sum(w))) - y
            for k, wk in zip(at, w):
                sigma = ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / 0.5
                z[k] += g - sigma * wk
                n[k] += g * g
    assert np.allclose(ftrl.fit(rows, labels, how), [weight(k) for k in range(9)])


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(spark, module, label):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = next(s for m, s in zip((quality, toxicity), both(spark, docs, labels)) if m is module)
    pairs = scored.where(module.held_out()).join(labels, "doc_id").select("score", label).collect()
    right = [(row.score >= 0.5) == row[label] for row in pairs]
    ones = [row.score >= 0.5 for row in pairs if row[label] == 1]
    assert len(right) > 500 and np.mean(right) > 0.97 and np.mean(ones) > 0.8
