"""What a Python worker keeps between its tasks."""

import ctypes
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voltledger.llm import decontaminate, neardup, sentencepieces, words
from voltledger.llm.memory import giving_back

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ROOT = str(Path(__file__).resolve().parents[2])


def batch(texts):
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["node", "text"]
    )


def test_segments_are_forgotten_behind_a_task():
    data = sentencepieces.read_model(MODEL)
    texts = ["some words to know", None, "", "and some more words"]
    made = list(sentencepieces.coded_rows(iter([batch(texts)]), data, 1, 1, True))
    assert [x for part in made for x in part.column(5).to_pylist()] == [True] * 4
    assert not sentencepieces.codec_of(data, 1).number
    assert not len(sentencepieces.codec_of(data, 1).flat)


@pytest.mark.parametrize("rows", [neardup.key_rows, neardup.bag_rows])
def test_tables_are_forgotten_behind_a_task(rows):
    made = list(rows(iter([batch(["one two three four five six", "", "one"])])))
    assert sum(len(part) for part in made) >= 2
    assert not words._powers


def test_memory_is_given_back_when_a_task_ends_early_or_fails():
    def work(batches):
        words.powers(words.BASE, 8)
        for one in batches:
            yield 1 // one

    stopped = giving_back(work)(iter([1, 1]))
    assert next(stopped) == 1 and words._powers
    stopped.close()
    assert not words._powers
    with pytest.raises(ZeroDivisionError):
        list(giving_back(work)(iter([1, 0])))
    assert not words._powers


# Every hundredth of the texts stays, so that the others leave holes between those.
HELD = """
import re
from voltledger.llm.memory import giving_back

def held():
    text = open("/proc/self/smaps_rollup").read()
    return sum(map(int, re.findall(r"\\nPss_Anon: +(\\d+)", text))) / 1024

kept = []
def work(batches):
    for batch in batches:
        texts = [bytes(4000) for _ in range(50_000)]
        kept.extend(texts[::100])
        yield len(texts)

before = held()
assert list(WRAP(work)(iter([0]))) == [50_000]
print(held() - before)
"""


@pytest.mark.skipif(
    not hasattr(ctypes.CDLL(None), "malloc_trim") or not Path("/proc/self/smaps_rollup").exists(),
    reason="another C library or system",
)
def test_a_process_keeps_little_of_what_a_task_freed():
    def grown(wrap):
        code = HELD.replace("WRAP", wrap)
        run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
        assert run.returncode == 0, run.stderr
        return float(run.stdout)

    assert grown("") > 150
    assert grown("giving_back") < 50


def test_udfs_over_several_batches_of_a_task(spark):
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "2")
    try:
        text = "a line of words that is one of the passages of the benchmark"
        docs = spark.createDataFrame(
            [(1, text), (2, None), (3, ""), (4, f"before {text} behind"), (5, "other words")],
            "doc_id long, text string",
        ).coalesce(1)
        items = spark.createDataFrame([(7, text)], "item_id long, text string")
        hits = decontaminate.with_hits(docs, items)
        found = {r[0]: r[1] for r in hits.select("doc_id", F.size("hits")).collect()}
        assert found == {1: 1, 2: 0, 3: 0, 4: 1, 5: 0}
        sketch = [bytes([k]) * neardup.SKETCH for k in range(5)]
        pairs = spark.createDataFrame(
            [(k, bytearray(sketch[k]), bytearray(sketch[k // 2 * 2]), [1, 2, k], [1, 2, 4]) for k in range(3, 5)]
            + [(k, bytearray(sketch[k]), bytearray(sketch[0]), [5, 6], [6, 7, 8]) for k in range(3)],
            "k int, a binary, b binary, x array<long>, y array<long>",
        ).coalesce(1)
        alike = pairs.select(
            "k", neardup.sketched_similarity("a", "b"), neardup.bag_similarity("x", "y")
        )
        assert {tuple(r) for r in alike.collect()} == {
            (0, 1.0, 0.25), (1, 0.0, 0.25), (2, 0.0, 0.25), (3, 0.0, 0.5), (4, 1.0, 1.0),
        }
    finally:
        spark.conf.set(size, before)
