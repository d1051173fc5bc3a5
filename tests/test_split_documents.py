"""Documents read by many tasks, held against those read by one."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger import sources
from voltledger.sources.documents import read_documents
from voltledger.sources.split_documents import read_split_documents

NESTED = T.StructType().add("a", "long").add("b", T.ArrayType(T.StructType().add("c", "string")))
SCHEMA = (
    T.StructType()
    .add("id", "long")
    .add("name", "string")
    .add("tags", T.ArrayType(T.StringType()))
    .add("inner", NESTED)
)


def a_text(rng):
    signs = ['}', '{', '"', "\\", "]", "[", ",", "\n", "é", "日", " ", "a", "}}", '\\"', "\\\\"]
    return "".join(rng.choice(signs) for _ in range(rng.randrange(0, 9)))


def a_record(rng, n):
    record = {"id": n, "name": a_text(rng)}
    if rng.random() < 0.5:
        record["tags"] = [a_text(rng) for _ in range(rng.randrange(0, 4))]
    if rng.random() < 0.5:
        record["inner"] = {"a": n, "b": [{"c": a_text(rng)} for _ in range(rng.randrange(0, 3))]}
    if rng.random() < 0.2:
        record["other"] = {"x": [{}, [], {"}": "{"}]}
    return record


def a_document(rng):
    records = [a_record(rng, n) for n in range(rng.choice([0, 1, 2, 7, 30]))]
    content = rng.choice([records, records, records, a_record(rng, 5)])
    how = rng.choice([{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}])
    return rng.choice(["", "\n ", "\t"]) + json.dumps(content, **how) + rng.choice(["", "\n", " \r\n"])


def broken(rng, text):
    """The text with one fault; some leave it sound."""
    at = rng.randrange(len(text) + 1)
    return rng.choice(
        [
            text[:at],
            text[:at] + rng.choice('{}[]",\\x ') + text[at:],
            text[:at] + text[at + 1 :],
            text + text,
            text + rng.choice(["]", "}", ",", "x", "[]", "{}"]),
            text.replace("}", "]", 1),
            text.replace("[", "{", 1),
            text.replace('"id": ', '"id": "x', 1),
        ]
    )


COUNT = 70

FIXED = {
    "empty": "",
    "blank": " \n ",
    "nothing": "[]",
    "spaced": " [ \n ] ",
    "number": "5",
    "numbers": "[1, 2]",
    "null": "null",
    "nulls": '[null, {"id": 1}]',
    "mixed": '[{"id": 1}, 2]',
    "trailing": '[{"id": 1},]',
    "leading": '[,{"id": 1}]',
    "unclosed": '[{"id": 1}',
    "cut": '[{"id": 1}, {"id": 2',
    "object_cut": '{"id": 1',
    "object": '{"id": 1}',
    "two_objects": '{"id": 1}{"id": 2}',
    "two_lists": '[{"id": 1}],[{"id": 2}]',
    "reopened": '[{"id": 1}][{"id": 2}]',
    "crossed": '[{"id": 1, "tags": ["a"}, {"id": 2]}]',
    "in_text": '[{"id": 1, "name": "}, {\\"id\\": 2}]"}]',
    "wrong_type": '[{"id": 1}, {"id": "x"}]',
    "brace_behind": '[{"id": 1}]}',
    "empty_object": "[{}]",
    "missing_comma": '[{"id": 1} {"id": 2}]',
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(11)
    path = tmp_path_factory.mktemp("documents")
    for n in range(COUNT):
        text = a_document(rng)
        (path / f"made {n}.json").write_text(text, encoding="utf-8")
        (path / f"broken-{n}.json").write_text(broken(rng, text), encoding="utf-8")
    for name, text in FIXED.items():
        (path / f"{name}.json").write_text(text)
    return str(path)


def records_of(rows, many):
    found = {}
    for row in rows:
        records = found.setdefault(row.file, (row.rejected, []))[1]
        if not row.rejected:
            records += row.records if many else [row.record]
    return {file: (rejected, sorted(map(str, records))) for file, (rejected, records) in found.items()}


@pytest.mark.parametrize("split_bytes", [90, 1500])
def test_the_same_as_read_by_one_task(spark, folder, split_bytes):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = read_split_documents(spark, folder, SCHEMA).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = records_of(rows, many=False)
    want = records_of(read_documents(spark, folder, SCHEMA).collect(), many=True)
    assert len(want) > 2 * COUNT
    # A sound file without records has no row.
    want = {file: one for file, one in want.items() if one[0] or one[1]}
    assert {f.split("/")[-1] for f in want if want[f] != got.get(f)} == set()
    assert got.keys() == want.keys()
    assert sum(rejected for rejected, _ in want.values()) > 40


def test_a_large_list_is_read_by_many_tasks(spark, tmp_path):
    records = [{"id": n, "name": "} ] , [ {" * (n % 7)} for n in range(5_000)]
    (tmp_path / "one.json").write_text(json.dumps(records))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        found = sources.read_json_records(spark, str(tmp_path), SCHEMA, split=True)
        assert found.agg(F.count("*"), F.sum("id"), F.sum(F.length("name"))).first() == (
            5_000, sum(range(5_000)), sum(9 * (n % 7) for n in range(5_000)),
        )
        pieces = spark.read.option("lineSep", "}").text(str(tmp_path))
        sizes = pieces.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 10 and max(s["count"] for s in sizes) < 2_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_landing_and_errors(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "landed")
    raw.mkdir()
    (raw / "good.json").write_text('[{"id": 1}, {"id": 2}]')
    (raw / "cut.json").write_text('[{"id": 1}, {"id": 2}')
    counts = sources.land_json_documents(spark, str(raw), target, SCHEMA, split=True)
    assert tuple(counts.first()) == (2, 1)
    assert sorted(r.id for r in sources.read_accepted(spark, target, SCHEMA).collect()) == [1, 2]
    names = sorted(r.raw_line.split("/")[-1] for r in sources.read_rejected(spark, target, SCHEMA).collect())
    assert names == ["cut.json"]
    with pytest.raises(Exception, match="not one JSON document"):
        sources.read_json_records(spark, str(raw), SCHEMA, split=True).collect()
    (raw / "packed.json.gz").write_bytes(gzip.compress(b'[{"id": 1}]'))
    with pytest.raises(Exception, match="compressed"):
        sources.read_json_records(spark, str(raw), SCHEMA, split=True).collect()
