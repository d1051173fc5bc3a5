import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.odd import WORDS, no_documents, odd_documents
from voltledger.llm import boilerplate, queries

BLANK = " \t\r"


def plain(rows, least):
    """Text and number of removed lines per row of (doc_id, text, source)."""
    sites, first = defaultdict(set), {}
    for doc_id, text, source in rows:
        for place, line in enumerate((text or "").split("\n")):
            bare = line.strip(BLANK)
            if bare:
                sites[bare] |= {source} - {None}
                here = (doc_id is not None, doc_id or 0, place)
                first[bare] = min(first.get(bare, here), here)
    made = []
    for doc_id, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [
            line
            for place, line in enumerate(lines)
            if not (bare := line.strip(BLANK))
            or len(sites[bare]) < least
            or first[bare] == (doc_id is not None, doc_id or 0, place)
        ]
        made.append((doc_id, None if text is None else "\n".join(kept), len(lines) - len(kept)))
    return sorted(made, key=repr)


def found(docs, least):
    rows = boilerplate.without_boilerplate(docs, least).collect()
    return sorted([(row.doc_id, row.text, row.n_removed) for row in rows], key=repr)


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_against_plain_python(spark, least):
    rng = random.Random(least)
    lines = [f"line {k}" for k in range(12)] + ["", " ", "\t line 3 \r", "é日本"]
    rows = [
        (k, "\n".join(rng.choices(lines, k=rng.randint(0, 9))), rng.choice(["a", "b", "c", "d", None, "e"]))
        for k in range(80)
    ]
    rows += [(None, "line 1\nline 2", "a"), (7, None, "b"), rows[3], rows[3], (5, "line 1", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert found(docs, least) == plain(rows, least)


def test_many_sites_near_the_threshold(spark):
    """Estimates of hundreds of sites are not exact, so that the exact count decides."""
    rows = [(k, "at\nbelow" if k < 299 else "at", f"site{k}") for k in range(300)]
    rows += [(1000 + k, "above", f"site{k}") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    gone = {(row.doc_id, row.n_removed) for row in boilerplate.without_boilerplate(docs, 300).collect()}
    assert {k for k, n in gone if n} == {*range(1, 300), *range(1001, 1900)}
    assert max(n for _, n in gone) == 1


def test_a_long_text_of_one_line(spark):
    rows = [(k, "\n".join(["same"] * 20_000), f"s{k}") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert found(docs, 2) == [(0, "same", 19_999), (1, "", 20_000), (2, "", 20_000)]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(row.doc_id, row.text, row.source) for row in docs.collect()]
    assert found(docs, 2) == plain(rows, 2)
    assert boilerplate.without_boilerplate(docs).columns.count("n_removed") == 1
    assert boilerplate.without_boilerplate(no_documents(spark)).collect() == []


def test_no_python_runs_in_a_task(spark):
    docs = odd_documents(spark)
    plan = boilerplate.without_boilerplate(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_given_table_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        want = duck.sql(queries.ORACLES["op2_line_dedup"]).fetchall()
    got = [tuple(row) for row in queries.QUERIES["op2_line_dedup"](spark, folder).collect()]
    assert sorted(got) == sorted(want) and sum(row[2] for row in want) > 100


def cleaned_by_stage(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return {row.doc_id: row.text for row in corpus_pipeline.remove_boilerplate(spark, docs, "").collect()}


def test_long_lines_of_a_corpus_with_a_hot_source(spark):
    """A third of the rows are of one of 20 sources, so that copies stand on fewer sites than 10."""
    rng = random.Random(3)
    long = {k: f"passage {k} " + " ".join(rng.choices(WORDS, k=60)) for k in range(30)}
    sources = [f"s{k}" for k in range(20)]
    rows = []
    for k, passage in long.items():
        for copy in range(20):
            source = "s0" if rng.random() < 1 / 3 else rng.choice(sources)
            rows.append((len(rows), f"own {k} {copy}\n{passage}\nshort {k}", source))
    spreads = [len({s for _, t, s in rows if passage in t}) for passage in long.values()]
    assert 3 <= min(spreads) < 10 and {row[2] for row in rows} == set(sources)
    texts = cleaned_by_stage(spark, rows)
    assert len(texts) == len(rows)
    for k, passage in long.items():
        holding = [i for i, text in texts.items() if passage in text]
        assert holding == [20 * k]
        assert sum(text.endswith(f"short {k}") for text in texts.values()) == (1 if spreads[k] >= 10 else 20)


@pytest.mark.parametrize("n_sources, needed", [(1, (2, 2)), (2, (2, 2)), (5, (3, 3)), (9, (5, 3)), (19, (10, 3)), (40, (10, 3))])
def test_sites_needed(spark, n_sources, needed):
    rows = [(k, "x", f"s{k % n_sources}") for k in range(80)] + [(99, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert boilerplate.sites_needed(docs) == needed


def test_a_corpus_of_fewer_than_ten_sources(spark):
    """On 9 sites, short lines need 5 and long lines 3."""
    long = {n: f"long {n} " + "word " * 60 + "end" for n in (2, 3)}
    rows = []
    for site in range(9):
        lines = [f"on {n}" for n in (4, 5, 9) if site < n] + [t for n, t in long.items() if site < n]
        rows.append((site, "\n".join([f"own {site}", *lines]), f"s{site}"))
    texts = cleaned_by_stage(spark, rows)
    kept = [sorted(line for line in texts[k].split("\n") if not line.startswith("own")) for k in range(9)]
    assert kept[0] == sorted(["on 4", "on 5", "on 9", *long.values()])
    assert kept[1] == ["long 2 " + "word " * 60 + "end", "on 4"]
    assert kept[2:] == [["on 4"], ["on 4"], [], [], [], [], []]


@pytest.mark.parametrize("n_sources", [2, 9, 20])
def test_the_query_follows_the_sites_there_are(spark, tmp_path, n_sources):
    """The same documents dealt over few sources: the query and its SQL agree, and lines go."""
    folder = str(tmp_path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    dealt = docs.withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % n_sources))
    dealt.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    rows = queries.QUERIES["op2_line_dedup"](spark, folder).collect()
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = duck.sql(queries.ORACLES["op2_line_dedup"])
    assert want.columns == ["doc_id", "text", "n_removed"]
    assert sorted(map(tuple, rows)) == sorted(want.fetchall())
    assert sum(row.n_removed for row in rows) > 0
