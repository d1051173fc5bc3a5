import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from voltledger.llm import warc
from voltledger.session import new_path

SCHEMA = "page_id long, url string, html string, digest string, row int, `key` string, `odd.name` int"

HTML = [
    None,
    "",
    "",
    "<p>one</p>",
    "<p>one</p>",
    "<p>one</p>",
    "ends with a break\r\n",
    "two breaks\r\n\r\n",
    "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc",
    "a lone return \r",
    "naïve 日本語 \x00 \U0001f389",
    "x" * 300_000,
    "\r\n" * 5_000,
]


def pages(spark, data):
    return spark.createDataFrame(
        [(key, url, html, "d", 7, "k", 1) for key, url, html in data], SCHEMA
    ).repartition(3)


def odd_pages():
    urls = ["http://a.example/", None, "http://b.example/x y\r\nWARC-Type: lie", "http://ü.example/", ""]
    rows = [(10 + k, urls[k % 5], html) for k, html in enumerate(HTML)]
    return [*rows, (3, "u", "<p>one</p>"), (3, "u", "<p>one</p>"), (None, "n", "<p>one</p>"), (None, "n", "only")]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(data, least=0):
    """Per row: key, bytes, digest, type, refers_to."""
    seen = {}
    ordered = sorted(range(len(data)), key=lambda k: (data[k][0] is None, data[k][0] or 0))
    out = []
    for k in ordered:
        key, _, html = data[k]
        size = len((html or "").encode())
        if size >= least and (html or "") in seen:
            out.append((key, size, digest(html), "revisit", seen[html or ""]))
        else:
            seen.setdefault(html or "", key)
            out.append((key, size, digest(html), "response", None))
    return sorted(out, key=str)


def got(found):
    rows = found.collect()
    assert all(row.verified for row in rows)
    return sorted(
        [(r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows], key=str
    )


@pytest.mark.parametrize("least", [0, 5])
def test_against_plain_python(spark, least):
    data = odd_pages()
    path = new_path(spark, "warc")
    warc.store(pages(spark, data), path, least_bytes=least)
    assert got(warc.captures(warc.read(warc.records(spark, path)))) == expected(data, least)
    assert warc.payloads(spark, path).count() == len({html or "" for _, _, html in data})
    assert warc.headers(spark, path).count() == len(data)


def test_a_hot_payload_is_stored_once(spark):
    rng = random.Random(4)
    data = [(k, "u", "same" if k % 3 else f"page {rng.random()}") for k in range(1, 301)]
    path = new_path(spark, "warc")
    warc.store(pages(spark, data), path)
    found = warc.captures(warc.read(warc.records(spark, path)))
    assert got(found) == expected(data)
    assert warc.payloads(spark, path).count() == 101


def plain_record(row):
    """The bytes of a response, by hand."""
    body = (row.html or "").encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body)
    return b"Content-Length: %d\r\n\r\n" % (len(http) + len(body)) + http + body


def test_records_are_rebuilt_byte_for_byte(spark):
    data = odd_pages()
    path = new_path(spark, "warc")
    warc.store(pages(spark, data), path)
    made = [row.record for row in warc.records(spark, path).collect()]
    responses = [m for m in made if b"\r\nWARC-Type: response\r\n" in m.split(b"\r\n\r\n")[0] + b"\r\n"]
    wanted = {plain_record(row) for row in pages(spark, data).collect()}
    assert len(responses) == len(wanted)
    assert {w for m in responses for w in wanted if m.endswith(w)} == wanted
    ids = [m.split(b"WARC-Record-ID: ")[1].split(b"\r\n")[0] for m in made]
    assert len(set(ids)) == len(data)
    assert all(m.startswith(b"WARC/1.1\r\nWARC-Type: ") for m in made)
    assert not any(b"\r\nWARC-Type: lie" in m for m in made)
    assert any(b"http://b.example/x%20y%0D%0AWARC-Type:%20lie\r\n" in m for m in made)


def test_files_hold_the_same_records(spark, tmp_path):
    data = odd_pages()
    path = new_path(spark, "warc")
    warc.store(pages(spark, data), path)
    found = warc.records(spark, path)
    warc.write_files(found.repartition(2), str(tmp_path / "files"))
    back = warc.read_files(spark, str(tmp_path / "files"))
    assert sorted(r.record for r in back.collect()) == sorted(r.record for r in found.collect())
    assert got(warc.captures(warc.read(back))) == expected(data)


def test_a_file_that_is_cut_off_is_refused(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort\r\n\r\n"
    (tmp_path / "cut.gz").write_bytes(gzip.compress(record))
    with pytest.raises(Exception, match="cut off"):
        warc.read_files(spark, str(tmp_path)).collect()


def test_damage_is_seen(spark):
    data = [(1, "u", "first"), (2, "u", "second"), (3, "u", "first")]
    path, bad = new_path(spark, "warc"), new_path(spark, "warc")
    warc.store(pages(spark, data), path)
    warc.headers(spark, path).write.parquet(f"{bad}/headers")
    spoiled = F.when(F.col("payload") == F.lit(b"first"), F.lit(b"fIrst")).otherwise(F.col("payload"))
    stored = warc.payloads(spark, path).withColumn("payload", spoiled).drop("sound")
    stored.write.parquet(f"{bad}/payloads")
    assert sorted(r.sound for r in warc.payloads(spark, bad).collect()) == [False, True]
    rows = warc.captures(warc.read(warc.records(spark, bad).where("record is not null"))).collect()
    assert sorted((r.key, r.verified) for r in rows) == [(2, True), (3, False)]


def test_empty_table(spark):
    path = new_path(spark, "warc")
    warc.store(spark.createDataFrame([], SCHEMA), path)
    assert warc.captures(warc.read(warc.records(spark, path))).collect() == []


def test_payload_bytes_beyond_text(spark, tmp_path):
    body = bytes(range(256)) * 3
    rows = spark.createDataFrame([(1, "u", body)], "page_id long, url string, html binary")
    path = new_path(spark, "warc")
    warc.store(rows, path)
    found = warc.records(spark, path)
    assert found.first().record.endswith(body)
    warc.write_files(found, str(tmp_path / "files"))
    assert warc.read_files(spark, str(tmp_path / "files")).first().record.endswith(body)
