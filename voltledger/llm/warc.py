"""Web archive (WARC) records whose payload bytes are stored once, by content.

``store`` writes an archive of two tables into a folder: ``payloads`` has each distinct payload
once, under its SHA-256; ``headers`` has one row per record with its exact WARC and HTTP header
bytes and the digest of its payload. ``records`` joins them to the records as they were, byte for
byte, and ``read`` parses those bytes: it measures and digests every payload again and compares
that with what the headers say. ``write_files`` and ``read_files`` exchange the same records with
gzipped WARC files.

Of the records with equal payloads of at least ``least_bytes`` bytes, the one with the smallest key
is a ``response`` and the others are ``revisit`` records, which carry headers only and name it;
records with smaller payloads are all responses. A null payload is an empty one. A null key stands
behind all others, and of rows with the same key and payload the first one stored is the response,
so every row is one record, repeated rows too. A null address leaves its header line out; control
signs, spaces and bytes beyond ASCII in an address are percent-encoded in the header. Other columns
take no part. An empty table makes an empty archive.

Only digests are grouped and joined to choose the responses. Payload bytes are shuffled once to be
stored, equal ones within a task already combined, and once to be joined to their response.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.session import written

# Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_STATUS = "HTTP/1.1 200 OK"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# The key of a record, which the format has no field for, goes into one of our own.
KEY_FIELD = "X-Record-Key"
REFERS_FIELD = "X-Refers-To-Key"

DATE = "2024-01-01T00:00:00Z"


def sha1_base32(content: Column) -> Column:
    """The bare upper-case base32 SHA-1 of bytes: 40 hexadecimal digits, five to four."""
    digits = F.sha1(content)
    fours = [
        F.lpad(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(F.concat(*fours), BASE32_DIGITS, BASE32)


def record_id(digest: Column, key: Column, row: Column) -> Column:
    """A name for a record that is the same whenever its row is stored again."""
    text = F.md5(F.concat_ws("/", digest, key.cast("string"), row.cast("string")))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    uuid = F.concat_ws("-", *[F.substring(text, start, size) for start, size in cuts])
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


def plain_address(url: Column) -> Column:
    """The address with everything but printable ASCII percent-encoded, byte by byte."""
    pairs = F.regexp_extract_all(F.hex(F.encode(url, "UTF-8")), F.lit("(..)"), 1)
    safe = F.transform(
        pairs,
        lambda pair: F.when(
            (pair > "20") & (pair < "7F"), F.decode(F.unhex(pair), "UTF-8")
        ).otherwise(F.concat(F.lit("%"), pair)),
    )
    return F.when(url.rlike("^[!-~]*$"), url).otherwise(F.array_join(safe, ""))


def lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; one whose value is null is left out."""
    made = [F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)) for name, value in fields]
    return F.concat_ws("", *made)


def headers_of(captures: DataFrame, least_bytes: int, date: str) -> DataFrame:
    """``row, key, digest, warc, http`` for ``row, key, url, digest, sha1, bytes``."""
    order = F.struct(F.col("key").isNull().alias("none"), "key", "row")
    firsts = (
        captures.where(F.col("bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.min(order).alias("first"))
        .select("digest", F.col("first.key").alias("first_key"), F.col("first.row").alias("first_row"))
    )
    joined = captures.join(firsts, "digest", "left")
    revisit = F.coalesce(F.col("first_row") != F.col("row"), F.lit(False))
    http = F.concat(
        F.lit(HTTP_STATUS + CRLF),
        lines(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("bytes"))),
        F.lit(CRLF),
    )
    block = F.octet_length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))

    def only_revisit(value: Column) -> Column:
        return F.when(F.col("revisit"), value)

    warc = F.concat(
        F.lit(VERSION + CRLF),
        lines(
            ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
            ("WARC-Record-ID", record_id(F.col("digest"), F.col("key"), F.col("row"))),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", plain_address(F.col("url"))),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
            ("WARC-Profile", only_revisit(F.lit(PROFILE))),
            (
                "WARC-Refers-To",
                only_revisit(record_id(F.col("digest"), F.col("first_key"), F.col("first_row"))),
            ),
            (REFERS_FIELD, only_revisit(F.col("first_key"))),
            (KEY_FIELD, F.col("key")),
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", block),
        ),
        F.lit(CRLF),
    )
    made = joined.withColumn("revisit", revisit).withColumn("http", http)
    return made.select("row", "key", "digest", "revisit", warc.alias("warc"), "http")


def store(
    rows: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    date: str = DATE,
) -> None:
    """Write an archive with one record per row into the folder ``path``."""
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    captures = written(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{key}`").alias("key"),
            F.col(f"`{url}`").cast("string").alias("url"),
            F.sha2(body, 256).alias("digest"),
            sha1_base32(body).alias("sha1"),
            F.octet_length(body).cast("long").alias("bytes"),
        ),
        "warc-captures",
    )
    headers_of(captures, least_bytes, date).write.parquet(f"{path}/headers")
    bodies = rows.select(body.alias("payload"))
    distinct = bodies.groupBy(F.sha2("payload", 256).alias("digest")).agg(
        F.first("payload").alias("payload")
    )
    distinct.write.option("compression", "zstd").parquet(f"{path}/payloads")


def headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/headers")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """``digest, payload, sound`` per distinct payload; ``sound``: its bytes have that digest."""
    stored = spark.read.parquet(f"{path}/payloads")
    return stored.withColumn("sound", F.sha2("payload", 256) == F.col("digest"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``row, record``: the exact bytes of each record, without the blank lines behind it.

    A response whose payload is lost or has another digest than it is stored under has no record:
    null.
    """
    head = F.encode(F.concat("warc", "http"), "UTF-8")
    rows = headers(spark, path)
    sound = payloads(spark, path).where("sound").drop("sound")
    whole = rows.where(~F.col("revisit")).join(sound, "digest", "left")
    revisits = rows.where("revisit")
    return whole.select("row", F.concat(head, "payload").alias("record")).unionAll(
        revisits.select("row", head.alias("record"))
    )


def field(head: Column, name: str) -> Column:
    """The value of a header line, or null."""
    found = F.regexp_extract(head, rf"\n{name}: ([^\r\n]*)\r", 1)
    return F.when(found != "", found)


def head_end(content: Column) -> Column:
    """How many bytes the header takes that bytes begin with, its blank line included; headers are
    ASCII, so signs are bytes."""
    return F.instr(content.cast("string"), END) + F.lit(len(END) - 1)


def read(found: DataFrame) -> DataFrame:
    """What the bytes in ``record`` say and hold, one row per record.

    ``id, key, type, url, refers_id, refers_to, said_digest`` come from the headers;
    ``payload_bytes, payload_digest`` are measured on a response's payload and null for a revisit;
    ``sound`` is true if the block is as long, and the payload digested, as the headers say.
    ``key`` and ``refers_to`` are texts.
    """
    record = F.col("record")
    cut = found.select("record", head_end(record).alias("head"))
    block = cut.select(
        F.substring(record, F.lit(1), F.col("head")).cast("string").alias("head"),
        F.substring(record, F.col("head") + 1, F.octet_length(record)).alias("block"),
    )
    body = F.substring(F.col("block"), head_end(F.col("block")) + 1, F.octet_length("block"))
    parsed = block.select(
        field(F.col("head"), "WARC-Record-ID").alias("id"),
        field(F.col("head"), KEY_FIELD).alias("key"),
        field(F.col("head"), "WARC-Type").alias("type"),
        field(F.col("head"), "WARC-Target-URI").alias("url"),
        field(F.col("head"), "WARC-Refers-To").alias("refers_id"),
        field(F.col("head"), REFERS_FIELD).alias("refers_to"),
        F.substring_index(field(F.col("head"), "WARC-Payload-Digest"), ":", -1).alias("said_digest"),
        field(F.col("head"), "Content-Length").cast("long").alias("said_bytes"),
        F.octet_length("block").alias("block_bytes"),
        body.alias("body"),
    )
    response = F.col("type") == "response"
    measured = parsed.select(
        "*",
        F.when(response, F.octet_length("body").cast("long")).alias("payload_bytes"),
        F.when(response, sha1_base32(F.col("body"))).alias("payload_digest"),
    )
    same = F.when(response, F.col("payload_digest") == F.col("said_digest")).otherwise(True)
    sound = F.coalesce((F.col("said_bytes") == F.col("block_bytes")) & same, F.lit(False))
    return measured.withColumn("sound", sound).drop("body", "said_bytes", "block_bytes")


def captures(found: DataFrame, key_type: str = "long") -> DataFrame:
    """``key, url, payload_bytes, payload_digest, record_type, refers_to, verified`` per record of
    ``read``, a revisit with the figures of the response that it names.

    ``verified``: the record is sound and, for a revisit, its response is there, sound, and has the
    digest that the revisit says.
    """
    found = written(found, "warc-read")
    response = F.col("type") == "response"
    targets = found.where(response).select(
        F.col("id").alias("refers_id"),
        F.col("payload_bytes").alias("target_bytes"),
        F.col("payload_digest").alias("target_digest"),
        F.col("sound").alias("target_sound"),
    )
    joined = found.join(targets, "refers_id", "left")
    held = F.col("target_sound") & (F.col("target_digest") == F.col("said_digest"))
    verified = F.col("sound") & F.when(response, True).otherwise(F.coalesce(held, F.lit(False)))
    return joined.select(
        F.col("key").cast(key_type).alias("key"),
        "url",
        F.coalesce("payload_bytes", "target_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "target_digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(key_type).alias("refers_to"),
        verified.alias("verified"),
    )


def write_files(found: DataFrame, path: str) -> None:
    """Write ``record`` of each row to gzipped WARC files, one per task, in the folder ``path``."""
    text = found.select(F.col("record").cast("string"))
    text.write.option("lineSep", END).option("compression", "gzip").text(path)


def joined_records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The records of files that come line by line, each file as a whole and in order."""
    crlf = CRLF.encode()
    name, head, body, missing = None, [], bytearray(), 0
    for frame in frames:
        made: list[bytes] = []
        for line, file in zip(frame["value"], frame["file"]):
            if file != name:
                if head:
                    raise ValueError(f"{name}: the last record is cut off")
                name = file
            if missing:
                body += line
                missing -= len(line)
                if missing > 0:
                    body += crlf
                    missing -= len(crlf)
                if missing < 0:
                    raise ValueError(f"{name}: a record is longer than it says")
            elif line:
                head.append(line)
                continue
            elif head:
                said = [one for one in head if one.lower().startswith(b"content-length:")]
                if not said:
                    raise ValueError(f"{name}: a record does not say how long it is")
                missing = int(said[0].split(b":")[1])
            if head and not missing:
                made.append(crlf.join(head) + END.encode() + bytes(body))
                head, body = [], bytearray()
        yield pd.DataFrame({"record": made})
    if head:
        raise ValueError(f"{name}: the last record is cut off")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``record`` of the gzipped WARC files in a folder. A gzipped file is read by one task, line
    by line; what is held at once are some thousand lines and one record."""
    found = spark.read.option("lineSep", CRLF).option("pathGlobFilter", "*.gz").text(path)
    found = found.select(F.col("value").cast("binary"), F.input_file_name().alias("file"))
    return found.mapInPandas(joined_records, "record binary")
