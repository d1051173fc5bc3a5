"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.llm import (
    boilerplate,
    codes,
    decontaminate,
    mainhtml,
    neardup,
    negatives,
    quality,
    secrets,
    sentencepieces,
    toxicity,
    vectors,
    warc,
    wordpieces,
)
from voltledger.session import new_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The vocabulary files of public tokenizers; any other path of the same kind will do.
TOKENIZERS = "/opt/tokenizers"
WORD_PIECES = f"{TOKENIZERS}/byte_bpe_50k.json"
SENTENCE_PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scored(rows: DataFrame, held_out) -> DataFrame:
    return rows.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepieces.with_pieces(docs, SENTENCE_PIECES).drop("text")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    least, long = boilerplate.sites_needed(docs)
    cleaned = boilerplate.without_boilerplate(docs, least, long_sites=long)
    return cleaned.select("doc_id", "text", "n_removed")


ORACLES["op2_line_dedup"] = """
    WITH pieces AS (
        SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
    ), lines AS (
        SELECT doc_id, source, text, unnest(lines) AS line,
               unnest(range(len(lines))) AS place
        FROM pieces
    ), trimmed AS (
        SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM lines
    ), needed AS (
        SELECT greatest(2, least(10, (count(DISTINCT source) + 1) // 2)) AS sites FROM documents
    ), boilerplate AS (
        SELECT bare, min({'doc_id': doc_id, 'place': place}) AS first
        FROM trimmed, needed WHERE bare <> '' GROUP BY bare, sites
        HAVING count(DISTINCT source) >= CASE WHEN length(bare) >= 200 THEN least(3, sites) ELSE sites END
    ), marked AS (
        SELECT t.*, b.bare IS NOT NULL AND b.first <> {'doc_id': t.doc_id, 'place': t.place} AS gone
        FROM trimmed t LEFT JOIN boilerplate b USING (bare)
    )
    SELECT doc_id,
           coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text,
           count(*) FILTER (WHERE gone) AS n_removed
    FROM marked GROUP BY doc_id, marked.text
"""


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = docs.select("doc_id", "text")
    return scored(quality.with_quality(rows, labels), quality.held_out())


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.update_ledger(docs, new_path(spark, "secret-ledger"))
    return secrets.digest(secrets.findings(docs, ledger))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = docs.select("doc_id", "text")
    return scored(toxicity.with_toxicity(rows, labels), toxicity.held_out())


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return wordpieces.with_token_counts(docs, WORD_PIECES).drop("text")


@query
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.matches(docs, benchmark)


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.classes(docs).drop("node")


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return mainhtml.main_text(pages).select("page_id", "url", "text", "n_chars")


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, codebooks = codes.product_codes(table(spark, sf_dir, "embeddings"))
    return found.withColumn("codebooks_sha256", F.lit(codes.digest(codebooks)))


def nearest(points: str, entries: str) -> str:
    """SQL for the nearest entry of each point's part and its squared distance."""
    return f"""
        SELECT p.vec_id, p.label, p.part, p.point,
               min({{'error': list_sum(list_transform(range(1, len(p.point) + 1), lambda k:
                   (p.point[k] - e.point[k]) * (p.point[k] - e.point[k])))::BIGINT,
                   'entry': e.entry}}) AS best
        FROM {points} p JOIN {entries} e USING (part) GROUP BY ALL"""


def one_round(before: str, after: str) -> str:
    """SQL for a round: the codebook ``after`` from ``before``."""
    return f"""
    assigned_{after} AS ({nearest("points", before)}
    ), sums_{after} AS (
        SELECT part, entry, k, floor_div AS mean FROM (
            SELECT part, best.entry AS entry, k, sum(point[k])::BIGINT AS total, count(*) AS n,
                   (total - ((total % n) + n) % n) // n AS floor_div
            FROM assigned_{after}, range(1, 17) places(k) GROUP BY ALL)
    ), means_{after} AS (
        SELECT part, entry, list(mean ORDER BY k) AS point FROM sums_{after} GROUP BY ALL
    ), {after} AS (
        SELECT b.part, b.entry, coalesce(m.point, b.point) AS point
        FROM {before} b LEFT JOIN means_{after} m USING (part, entry)
    ), """


# The given vectors have 64 components and so 16 in a part, and no vec_id twice.
ORACLES["op11_vector_codes"] = f"""
    WITH kept AS (
        SELECT vec_id, label,
               list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS vector
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), points AS (
        SELECT vec_id, label, part, vector[1 + 16 * part : 16 + 16 * part] AS point
        FROM kept, range(4) parts(part)
    ), book_0 AS (
        SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, point
        FROM points QUALIFY entry < 256
    ), {"".join(one_round(f"book_{k}", f"book_{k + 1}") for k in range(4))} last AS (
        {nearest("points", "book_4")}
    ), coded AS (
        SELECT vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
               sum(best.error)::BIGINT AS error
        FROM last GROUP BY vec_id, label
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(point[k]::VARCHAR, ',' ORDER BY part, entry, k))
            FROM book_4, range(1, 17) places(k)) AS codebooks_sha256
    FROM coded
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLES["op12_hard_negatives"] = """
    WITH kept AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS alike,
               list_sum(list_transform(range(1, len(a.vector) + 1),
                                       lambda k: a.vector[k] * c.vector[k]))::BIGINT AS score
        FROM kept a JOIN kept c ON a.vec_id <> c.vec_id
        WHERE a.vec_id % 100 = 0
    ), positives AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id
                              ORDER BY s.score DESC, s.id)::INTEGER AS rank
    FROM positives JOIN scored s USING (anchor_id)
    WHERE NOT s.alike AND 80 * positive_score <= 100 * s.score
      AND 100 * s.score <= 100 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) <= 5
"""


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = new_path(spark, "warc")
    warc.store(table(spark, sf_dir, "pages"), archive)
    found = warc.captures(warc.read(warc.records(spark, archive)))
    return found.select(
        F.col("key").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "verified",
    )


ORACLES["op13_warc"] = """
    WITH bodies AS (
        SELECT page_id, coalesce(html, '') AS body FROM pages
    ), digested AS (
        SELECT page_id, octet_length(encode(body)) AS payload_bytes,
               sha1(body) AS digits, min(page_id) OVER (PARTITION BY body) AS first
        FROM bodies
    ), fives AS (
        SELECT *, list_transform(range(8), lambda k: ('0x' || digits[5 * k + 1 : 5 * k + 5])::BIGINT)
               AS parts
        FROM digested
    )
    SELECT page_id, payload_bytes,
           list_aggregate(list_transform(range(32), lambda k:
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((parts[1 + k // 4] >> (15 - 5 * (k % 4))) & 31)]
           ), 'string_agg', '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to,
           true AS verified
    FROM fives
"""
