"""From raw documents to token ids: five stages, each over all rows that the one before kept.

Every stage takes and returns the columns of ``documents`` (and any others that are there); the
last adds those of the encoding. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.llm import boilerplate, decontaminate, neardup, quality, sentencepieces
from voltledger.session import written

SENTENCE_PIECES = "/opt/tokenizers/piece_bpe_32k.model"
ACCEPTED_SCORE = 0.5


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from their labels.

    Null and empty texts have a score like any other and go if it is below the bound. Repeated rows
    have equal scores, so they stay or go together. Other columns pass through.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rated = quality.with_quality(docs, labels, name="__quality")
    return rated.where(F.col("__quality") >= ACCEPTED_SCORE).drop("__quality")


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sites share, long lines that some share, as many as the
    sites of these documents ask for. One that was nothing else goes: all of its lines stand in
    documents before it."""
    least, long = boilerplate.sites_needed(docs)
    cleaned = boilerplate.without_boilerplate(docs, least, count="__removed", long_sites=long)
    emptied = (F.col("__removed") > 0) & (F.trim("text") == "")
    kept = cleaned.where(~F.coalesce(emptied, F.lit(False))).drop("__removed")
    if "n_chars" in docs.columns:
        chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", chars)
    return kept


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id.

    Null texts count as empty ones, and texts without words are near duplicates of their equals
    only. Of rows that repeat an id and a text one stays. A null id comes behind all others.
    """
    return neardup.survivors(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even nearly.

    Null and empty texts hold none and stay. Repeated rows stay or go together. An item without
    words is in no document; a benchmark above the size that the operator allows is refused.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    searched = decontaminate.with_hits(docs, benchmark, name="__hits")
    return searched.where(F.size("__hits") == 0).drop("__hits")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their SentencePiece ids, checked by decoding and against the library."""
    return sentencepieces.with_pieces(docs, SENTENCE_PIECES)


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", remove_boilerplate),
    ("MinHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_contaminated),
    ("SentencePiece encoding and decoding", encode),
]

# Scores, signatures and token ids are beyond SQL; the tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
