"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of every text is a blob, named by the SHA-256 of its bytes. The ledger has one row
for each pair of blob and rule version that was scanned, with the spans found. A scan takes only
pairs that the ledger does not have, so that copies, older versions and unchanged files cost
nothing, and a new rule version scans only by that rule. Findings are then joined back to every
row that holds the blob.

Null text counts as empty. Spans are code points, the end exclusive, of whole matches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Spans = list[tuple[int, int]]
SPANS = "array<struct<start:int,end:int>>"
LEDGER = f"blob string, rule string, version int, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """``find`` gives the spans in a text; its version goes up whenever it changes."""

    name: str
    version: int
    find: Callable[[str], Spans]


# The three patterns and the least lengths of what they must match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX = re.compile(r"[0-9a-f]+")
HEX_LEAST = 32
# A maximal run that is long enough: the same spans as HEX with HEX_LEAST, without short matches.
HEX_RUN = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)


def find_assign(text: str) -> Spans:
    low = text.lower()
    if not any(part in low for part in ("passw", "secret", "token", "key")):
        return []
    return [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]


def find_access(text: str) -> Spans:
    if "AKIA" not in text:
        return []
    return [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]


def find_hex(text: str) -> Spans:
    return [m.span() for m in HEX_RUN.finditer(text)]


RULES = (Rule("assign", 1, find_assign), Rule("access", 1, find_access), Rule("hex", 1, find_hex))


def blob_name(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def unseen(blobs: DataFrame, ledger: DataFrame | None, rules: Sequence[Rule]) -> DataFrame:
    """One row per blob that some rule has not scanned, with the names of those rules in ``todo``."""
    wanted = F.array(*[F.lit(rule.name) for rule in rules])
    if ledger is None:
        return blobs.withColumn("todo", wanted)
    current = F.lit(False)
    for rule in rules:
        current = current | ((F.col("rule") == rule.name) & (F.col("version") == rule.version))
    done = ledger.where(current).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    todo = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    return (
        blobs.join(done, "blob", "left")
        .withColumn("todo", todo)
        .drop("done")
        .where(F.size("todo") > 0)
    )


def scan(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows for ``texts(blob, text, todo)``: one per blob and rule in ``todo``."""

    @F.pandas_udf("array<struct<rule:string,version:int,spans:array<struct<start:int,end:int>>>>")
    def found(text: pd.Series, todo: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [
                    {
                        "rule": rule.name,
                        "version": rule.version,
                        "spans": [{"start": a, "end": b} for a, b in rule.find(one)],
                    }
                    for rule in rules
                    if rule.name in names
                ]
                for one, names in zip(text, map(set, todo))
            ]
        )

    return (
        texts.select("blob", F.explode(found("text", "todo")).alias("f"))
        .select("blob", "f.rule", "f.version", "f.spans")
        .dropDuplicates(["blob", "rule"])
    )


def new_entries(
    docs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The ledger rows still missing for ``docs(doc_id, text)``; append them to the ledger.

    One row of each blob is scanned, that with the lowest ``doc_id``; ids are counted per blob
    before anything is shuffled, and the texts are then shuffled once, by id.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("blob", blob_name(F.col("text")))
    blobs = rows.groupBy("blob").agg(F.min("doc_id").alias("first_id"))
    todo = unseen(blobs, ledger, rules).withColumnRenamed("blob", "todo_blob")
    same = (F.col("blob") == F.col("todo_blob")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    return scan(rows.join(todo, same).select("blob", "text", "todo"), rules)


def findings(docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with their ``blob`` and, as ``spans_`` and the rule's name, the spans that the ledger
    has for it. Columns of ``docs`` that have these names are replaced."""
    per_blob = ledger.groupBy("blob").agg(
        *[
            F.max(
                F.when(
                    (F.col("rule") == rule.name) & (F.col("version") == rule.version),
                    F.col("spans"),
                )
            ).alias(f"spans_{rule.name}")
            for rule in rules
        ]
    )
    rows = docs.drop(*per_blob.columns).withColumn("blob", blob_name(F.col("text")))
    return rows.join(per_blob, "blob", "left")


def update_ledger(docs: DataFrame, path: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Scan what the ledger at ``path`` lacks, append it there, and return the whole ledger.

    The first call makes the ledger. A call that fails leaves it as it was, and a call that is
    made twice adds nothing; findings do not change if a pair of blob and rule stands there twice.
    """
    spark = docs.sparkSession
    try:
        known = spark.read.schema(LEDGER).parquet(path)
        known.isEmpty()
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    new_entries(docs, known, rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def digest(found: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row of ``findings``: ``doc_id``, counts by rule, the spans as text, and their SHA-256."""
    columns = [F.coalesce(f"spans_{rule.name}", F.array().cast(SPANS)) for rule in rules]

    def tag(place: int, rule: Rule) -> Callable[[Column], Column]:
        return lambda span: F.struct(
            span["start"].alias("start"),
            F.lit(place).alias("place"),
            F.lit(rule.name).alias("rule"),
            span["end"].alias("end"),
        )

    tags = [F.transform(c, tag(k, r)) for k, (r, c) in enumerate(zip(rules, columns))]
    tagged = F.array_sort(F.flatten(F.array(*tags)))
    text = F.array_join(
        F.transform(tagged, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ","
    )
    return found.select(
        "doc_id",
        *[
            F.size(column).cast("long").alias(f"n_{rule.name}")
            for rule, column in zip(rules, columns)
        ],
        text.alias("spans"),
    ).withColumn("base_sha256", F.sha2(F.col("spans").cast("binary"), 256))
