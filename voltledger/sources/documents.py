"""Files that are one JSON document each: a list of records or a single one, indented or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def is_one_value(text: Column) -> Column:
    """The text is exactly one JSON value, with nothing but white space around it.

    Put in brackets it must be a list of one, and put behind a name an object of one. What
    follows a first value can close the list or the object, but not both.
    """
    in_list = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}"))))
    return F.coalesce((in_list == 1) & (in_object == 1), F.lit(False))


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per file: ``file``, ``rejected``, and its ``records``, an array of structs.

    A file is rejected whole unless it is exactly one list or object and every record fits the
    schema. One task reads a file, and its text must fit in a row (2 GB).
    """
    text = F.col("value")
    is_list = F.ltrim(F.translate("value", "\t\r\n", "   ")).startswith("[")
    elements = F.when(is_list, F.from_json(text, "array<string>"))
    parsed = F.transform(
        elements.otherwise(F.array(text)),
        lambda element: F.from_json(element, with_corrupt(schema), PERMISSIVE),
    )
    faulty = F.exists("records", lambda record: record.isNull() | record[CORRUPT].isNotNull())
    rejected = F.coalesce(~F.col("is_whole") | faulty, F.lit(True))
    return (
        spark.read.text(path, wholetext=True)
        .select(
            F.col("_metadata.file_path").alias("file"),
            is_one_value(text).alias("is_whole"),
            parsed.alias("records"),
        )
        .select("file", rejected.alias("rejected"), "records")
    )
