"""One large JSON document read by many tasks.

A list of records has no line breaks to be cut at that can be trusted, so it is cut at every closing
brace, also those within texts: Spark's text reader does this from any place in a file, so each
split is read by its own task. What a piece between two braces means depends on all text before it:
whether it begins within a quoted text, and how many brackets are open. Both are prefix sums. Each
piece has the number of its quotation marks, and the brackets that it opens and closes if it begins
outside or inside a text; these add up within a split, the totals of the splits add up over the
file, and with a split's start known every piece of it is known. A brace that takes the depth back
to that of the list ends a record.

First the counts alone are summed, a row per piece without its text. Then the text is read again
and put in order split by split; only a record that goes over the end of a split is put together
from pieces of several. A window holds one split, or the totals of the splits of one file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.session import written
from voltledger.sources.documents import CORRUPT, PERMISSIVE, with_corrupt

END = "}"
SPACE = "[ \\t\\r\\n]*"
COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$"

SPLIT = ("file", "split")
# Rejected files whose names are sent to every task; more are joined by a shuffle.
FEW_FILES = 100_000


def _added(c: Column, last: int, by: tuple = SPLIT, order: str = "id") -> Column:
    """The sum over the rows of a group up to the present one (0) or the one before (-1)."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, last)
    return F.coalesce(F.sum(c).over(window), F.lit(0))


def _before(c: Column) -> Column:
    return _added(c, -1)


def _so_far(c: Column) -> Column:
    return _added(c, 0)


def _earlier_splits(c: Column) -> Column:
    return _added(c, -1, ("file",), "split")


def _occurrences(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _bare() -> Column:
    """The piece without what is escaped in it, which is neither a quotation mark nor a bracket."""
    value = F.col("value")
    return F.when(value.contains("\\"), F.regexp_replace(value, r"(?s)\\.", "")).otherwise(value)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, id, size, value, quotes`` per piece."""
    found = spark.read.option("lineSep", END).text(path)
    name = F.col("_metadata.file_path")
    file = F.when(
        name.rlike(COMPRESSED),
        F.raise_error(F.concat(F.lit("a compressed file cannot be split: "), name)),
    ).otherwise(name)
    return found.select(
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("id"),
        "value",
        _occurrences(_bare(), '"').alias("quotes"),
    )


def _change(inside: Column) -> Column:
    """What a piece and the brace behind it do to the depth, if it begins ``inside`` a text."""
    begun = F.when(inside, F.regexp_replace(_bare(), '^[^"]*("|$)', "")).otherwise(_bare())
    text = F.regexp_replace(begun, '"[^"]*("|$)', "")
    ends_outside = (F.col("quotes") + inside.cast("int")) % 2 == 0
    closed = _occurrences(text, "]") + ends_outside.cast("int")
    return (_occurrences(text, "{[") - closed).cast("long")


def _is_inside(start: Column) -> Column:
    """Whether a piece begins within a text, if its split begins as ``start`` (0 or 1) says."""
    return (start + _before(F.col("quotes"))) % 2 == 1


def _split_starts(pieces: DataFrame) -> DataFrame:
    """``file, split, inside, depth, base, ended, open_end, strange`` per split.

    The state at its start, the depth at which records end, and how many ended before it.
    ``open_end``: the file has no brace behind its last piece; ``strange``: its pieces are not as
    long as it is, so it was read in another way than it is stored.
    """
    own = F.when(F.col("inside") == 1, F.col("depth_1")).otherwise(F.col("depth_0"))
    first = F.substring(F.ltrim(F.translate("value", "\t\r\n", "   ")), 1, 1)
    narrow = pieces.select(
        *SPLIT,
        "id",
        "size",
        (F.octet_length("value") + 1).cast("long").alias("bytes"),
        first.alias("opens"),
        "quotes",
        _change(F.lit(False)).alias("outside"),
        _change(F.lit(True)).alias("inside"),
    )

    def depth(start: int) -> Column:
        return F.when(_is_inside(F.lit(start)), F.col("inside")).otherwise(F.col("outside"))

    narrow = narrow.select(
        "*",
        (_so_far(F.col("quotes")) % 2).alias("parity"),
        depth(0).alias("change_0"),
        depth(1).alias("change_1"),
    )
    depths = [_so_far(F.col(f"change_{start}")).alias(f"depth_{start}") for start in (0, 1)]
    narrow = narrow.select(*SPLIT, "id", "size", "bytes", "opens", "parity", *depths)
    narrow = written(narrow, "document-pieces")
    splits = narrow.groupBy(*SPLIT).agg(
        *[F.max_by(name, "id").alias(name) for name in ("parity", "depth_0", "depth_1")],
        F.min_by("opens", "id").alias("opens"),
        F.sum("bytes").alias("bytes"),
        F.max("size").alias("size"),
    )
    by_split = Window.partitionBy("file").orderBy("split")
    whole = by_split.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    splits = splits.select(
        *SPLIT,
        "depth_0",
        "depth_1",
        (_earlier_splits(F.col("parity")) % 2).alias("inside"),
        F.when(F.first("opens").over(whole) == "[", 1).otherwise(0).alias("base"),
        (F.sum("bytes").over(whole) - F.col("size")).alias("over"),
    )
    splits = splits.select(
        *SPLIT, "inside", "base", "over", _earlier_splits(own).alias("depth")
    )
    splits = written(splits, "document-splits")
    is_end = ((F.col("parity") + F.col("inside")) % 2 == 0) & (F.col("depth") + own == F.col("base"))
    ends = narrow.join(splits, list(SPLIT)).groupBy(*SPLIT).agg(F.count_if(is_end).alias("ends"))
    return written(
        splits.join(ends, list(SPLIT)).select(
            *SPLIT,
            "inside",
            "depth",
            "base",
            _earlier_splits(F.col("ends")).alias("ended"),
            (F.col("over") == 1).alias("open_end"),
            (~F.col("over").isin(0, 1)).alias("strange"),
        ),
        "document-starts",
    )


def _joined_by(place: str) -> Column:
    """The texts of a group in the order of ``place``, with the braces between them."""
    parts = F.sort_array(F.collect_list(F.struct(place, "value")))
    return F.array_join(F.transform(parts, lambda part: part["value"]), END)


FILE = ("base", "open_end", "strange")


def _texts(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """``file, n, is_end, value`` and what is known of the file: the n-th record of each file with
    what stands before it, without its last brace. What is behind the last record is no end."""
    rows = pieces.join(starts, list(SPLIT)).withColumn("within", _is_inside(F.col("inside")))
    rows = rows.select(
        *SPLIT,
        "id",
        "value",
        "inside",
        "depth",
        "ended",
        *FILE,
        _change(F.col("within")).alias("change"),
        ((F.col("inside") + _so_far(F.col("quotes"))) % 2 == 0).alias("ends_outside"),
    )
    depth = F.col("depth") + _so_far(F.col("change"))
    rows = rows.withColumn("is_end", F.col("ends_outside") & (depth == F.col("base")))
    rows = rows.withColumn("n", F.col("ended") + _before(F.col("is_end").cast("int")))
    fresh = (F.col("split") == 0) | ((F.col("inside") == 0) & (F.col("depth") == F.col("base")))
    begins = fresh | (F.col("n") > F.col("ended"))
    # The pieces of a split are in one partition already, so this takes no shuffle.
    parts = rows.withColumn("begins", begins).groupBy(*SPLIT, "n", "begins", *FILE)
    parts = parts.agg(_joined_by("id").alias("value"), F.max("is_end").alias("is_end"))
    parts = written(parts, "document-parts")
    whole = F.col("begins") & F.col("is_end")
    # Only records that go over the end of a split, and rests, are put together from several.
    crossing = parts.where(~whole).groupBy("file", "n", *FILE)
    crossing = crossing.agg(_joined_by("split").alias("value"), F.max("is_end").alias("is_end"))
    columns = ["file", "n", *FILE, "is_end", "value"]
    return parts.where(whole).select(columns).unionAll(crossing.select(columns))


def _parsed(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """``file, n, is_end, ok, record`` and what is known of the file."""
    text, is_list, first = F.col("value"), F.col("base") == 1, F.col("n") == 0
    lead = (
        F.when(is_list & first, text.rlike(rf"^{SPACE}\[{SPACE}\{{"))
        .when(is_list, text.rlike(rf"^{SPACE},{SPACE}\{{"))
        .otherwise(first & text.rlike(rf"^{SPACE}\{{"))
    )
    rest = (
        F.when(~F.col("open_end"), False)
        .when(is_list & first, text.rlike(rf"^{SPACE}\[{SPACE}\]{SPACE}$"))
        .when(is_list, text.rlike(rf"^{SPACE}\]{SPACE}$"))
        .otherwise((F.col("n") == 1) & text.rlike(rf"^{SPACE}$"))
    )
    body = F.concat(F.regexp_replace(text, rf"^{SPACE}[\[,]?{SPACE}(?=\{{)", ""), F.lit(END))
    record = F.when(F.col("is_end") & lead, F.from_json(body, with_corrupt(schema), PERMISSIVE))
    parsed = texts.select(
        "file", "n", *FILE, "is_end", rest.alias("rest"), record.alias("record")
    )
    fits = F.col("record").isNotNull() & F.col(f"record.{CORRUPT}").isNull()
    ok = F.when(F.col("is_end"), fits).otherwise(F.col("rest"))
    return parsed.select("file", "n", *FILE, "is_end", ok.alias("ok"), "record")


def read_split_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``file, rejected, record``: a row per record of a sound file, and one row per rejected file.

    The same files are sound as for ``read_documents``: exactly one list of objects or one object,
    all of them fitting the schema. A null or a value in place of an object rejects its file, as do
    elements that are lists themselves. A file without a byte has no row. Compressed files are
    refused, as they cannot be split.
    """
    pieces = _pieces(spark, path)
    starts = _split_starts(pieces)
    parsed = written(_parsed(_texts(pieces, starts), schema), "document-records")
    files = parsed.groupBy("file", *FILE).agg(
        F.count_if(~F.col("ok")).alias("faults"),
        F.count_if("is_end").alias("records"),
        F.count_if(~F.col("is_end")).alias("rests"),
    )
    complete = F.when(F.col("base") == 1, F.col("rests") == 1).otherwise(
        (F.col("records") == 1) & ((F.col("rests") == 1) == F.col("open_end"))
    )
    sound = (F.col("faults") == 0) & ~F.col("strange") & complete
    rejected = files.where(~sound).select("file")
    rejected = written(rejected, "document-rejects")
    if rejected.count() <= FEW_FILES:
        rejected = F.broadcast(rejected)
    kept = parsed.where("is_end").join(rejected, "file", "left_anti")
    return kept.select("file", F.lit(False).alias("rejected"), "record").unionAll(
        rejected.select(
            "file", F.lit(True), F.lit(None).cast(parsed.schema["record"].dataType).alias("record")
        )
    )
