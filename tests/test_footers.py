import datetime
import math

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.frames import plan
from voltledger.sources import footers

ROWS = [
    (1, 1.5, "a", datetime.date(2020, 1, 2), True, [1], None),
    (None, math.nan, None, None, None, None, None),
    (-7, -0.0, "zz" * 80, datetime.date(1999, 5, 6), False, [], None),
    (4, 9.5, "", datetime.date(2024, 2, 29), True, [None, 2], None),
]
SCHEMA = "n long, x double, s string, d date, b boolean, l array<int>, none int"
COLUMNS = ["n", "x", "s", "d", "b", "l", "none"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("footers") / "rows")
    spark.createDataFrame(ROWS * 50, SCHEMA).repartition(5).write.parquet(path)
    return path


def test_the_same_as_reading_the_rows(spark, folder):
    df = spark.read.parquet(folder)
    row = footers.stored_profile(spark, folder, bounds=["n", "x", "s", "d", "b", "none"]).first()
    assert row.n_rows == 200
    for name in COLUMNS:
        nulls = df.where(F.col(name).isNull()).count()
        assert (row[f"{name}_values"], row[f"{name}_nulls"]) == (200 - nulls, nulls)
    assert (row.n_min, row.n_max) == (-7, 4) and (row.none_min, row.none_max) == (None, None)
    assert row.x_min == 0 and math.isnan(row.x_max)
    assert (row.s_min, row.s_max) == ("", "zz" * 80)
    assert (row.d_min, row.d_max) == (datetime.date(1999, 5, 6), datetime.date(2024, 2, 29))
    assert (row.b_min, row.b_max) == (False, True)


def test_no_column_is_read(spark, folder):
    found = footers.footer_aggregate(spark, folder, ["n", "x", "s"], ["n", "d"])
    text = plan(found)
    assert "PushedAggregation: [COUNT(*), COUNT(n), COUNT(x), COUNT(s), MIN(n), MAX(n), MIN(d), MAX(d)]" in text
    # What the scan gives out is the aggregates themselves.
    assert "ReadSchema: struct<count(*):bigint,count(n):bigint" in text
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert found.first().n_rows == 200


def test_what_footers_lack_is_read(spark, folder, monkeypatch):
    """Bounds of a column of nulls; counts still come from the footers."""
    seen = []
    real = footers._aggregated
    monkeypatch.setattr(footers, "_aggregated", lambda df, m: seen.append(list(m)) or real(df, m))
    row = footers.stored_profile(spark, folder, ["n"], bounds=["n", "none"]).first()
    assert tuple(row) == (200, 150, 50, -7, 4, None, None)
    assert seen[-2:] == [["n_rows", "n_values"], ["n_min", "n_max", "none_min", "none_max"]]


def test_files_without_statistics_are_read(spark, tmp_path):
    table = pa.table({"n": pa.array([3, None, 5], pa.int64()), "s": ["a", None, "c"]})
    pq.write_table(table, tmp_path / "bare.parquet", write_statistics=False)
    row = footers.stored_profile(spark, str(tmp_path), bounds=["n"]).first()
    assert tuple(row) == (3, 2, 1, 2, 1, 3, 5)


def test_partitions_empty_tables_and_names(spark, tmp_path):
    parted = str(tmp_path / "parted")
    spark.range(30).select("id", (F.col("id") % 3).cast("int").alias("p")).write.partitionBy("p").parquet(parted)
    row = footers.stored_profile(spark, parted, bounds=["id", "p"]).first()
    assert tuple(row) == (30, 30, 0, 30, 0, 0, 29, 0, 2)
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], "a int, `b.c` int").write.parquet(empty)
    assert tuple(footers.stored_profile(spark, empty, bounds=["a"]).first()) == (0, 0, 0, 0, 0, None, None)
    assert tuple(footers.stored_profile(spark, empty, []).first()) == (0,)
    dotted = str(tmp_path / "dotted")
    spark.createDataFrame([(1, 2), (None, 3)], "a int, `b.c` int").write.parquet(dotted)
    assert tuple(footers.stored_profile(spark, dotted, bounds=["b.c"]).first()) == (2, 1, 1, 2, 0, 2, 3)
    with pytest.raises(ValueError, match="zz"):
        footers.stored_profile(spark, dotted, ["zz"])
