"""Catalog tables: ids, null filling, quoting and order."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.frames import rows
from voltledger import operators as ops
from voltledger import sources
from voltledger.session import new_path, shared_folder

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("num", T.IntegerType()),
        T.StructField("data", T.StringType()),
    ]
)


@pytest.fixture
def table(spark, tmp_path):
    sources.create_table(spark, "test", SCHEMA, str(tmp_path / "test"))
    yield "test"
    spark.sql("DROP TABLE test")


def all_rows(spark, table):
    return rows(spark.table(table).orderBy("id"))


def test_insert_append_and_read_in_order(spark, table):
    sources.insert_row(spark, table, {"num": 50, "data": "it's \\ 'so'"}, id_column="id")
    assert all_rows(spark, table) == [(1, 50, "it's \\ 'so'")]
    batch = spark.createDataFrame([(7,), (5,), (90,)], "num int")
    sources.append_rows(table, batch, id_column="id", order_by=["num"])
    assert all_rows(spark, table)[1:] == [(2, 5, None), (3, 7, None), (4, 90, None)]
    ordered = sources.read_ordered(spark, table, ["id", "num"], "num")
    assert rows(ordered) == [(2, 5), (3, 7), (1, 50), (4, 90)]


def test_no_append_reads_the_ids(spark, tmp_path):
    """The files of a table are taken away, and ids go on where they were."""
    place = tmp_path / "gone"
    sources.create_table(spark, "gone", SCHEMA, str(place), id_column="id")
    batch = spark.range(10, numPartitions=3).select(F.col("id").cast("int").alias("num"))
    sources.append_rows("gone", batch, id_column="id")
    sources.insert_row(spark, "gone", {"num": 1}, id_column="id")
    for part in place.glob("part-*"):
        part.rename(tmp_path / part.name)
    spark.catalog.refreshTable("gone")
    sources.append_rows("gone", batch, id_column="id")
    sources.insert_row(spark, "gone", {"num": 2}, id_column="id")
    assert [row[0] for row in all_rows(spark, "gone")] == list(range(12, 23))
    spark.sql("DROP TABLE gone")


def test_ids_of_a_table_made_elsewhere(spark, table):
    spark.sql(f"INSERT INTO {table} VALUES (41, 1, 'x')")
    sources.append_rows(table, spark.createDataFrame([(2,)], "num int"), id_column="id")
    assert [row[0] for row in all_rows(spark, table)] == [41, 42]


def test_the_staged_batch_is_removed(spark, table):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = sorted(folder.iterdir())
    sources.append_rows(table, spark.createDataFrame([(2,)], "num int"), id_column="id")
    assert sorted(folder.iterdir()) == before


def test_columns_named_like_the_helpers(spark, tmp_path):
    names = ["file_name", "row_index", "rows_before", "_file_name", "n"]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ["id", *names]])
    place = str(tmp_path / "it's")
    sources.create_table(spark, "odd_table", schema, place, id_column="id")
    batch = spark.range(5).select(*[F.col("id").alias(name) for name in names])
    sources.append_rows("odd_table", batch, id_column="id", order_by=["n"], broadcast_files=0)
    got = all_rows(spark, "odd_table")
    assert got == [(k + 1, k, k, k, k, k) for k in range(5)]
    spark.sql("DROP TABLE odd_table")


def positions(df, *columns):
    """Rows with the partition they are in, in the order of the partitions and within them."""
    placed = df.withColumn("part", F.spark_partition_id())
    placed = placed.withColumn("place", F.monotonically_increasing_id())
    found = sorted(placed.collect(), key=lambda row: (row.part, row.place))
    return [tuple(row[c] for c in columns) for row in found], len({row.part for row in found})


@pytest.mark.parametrize("how", ["table", "rows", "groups"])
def test_order_holds_over_many_partitions(spark, tmp_path, how):
    """One value has half of the rows; with a tie-break its rows are dealt to several tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        num = F.when(F.col("id") % 2 == 0, F.lit(5)).when(F.col("id") % 7 != 0, F.col("id") % 100)
        df = spark.range(20_000, numPartitions=6).select("id", num.cast("int").alias("num"))
        if how == "table":
            df.withColumn("data", F.lit("x")).write.mode("overwrite").option("path", str(tmp_path / "o")).saveAsTable("ordered")
            ordered = sources.read_ordered(spark, "ordered", ["id", "num"], "num", ["id"])
            key = lambda row: (row[1] is None, row[1] or 0, row[0])
        elif how == "rows":
            ordered = ops.sorted_rows(df, "num", descending=True, tie_break=["id"])
            key = lambda row: (row[1] is not None, -(row[1] or 0), row[0])
        else:
            df = df.withColumn("num", F.when(F.col("id") > 9, F.col("id") % 3))
            ordered = ops.group_sums(df, "id", ["num"], descending_by="num")
            key = lambda row: (-row[1], row[0])
        got, n_parts = positions(ordered, "id", "num")
        assert n_parts >= 4 and len(got) == 20_000 and got == sorted(got, key=key)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.sql("DROP TABLE IF EXISTS ordered")


@pytest.mark.parametrize("how", ["table", "rows"])
def test_a_hot_value_is_split_without_a_tie_break(spark, tmp_path, how):
    """One value has a third of the rows; equal values keep the order of the input."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        num = F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 101).cast("int")
        df = spark.range(60_000, numPartitions=5).select("id", num.alias("num"), F.lit(1).alias("place"))
        if how == "table":
            df.write.mode("overwrite").option("path", str(tmp_path / "h")).saveAsTable("hot")
            ordered = sources.read_ordered(spark, "hot", ["id", "num"], "num")
        else:
            ordered = ops.sorted_rows(df, "num", descending=True)
            assert ordered.columns == df.columns
        got, _ = positions(ordered, "id", "num")
        values = [row[1] for row in got]
        assert values == sorted(values, reverse=how == "rows") and len(got) == 60_000
        sizes = sorted(r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
        if how == "rows":
            ids = [row[0] for row in got]
            assert all(a < b for (a, m), (b, n) in zip(got, got[1:]) if m == n) and len(set(ids)) == 60_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.sql("DROP TABLE IF EXISTS hot")


def test_ordered_read_has_nulls_last(spark, table):
    batch = spark.createDataFrame([(None,), (2,), (1,)], "num int")
    sources.append_rows(table, batch)
    assert rows(sources.read_ordered(spark, table, ["num"], "num")) == [(1,), (2,), (None,)]


def test_ids_have_no_gap_over_many_files(spark, table):
    for start in (0, 1000):
        batch = spark.range(start, start + 1000, numPartitions=17).select(
            F.col("id").cast("int").alias("num")
        )
        sources.append_rows(table, batch, id_column="id")
    got = all_rows(spark, table)
    assert [r[0] for r in got] == list(range(1, 2001))
    assert sorted(r[1] for r in got[:1000]) == list(range(1000))


def test_ids_follow_an_order_over_many_files(spark, table):
    batch = spark.range(5000, numPartitions=9).select(
        (F.lit(4999) - F.col("id")).cast("int").alias("num")
    )
    sources.append_rows(table, batch, id_column="id", order_by=["num"])
    assert all(row[0] == row[1] + 1 for row in all_rows(spark, table))


def test_ids_when_a_task_writes_several_files(spark, table):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        batch = spark.range(100, numPartitions=3).select(F.col("id").cast("int").alias("num"))
        sources.append_rows(table, batch, id_column="id", order_by=["num"])
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert all(row[0] == row[1] + 1 for row in all_rows(spark, table))


def test_ids_of_a_batch_that_changes_when_computed_again(spark, table):
    batch = spark.range(1000, numPartitions=8).select(
        (F.rand() * 1e6).cast("int").alias("num")
    ).repartition(5)
    sources.append_rows(table, batch, id_column="id")
    assert [r[0] for r in all_rows(spark, table)] == list(range(1, 1001))


def test_empty_batch(spark, table):
    sources.append_rows(table, spark.createDataFrame([], "num int"), id_column="id")
    assert all_rows(spark, table) == []


def test_columns_that_do_not_fit(spark, table):
    with pytest.raises(ValueError, match="not in test"):
        sources.append_rows(table, spark.range(1).withColumn("zzz", F.lit(1)).drop("id"))
    with pytest.raises(ValueError, match="assigned on append"):
        sources.append_rows(table, spark.range(1), id_column="id")
    with pytest.raises(ValueError, match="missing columns"):
        sources.insert_row(spark, table, {"zzz": 1})


def test_create_twice(spark, table):
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        sources.create_table(spark, table, SCHEMA)


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x") != new_path(spark, "x")
