"""The physical plans are the ones wanted: pruned, pushed down, one scan, partial aggregation."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.frames import executed_plan, plan, scans
from voltledger import functions as fn
from voltledger import operators as ops
from voltledger.plans import grid, register

REGISTER_SCHEMA = (
    "codeeicresourceobject string, region string, filiere string, technologie string, regime string, "
    "nbinstallations long, datemiseenservice string, nominstallation string, codeiris string, "
    + ", ".join(f"{name} double" for name in register.MEASURES)
)


@pytest.fixture(scope="module")
def installations(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "register")
    spark.createDataFrame([], REGISTER_SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def series(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "series")
    schema = "date_heure timestamp_ntz, nature string, libelle_region string, value double"
    spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.parquet(path)


def pushed(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return "\n".join(line for line in text.splitlines() if "PushedFilters" in line)


def read_columns(df) -> set[str]:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    schemas = [line for line in text.splitlines() if "ReadSchema" in line]
    fields = ",".join(s.split("struct<")[1].rstrip(">") for s in schemas)
    return {f.split(":")[0] for f in fields.split(",") if f}


def final_scans(df) -> int:
    """Scans that ran: those of the plans as adaptive execution left them, subqueries included."""
    n, skipped_from = 0, None
    for line in executed_plan(df).splitlines():
        depth = len(line) - len(line.lstrip(" :|+-"))
        if skipped_from is not None and depth >= skipped_from:
            continue
        skipped_from = depth if "== Initial Plan ==" in line else None
        n += "FileScan" in line
    return n


def test_reconciliation_is_one_scan_without_a_row_shuffle(installations):
    df = register.reconciliation(installations)
    assert scans(plan(df)) == 1
    assert "partial_sum" in plan(df)
    assert "hashpartitioning" not in plan(df)
    assert read_columns(df) == {
        "region",
        "datemiseenservice",
        "puismaxinstallee",
        "puismaxcharge",
        "puismaxraccharge",
    }


def test_share_reads_and_shuffles_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).select(
        (F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("v"), F.lit("x").alias("w")
    ).write.parquet(path)
    df = ops.group_share(spark.read.parquet(path), "k", "v", "share")
    assert final_scans(df) == 1
    text = executed_plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "w#" not in "".join(line for line in text.splitlines() if "FileScan" in line)


def test_exact_share_reads_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") / 3).alias("v")).write.parquet(path)
    df = ops.group_share(spark.read.parquet(path), "k", "v", "share", exact=True)
    assert final_scans(df) == 1
    text = executed_plan(df)
    assert "Python" not in text and "CartesianProduct" not in text
    assert "partial_sum(s0" in text


def test_a_date_is_parsed_once_per_column(spark, tmp_path):
    path = str(tmp_path / "dates")
    spark.createDataFrame([("2010-02-26", "26/02/2010")], "a string, b string").write.parquet(path)
    df = spark.read.parquet(path)
    moved = df.filter(fn.dates_differ(F.col("a"), F.col("b")))
    filtered = [line for line in plan(moved).splitlines() if "Filter" in line and "Scan" not in line]
    assert filtered[0].count("regexp_replace(") == 2 and filtered[0].count(" as date)") == 2
    # Each column is named where it is parsed and where it stands for itself.
    assert filtered[0].count("a#") == 2 and filtered[0].count("b#") == 2


def test_filters_reach_the_scan(installations):
    filters = pushed(register.fuel_share_with_code(installations))
    assert "IsNotNull(codeeicresourceobject)" in filters and "Not(In(region" in filters
    suffix = installations.filter(F.col("datemiseenservice").endswith("2025"))
    assert "StringEndsWith(datemiseenservice,2025)" in pushed(suffix)
    assert "GreaterThan(nbinstallations,1)" in pushed(
        register.null_iris_of_aggregates(installations)
    )


def test_grid_period_reaches_the_scan(series):
    df = grid.definitive_completeness(series, ["Corse"], (date(2024, 1, 1), date(2024, 1, 31)))
    filters = pushed(df)
    assert "GreaterThanOrEqual(date_heure,2024-01-01" in filters
    assert "LessThan(date_heure,2024-02-01" in filters
    assert "EqualTo(nature," in filters
    assert read_columns(df) == {"date_heure", "nature", "libelle_region"}


def test_grid_is_shuffled_by_group_and_slot(series):
    text = plan(grid.definitive_completeness(series, ["Corse"]))
    shuffles = [line for line in text.splitlines() if "hashpartitioning(libelle_region" in line]
    # The rows go by group and slot; what is left goes by group alone.
    assert "slot#" in shuffles[-1] and "slot#" not in shuffles[0]


def test_missing_slots_read_and_shuffle_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.sql(
        "SELECT timestampadd(MINUTE, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01') AS t, id % 3 AS g "
        "FROM range(1000)"
    ).write.parquet(path)
    days = (date(2024, 1, 1), date(2024, 1, 2))
    df = ops.missing_slots(spark.read.parquet(path), "g", "t", *days, 30)
    assert final_scans(df) == 1
    assert df.count() == 3 * (96 - 34)


def test_top_rows_sort_nothing_whole(installations):
    df = ops.top_rows(installations, "puismaxinstallee", 20, descending=True)
    assert "TakeOrderedAndProject" in plan(df)
    assert "rangepartitioning" not in plan(df)


def test_sorted_rows_are_cut_by_the_tie_break_too(installations):
    df = ops.sorted_rows(installations, "region", tie_break=["nominstallation"])
    line = next(line for line in plan(df).splitlines() if "rangepartitioning" in line)
    assert "region" in line and "nominstallation" in line


def test_profiles_are_one_scan(installations):
    for df in (
        ops.null_count(installations),
        ops.has_null(installations),
        ops.count_per_column(installations),
        ops.sum_columns(installations, register.MEASURES),
        ops.status_partition(installations, "regime", ["a", "b"]),
        ops.columns_equal(installations, "puismaxinstallee", "maxpuis"),
    ):
        text = plan(df)
        assert scans(text) == 1 and text.count("Exchange") == 1 and "SinglePartition" in text


def test_row_count_reads_no_column(installations):
    assert read_columns(ops.row_count(installations)) == set()


def test_key_report_reads_each_key_alone(installations):
    df = ops.duplicate_key_report(installations, ["codeeicresourceobject", "codeiris"])
    assert scans(plan(df)) == 2
    assert read_columns(df) == {"codeeicresourceobject", "codeiris"}


def test_no_analysis_leaves_the_jvm(installations, series):
    for df in (
        register.reconciliation(installations),
        register.region_power(installations),
        register.large_average_power(installations),
        grid.definitive_missing_slots(series, ["Corse"], (date(2024, 1, 1), date(2024, 1, 2))),
    ):
        assert "Python" not in plan(df) and "Arrow" not in plan(df)


@pytest.mark.parametrize("hot", [None, "a"])
def test_a_hot_group_is_combined_before_the_shuffle(spark, tmp_path, hot):
    """Records shuffled do not grow with the rows of a group."""
    path = str(tmp_path / "hot")
    spark.range(9000, numPartitions=3).select(
        F.when(F.col("id") < 6000, F.lit(hot)).otherwise("b").alias("k"),
        F.col("id").alias("v"),
    ).write.parquet(path)
    df = ops.group_sums(spark.read.parquet(path), "k", ["v"])
    df.write.format("noop").mode("overwrite").save()
    assert "partial_sum" in plan(df)
    assert {r.k: r.v for r in df.collect()}[hot] == sum(range(6000))
