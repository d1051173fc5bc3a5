from pyspark.sql import functions as F

from acceptance.registry import check, table
from voltledger import operators as ops

KEYED = """
WITH l AS (SELECT *, CASE WHEN l_linenumber <> 1 THEN l_orderkey END AS k FROM lineitem),
     n AS (SELECT k, count(*) AS n FROM l GROUP BY k)
"""


def _keyed(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.withColumn("k", F.when(F.col("l_linenumber") != 1, F.col("l_orderkey")))


@check(
    KEYED
    + """SELECT l.k, l_orderkey, l_linenumber, l_quantity FROM l JOIN n ON l.k IS NOT DISTINCT FROM n.k WHERE n > 1"""
)
def duplicated_rows(spark, sf_dir):
    rows = ops.duplicated_rows(_keyed(spark, sf_dir), "k")
    return rows.select("k", "l_orderkey", "l_linenumber", "l_quantity")


@check(
    KEYED
    + "SELECT sum(l_quantity) AS l_quantity FROM l JOIN n ON l.k IS NOT DISTINCT FROM n.k WHERE n > 1"
)
def duplicated_sum(spark, sf_dir):
    return ops.duplicated_sum(_keyed(spark, sf_dir), "k", "l_quantity")


@check(
    KEYED
    + """,
     p AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT 'k' AS key, cast(coalesce(sum(n), 0) AS bigint) AS dup_rows FROM n WHERE k IS NOT NULL AND n > 1
UNION ALL SELECT 'l_partkey', cast(coalesce(sum(n), 0) AS bigint) FROM p WHERE n > 1"""
)
def duplicate_key_report(spark, sf_dir):
    return ops.duplicate_key_report(_keyed(spark, sf_dir), ["k", "l_partkey"])


@check(
    """
    WITH v AS (SELECT value, count(*) AS n FROM events GROUP BY 1),
         i AS (SELECT event_id, count(*) AS n FROM events GROUP BY 1)
    SELECT 'value' AS key, cast(coalesce(sum(n), 0) AS bigint) AS dup_rows FROM v WHERE n > 1
    UNION ALL SELECT 'event_id', cast(coalesce(sum(n), 0) AS bigint) FROM i WHERE n > 1
    """
)
def duplicate_event_keys(spark, sf_dir):
    return ops.duplicate_key_report(table(spark, sf_dir, "events"), ["value", "event_id"])
