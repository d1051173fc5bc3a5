from pyspark.sql import functions as F

from acceptance.projections import customer_with_nulls
from acceptance.registry import cents, check, null_if, table
from voltledger import operators as ops
from voltledger.functions import differs, ratio_above

CUSTOMER = """
WITH c AS (SELECT c_custkey, c_nationkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)
SELECT c_custkey, c_nationkey, c_mktsegment FROM c WHERE """


def _customer(spark, sf_dir):
    return customer_with_nulls(spark, sf_dir).select("c_custkey", "c_nationkey", "c_mktsegment")


@check(CUSTOMER + "c_mktsegment IS NULL")
def filter_is_null(spark, sf_dir):
    return _customer(spark, sf_dir).filter(F.col("c_mktsegment").isNull())


@check(CUSTOMER + "c_mktsegment IS NOT NULL")
def filter_not_null(spark, sf_dir):
    return _customer(spark, sf_dir).filter(F.col("c_mktsegment").isNotNull())


@check(CUSTOMER + "c_mktsegment = 'MACHINERY'")
def filter_eq(spark, sf_dir):
    return _customer(spark, sf_dir).filter(F.col("c_mktsegment") == "MACHINERY")


@check(CUSTOMER + "c_mktsegment <> 'MACHINERY'")
def filter_ne(spark, sf_dir):
    return _customer(spark, sf_dir).filter(F.col("c_mktsegment") != "MACHINERY")


@check(CUSTOMER + "c_mktsegment IS NULL AND nullif(c_nationkey, 3) IS NULL")
def filter_and_nulls(spark, sf_dir):
    nation = null_if("c_nationkey", 3)
    return _customer(spark, sf_dir).filter(F.col("c_mktsegment").isNull() & nation.isNull())


@check("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber > 5")
def filter_gt(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") > 5)
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@check(
    """
    WITH l AS (SELECT l_orderkey, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax FROM lineitem)
    SELECT l_orderkey, discount, tax FROM l WHERE discount IS DISTINCT FROM tax
    """
)
def ne_missing(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", null_if("l_discount", 0).alias("discount"), null_if("l_tax", 0).alias("tax")
    )
    return ops.rows_differing(rows, "discount", "tax")


@check(
    """
    SELECT count(*) FILTER (WHERE nullif(l_discount, 0) IS DISTINCT FROM nullif(l_tax, 0)) AS n_differing,
           count(*) AS n_rows
    FROM lineitem
    """
)
def ne_missing_count(spark, sf_dir):
    moved = differs(null_if("l_discount", 0), null_if("l_tax", 0))
    return table(spark, sf_dir, "lineitem").agg(
        F.count_if(moved).alias("n_differing"), F.count(F.lit(1)).alias("n_rows")
    )


ORDERS = """
WITH o AS (SELECT nullif(o_orderpriority, '5-LOW') AS region,
                  cast(round(o_totalprice * 100) AS bigint) AS power FROM orders)
"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        null_if("o_orderpriority", "5-LOW").alias("region"), cents("o_totalprice").alias("power")
    )


@check(
    ORDERS
    + "SELECT region, cast(sum(power) AS bigint) AS power FROM o WHERE region NOT IN ('1-URGENT') GROUP BY 1"
)
def not_in_group(spark, sf_dir):
    kept = _orders(spark, sf_dir).filter(~F.col("region").isin("1-URGENT"))
    return ops.group_sums(kept, "region", ["power"])


@check(
    ORDERS
    + """SELECT count(*) FILTER (WHERE region NOT IN ('1-URGENT')) AS n_kept,
                count(*) FILTER (WHERE region IN ('1-URGENT')) AS n_excluded,
                count(*) FILTER (WHERE region IS NULL) AS n_null_dropped FROM o"""
)
def not_in_exclusions(spark, sf_dir):
    return ops.exclusion_report(_orders(spark, sf_dir), "region", ["1-URGENT"])


@check(
    """
    SELECT cast(sum(round(p_retailprice * 100)) AS bigint) AS price FROM part WHERE p_brand LIKE '%7'
    """
)
def endswith_sum(spark, sf_dir):
    rows = table(spark, sf_dir, "part").filter(F.col("p_brand").endswith("7"))
    return ops.sum_columns(rows.select(cents("p_retailprice").alias("price")), ["price"])


@check(
    """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_quantity / cast(l_linenumber - 1 AS double) > 20
    """
)
def ratio_threshold(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    above = ratio_above(F.col("l_quantity"), F.col("l_linenumber") - 1, 20)
    return rows.filter(above).select("l_orderkey", "l_linenumber", "l_quantity")
