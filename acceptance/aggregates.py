from pyspark.sql import functions as F

from acceptance.projections import customer_with_nulls
from acceptance.registry import cents, check, null_if, table
from voltledger import functions as fn
from voltledger import operators as ops


@check("SELECT coalesce(sum(o_totalprice), 0) AS o_totalprice FROM orders WHERE o_totalprice < 0")
def sum_or_zero(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") < 0)
    return ops.sum_columns(rows, ["o_totalprice"])


@check(
    """
    SELECT cast(coalesce(sum(round(o_totalprice * 100)), 0) AS bigint) AS total FROM orders
    """
)
def sum_total(spark, sf_dir):
    return ops.sum_columns(
        table(spark, sf_dir, "orders").select(cents("o_totalprice").alias("total")), ["total"]
    )


@check(
    """
    SELECT cast(sum(round(l_quantity * 100)) AS bigint) AS quantity,
           cast(sum(round(l_discount * 100)) AS bigint) AS discount,
           cast(sum(round(l_tax * 100)) AS bigint) AS tax FROM lineitem
    """
)
def sum_columns(spark, sf_dir):
    amounts = table(spark, sf_dir, "lineitem").select(
        cents("l_quantity").alias("quantity"),
        cents("l_discount").alias("discount"),
        cents("l_tax").alias("tax"),
    )
    return ops.sum_columns(amounts, ["quantity", "discount", "tax"])


@check("SELECT round_even(sum(l_discount), 3) AS l_discount FROM lineitem")
def sum_name_contains(spark, sf_dir):
    return ops.sum_matching(table(spark, sf_dir, "lineitem"), "dis", 3)


@check(
    """
    SELECT round_even(sum(l_extendedprice), 2) AS l_extendedprice, round_even(sum(l_tax), 2) AS l_tax,
           cast(sum(l_linenumber) AS bigint) AS l_linenumber FROM lineitem
    """
)
def sum_round(spark, sf_dir):
    return ops.sum_rounded(
        table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_tax", "l_linenumber"], 2
    )


@check(
    """
    WITH o AS (SELECT cast(round(o_totalprice * 100) AS bigint) AS p, o_orderstatus AS s, o_orderpriority AS r FROM orders)
    SELECT cast(sum(p) AS bigint) AS total, cast(sum(p) FILTER (WHERE s = 'F') AS bigint) AS finished,
           cast(coalesce(sum(p) FILTER (WHERE r LIKE '%LOW'), 0) AS bigint) AS low,
           cast(coalesce(sum(p) FILTER (WHERE s = 'none'), 0) AS bigint) AS absent,
           cast(sum(p) - sum(p) FILTER (WHERE s = 'F') AS bigint) AS total_less_finished,
           cast(sum(p) - sum(p) FILTER (WHERE r LIKE '%LOW') AS bigint) AS total_less_low,
           cast(sum(p) - 16195900 AS bigint) AS total_less_published
    FROM o
    """
)
def reconcile_totals(spark, sf_dir):
    power = F.col("power")
    c = F.col
    return ops.reconcile(
        table(spark, sf_dir, "orders").withColumn("power", cents("o_totalprice")),
        {
            "total": (power, None),
            "finished": (power, c("o_orderstatus") == "F"),
            "low": (power, c("o_orderpriority").endswith("LOW")),
            "absent": (power, c("o_orderstatus") == "none"),
        },
        {
            "total_less_finished": c("total") - c("finished"),
            "total_less_low": c("total") - c("low"),
            "total_less_published": c("total") - 16_195_900,
        },
    )


QUANTITY_BY_FLAG = """
SELECT l_returnflag, cast(sum(round(l_quantity * 100)) AS bigint) AS quantity{more}
FROM lineitem GROUP BY 1
"""


def _lineitem_cents(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag", cents("l_quantity").alias("quantity"), cents("l_tax").alias("tax")
    )


@check(QUANTITY_BY_FLAG.format(more=""))
def group_sum(spark, sf_dir):
    return ops.group_sums(_lineitem_cents(spark, sf_dir), "l_returnflag", ["quantity"])


@check(QUANTITY_BY_FLAG.format(more=", cast(sum(round(l_tax * 100)) AS bigint) AS tax"))
def group_multi_sum(spark, sf_dir):
    rows = _lineitem_cents(spark, sf_dir)
    return ops.group_sums(rows, "l_returnflag", ["quantity", "tax"], descending_by="quantity")


@check(
    """
    SELECT nullif(o_orderpriority, '5-LOW') AS priority,
           cast(coalesce(sum(round(o_totalprice * 100)) FILTER (WHERE o_orderpriority <> '2-HIGH'), 0) AS bigint) AS power
    FROM orders GROUP BY 1
    """
)
def group_sum_null_key(spark, sf_dir):
    power = F.when(F.col("o_orderpriority") != "2-HIGH", cents("o_totalprice"))
    rows = table(spark, sf_dir, "orders").select(
        null_if("o_orderpriority", "5-LOW").alias("priority"), power.alias("power")
    )
    return ops.group_sums(rows, "priority", ["power"], descending_by="power")


SHARE = """
WITH g AS (SELECT o_orderpriority AS filiere, cast(sum(round(o_totalprice * 100)) AS bigint) AS power
           FROM orders {where} GROUP BY 1)
SELECT filiere, power, round_even(power / cast((SELECT sum(power) FROM g) AS double) * 100, 2) AS share FROM g
"""


def _fuel_power(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("filiere"),
        null_if("o_orderstatus", "P").alias("code"),
        cents("o_totalprice").alias("power"),
    )


@check(SHARE.format(where=""))
def group_share(spark, sf_dir):
    return ops.group_share(_fuel_power(spark, sf_dir), "filiere", "power", "share")


@check(
    SHARE.format(
        where="WHERE o_orderpriority NOT IN ('5-LOW') AND nullif(o_orderstatus, 'P') IS NOT NULL"
    )
)
def flagship(spark, sf_dir):
    """Share of power by fuel, without excluded regions and rows that have no code."""
    kept = _fuel_power(spark, sf_dir).filter(~F.col("filiere").isin("5-LOW"))
    return ops.group_share(kept.filter(F.col("code").isNotNull()), "filiere", "power", "share")


NULLS = """
SELECT count(*) FILTER (WHERE c_custkey IS NULL){test} AS c_custkey, count(*) FILTER (WHERE c_name IS NULL){test} AS c_name,
       count(*) FILTER (WHERE c_nationkey IS NULL){test} AS c_nationkey, count(*) FILTER (WHERE c_acctbal IS NULL){test} AS c_acctbal,
       count(*) FILTER (WHERE nullif(c_mktsegment, 'BUILDING') IS NULL){test} AS c_mktsegment FROM customer
"""


@check(NULLS.format(test=""))
def null_count(spark, sf_dir):
    return ops.null_count(customer_with_nulls(spark, sf_dir))


@check(NULLS.format(test=" > 0"))
def has_null(spark, sf_dir):
    return ops.has_null(customer_with_nulls(spark, sf_dir))


@check("SELECT o_orderstatus, count(*) AS count FROM orders GROUP BY 1")
def value_counts(spark, sf_dir):
    return ops.value_counts(table(spark, sf_dir, "orders"), "o_orderstatus")


@check("SELECT nullif(o_orderpriority, '5-LOW') AS priority, count(*) AS count FROM orders GROUP BY 1")
def value_counts_null(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        null_if("o_orderpriority", "5-LOW").alias("priority")
    )
    return ops.value_counts(rows, "priority")


@check(
    """
    SELECT count(o_orderkey) AS o_orderkey, count(o_totalprice) AS o_totalprice,
           count(nullif(o_orderpriority, '5-LOW')) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    """
)
def count_per_column(spark, sf_dir):
    finished = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return ops.count_per_column(
        finished.select(
            "o_orderkey",
            "o_totalprice",
            null_if("o_orderpriority", "5-LOW").alias("o_orderpriority"),
        )
    )


@check("SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, sf_dir):
    return ops.row_count(table(spark, sf_dir, "lineitem"))


@check(
    """
    SELECT min(o_orderdate) AS o_orderdate_min, max(o_orderdate) AS o_orderdate_max,
           min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max FROM orders
    """
)
def min_max(spark, sf_dir):
    return ops.min_max(table(spark, sf_dir, "orders"), ["o_orderdate", "o_totalprice"])


@check("SELECT count(DISTINCT nullif(o_orderpriority, '5-LOW')) AS n_distinct FROM orders")
def count_distinct(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        null_if("o_orderpriority", "5-LOW").alias("priority")
    )
    return ops.count_distinct(rows, "priority")


@check("SELECT bool_and(l_discount IS NOT DISTINCT FROM l_tax) AS is_equal FROM lineitem")
def columns_equal(spark, sf_dir):
    return ops.columns_equal(table(spark, sf_dir, "lineitem"), "l_discount", "l_tax")


@check(
    """
    SELECT bool_and(nullif(o_orderpriority, '5-LOW') IS NOT DISTINCT FROM
                    (CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END)) AS is_equal FROM orders
    """
)
def columns_equal_null(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        null_if("o_orderpriority", "5-LOW").alias("a"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("b"),
    )
    return ops.columns_equal(rows, "a", "b")


@check(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_extendedprice / 7, 2) AS two_places,
           round_even(l_extendedprice / 7, 3) AS three_places FROM lineitem
    """
)
def round_half_even(spark, sf_dir):
    seventh = F.col("l_extendedprice") / 7
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        fn.round_half_even(seventh, 2).alias("two_places"),
        fn.round_half_even(seventh, 3).alias("three_places"),
    )


@check(
    """
    SELECT o_orderstatus, date_diff('day', min(o_orderdate), max(o_orderdate)) + 1 AS n_days,
           count(DISTINCT cast(o_orderdate AS date)) AS n_days_seen
    FROM orders GROUP BY 1
    """
)
def calendar_days(spark, sf_dir):
    first, last = F.min("o_orderdate"), F.max("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderstatus")
        .agg(
            fn.days_between(first, last).cast("long").alias("n_days"),
            F.count_distinct(F.col("o_orderdate").cast("date")).alias("n_days_seen"),
        )
    )


@check(
    """
    SELECT coalesce(sum(cast(round(o_totalprice * 100) AS bigint)) FILTER (WHERE o_orderstatus = 'F'), 0)::bigint AS finished,
           0::bigint AS absent FROM orders
    """
)
def conditional_sums(spark, sf_dir):
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").agg(
        fn.sum_or_zero(cents("o_totalprice"), status == "F").alias("finished"),
        fn.sum_or_zero(cents("o_totalprice"), status == "none").alias("absent"),
    )
