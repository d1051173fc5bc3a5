"""Sums of doubles that do not depend on the order of rows, beside whole-number SQL.

The SQL turns every amount into a whole number of 2**-60, adds those up exactly, and rounds once:
the top 61 bits, with the last one set if anything lies below them, become a double.
"""

from pyspark.sql import functions as F

from acceptance.registry import check, null_if, table
from voltledger import operators as ops


def whole(amount: str) -> str:
    """SQL for a double as an exact whole number of 2**-60."""
    return f"cast(({amount}) * pow(2::DOUBLE, 60) AS HUGEINT)"


def nearest(total: str) -> str:
    """SQL for the double nearest to a whole number of 2**-60."""
    size = f"abs({total})"
    step = f"cast(pow(2::DOUBLE, greatest(0, floor(log2(greatest({size}, 1))) - 60)) AS HUGEINT)"
    upper = f"cast({size} // {step} AS BIGINT) | cast({size} % {step} <> 0 AS BIGINT)"
    value = f"cast({upper} AS DOUBLE) * cast({step} AS DOUBLE) / pow(2::DOUBLE, 60)"
    return f"CASE WHEN {total} < 0 THEN -({value}) ELSE {value} END"


DISCOUNTED = "l_extendedprice * (1 - l_discount)"
SIGNED = f"CASE WHEN l_linenumber % 2 = 0 THEN -({DISCOUNTED}) ELSE {DISCOUNTED} END"


def _lines(spark, sf_dir):
    discounted = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    signed = F.when(F.col("l_linenumber") % 2 == 0, -discounted).otherwise(discounted)
    return table(spark, sf_dir, "lineitem").select(
        "*", discounted.alias("discounted"), signed.alias("signed")
    )


@check(
    f"""
    SELECT {nearest("discounted")} AS discounted, {nearest("signed")} AS signed, numbers AS l_linenumber
    FROM (SELECT sum({whole(DISCOUNTED)}) AS discounted, sum({whole(SIGNED)}) AS signed,
                 cast(sum(l_linenumber) AS BIGINT) AS numbers FROM lineitem)
    """
)
def exact_sum_columns(spark, sf_dir):
    return ops.sum_columns(
        _lines(spark, sf_dir), ["discounted", "signed", "l_linenumber"], exact=True
    )


@check(
    f"""
    SELECT round_even({nearest("discounted")}, 1) AS discounted
    FROM (SELECT sum({whole(DISCOUNTED)}) AS discounted FROM lineitem)
    """
)
def exact_sum_name_contains(spark, sf_dir):
    lines = _lines(spark, sf_dir).select("discounted", "signed")
    return ops.sum_matching(lines, "disc", 1, exact=True)


@check(
    f"""
    SELECT l_partkey, {nearest("discounted")} AS discounted, {nearest("signed")} AS signed
    FROM (SELECT l_partkey, sum({whole(DISCOUNTED)}) AS discounted, sum({whole(SIGNED)}) AS signed
          FROM lineitem GROUP BY l_partkey)
    """
)
def exact_group_multi_sum(spark, sf_dir):
    return ops.group_sums(_lines(spark, sf_dir), "l_partkey", ["discounted", "signed"], exact=True)


@check(
    f"""
    SELECT flag, {nearest("discounted")} AS discounted
    FROM (SELECT nullif(l_returnflag, 'R') AS flag, coalesce(sum({whole(DISCOUNTED)}) FILTER (WHERE l_returnflag <> 'A'), 0) AS discounted
          FROM lineitem GROUP BY ALL)
    """
)
def exact_group_sum_null_key(spark, sf_dir):
    amount = F.when(F.col("l_returnflag") != "A", F.col("discounted"))
    lines = _lines(spark, sf_dir).select(
        null_if("l_returnflag", "R").alias("flag"), amount.alias("discounted")
    )
    return ops.group_sums(lines, "flag", ["discounted"], exact=True)


@check(
    f"""
    WITH grouped AS (
        SELECT l_shipdate AS shipped, sum({whole(DISCOUNTED)}) AS total FROM lineitem GROUP BY l_shipdate
    ), everything AS (SELECT sum(total) AS all_of_it FROM grouped)
    SELECT shipped, {nearest("total")} AS discounted,
           round_even({nearest("total")} / {nearest("all_of_it")} * 100, 4) AS share
    FROM grouped, everything
    """
)
def exact_group_share(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumnRenamed("l_shipdate", "shipped")
    return ops.group_share(lines, "shipped", "discounted", "share", digits=4, exact=True)


@check(
    f"""
    SELECT {nearest("total")} AS total, {nearest("rest")} AS returned, n AS n_lines,
           {nearest("total")} - {nearest("rest")} AS total_less_returned
    FROM (SELECT sum({whole(DISCOUNTED)}) AS total, cast(sum(l_linenumber) AS BIGINT) AS n,
                 sum({whole(DISCOUNTED)}) FILTER (WHERE l_returnflag = 'R') AS rest FROM lineitem)
    """
)
def exact_reconcile(spark, sf_dir):
    amount = F.col("discounted")
    measures = {
        "total": (amount, None),
        "returned": (amount, F.col("l_returnflag") == "R"),
        "n_lines": (F.col("l_linenumber"), None),
    }
    less = {"total_less_returned": F.col("total") - F.col("returned")}
    return ops.reconcile(_lines(spark, sf_dir), measures, less, exact=True)
