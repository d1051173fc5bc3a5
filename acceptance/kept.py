"""Profiles kept up to date: the tables are added in loads, some of them late, some twice."""

from datetime import date

from pyspark.sql import functions as F

from acceptance.registry import check, table
from voltledger import operators as ops
from voltledger.session import new_path

FIRST, SECOND = "1997-01-01", "1999-01-01"


def _order_loads(spark, sf_dir):
    """Orders in three loads by date, the last period first and the first one twice, with keys of
    which some are repeated or null."""
    day, number = F.col("o_orderdate"), F.col("o_orderkey")
    # The remainder of the cube, from remainders: the cube itself may not fit in a long.
    rest = number % 20_011
    key = rest * rest % 20_011 * rest % 20_011
    orders = table(spark, sf_dir, "orders").select(
        F.when(key != 7, key).alias("customer"), "o_orderdate", "o_orderpriority"
    )
    early, late = orders.where(day < FIRST), orders.where(day >= SECOND)
    between = orders.where((day >= FIRST) & (day < SECOND))
    return orders, [("late", late), ("early", early), ("between", between), ("early", early)]


@check(
    """
    SELECT count(*) AS n_keys, cast(sum(n) AS bigint) AS n_rows
    FROM (SELECT count(*) AS n FROM orders GROUP BY nullif(o_orderkey * o_orderkey * o_orderkey % 20011, 7) HAVING count(*) > 1)
    """
)
def kept_duplicates(spark, sf_dir):
    state = new_path(spark, "key-counts")
    orders, loads = _order_loads(spark, sf_dir)
    for name, rows in loads:
        ops.add_key_counts(state, name, rows, "customer", buckets=8)
    return ops.kept_duplicates(spark, state, orders.schema["customer"].dataType)


@check(
    """
    WITH o AS (SELECT nullif(o_orderkey * o_orderkey * o_orderkey % 20011, 7) AS customer, o_orderdate FROM orders)
    SELECT customer, o_orderdate FROM o WHERE o_orderdate < '1997-01-01' AND coalesce(customer, -1) IN
          (SELECT coalesce(customer, -1) FROM o GROUP BY 1 HAVING count(*) > 1)
    """
)
def duplicated_in_load(spark, sf_dir):
    state = new_path(spark, "key-counts")
    _, loads = _order_loads(spark, sf_dir)
    for name, rows in loads:
        ops.add_key_counts(state, name, rows, "customer", buckets=8)
    found = ops.duplicated_in_load(state, loads[-1][1], "customer", buckets=8)
    return found.select("customer", "o_orderdate")


@check(
    """
    WITH e AS (SELECT event_type, ts, date_trunc('hour', ts) AS slot FROM events
               WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-21')
    SELECT event_type AS "group", cast(slot AS date) AS day, count(*) AS n_rows,
           count(DISTINCT slot) AS n_slots, 24 - count(DISTINCT slot) AS n_missing
    FROM e GROUP BY ALL
    """
)
def kept_day_completeness(spark, sf_dir):
    """Events rounded down to the hour; a load per part of the week, the first one added twice."""
    state = new_path(spark, "slots")
    events = table(spark, sf_dir, "events").select(
        "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot")
    )
    weekend = F.dayofweek("slot").isin(1, 7)
    loads = [("weekend", weekend), ("week", ~weekend), ("weekend", weekend)]
    for name, some in loads:
        ops.add_grid_load(state, name, events.where(some), "event_type", "slot", 60)
    kind = events.schema["event_type"].dataType
    return ops.kept_day_completeness(spark, state, kind, date(2024, 1, 2), date(2024, 1, 20), 60)


@check(
    """
    SELECT 'customer' AS "column", count(DISTINCT nullif(o_orderkey * o_orderkey * o_orderkey % 20011, 7)) >= 5 AS reached, false AS counted FROM orders
    UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) >= 5, true FROM orders
    UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) >= 1000000, false FROM orders
    """
)
def distinct_at_least(spark, sf_dir):
    state = new_path(spark, "sketches")
    orders, loads = _order_loads(spark, sf_dir)
    columns = ["customer", "o_orderpriority", "o_orderdate"]
    for name, rows in loads:
        ops.add_sketches(state, name, rows, columns)
    limits = {"customer": 5, "o_orderpriority": 5, "o_orderdate": 1_000_000}
    return ops.at_least_distinct(spark, state, orders, limits)
