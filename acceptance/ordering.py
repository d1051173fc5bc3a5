from acceptance.registry import cents, check, null_if, table
from voltledger import operators as ops


@check("SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 20")
def top_n_sorted(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return ops.top_rows(rows, "ts", 20, tie_break=["event_id"])


@check(
    """
    SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
    ORDER BY priority DESC NULLS FIRST, o_orderkey LIMIT 20
    """
)
def top_n_nulls_first(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", null_if("o_orderpriority", "5-LOW").alias("priority")
    )
    return ops.top_rows(rows, "priority", 20, descending=True, tie_break=["o_orderkey"])


@check(
    """
    SELECT p_brand, cast(sum(round(p_retailprice * 100)) AS bigint) AS price FROM part
    GROUP BY 1 ORDER BY 2 DESC NULLS FIRST, 1 LIMIT 3
    """
)
def sorted_group_top(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_brand", cents("p_retailprice").alias("price"))
    return ops.group_sums(rows, "p_brand", ["price"], descending_by="price").limit(3)


@check("SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders")
def sorted_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return ops.sorted_rows(rows, "o_orderstatus", tie_break=["o_orderkey"])


@check("SELECT l_orderkey, l_linenumber, l_linestatus FROM lineitem ORDER BY l_linestatus DESC")
def sorted_hot_value(spark, sf_dir):
    """Two values share all rows, and there is no tie-break: ranges are cut by place."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return ops.sorted_rows(lines, "l_linestatus", descending=True)
