from acceptance.registry import check, null_if, table
from voltledger import operators as ops
from voltledger import sources


@check("SELECT r_regionkey, r_name FROM region")
def scan_parquet(spark, sf_dir):
    return sources.read_parquet(spark, f"{sf_dir}/region.parquet")


@check("SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def frame_shape(spark, sf_dir):
    return ops.frame_shape(table(spark, sf_dir, "lineitem"))


@check("SELECT n_name FROM nation")
def project(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_name")


@check("SELECT n_nationkey, n_name AS nation_name, n_regionkey AS region_key FROM nation")
def silver_projection(spark, sf_dir):
    names = {"n_nationkey": "", "n_name": "nation_name", "n_regionkey": "region_key"}
    return sources.project(table(spark, sf_dir, "nation"), names)


@check("SELECT l_tax FROM lineitem")
def select_name_contains(spark, sf_dir):
    return ops.select_matching(table(spark, sf_dir, "lineitem"), "tax")


def customer_with_nulls(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.withColumn("c_mktsegment", null_if("c_mktsegment", "BUILDING"))


@check("SELECT nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer")
def null_columns_only(spark, sf_dir):
    return ops.null_columns_only(customer_with_nulls(spark, sf_dir))
