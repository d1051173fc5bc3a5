"""Files and tables written from the given tables into the shared folder, and read back."""

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F
from pyspark.sql import types as T

from acceptance.registry import check, null_if, table
from voltledger import sources
from voltledger.session import new_path

@check(
    """
    SELECT count(*) AS n_rows, count(l_orderkey) AS l_orderkey_values, cast(0 AS bigint) AS l_orderkey_nulls,
           count(flag) AS flag_values, count(*) - count(flag) AS flag_nulls,
           min(l_orderkey) AS l_orderkey_min, max(l_orderkey) AS l_orderkey_max,
           min(shipped) AS shipped_min, max(shipped) AS shipped_max,
           min(l_extendedprice) AS l_extendedprice_min, max(l_extendedprice) AS l_extendedprice_max
    FROM (SELECT *, nullif(l_returnflag, 'A') AS flag, cast(l_shipdate AS date) AS shipped FROM lineitem)
    """
)
def profile_from_footers(spark, sf_dir):
    path = new_path(spark, "lines")
    flag, shipped = null_if("l_returnflag", "A"), F.col("l_shipdate").cast("date")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", flag.alias("flag"), shipped.alias("shipped")
    )
    lines.write.parquet(path)
    bounds = ["l_orderkey", "shipped", "l_extendedprice"]
    return sources.stored_profile(spark, path, ["l_orderkey", "flag"], bounds)


ORDER_TYPES = "o_orderkey bigint, o_orderstatus string, o_totalprice double"


@check("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def read_json(spark, sf_dir):
    path = new_path(spark, "orders-json")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    orders.write.json(path)
    return sources.read_json_records(spark, path, ORDER_TYPES, lines=True)


@check("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def read_csv(spark, sf_dir):
    path = new_path(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice", "o_orderkey")
    orders.write.csv(path, header=True)
    return sources.read_csv(spark, path, {"o_orderkey": "bigint", "o_totalprice": "double"})


@check("SELECT c_custkey, c_name, c_acctbal FROM customer")
def flatten_results(spark, sf_dir):
    # A page holds the customers of a hundred consecutive unique keys, as an API page would.
    path = new_path(spark, "customer-pages")
    customer = table(spark, sf_dir, "customer")
    pages = customer.groupBy(F.floor(F.col("c_custkey") / 100).alias("page")).agg(
        F.count(F.lit(1)).alias("total_count"),
        F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal")).alias("results"),
    )
    pages.select("total_count", "results").write.json(path)
    schema = "total_count bigint, results array<struct<c_custkey: bigint, c_name: string, c_acctbal: double>>"
    return sources.flatten_results(sources.read_json_records(spark, path, schema, lines=True))


LANDED = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderstatus", T.StringType()),
    ]
)


def _raw_orders(spark, sf_dir, path, by_priority=False):
    """Lines of which one kind is cut short, one has text for a number, and the rest are good; in
    a file per task, or per priority."""
    priority = F.col("o_orderpriority")
    good = F.to_json(F.struct("o_orderkey", "o_totalprice", "o_orderstatus"))
    cut = F.left(good, F.length(good) - 1)
    wrong = F.to_json(F.struct(F.col("o_orderkey"), F.lit("n/a").alias("o_totalprice")))
    line = F.when(priority == "5-LOW", cut).when(priority == "2-HIGH", wrong).otherwise(good)
    lines = table(spark, sf_dir, "orders").select(line.alias("value"), "o_orderpriority")
    if by_priority:
        lines.repartition("o_orderpriority").write.partitionBy("o_orderpriority").text(path)
    else:
        lines.drop("o_orderpriority").write.text(path)


@check(
    """
    SELECT count(*) FILTER (WHERE o_orderpriority NOT IN ('5-LOW', '2-HIGH')) AS n_records,
           count(*) FILTER (WHERE o_orderpriority IN ('5-LOW', '2-HIGH')) AS n_rejected FROM orders
    """
)
def bronze_ingest(spark, sf_dir):
    raw, target = new_path(spark, "orders-raw"), new_path(spark, "orders-bronze")
    _raw_orders(spark, sf_dir, raw)
    return sources.land_json_lines(spark, raw, target, LANDED)


@check(
    """
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
    WHERE o_orderpriority NOT IN ('5-LOW', '2-HIGH')
    """
)
def bronze_records(spark, sf_dir):
    raw, target = new_path(spark, "orders-raw"), new_path(spark, "orders-bronze")
    _raw_orders(spark, sf_dir, raw)
    sources.land_json_lines(spark, raw, target, LANDED)
    return sources.read_accepted(spark, target, LANDED)


@check(
    """
    SELECT cast(5 AS bigint) AS n_files, cast(5 AS bigint) AS n_known, count(*) FILTER (WHERE NOT bad) AS n_records,
           count(*) FILTER (WHERE bad) AS n_rejected, count(*) FILTER (WHERE NOT bad) AS n_read
    FROM (SELECT o_orderpriority IN ('5-LOW', '2-HIGH') AS bad FROM orders)
    """
)
def bronze_landed_again(spark, sf_dir):
    """The orders in a file per priority are landed, then some of them and copies under other
    names again, then all."""
    raw, copies, target = (new_path(spark, name) for name in ("orders-raw", "orders-copy", "orders-bronze"))
    _raw_orders(spark, sf_dir, raw, by_priority=True)
    some = f"{raw}/o_orderpriority={{1-URGENT,5-LOW}}"
    counts = [sources.land_new_contents(spark, some, target, LANDED)]
    spark.read.text(raw).repartition("o_orderpriority").write.partitionBy("o_orderpriority").text(copies)
    for source in (f"{copies}/*", f"{raw}/*"):
        counts.append(sources.land_new_contents(spark, source, target, LANDED))
    first, second, third = counts
    n_read = sources.read_contents(spark, target, LANDED).agg(F.count("*").alias("n_read")).scalar()
    taken = first.unionAll(second).agg(
        F.sum("n_files").alias("n_files"), F.sum("n_records").alias("n_records"), F.sum("n_rejected").alias("n_rejected")
    )
    again = third.where("n_files = 0").select("n_known").scalar()
    return taken.select("n_files", again.alias("n_known"), "n_records", "n_rejected", n_read.alias("n_read"))


def _order_documents(spark, sf_dir, path, faults):
    """Indented lists of the orders of 10,000 consecutive keys. With ``faults``, of three of them
    one has a second list behind it and one is cut short."""
    page = F.floor(F.col("o_orderkey") / 10_000).cast("int").alias("page")
    record = F.to_json(F.struct("o_orderkey", "o_totalprice", "o_orderstatus"))
    pages = table(spark, sf_dir, "orders").groupBy(page).agg(F.collect_list(record).alias("all"))
    text = F.concat(F.lit("[\n  "), F.array_join("all", ",\n  "), F.lit("\n]"))
    if faults:
        third = F.col("page") % 3
        twice, cut = F.concat(text, F.lit("\n"), text), F.left(text, F.length(text) - 3)
        text = F.when(third == 1, twice).when(third == 2, cut).otherwise(text)
    pages.select("page", text.alias("value")).write.partitionBy("page").text(path)


@check("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def read_json_array(spark, sf_dir):
    path = new_path(spark, "orders-documents")
    _order_documents(spark, sf_dir, path, faults=False)
    return sources.read_json_records(spark, path, LANDED)


def _landed_documents(spark, sf_dir):
    raw, target = new_path(spark, "orders-documents"), new_path(spark, "orders-bronze")
    _order_documents(spark, sf_dir, raw, faults=True)
    return target, sources.land_json_documents(spark, raw, target, LANDED)


@check(
    """
    SELECT count(*) FILTER (WHERE o_orderkey // 10000 % 3 = 0) AS n_records,
           count(DISTINCT o_orderkey // 10000) FILTER (WHERE o_orderkey // 10000 % 3 <> 0) AS n_rejected_files
    FROM orders
    """
)
def bronze_documents(spark, sf_dir):
    return _landed_documents(spark, sf_dir)[1]


@check(
    """
    SELECT DISTINCT cast(o_orderkey // 10000 AS int) AS page FROM orders
    WHERE o_orderkey // 10000 % 3 <> 0
    """
)
def bronze_documents_rejected(spark, sf_dir):
    rejected = sources.read_rejected(spark, _landed_documents(spark, sf_dir)[0], LANDED)
    page = F.regexp_extract("raw_line", "page=([0-9]+)", 1).cast("int")
    return rejected.select(page.alias("page"))


@check("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def read_json_array_split(spark, sf_dir):
    path = new_path(spark, "orders-documents")
    _order_documents(spark, sf_dir, path, faults=False)
    return sources.read_json_records(spark, path, LANDED, split=True)


@check(
    """
    SELECT o_orderkey, o_totalprice, o_orderstatus, cast(NULL AS int) AS rejected_page
    FROM orders WHERE o_orderkey // 10000 % 3 = 0
    UNION ALL
    SELECT DISTINCT NULL, NULL, NULL, cast(o_orderkey // 10000 AS int) FROM orders
    WHERE o_orderkey // 10000 % 3 <> 0
    """
)
def bronze_documents_split(spark, sf_dir):
    raw, target = new_path(spark, "orders-documents"), new_path(spark, "orders-bronze")
    _order_documents(spark, sf_dir, raw, faults=True)
    sources.land_json_documents(spark, raw, target, LANDED, split=True)
    accepted = sources.read_accepted(spark, target, LANDED)
    page = F.regexp_extract("raw_line", "page=([0-9]+)", 1).cast("int")
    rejected = sources.read_rejected(spark, target, LANDED).select(page.alias("rejected_page"))
    return accepted.unionByName(rejected, allowMissingColumns=True)


NUMBERED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("num", T.IntegerType()),
        T.StructField("data", T.StringType()),
    ]
)


def _new_table(spark):
    name = f"voltledger_{uuid.uuid4().hex}"
    sources.create_table(spark, name, NUMBERED, location=new_path(spark, name), id_column="id")
    return name


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("num"), F.col("c_name").alias("data")
    )


def _numbered_customers(spark, sf_dir):
    """A new table with one row per customer, numbered in the order of the unique name."""
    name = _new_table(spark)
    batch = _customers(spark, sf_dir).select("num", "data")
    sources.append_rows(name, batch, id_column="id", order_by=["data"])
    return name


CUSTOMERS = """
SELECT row_number() OVER (ORDER BY c_name) AS id, c_nationkey AS num, c_name AS data FROM customer
"""


@check(CUSTOMERS)
def create_table(spark, sf_dir):
    return spark.table(_numbered_customers(spark, sf_dir))


@check(
    CUSTOMERS + " UNION ALL SELECT count(*) + 1, cast(max(c_nationkey) AS int), 'abc''def' FROM customer"
)
def param_insert(spark, sf_dir):
    name = _numbered_customers(spark, sf_dir)
    largest = spark.table(name).agg(F.max("num")).first()[0]
    sources.insert_row(spark, name, {"num": largest, "data": "abc'def"}, id_column="id")
    return spark.table(name)


@check(
    CUSTOMERS
    + """
    UNION ALL
    SELECT (SELECT count(*) FROM customer) + row_number() OVER (ORDER BY s_suppkey),
           cast(s_suppkey AS int), NULL FROM supplier
    """
)
def append_fill_null(spark, sf_dir):
    name = _numbered_customers(spark, sf_dir)
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("num"))
    sources.append_rows(name, supplier, id_column="id", order_by=["num"])
    return spark.table(name)


@check(
    """
    SELECT count(*) AS n_rows, count(*) AS n_ids, cast(2 AS bigint) AS n_loads,
           cast(sum(num) AS bigint) AS num, cast(true AS boolean) AS in_claims
    FROM (SELECT c_nationkey AS num FROM customer UNION ALL SELECT s_suppkey FROM supplier)
    """
)
def append_two_writers(spark, sf_dir):
    name, claims = f"voltledger_{uuid.uuid4().hex}", new_path(spark, "claims")
    sources.create_table(spark, name, NUMBERED, location=new_path(spark, name), load_column="load")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("num"))
    batches = [_customers(spark, sf_dir).select("num", "data"), supplier]
    with ThreadPoolExecutor(2) as writers:
        appends = [
            writers.submit(sources.append_claimed, name, batch, claims, "id", "load", size=1000)
            for batch in batches
        ]
        for append in appends:
            append.result()
    return spark.table(name).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        F.count_distinct("load").alias("n_loads"),
        F.sum("num").alias("num"),
        (F.min("id") >= 1).alias("in_claims"),
    )


@check("SELECT id, num FROM (" + CUSTOMERS + ") ORDER BY num NULLS LAST")
def table_ordered_read(spark, sf_dir):
    return sources.read_ordered(spark, _numbered_customers(spark, sf_dir), ["id", "num"], "num", ["id"])
