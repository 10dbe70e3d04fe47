"""Scans, sinks, copies."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.catalog.registry import query
from tallymart.operators import compare
from tallymart.plans import shop
from tallymart.session import materialise, new_path
from tallymart.sources import column_types, readers, writers


@query(
    "src_csv_roundtrip",
    """SELECT c_custkey AS customer_id, 'The "' || c_name || '", ' || c_mktsegment AS label, c_mktsegment AS segment FROM customer""",
)
def src_csv_roundtrip(t):
    """Commas and quotes inside a text survive writing and reading."""
    label = F.concat(F.lit('The "'), "name", F.lit('", '), "segment")
    path = new_path(t.spark, "csv")
    writers.csv(t.customers.select("customer_id", label.alias("label"), "segment"), path)
    return readers.csv(t.spark, path, "customer_id bigint, label string, segment string")


@query("src_csv_inferred", "SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_totalprice AS total FROM orders")
def src_csv_inferred(t):
    path = new_path(t.spark, "csv")
    rows = t.raw("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("total")
    )
    writers.csv(rows, path)
    return readers.csv(t.spark, path).withColumn("order_id", F.col("order_id").cast("long"))


@query(
    "src_csv_corrupt",
    """SELECT count(*) FILTER (line_no = 7) AS corrupt, count(*) FILTER (line_no <> 7) AS good,
              CAST(sum(CASE WHEN line_no <> 7 THEN quantity END) AS BIGINT) AS quantity FROM shop_items""",
)
def src_csv_corrupt(t):
    """Rows that do not fit the schema are kept aside, the others are read."""
    path = new_path(t.spark, "csv")
    quantity = F.when(F.col("line_no") == 7, "seven").otherwise(F.col("quantity").cast("string"))
    writers.csv(t.items.select("order_id", quantity.alias("quantity")), path)
    rows = readers.csv(t.spark, path, "order_id bigint, quantity int", keep_corrupt=True)
    broken = F.col(readers.CORRUPT).isNotNull()
    return rows.agg(
        F.count_if(broken).alias("corrupt"),
        F.count_if(~broken).alias("good"),
        F.sum(F.when(~broken, F.col("quantity"))).alias("quantity"),
    )


@query("src_parquet_roundtrip", "SELECT order_id, line_no, product_id, CAST(line_total AS DOUBLE) AS line_total FROM shop_items WHERE quantity > 25")
def src_parquet_roundtrip(t):
    path = new_path(t.spark, "parquet")
    writers.parquet(t.items, path)
    rows = readers.parquet(t.spark, path).filter(F.col("quantity") > 25)
    return rows.select("order_id", "line_no", "product_id", F.col("line_total").cast("double").alias("line_total"))


@query(
    "src_table_append",
    """SELECT customer_id, name, segment FROM shop_customers UNION ALL SELECT s_suppkey, s_name, 'SUPPLIER' FROM supplier
       UNION ALL SELECT * FROM (VALUES (-1, 'First, literal', 'X'), (-2, 'Second', NULL))""",
)
def src_table_append(t):
    """Create a table, replace it, append a selection and literal rows, scan it by name."""
    name = f"tallymart_{uuid.uuid4().hex}"
    path = new_path(t.spark, "table")
    writers.replace_table(t.orders, name, path)
    writers.replace_table(t.customers.select("customer_id", "name", "segment"), name, path)
    sellers = t.raw("supplier").select(
        F.lit("SUPPLIER").alias("segment"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("customer_id")
    )
    writers.append_to_table(sellers, name)
    writers.append_rows(t.spark, name, [(-1, "First, literal", "X"), (-2, "Second", None)])
    return readers.table(t.spark, name)


@query(
    "src_load_entities",
    """SELECT 'customers' AS table_name, count(*) AS n_rows, sum(customer_id)::BIGINT AS key_sum FROM shop_customers
       UNION ALL SELECT 'products', count(*), sum(product_id)::BIGINT FROM shop_products
       UNION ALL SELECT 'orders', count(*), sum(order_id)::BIGINT FROM shop_orders""",
)
def src_load_entities(t):
    """Several CSV tables into one set of frames, each cut to the columns it loads."""
    folder = new_path(t.spark, "entities")
    schemas = {
        "customers": "customer_id bigint, name string, segment string, nation_id int, balance decimal(18,2)",
        "products": "product_id bigint, product_name string, category string, brand string, unit_price decimal(10,2), stock_qty int",
        "orders": "order_id bigint, customer_id bigint, order_date date, status string, total_amount decimal(12,2), priority string",
    }
    for name in schemas:
        writers.csv(getattr(t, name), f"{folder}/{name}.csv")
    result = None
    for name, df in readers.csv_tables(t.spark, folder, schemas).items():
        key = df.columns[0]
        row = readers.columns(df, [key]).agg(F.count("*").alias("n_rows"), F.sum(key).alias("key_sum"))
        row = row.select(F.lit(name).alias("table_name"), "n_rows", "key_sum")
        result = row if result is None else result.unionByName(row)
    return result


@query("src_file_audit")
def src_file_audit(t):
    files = readers.file_metadata(t.spark, t.sf_dir)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", "modificationTime")


@query(
    "snk_format_sizes",
    "SELECT 'csv' AS format, count(*) AS n_rows, FALSE AS smallest FROM lineitem UNION ALL SELECT 'parquet', count(*), TRUE FROM lineitem",
)
def snk_format_sizes(t):
    sizes = writers.compare_formats(t.items, new_path(t.spark, "formats"))
    least = F.min("n_bytes").over(Window.partitionBy(F.lit(1)))  # two rows
    return sizes.select("format", "n_rows", (F.col("n_bytes") == least).alias("smallest"))


@query("copy_verify", "SELECT count(*) AS n_source, count(*) AS n_target, TRUE AS same_rows FROM orders")
def copy_verify(t):
    source, target = new_path(t.spark, "copy"), new_path(t.spark, "copy")
    writers.csv(t.orders, source)
    schema = "order_id bigint, customer_id bigint, order_date date, status string, total_amount decimal(12,2), priority string"
    return writers.copy_csv(t.spark, source, target, schema)


_COPY = """SELECT order_id, customer_id, status, CAST(total_amount AS DOUBLE) + CASE WHEN order_id % 5000 = 7 THEN 1 ELSE 0 END AS total_amount
           FROM shop_orders, range(2) copies(k) WHERE order_id % 5000 <> 8 AND (k = 0 OR order_id % 5000 = 9)"""
_ORDERS = "SELECT order_id, customer_id, status, CAST(total_amount AS DOUBLE) AS total_amount, 1 AS s, 0 AS t FROM shop_orders"


@query(
    "copy_diff",
    f"""SELECT order_id, customer_id, status, total_amount, sum(s)::BIGINT AS n_source, sum(t)::BIGINT AS n_target
        FROM ({_ORDERS} UNION ALL SELECT *, 0, 1 FROM ({_COPY})) GROUP BY ALL HAVING sum(s) <> sum(t)""",
)
def copy_diff(t):
    """A copy in which some orders are changed, lost or doubled."""
    rows = t.orders.select("order_id", "customer_id", "status", F.col("total_amount").cast("double").alias("total_amount"))
    kind = F.col("order_id") % 5000
    copy = rows.filter(kind != 8).withColumn("total_amount", F.col("total_amount") + F.when(kind == 7, 1).otherwise(0))
    copy = materialise(copy.unionByName(rows.filter(kind == 9)), "copy")
    return compare.differing_rows(rows, copy, ["order_id"])


@query("report_export", "SELECT month, CAST(revenue AS DOUBLE) AS total_revenue, orders_count FROM months")
def report_export(t):
    """A named report saved as one CSV file and read back."""
    path = new_path(t.spark, "report")
    writers.csv(shop.run_report("revenue_by_month", t.shop), path, single_file=True)
    return readers.csv(t.spark, path, "month string, total_revenue double, orders_count bigint")


# column, expression of its text in SQL, type and format that all rows together admit, whether two formats do
_TEXT_COLUMNS = [
    ("order_id", "CAST(l_orderkey AS VARCHAR)", "CASE WHEN max(length(text)) <= 9 THEN 'int' ELSE 'bigint' END", "NULL", "FALSE"),
    ("price", "CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR)", "'decimal(' || (max(length(text)) - 1) || ',2)'", "NULL", "FALSE"),
    ("part_code", "lpad(CAST(l_partkey AS VARCHAR), 12, '0')", "'string'", "NULL", "FALSE"),
    ("is_open", "CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END", "'boolean'", "NULL", "FALSE"),
    ("ship_iso", "strftime(l_shipdate, '%Y-%m-%d')", "'date'", "'yyyy-M-d'", "FALSE"),
    ("ship_day_first", "strftime(l_shipdate, '%d/%m/%Y')", "'date'", "'d/M/yyyy'", "FALSE"),
    ("ship_month_first", "strftime(l_shipdate, '%m/%d/%Y')", "'date'", "'M/d/yyyy'", "FALSE"),
    ("early_in_month", "CASE WHEN day(l_shipdate) <= 12 THEN strftime(l_shipdate, '%d-%m-%Y') END", "'date'", "'d-M-yyyy'", "TRUE"),
    ("flag", "l_returnflag", "'string'", "NULL", "FALSE"),
]


@query(
    "src_infer_types",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(text) AS n_values, count(*) - count(text) AS n_blank, {kind} AS type, CAST({form} AS VARCHAR) AS format, "
        f"{either} AS ambiguous FROM (SELECT {text} AS text FROM lineitem)"
        for name, text, kind, form, either in _TEXT_COLUMNS
    ),
)
def src_infer_types(t):
    """Types of a CSV file without a schema, the file read once."""
    ship = F.col("l_shipdate")
    texts = t.raw("lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(14,2)").cast("string").alias("price"),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("part_code"),
        F.when(F.col("l_linestatus") == "O", "true").otherwise("false").alias("is_open"),
        F.date_format(ship, "yyyy-MM-dd").alias("ship_iso"),
        F.date_format(ship, "dd/MM/yyyy").alias("ship_day_first"),
        F.date_format(ship, "MM/dd/yyyy").alias("ship_month_first"),
        F.when(F.dayofmonth(ship) <= 12, F.date_format(ship, "dd-MM-yyyy")).alias("early_in_month"),
        F.col("l_returnflag").alias("flag"),
    )
    path = new_path(t.spark, "csv")
    writers.csv(texts, path)
    return column_types.infer_types(readers.csv(t.spark, path, ", ".join(f"{c} string" for c in texts.columns)))
