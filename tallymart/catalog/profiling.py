"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.catalog.cleaning import cleaned_shop
from tallymart.catalog.registry import query
from tallymart.operators import profile, sampling, sketches


def _unpivot(columns: list[str], expr: str, source: str, value: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {expr.format(c)} AS {value} FROM {source}" for c in columns)


@query("prof_head", "SELECT order_id, customer_id, status FROM shop_orders ORDER BY order_id LIMIT 10")
def prof_head(t):
    return profile.head(t.orders.select("order_id", "customer_id", "status"), 10, ["order_id"])


@query("prof_tail", "SELECT order_id, customer_id, status FROM shop_orders ORDER BY order_id DESC LIMIT 5")
def prof_tail(t):
    return profile.tail(t.orders.select("order_id", "customer_id", "status"), 5, ["order_id"])


_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query("prof_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in _TABLES))
def prof_counts(t):
    return profile.row_counts({name: t.raw(name) for name in _TABLES})


_LINE_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@query(
    "prof_schema",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS type, TRUE AS nullable, count({c}) AS non_nulls FROM lineitem"
        for i, (c, t) in enumerate(_LINE_TYPES.items(), 1)
    ),
)
def prof_schema(t):
    return profile.info(t.raw("lineitem"))


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query(
    "prof_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
            CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in _NUMBERS
    ),
)
def prof_summary(t):
    # rounded, since sums of doubles depend on the order of the rows
    summary = profile.summary(t.raw("lineitem"), _NUMBERS)
    return summary.withColumn("mean", F.round("mean", 4)).withColumn("stddev", F.round("stddev", 4))


_RETAIL = (
    "user_id transaction_date status price sale_amount revenue email username age subscription city region "
    "product_category raw_timestamp store_id"
).split()
_NULLS = _unpivot(_RETAIL, "count(*) FILTER ({0} IS NULL)", "retail", "nulls")


@query("prof_nulls", _NULLS)
def prof_nulls(t):
    return profile.null_counts(t.retail)


@query("prof_nulls_present", f"SELECT * FROM ({_NULLS}) WHERE nulls > 0")
def prof_nulls_present(t):
    return profile.null_counts(t.retail, only_present=True)


@query("prof_nulls_total", f"SELECT sum(nulls)::BIGINT AS total_nulls FROM ({_NULLS})")
def prof_nulls_total(t):
    return profile.total_nulls(t.retail)


@query("prof_nulls_column", "SELECT count(*) AS null_email FROM dirty_customers WHERE email IS NULL")
def prof_nulls_column(t):
    return t.dirty_customers.filter(F.col("email").isNull()).agg(F.count("*").alias("null_email"))


@query("prof_rows_with_null", "SELECT customer_id, email, country FROM dirty_customers WHERE email IS NULL OR country IS NULL")
def prof_rows_with_null(t):
    return profile.rows_with_null(t.dirty_customers, ["email", "country"]).select("customer_id", "email", "country")


_TEXTS = {"status", "email", "username", "subscription", "city", "region", "product_category", "raw_timestamp", "store_id"}


@query(
    "prof_null_blank_audit",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, "
        + (f"count(*) FILTER (trim({c}, ' ') = '')" if c in _TEXTS else "CAST(0 AS BIGINT)")
        + " AS blanks FROM retail"
        for c in _RETAIL
    )
    + ") WHERE nulls > 0 OR blanks > 0",
)
def prof_null_blank_audit(t):
    return profile.null_blank_audit(t.retail)


@query(
    "prof_dup_rows",
    """SELECT (SELECT count(*) FROM retail_with_copies) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM retail_with_copies)) AS n_distinct,
       (SELECT count(*) FROM retail_with_copies) - (SELECT count(*) FROM (SELECT DISTINCT * FROM retail_with_copies)) AS n_duplicates""",
)
def prof_dup_rows(t):
    return profile.duplicate_row_count(t.retail_with_copies)


@query(
    "prof_dup_keys",
    "SELECT order_id, line_no, count(*) AS duplicate_count FROM shop_items GROUP BY order_id, line_no HAVING count(*) > 1",
)
def prof_dup_keys(t):
    return profile.duplicate_keys(t.items, ["order_id", "line_no"])


_STEPS = [
    ("customers", "clean", "dirty_customers", "ok_customers"),
    ("products", "clean", "dirty_products", "ok_products"),
    ("orders", "clean", "dirty_orders", "ok_orders"),
    ("order_items", "clean", "dirty_items", "ok_items"),
    ("orders", "without items", "ok_orders", "ok_sold_orders"),
]


@query(
    "prof_step_audit",
    "SELECT *, rows_before - rows_after AS removed FROM ("
    + " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{step}' AS step, (SELECT count(*) FROM {before}) AS rows_before, "
        f"(SELECT count(*) FROM {after}) AS rows_after"
        for table, step, before, after in _STEPS
    )
    + ")",
)
def prof_step_audit(t):
    return cleaned_shop(t).audit


@query(
    "prof_sample",
    """SELECT order_id, customer_id, order_date, status FROM (
           SELECT *, row_number() OVER (PARTITION BY status ORDER BY ('0x' || substr(md5('1:' || order_id), 1, 15))::BIGINT, order_id) AS place,
                  ceil(0.015 * count(*) OVER (PARTITION BY status)) AS size FROM shop_orders) WHERE place <= size""",
    dates=["order_date"],
)
def prof_sample(t):
    return sampling.exact_sample(t.orders.select("order_id", "customer_id", "order_date", "status"), ["order_id"], 0.015, 1, ["status"])


@query(
    "prof_quartiles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, quantile_disc({c}, 0.25)::DOUBLE AS q25, quantile_disc({c}, 0.5)::DOUBLE AS q50,
            quantile_disc({c}, 0.75)::DOUBLE AS q75 FROM lineitem"""
        for c in _NUMBERS
    ),
)
def prof_quartiles(t):
    return sketches.quantiles(t.raw("lineitem"), _NUMBERS)


@query(
    "prof_plan",
    """SELECT 'narrow' AS name, 0 AS shuffles, 0 AS broadcasts, 1 AS scans, 'l_orderkey,l_quantity' AS columns_read,
              'GreaterThan(l_quantity,45.0),IsNotNull(l_quantity)' AS pushed, count(*) AS n_rows FROM lineitem WHERE l_quantity > 45
       UNION ALL SELECT 'wide', 1, 0, 1, 'l_extendedprice,l_returnflag', '', count(DISTINCT l_returnflag) FROM lineitem""",
)
def prof_plan(t):
    """A query of narrow steps and one with a wide step: what their plans cost, next to their rows."""
    lines = t.raw("lineitem")
    narrow = lines.filter(F.col("l_quantity") > 45).select("l_orderkey", "l_quantity")
    wide = lines.groupBy("l_returnflag").agg(F.max("l_extendedprice").alias("largest"))

    def described(name, df):
        plan = profile.plan_summary(df)
        told = {"name": name, "shuffles": plan.shuffles, "broadcasts": plan.broadcasts, "scans": plan.scans, "columns_read": ",".join(plan.columns_read), "pushed": ",".join(plan.pushed)}
        return df.agg(F.count("*").alias("n_rows")).select(*[F.lit(v).alias(c) for c, v in told.items()], "n_rows")

    return described("narrow", narrow).unionByName(described("wide", wide))
