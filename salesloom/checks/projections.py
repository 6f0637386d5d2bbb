"""Projections, filters and scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesloom.checks.registry import check, completed
from salesloom.functions.amounts import cents, from_cents, zero_if_null
from salesloom.functions.campaigns import flag_by_coin, flag_by_key
from salesloom.functions.dates import date_of, days_between, in_years, month_label, parse_date
from salesloom.operators.ranking import top_k_with_ties
from salesloom.plans.sold import same_offer


@check("p01_project", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem")
def project(t):
    return t["lineitem"].select("l_orderkey", "l_partkey", "l_extendedprice")


@check(
    "p02_rename_alias",
    'SELECT o_orderkey AS "ORDERKEY", o_custkey AS "BUYER", o_orderpriority AS "PRIORITY" FROM orders',
)
def rename_alias(t):
    return t["orders"].select(
        F.col("o_orderkey").alias("ORDERKEY"),
        F.col("o_custkey").alias("BUYER"),
        F.col("o_orderpriority").alias("PRIORITY"),
    )


@check(
    "p03_computed_column",
    completed(
        """
SELECT l_orderkey, l_linenumber, CAST(price * (1 - discount) AS DOUBLE) AS discounted,
       CAST(price - ps_supplycost AS DOUBLE) AS profit
FROM items JOIN offers ON l_partkey = ps_partkey AND l_suppkey = ps_suppkey
"""
    ),
)
def computed_column(t):
    return (
        t["lineitem"]
        .join(t["partsupp"], same_offer())
        .select(
            "l_orderkey",
            "l_linenumber",
            (cents("l_extendedprice") * (100 - cents("l_discount")) / 10_000).alias("discounted"),
            from_cents(cents("l_extendedprice") - cents("ps_supplycost")).alias("profit"),
        )
    )


@check(
    "p04_add_or_replace_column",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
       CAST(year(o_orderdate) AS INTEGER) AS order_year
FROM orders
""",
)
def add_or_replace_column(t):
    orders = t["orders"]
    return (
        orders.withColumn("o_orderdate", date_of(orders, "o_orderdate"))
        .withColumn("order_year", F.year("o_orderdate"))
        .select("o_orderkey", "o_orderdate", "order_year")
    )


@check(
    "p05_rename_column",
    'SELECT s_suppkey, s_name AS "SUPPLIER_NAME", s_nationkey, s_acctbal AS "BALANCE" FROM supplier',
)
def rename_column(t):
    return (
        t["supplier"]
        .withColumnRenamed("s_name", "SUPPLIER_NAME")
        .withColumnRenamed("s_acctbal", "BALANCE")
    )


@check("p06_drop_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_columns(t):
    return t["customer"].drop("c_nationkey", "c_acctbal")


@check(
    "p07_comparison_filter",
    completed(
        """
SELECT l_orderkey, l_linenumber, CAST(shipped - l_commitdate AS INTEGER) AS day_diff
FROM items WHERE shipped - l_commitdate > 0
"""
    ),
)
def comparison_filter(t):
    items = t["lineitem"]
    late = days_between(date_of(items, "l_shipdate"), date_of(items, "l_commitdate"))
    return items.select("l_orderkey", "l_linenumber", late.alias("day_diff")).filter(
        F.col("day_diff") > 0
    )


@check(
    "p08_membership_filter",
    "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) IN (1996, 1997, 1998)",
)
def membership_filter(t):
    # the years follow each other, so membership is a range the scan can use
    orders = t["orders"]
    return orders.filter(in_years(orders, "o_orderdate", 1996, 1998)).select(
        "o_orderkey", "o_custkey"
    )


@check(
    "p09_rank_filter",
    """
SELECT s_suppkey, s_nationkey, s_acctbal
FROM (SELECT *, rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC) AS place FROM supplier)
WHERE place <= 2
""",
)
def rank_filter(t):
    return top_k_with_ties(t["supplier"], 2, "s_acctbal", within=["s_nationkey"]).select(
        "s_suppkey", "s_nationkey", "s_acctbal"
    )


@check(
    "p10_conjunction",
    """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity >= 25 AND l_discount > 0.03
""",
)
def conjunction(t):
    return (
        t["lineitem"]
        .filter(
            (F.col("l_returnflag") == "R")
            & (F.col("l_quantity") >= 25)
            & (F.col("l_discount") > 0.03)
        )
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    )


@check(
    "p11_literal_column",
    completed(
        """
SELECT l_orderkey, l_linenumber, 1 AS delay_flag FROM items WHERE shipped > l_commitdate
"""
    ),
)
def literal_column(t):
    items = t["lineitem"]
    return items.filter(
        date_of(items, "l_shipdate") > date_of(items, "l_commitdate")
    ).select("l_orderkey", "l_linenumber", F.lit(1).alias("delay_flag"))


# text dates with months 00 to 14 and any day: some are no dates
_TEXT_DATE_SQL = """
SELECT o_orderkey, year(o_orderdate) || '-' || lpad(CAST(o_orderkey % 15 AS VARCHAR), 2, '0')
       || '-' || lpad(CAST(1 + o_custkey % 31 AS VARCHAR), 2, '0') AS written
FROM orders
"""


@check(
    "f01_parse_date",
    f"SELECT o_orderkey, written, TRY_CAST(written AS DATE) AS parsed FROM ({_TEXT_DATE_SQL})",
)
def parse_text_date(t):
    written = F.format_string(
        "%d-%02d-%02d",
        F.year("o_orderdate"),
        F.col("o_orderkey") % 15,
        1 + F.col("o_custkey") % 31,
    )
    return (
        t["orders"]
        .select("o_orderkey", written.alias("written"))
        .withColumn("parsed", parse_date(F.col("written")))
    )


@check("f02_year", "SELECT l_orderkey, CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem")
def year_of_date(t):
    items = t["lineitem"]
    return items.select("l_orderkey", F.year(date_of(items, "l_shipdate")).alias("ship_year"))


@check(
    "f03_format_month",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_year FROM orders",
)
def format_month(t):
    orders = t["orders"]
    return orders.select(
        "o_orderkey", month_label(date_of(orders, "o_orderdate")).alias("month_year")
    )


@check(
    "f04_day_difference",
    completed(
        """
SELECT l_orderkey, l_linenumber, CAST(shipped - CAST(o_orderdate AS DATE) AS INTEGER) AS lead_time,
       CAST(shipped - l_commitdate AS INTEGER) AS delay
FROM items JOIN orders ON l_orderkey = o_orderkey
"""
    ),
)
def day_difference(t):
    items, orders = t["lineitem"], t["orders"]
    shipped = date_of(items, "l_shipdate")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        days_between(shipped, date_of(orders, "o_orderdate")).alias("lead_time"),
        days_between(shipped, date_of(items, "l_commitdate")).alias("delay"),
    )


@check(
    "f05_arithmetic",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) + CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS plus,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS minus,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DOUBLE) AS tax
FROM lineitem
""",
)
def arithmetic(t):
    price, quantity = cents("l_extendedprice"), cents("l_quantity")
    return t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        from_cents(price + quantity).alias("plus"),
        from_cents(price - quantity).alias("minus"),
        (price * cents("l_tax") / 10_000).alias("tax"),
    )


@check(
    "f06_case_when",
    """
SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END
       AS size_class
FROM part
""",
)
def case_when(t):
    return t["part"].select(
        "p_partkey",
        F.when(F.col("p_size") < 10, "small")
        .when(F.col("p_size") < 30, "medium")
        .otherwise("large")
        .alias("size_class"),
    )


@check(
    "f07_coalesce_zero",
    """
SELECT c_custkey, coalesce(n, 0) AS urgent_orders
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders
                         WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) ON c_custkey = o_custkey
""",
)
def coalesce_zero(t):
    urgent = (
        t["orders"]
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("n"))
    )
    return (
        t["customer"]
        .join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", zero_if_null("n").alias("urgent_orders"))
    )


@check(
    "f08_least_greatest",
    """
SELECT l_orderkey, l_linenumber, least(l_partkey, l_suppkey) AS low, greatest(l_partkey, l_suppkey) AS high
FROM lineitem
""",
)
def least_greatest(t):
    return t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        F.least("l_partkey", "l_suppkey").alias("low"),
        F.greatest("l_partkey", "l_suppkey").alias("high"),
    )


@check(
    "f09_struct",
    """
SELECT l_partkey AS part_1, l_suppkey AS supplier_1, l_orderkey AS "ORDERKEY",
       l_linenumber AS "LINE" FROM lineitem
""",
)
def struct_fields(t):
    nested = t["lineitem"].select(
        F.struct("l_partkey", "l_suppkey").alias("plain"),
        F.struct(
            F.col("l_orderkey").alias("ORDERKEY"), F.col("l_linenumber").alias("LINE")
        ).alias("named"),
    )
    return nested.select(
        F.col("plain.l_partkey").alias("part_1"),
        F.col("plain.l_suppkey").alias("supplier_1"),
        "named.ORDERKEY",
        "named.LINE",
    )


@check(
    "f10_random_split",
    """
SELECT c_custkey, CAST(CASE WHEN md5('0:' || CAST(c_custkey AS VARCHAR)) < '8' THEN 1 ELSE 0 END
       AS INTEGER) AS mkt_campaign
FROM customer
""",
)
def split_by_key(t):
    return t["customer"].select("c_custkey", flag_by_key("c_custkey").alias("mkt_campaign"))


@check(
    "f10_random_split_by_coin",
    """
SELECT count(*) AS n_rows, TRUE AS only_flags, TRUE AS about_half FROM customer
""",
)
def split_by_coin(t):
    """A seeded coin per customer; another engine cannot repeat it, but for what a coin must do."""
    flags = t["customer"].select(flag_by_coin(seed=7).alias("flag"))
    return flags.agg(
        F.count("*").alias("n_rows"),
        (F.min("flag").isin(0, 1) & F.max("flag").isin(0, 1)).alias("only_flags"),
        F.avg("flag").between(0.3, 0.7).alias("about_half"),
    )


@check(
    "f11_text_to_number",
    """
SELECT o_orderkey, CAST(o_orderkey AS BIGINT) AS whole, o_totalprice AS amount,
       CAST(NULL AS BIGINT) AS not_a_number
FROM orders
""",
)
def text_to_number(t):
    written = t["orders"].select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("whole"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("amount"),
        "o_orderpriority",
    )
    return written.select(
        "o_orderkey",
        F.col("whole").try_cast("bigint").alias("whole"),
        F.col("amount").try_cast("decimal(12,2)").cast("double").alias("amount"),
        F.col("o_orderpriority").try_cast("bigint").alias("not_a_number"),
    )


@check(
    "f12_split_text",
    """
SELECT c_custkey, string_split(c_name || '|' || c_mktsegment || '|', '|')[1] AS first_field,
       string_split(c_name || '|' || c_mktsegment || '|', '|')[2] AS second_field,
       CAST(len(string_split(c_name || '|' || c_mktsegment || '|', '|')) AS INTEGER) AS n_fields
FROM customer
""",
)
def split_text(t):
    fields = F.split(F.concat("c_name", F.lit("|"), "c_mktsegment", F.lit("|")), r"\|")
    return t["customer"].select(
        "c_custkey",
        F.get(fields, 0).alias("first_field"),
        F.get(fields, 1).alias("second_field"),
        F.size(fields).alias("n_fields"),
    )
