"""Joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesloom.checks.registry import check, completed
from salesloom.functions.amounts import cents, from_cents, money_sum, percent
from salesloom.functions.dates import date_of, month_label
from salesloom.operators.joining import attach, broadcast_if_small, label_twice
from salesloom.operators.pairing import pair_totals
from salesloom.plans.sold import same_offer


@check(
    "j01_inner_equi",
    """
SELECT o_orderkey, c_name, c_mktsegment FROM customer JOIN orders ON c_custkey = o_custkey
""",
)
def inner_equi(t):
    return (
        t["customer"]
        .join(t["orders"], F.col("c_custkey") == F.col("o_custkey"), "inner")
        .select("o_orderkey", "c_name", "c_mktsegment")
    )


@check(
    "j02_inner_composite",
    completed(
        """
SELECT l_orderkey, l_linenumber, ps_availqty
FROM offers JOIN items ON ps_partkey = l_partkey AND ps_suppkey = l_suppkey
"""
    ),
)
def inner_composite(t):
    return (
        t["partsupp"]
        .join(t["lineitem"], same_offer(), "inner")
        .select("l_orderkey", "l_linenumber", "ps_availqty")
    )


@check(
    "j03_right_outer",
    """
SELECT c_custkey, n_name, in_debt
FROM (SELECT n_nationkey, n_name, count(*) AS in_debt FROM nation JOIN supplier ON n_nationkey = s_nationkey
      WHERE s_acctbal < 0 GROUP BY ALL)
RIGHT JOIN customer ON n_nationkey = c_nationkey
""",
)
def right_outer(t):
    """Customers, with the suppliers in debt of their nation where there are any."""
    debtors = (
        t["supplier"]
        .filter(F.col("s_acctbal") < 0)
        .groupBy("s_nationkey")
        .agg(F.count("*").alias("in_debt"))
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"), "inner")
    )
    return debtors.join(t["customer"], F.col("n_nationkey") == F.col("c_nationkey"), "right").select(
        "c_custkey", "n_name", "in_debt"
    )


@check(
    "j04_left_outer_lookup",
    completed(
        """
SELECT sn.n_name AS sold_from, cn.n_name AS sold_to, n_lines, CAST(total AS DOUBLE) AS revenue
FROM (SELECT s_nationkey, c_nationkey, count(*) AS n_lines, sum(price) AS total
      FROM items JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
"""
    ),
)
def left_outer_lookup(t):
    """Revenue by nation of supplier and of customer, named from one table."""
    per_route = (
        t["lineitem"]
        .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey", "o_custkey")
        .agg(F.count("*").alias("n_lines"), F.sum(cents("l_extendedprice")).alias("total"))
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "c_nationkey")
        .agg(F.sum("n_lines").alias("n_lines"), from_cents(F.sum("total")).alias("revenue"))
    )
    return label_twice(
        per_route,
        t["nation"],
        "n_nationkey",
        "n_name",
        {"s_nationkey": "sold_from", "c_nationkey": "sold_to"},
    ).select("sold_from", "sold_to", "n_lines", "revenue")


@check(
    "j05_broadcast_hint",
    """
SELECT c_custkey, n_name, r_name FROM region JOIN nation ON r_regionkey = n_regionkey
JOIN customer ON n_nationkey = c_nationkey
""",
)
def broadcast_hint(t):
    places = t["region"].join(
        broadcast_if_small(t["nation"]), F.col("r_regionkey") == F.col("n_regionkey"), "inner"
    )
    return (
        t["customer"]
        .join(broadcast_if_small(places), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .select("c_custkey", "n_name", "r_name")
    )


@check(
    "j06_self_join_equi_plus_range",
    completed(
        """
SELECT a.l_orderkey AS order_key, CAST(count(*) AS DOUBLE) AS pairs, CAST(sum(a.price + b.price) AS DOUBLE) AS pair_value
FROM items a JOIN items b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey
GROUP BY a.l_orderkey
"""
    ),
)
def self_join_equi_plus_range(t):
    """Pairs of different parts per order: how many, and their summed price."""
    lines = t["lineitem"].select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        cents("l_extendedprice").alias("value"),
    )
    return pair_totals(lines).select(
        "order_key",
        F.col("pairs").cast("double").alias("pairs"),
        from_cents("pair_value").alias("pair_value"),
    )


@check(
    "j07_join_using",
    """
SELECT "PRIORITY", "YEAR", "MONTH_YEAR", n_month, n_year
FROM (SELECT o_orderpriority AS "PRIORITY", CAST(year(o_orderdate) AS INTEGER) AS "YEAR",
             strftime(o_orderdate, '%Y-%m') AS "MONTH_YEAR", count(*) AS n_month
      FROM orders GROUP BY ALL)
JOIN (SELECT o_orderpriority AS "PRIORITY", CAST(year(o_orderdate) AS INTEGER) AS "YEAR", count(*) AS n_year
      FROM orders GROUP BY ALL) USING ("PRIORITY", "YEAR")
""",
)
def join_using(t):
    orders = t["orders"]
    day = date_of(orders, "o_orderdate")
    months = orders.groupBy(
        F.col("o_orderpriority").alias("PRIORITY"),
        F.year(day).alias("YEAR"),
        month_label(day).alias("MONTH_YEAR"),
    ).agg(F.count("*").alias("n_month"))
    years = months.groupBy("PRIORITY", "YEAR").agg(F.sum("n_month").alias("n_year"))
    return months.join(years, ["PRIORITY", "YEAR"], "inner")


@check(
    "j08_join_on_struct_key",
    completed(
        """
SELECT ps_partkey, ps_suppkey, ps_availqty, n_lines
FROM offers JOIN (SELECT l_partkey, l_suppkey, count(*) AS n_lines FROM items GROUP BY ALL)
ON ps_partkey = l_partkey AND ps_suppkey = l_suppkey
"""
    ),
)
def join_on_struct_key(t):
    sold = t["lineitem"].groupBy(
        F.struct(
            F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("supplier_key")
        ).alias("offer")
    ).agg(F.count("*").alias("n_lines"))
    offers = t["partsupp"].withColumn(
        "offer",
        F.struct(
            F.col("ps_partkey").alias("part_key"), F.col("ps_suppkey").alias("supplier_key")
        ),
    )
    return offers.join(sold, on="offer").select("ps_partkey", "ps_suppkey", "ps_availqty", "n_lines")


@check(
    "j09_star_join",
    completed(
        """
SELECT r_name, c_mktsegment, CAST(sum(price) AS DOUBLE) AS revenue, count(*) AS n_lines
FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey
JOIN orders ON c_custkey = o_custkey JOIN items ON o_orderkey = l_orderkey
GROUP BY r_name, c_mktsegment
"""
    ),
)
def star_join(t):
    """Five tables; lines are summed per order, and orders per customer, on the way."""
    per_order = (
        t["lineitem"]
        .groupBy("l_orderkey")
        .agg(F.sum(cents("l_extendedprice")).alias("revenue"), F.count("*").alias("n_lines"))
    )
    per_customer = (
        t["orders"]
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("revenue").alias("revenue"), F.sum("n_lines").alias("n_lines"))
    )
    return (
        t["customer"]
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("r_name", "c_mktsegment")
        .agg(from_cents(F.sum("revenue")).alias("revenue"), F.sum("n_lines").alias("n_lines"))
    )


@check(
    "j10_aggregate_rejoin",
    """
SELECT o_orderkey, o_totalprice / total * 100 AS pct_of_customer
FROM orders JOIN (SELECT o_custkey AS buyer, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
                  FROM orders GROUP BY o_custkey) ON o_custkey = buyer
""",
)
def aggregate_rejoin(t):
    orders = t["orders"]
    totals = orders.groupBy("o_custkey").agg(money_sum("o_totalprice").alias("total"))
    return attach(orders, totals, ["o_custkey"]).select(
        "o_orderkey", percent("o_totalprice", "total").alias("pct_of_customer")
    )


@check(
    "j11_shared_lineage_join",
    """
SELECT o_custkey, n_orders, n_urgent
FROM (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey)
JOIN (SELECT o_custkey, count(*) AS n_urgent FROM orders WHERE o_orderpriority = '1-URGENT'
      GROUP BY o_custkey) USING (o_custkey)
""",
)
def shared_lineage_join(t):
    orders = t["orders"]
    every = orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    urgent = (
        orders.filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("n_urgent"))
    )
    return every.join(urgent, on="o_custkey", how="inner")
