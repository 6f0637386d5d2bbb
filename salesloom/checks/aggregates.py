"""Aggregates, distinct, pivot, windows, sorting and top rows over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from salesloom.checks.registry import check, completed
from salesloom.functions.amounts import (
    MONEY,
    RATE,
    UNITS,
    Wide,
    cents,
    from_cents,
    growth_percent,
    guarded_change,
    money_sum,
    percent,
    units,
    zero_if_null,
)
from salesloom.functions.dates import date_of, month_label
from salesloom.operators.grouping import spread, with_group_values, years_to_columns
from salesloom.operators.ranking import top_k_with_ties, top_n


@check(
    "a01_group_sum",
    completed(
        """
SELECT l_returnflag, l_linestatus, CAST(sum(price) AS DOUBLE) AS revenue,
       CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity
FROM items GROUP BY l_returnflag, l_linestatus
"""
    ),
)
def group_sum(t):
    return (
        t["lineitem"]
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            money_sum("l_extendedprice").alias("revenue"),
            money_sum("l_quantity").alias("quantity"),
        )
    )


@check(
    "a02_two_level_aggregate",
    """
SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       count(DISTINCT month(o_orderdate)) AS months,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS annual
FROM orders GROUP BY ALL
""",
)
def two_level_aggregate(t):
    orders = t["orders"]
    day = date_of(orders, "o_orderdate")
    monthly = orders.groupBy(
        "o_orderpriority", F.year(day).alias("order_year"), month_label(day).alias("month")
    ).agg(F.sum(cents("o_totalprice")).alias("monthly"))
    return monthly.groupBy("o_orderpriority", "order_year").agg(
        F.count("month").alias("months"), from_cents(F.sum("monthly")).alias("annual")
    )


@check(
    "a03_count_distinct",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_suppkey",
)
def count_distinct(t):
    return t["lineitem"].groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"))


@check("a04_group_count", "SELECT o_custkey, count(o_orderkey) AS orders FROM orders GROUP BY o_custkey")
def group_count(t):
    return t["orders"].groupBy("o_custkey").agg(F.count("o_orderkey").alias("orders"))


@check(
    "a05_group_max",
    "SELECT l_partkey, max(l_quantity) AS most FROM lineitem GROUP BY l_partkey",
)
def group_max(t):
    return t["lineitem"].groupBy("l_partkey").agg(F.max("l_quantity").alias("most"))


@check(
    "a06_pivot_fixed_values",
    """
SELECT o_custkey, nullif(count(*) FILTER (year(o_orderdate) = 1996), 0) AS "1996",
       nullif(count(*) FILTER (year(o_orderdate) = 1997), 0) AS "1997",
       nullif(count(*) FILTER (year(o_orderdate) = 1998), 0) AS "1998"
FROM orders GROUP BY o_custkey
""",
)
def pivot_fixed_values(t):
    orders = t["orders"]
    yearly = orders.groupBy(
        "o_custkey", F.year(date_of(orders, "o_orderdate")).alias("YEAR")
    ).agg(F.count("*").alias("placed"))
    return yearly.groupBy("o_custkey").pivot("YEAR", [1996, 1997, 1998]).agg(F.max("placed"))


@check("a07_distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(t):
    return t["lineitem"].select("l_partkey", "l_suppkey").distinct()


@check(
    "a08_drop_duplicates_subset",
    """
SELECT l_orderkey, count(*) AS parts FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
GROUP BY l_orderkey
""",
)
def drop_duplicates_subset(t):
    return (
        t["lineitem"]
        .dropDuplicates(["l_orderkey", "l_partkey"])
        .groupBy("l_orderkey")
        .agg(F.count("l_partkey").alias("parts"))
    )


@check("a09_drop_duplicates_all", "SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem")
def drop_duplicates_all(t):
    return t["lineitem"].select("l_orderkey", "l_suppkey", "l_returnflag").dropDuplicates()


@check(
    "a10_ratio_percent",
    completed(
        """
SELECT l_suppkey, CAST(coalesce(sum(price) FILTER (l_returnflag = 'R'), 0) AS DOUBLE)
       / CAST(sum(price) AS DOUBLE) * 100 AS returned_pct
FROM items GROUP BY l_suppkey
"""
    ),
)
def ratio_percent(t):
    price = cents("l_extendedprice")
    return (
        t["lineitem"]
        .groupBy("l_suppkey")
        .agg(
            zero_if_null(F.sum(F.when(F.col("l_returnflag") == "R", price))).alias("returned"),
            F.sum(price).alias("sold"),
        )
        .select(
            "l_suppkey",
            percent(from_cents("returned"), from_cents("sold")).alias("returned_pct"),
        )
    )


@check(
    "f05_amounts_near_the_limit",
    """
SELECT l_returnflag, count(*) AS n_lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4)) + CAST(99999999800000 AS DECIMAL(18,4))
                + l_linenumber * CAST(0.0001 AS DECIMAL(9,4))) AS VARCHAR) AS total
FROM lineitem GROUP BY l_returnflag
""",
)
def amounts_near_the_limit(t):
    """Sums of amounts that no double tells apart, as staged, far beyond a bigint."""
    price = F.col("l_extendedprice").cast(MONEY) + F.lit("99999999800000").cast(MONEY)
    price = (price + F.col("l_linenumber") * F.lit("0.0001").cast(RATE)).cast(MONEY)
    lines = t["lineitem"].select("l_returnflag", "l_partkey", price.alias("price"))
    per_part = lines.groupBy("l_returnflag", "l_partkey").agg(
        F.count("*").alias("n_lines"), *Wide.of(units("price")).sum().columns("total")
    )
    total = Wide.named("total").sum().whole().cast("decimal(33,0)") * F.lit("0.0001").cast("decimal(4,4)")
    return per_part.groupBy("l_returnflag").agg(
        F.sum("n_lines").alias("n_lines"), total.cast("decimal(38,4)").cast("string").alias("total")
    )


@check(
    "f05_parts_of_a_cent",
    """
SELECT l_returnflag,
       CAST(sum((CAST(l_extendedprice AS DECIMAL(18,4)) + CAST(0.0075 AS DECIMAL(9,4)))
                * (1 - CAST(l_discount AS DECIMAL(9,4)) - CAST(0.0025 AS DECIMAL(9,4)))) AS VARCHAR) AS discounted
FROM lineitem GROUP BY l_returnflag
""",
)
def parts_of_a_cent(t):
    """Amounts and rates with four decimals, multiplied and added up without rounding."""
    price = (F.col("l_extendedprice").cast(MONEY) + F.lit("0.0075").cast(RATE)).cast(MONEY)
    rate = (F.col("l_discount").cast(RATE) + F.lit("0.0025").cast(RATE)).cast(RATE)
    total = Wide.of(units(price)).times(UNITS - units(rate)).sum().whole().cast("decimal(29,0)")
    total = (total * F.lit("0.00000001").cast("decimal(8,8)")).cast("decimal(38,8)").cast("string")
    return t["lineitem"].groupBy("l_returnflag").agg(total.alias("discounted"))


@check(
    "a11_percent_change_guarded",
    """
SELECT o_custkey, CASE WHEN py = 0 THEN 100.0 WHEN cy = 0 THEN -100.0
                       ELSE CAST(cy - py AS DOUBLE) / CAST(py AS DOUBLE) * 100 END AS pct_change
FROM (SELECT o_custkey, count(*) FILTER (year(o_orderdate) = 1997) AS py,
             count(*) FILTER (year(o_orderdate) = 1998) AS cy FROM orders GROUP BY o_custkey)
""",
)
def percent_change_guarded(t):
    orders = t["orders"]
    year = F.year(date_of(orders, "o_orderdate"))
    return years_to_columns(orders, ["o_custkey"], year, [1997, 1998], F.lit(1)).select(
        "o_custkey",
        guarded_change(zero_if_null("1998"), zero_if_null("1997")).alias("pct_change"),
    )


@check(
    "a12_hash_repartition",
    completed(
        """
SELECT l_partkey, CAST(sum(price) AS DOUBLE) AS revenue, count(*) AS n_lines FROM items GROUP BY l_partkey
"""
    ),
)
def hash_repartition(t):
    """Sixteen partitions by part, each part spread over them by order."""
    return (
        spread(t["lineitem"], 16, ["l_partkey"], within=["l_orderkey"])
        .groupBy("l_partkey")
        .agg(money_sum("l_extendedprice").alias("revenue"), F.count("*").alias("n_lines"))
    )


@check(
    "w01_partition_sum",
    """
SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER (PARTITION BY o_custkey) AS DOUBLE)
       AS customer_total
FROM orders
""",
)
def partition_sum(t):
    return with_group_values(
        t["orders"], ["o_custkey"], customer_total=money_sum("o_totalprice")
    ).select("o_orderkey", "customer_total")


@check(
    "w02_partition_avg",
    """
SELECT l_orderkey, l_linenumber, l_quantity, avg(l_quantity) OVER (PARTITION BY l_orderkey) AS mean_quantity
FROM lineitem
""",
)
def partition_avg(t):
    return with_group_values(
        t["lineitem"].select("l_orderkey", "l_linenumber", "l_quantity"),
        ["l_orderkey"],
        mean_quantity=F.avg("l_quantity"),
    )


@check(
    "w03_partition_count",
    """
SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS orders_that_year
FROM orders
""",
)
def partition_count(t):
    orders = t["orders"]
    dated = orders.select(
        "o_orderkey", "o_custkey", F.year(date_of(orders, "o_orderdate")).alias("order_year")
    )
    return with_group_values(
        dated, ["o_custkey", "order_year"], orders_that_year=F.count("*")
    ).select("o_orderkey", "orders_that_year")


@check(
    "w04_lag",
    """
SELECT *, (annual - earlier) / earlier * 100 AS growth
FROM (SELECT *, lag(annual) OVER (PARTITION BY o_orderpriority ORDER BY order_year) AS earlier
      FROM (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS annual
            FROM orders GROUP BY ALL))
""",
)
def lag_value(t):
    orders = t["orders"]
    yearly = orders.groupBy(
        "o_orderpriority", F.year(date_of(orders, "o_orderdate")).alias("order_year")
    ).agg(money_sum("o_totalprice").alias("annual"))
    earlier = F.lag("annual").over(Window.partitionBy("o_orderpriority").orderBy("order_year"))
    return yearly.withColumn("earlier", earlier).withColumn(
        "growth", growth_percent("annual", "earlier")
    )


@check(
    "w05_rank_global",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(place AS INTEGER) AS place
FROM (SELECT *, rank() OVER (ORDER BY l_extendedprice DESC) AS place FROM lineitem) WHERE place <= 10
""",
)
def rank_global(t):
    return top_k_with_ties(t["lineitem"], 10, "l_extendedprice", rank="place").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "place"
    )


@check(
    "w06_rank_partitioned",
    """
SELECT p_partkey, p_type, p_size, CAST(place AS INTEGER) AS place
FROM (SELECT *, rank() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS place FROM part) WHERE place <= 5
""",
)
def rank_partitioned(t):
    """Largest parts per type; sizes repeat, so there are many ties."""
    return top_k_with_ties(t["part"], 5, "p_size", within=["p_type"], rank="place").select(
        "p_partkey", "p_type", "p_size", "place"
    )


@check("o01_sort_asc", "SELECT p_type, p_name, p_partkey FROM part ORDER BY p_type, p_name, p_partkey")
def sort_asc(t):
    # the key at the end lets rows of one frequent type sort in many tasks
    return t["part"].select("p_type", "p_name", "p_partkey").orderBy("p_type", "p_name", "p_partkey")


@check("o02_sort_desc", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sort_desc(t):
    return t["customer"].select("c_custkey", "c_acctbal").orderBy(
        F.col("c_acctbal").desc(), "c_custkey"
    )


@check(
    "o03_topn_sort_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def topn_sort_limit(t):
    return top_n(
        t["orders"].select("o_orderkey", "o_totalprice"),
        5,
        F.col("o_totalprice").desc_nulls_last(),
        F.col("o_orderkey"),
    )


@check(
    "o04_topk_rank_with_ties",
    """
SELECT l_returnflag, l_quantity, l_orderkey, l_linenumber
FROM (SELECT *, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS place FROM lineitem)
WHERE place <= 3
""",
)
def topk_rank_with_ties(t):
    """Largest quantities per return flag: thousands of lines tie at the top."""
    return top_k_with_ties(t["lineitem"], 3, "l_quantity", within=["l_returnflag"]).select(
        "l_returnflag", "l_quantity", "l_orderkey", "l_linenumber"
    )


@check(
    "o05_topk_rank_then_limit",
    completed(
        """
SELECT l_partkey, CAST(sum(price) AS DOUBLE) AS revenue FROM items GROUP BY l_partkey
ORDER BY sum(price) DESC, l_partkey LIMIT 10
"""
    ),
)
def topk_rank_then_limit(t):
    """Rank at most ten, sorted by rank, cut at ten: the first ten by value."""
    revenue = t["lineitem"].groupBy("l_partkey").agg(money_sum("l_extendedprice").alias("revenue"))
    return top_n(revenue, 10, F.col("revenue").desc_nulls_last(), F.col("l_partkey"))
