"""Sources, sinks and the daily run, over files made from the given tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.checks.answers import ANSWER_SQL
from salesloom.checks.landing import clear_away, land, text_lines, whole_rows
from salesloom.checks.registry import check, completed
from salesloom.functions.amounts import MONEY
from salesloom.plans.daily import run_day
from salesloom.plans.pairs import flat_pair_names
from salesloom.plans.registry import ANSWERS
from salesloom.schemas import LAYOUT, columns, enforce
from salesloom.session import fresh_folder, stored
from salesloom.sources.archives import read_lines, split_fields
from salesloom.sources.catalog import register
from salesloom.sources.given import GivenTables
from salesloom.sources.ingest import ingest, rejected_rows, source_path, typed_rows
from salesloom.sources.snapshots import (
    Staged,
    on_day,
    read_day,
    read_snapshots,
    write_snapshot,
)
from salesloom.sources.text import read_delimited

DAY, NEXT_DAY = date(2024, 9, 5), date(2024, 9, 16)


def _lines(tables: GivenTables, name: str) -> DataFrame:
    return read_lines(tables.spark, source_path(land(tables, name), name))


def _money_as_double(frame: DataFrame, table: str) -> DataFrame:
    return frame.withColumns(
        {c: F.col(c).cast("double") for c, kind in columns(table) if kind in ("money", "rate")}
    )


@check(
    "s01_zip_archive_scan",
    """
SELECT c_custkey || '|' || c_name || '||' || c_nationkey || '||'
       || CAST(c_acctbal AS DECIMAL(12,2)) || '|' || c_mktsegment || '||' AS line
FROM customer
""",
)
def zip_archive_scan(tables):
    return _lines(tables, "customer")


@check(
    "s02_line_split_flatten",
    """
SELECT 10 AS n_fields, CAST(p_partkey AS VARCHAR) AS first_field, p_name AS second_field,
       p_type AS fifth_field, '' AS last_field
FROM part
""",
)
def line_split_flatten(tables):
    return split_fields(_lines(tables, "part")).select(
        F.size("fields").alias("n_fields"),
        F.get("fields", 0).alias("first_field"),
        F.get("fields", 1).alias("second_field"),
        F.get("fields", 4).alias("fifth_field"),
        F.get("fields", 9).alias("last_field"),
    )


@check(
    "s03_typed_row_mapping",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate, '' AS l_comment
FROM lineitem
""",
)
def typed_row_mapping(tables):
    rows = typed_rows(split_fields(_lines(tables, "lineitem")), "lineitem")
    return _money_as_double(rows, "lineitem").drop(
        "l_commitdate", "l_receiptdate", "l_shipinstruct", "l_shipmode"
    )


@check(
    "s03_amounts_kept_or_refused",
    """
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber % 4 WHEN 0 THEN NULL
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,4)) + CASE l_linenumber % 4
              WHEN 1 THEN 0.005 WHEN 2 THEN 12345678901.0 ELSE 0 END AS DOUBLE) END AS price,
       CASE l_linenumber % 4 WHEN 3 THEN 250.0 ELSE l_discount END AS discount,
       CASE l_linenumber % 4 WHEN 0 THEN 'l_extendedprice'
         WHEN 1 THEN 'l_shipdate' ELSE '' END AS refused
FROM lineitem
""",
)
def amounts_kept_or_refused(tables):
    """Amounts with more decimals, more digits and rates above 100; some that nothing can hold, bad dates."""
    lines = text_lines(whole_rows(tables, "lineitem"), "lineitem")
    lines = lines.select(F.split("value", r"\|").alias("given"))
    fields = F.col("given")
    case = F.get(fields, 3).cast("int") % 4
    price = F.when(case == 0, F.concat(F.get(fields, 5), F.lit("00001"))).when(
        case == 1, (F.get(fields, 5).cast(MONEY) + F.lit("0.0050").cast(MONEY)).cast("string")
    ).when(case == 2, (F.get(fields, 5).cast(MONEY) + F.lit("12345678901").cast(MONEY)).cast("string"))
    changed = {
        5: F.coalesce(price, F.get(fields, 5)),
        6: F.when(case == 3, F.lit("250")).otherwise(F.get(fields, 6)),
        10: F.when(case == 1, F.lit("1997-13-01")).otherwise(F.get(fields, 10)),
    }
    # stored field by field, so that each reader below reads the fields it uses
    names = [name for name, _ in columns("lineitem")]
    rows = stored(lines.select(*[changed.get(i, F.get(fields, i)).alias(n) for i, n in enumerate(names)]), "fields")
    rows = rows.select(F.array(*names).alias("fields"))
    loose = typed_rows(rows, "lineitem", strict=False).select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("double").alias("price"),
        F.col("l_discount").cast("double").alias("discount"),
    )
    refused = rejected_rows(rows, "lineitem").select(
        F.get("fields", 0).cast("bigint").alias("order_"), F.get("fields", 3).cast("int").alias("line_"),
        F.array_join("refused", ",").alias("refused"),
    ).distinct()
    same = (F.col("l_orderkey") == F.col("order_")) & (F.col("l_linenumber") == F.col("line_"))
    return loose.join(refused, same, "left").select(
        "l_orderkey", "l_linenumber", "price", "discount", F.coalesce("refused", F.lit("")).alias("refused")
    )


@check(
    "s04_schema_enforcement",
    """
SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS s_address,
       CAST(s_nationkey AS BIGINT) AS s_nationkey, CAST(NULL AS VARCHAR) AS s_phone, s_acctbal,
       CAST(NULL AS VARCHAR) AS s_comment
FROM supplier
""",
)
def schema_enforcement(tables):
    return _money_as_double(enforce(tables["supplier"], "supplier", fill_missing=True), "supplier")


@check(
    "s05_delimited_text_scan",
    """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
       CAST(n_regionkey AS BIGINT) AS n_regionkey, CAST(NULL AS VARCHAR) AS n_comment
FROM nation
""",
)
def delimited_text_scan(tables):
    folder = land(tables, "nation")
    return read_delimited(tables.spark, source_path(folder, "nation"), "nation")


def _two_days(tables: GivenTables, name: str) -> str:
    """A root with two dates of one table, the first written twice."""
    root = fresh_folder(tables.spark, "snapshots")
    for day in (DAY, NEXT_DAY, DAY):
        write_snapshot(whole_rows(tables, name), root, name, day)
    return root


@check(
    "s06_partitioned_parquet_write",
    """
SELECT 2024 AS "year", 9 AS "month", d AS "day", count(*) AS n_rows,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM orders, (VALUES (5), (16)) AS days(d) GROUP BY d
""",
)
def partitioned_parquet_write(tables):
    root = _two_days(tables, "orders")
    return (
        read_snapshots(tables.spark, root, "orders")
        .groupBy("year", "month", "day")
        .agg(F.count("*").alias("n_rows"), F.sum("o_totalprice").cast("double").alias("total"))
    )


@check(
    "s07_partition_discovery_scan",
    """
SELECT p_partkey, p_name, 2024 AS "year", 9 AS "month", d AS "day"
FROM part, (VALUES (5), (16)) AS days(d)
""",
)
def partition_discovery_scan(tables):
    root = _two_days(tables, "part")
    return read_snapshots(tables.spark, root, "part").select(
        "p_partkey", "p_name", "year", "month", "day"
    )


@check(
    "s08_partition_slice",
    """
SELECT s_suppkey, s_name, s_acctbal FROM supplier
""",
)
def partition_slice(tables):
    root = _two_days(tables, "supplier")
    rows = on_day(read_snapshots(tables.spark, root, "supplier"), NEXT_DAY)
    return _money_as_double(rows, "supplier").select("s_suppkey", "s_name", "s_acctbal")


@check("s09_result_sink", ANSWER_SQL["q10_chg_supp_perf"])
def result_sink(tables):
    name, results = "q10_chg_supp_perf", fresh_folder(tables.spark, "results")
    write_snapshot(ANSWERS[name](tables), results, name, DAY)
    return read_day(tables.spark, results, name, DAY)


#: Text columns of the given tables, whose content is compared after ingest.
TEXTS = {
    "region": "r_name",
    "nation": "n_name",
    "customer": "c_name c_mktsegment",
    "supplier": "s_name",
    "part": "p_name p_brand p_type",
    "partsupp": "",
    "orders": "o_orderstatus o_orderpriority",
    "lineitem": "l_returnflag l_linestatus",
}
MONEYS = {
    "customer": "c_acctbal",
    "supplier": "s_acctbal",
    "part": "p_retailprice",
    "partsupp": "ps_supplycost",
    "orders": "o_totalprice",
    "lineitem": "l_quantity l_extendedprice l_discount l_tax",
}
DATES = {"orders": "o_orderdate", "lineitem": "l_shipdate"}


def _text_sum_sql(texts: list[str]) -> str:
    """Sum over all rows of 32 bits of a hash of some texts."""
    whole = " || '|' || ".join(f"coalesce({c}, '')" for c in texts) or "''"
    return f"CAST(sum(CAST('0x' || substr(md5({whole}), 1, 8) AS BIGINT)) AS BIGINT)"


def _contents_sql(table: str) -> str:
    key = columns(table)[0][0]
    money = " + ".join(f"sum(CAST({c} AS DECIMAL(18,2)))" for c in MONEYS.get(table, "").split())
    days = f"sum(CAST({DATES[table]} AS DATE) - DATE '1970-01-01')" if table in DATES else "0"
    return f"""
SELECT '{table}' AS name, count(*) AS n_rows, CAST(sum({key}) AS BIGINT) AS keys,
       CAST({money or "0"} AS DOUBLE) AS money, CAST({days} AS BIGINT) AS days,
       {_text_sum_sql(TEXTS[table].split())} AS texts
FROM {"offers" if table == "partsupp" else table}"""


def _text_sum(texts: list[str]) -> Column:
    whole = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in texts]) if texts else F.lit("")
    return F.sum(F.conv(F.substring(F.md5(whole), 1, 8), 16, 10).cast("bigint"))


def _contents(tables, table: str) -> DataFrame:
    """What a staged table holds, as sums that a lost or altered value changes."""
    money = [F.sum(F.col(c).cast("decimal(22,4)")) for c in MONEYS.get(table, "").split()]
    days = F.sum(F.datediff(F.col(DATES[table]), F.lit("1970-01-01"))) if table in DATES else F.lit(0)
    return tables[table].agg(
        F.lit(table).alias("name"),
        F.count("*").alias("n_rows"),
        F.sum(columns(table)[0][0]).alias("keys"),
        sum(money[1:], money[0]).cast("double").alias("money") if money else F.lit(0.0).alias("money"),
        days.cast("bigint").alias("days"),
        _text_sum(TEXTS[table].split()).alias("texts"),
    )


@check("s10_ingest_job", completed("\nUNION ALL\n".join(map(_contents_sql, LAYOUT))))
def ingest_job(tables):
    staging = fresh_folder(tables.spark, "staging")
    ingest(tables.spark, land(tables), staging, DAY)
    staged = Staged(tables.spark, staging, DAY)
    return reduce(DataFrame.unionByName, [_contents(staged, name) for name in LAYOUT])


def _cells_sql(name: str, kinds: dict[str, str]) -> str:
    """Each column of an answer as one row: how many values, their sum, the sum of their hashes."""
    return "\nUNION ALL\n".join(
        f"""
SELECT '{name}' AS answer, '{column}' AS col, count(*) AS n_rows, count("{column}") AS n_values,
       {f'CAST(sum(CAST(floor(CAST("{column}" AS DOUBLE) * 1000) AS BIGINT)) AS BIGINT)' if kind != "text" else "CAST(0 AS BIGINT)"} AS thousandths,
       {_text_sum_sql([f'"{column}"']) if kind == "text" else "CAST(0 AS BIGINT)"} AS texts
FROM {name}"""
        for column, kind in kinds.items()
    )


def _cells(frame: DataFrame, name: str) -> DataFrame:
    """The same from what was written, read once: one aggregate over all columns, then a row for each."""
    sums = []
    for column, kind in frame.dtypes:
        text = kind == "string"
        total = F.sum(F.floor(F.col(column).cast("double") * 1000))
        cell = F.struct(
            F.lit(name).alias("answer"),
            F.lit(column).alias("col"),
            F.count("*").alias("n_rows"),
            F.count(column).alias("n_values"),
            (F.lit(0).cast("bigint") if text else total).alias("thousandths"),
            (_text_sum([column]) if text else F.lit(0).cast("bigint")).alias("texts"),
        )
        sums.append(cell)
    return frame.agg(F.array(*sums).alias("cells")).select(F.inline("cells"))


# The columns of each answer; text, or a number.
ANSWER_COLUMNS = {
    "q01_most_profit_prods": (
        "P_NAME text, P_MFGR text, TOTAL_REVENUE_GENERATED num, TOTAL_COST num, TOTAL_PROFIT num,"
        " PROFIT_MARGIN_PCT num"
    ),
    "q02_sales_per_by_region": (
        "REGION text, YEAR num, MONTH_YEAR text, MONTHLY_REVENUE num, ANNUAL_REVENUE num,"
        " YEAR_OVER_YEAR_GROWTH_PERCENT num"
    ),
    "q03_delay_ords_pct_by_cust": "C_NAME text, AVG_DELAY_DAYS num, PCT_DELAYED_ORDERS num",
    "q04_top_supp_by_prod_cat": (
        "CATEGORY text, SUPPLIER_NAME text, TOT_PARTS_SUPPLIED num, PCT_TOT_SUPPLIED num"
    ),
    "q05_disc_on_sales": (
        "CATEGORY text, TOTAL_REVENUE num, TOTAL_DISCOUNT_REVENUE num, AVG_DISCOUNT_PCT num"
    ),
    "q06_cust_behavior": (
        "CUSTOMER_NAME text, 1996 num, PY_ORDERS_PLACED num, CY_ORDERS_PLACED num,"
        " PCT_CHG_IN_ORDERS num"
    ),
    "q07_effect_mkt_campaigns": "PRODUCT text, MKT_CAMPAIGN num, TOTAL_REVENUE num",
    "q08_most_profit_pairs": (
        "ORDERKEY num, P_NAME_1 text, P_NAME_2 text, PAIR_PROFIT num, TOTAL_REVENUE num,"
        " PCT_PAIR_PROFIT num"
    ),
    "q09_sale_lead_time": "S_SUPPKEY num, SUPPLIER text, TOTAL_REVENUE num, AVG_LEAD_TIME num",
    "q10_chg_supp_perf": (
        "SUPPLIER_NAME text, PY_SHIPPED_PARTS num, CY_SHIPPED_PARTS num, PCT_CHG_IN_ORDERS num"
    ),
}


def _daily_sql() -> str:
    kinds = {
        name: dict(part.split() for part in text.split(", ")) for name, text in ANSWER_COLUMNS.items()
    }
    answers = ",\n".join(f"{name} AS (\n{ANSWER_SQL[name]}\n)" for name in kinds)
    return f"WITH {answers}\n" + "\nUNION ALL\n".join(_cells_sql(n, k) for n, k in kinds.items())


@check("s11_daily_run", _daily_sql())
def daily_run(tables):
    """Every column of every answer, summed up from what a whole run wrote.

    The source files were made for this run; those of a table go once it is staged.
    """
    staging, results = (fresh_folder(tables.spark, label) for label in ("staging", "results"))
    source = land(tables)
    outcomes = run_day(
        tables.spark, source, staging, results, DAY, done=lambda table: clear_away(tables, source, table)
    )
    failed = [f"{o.answer}: {o.error}" for o in outcomes if o.error]
    if failed:
        raise RuntimeError("; ".join(failed))
    written = {o.answer: tables.spark.read.parquet(o.path) for o in outcomes}
    flat = {n: flat_pair_names(f) if "PART_NAMES" in f.columns else f for n, f in written.items()}
    return reduce(DataFrame.unionByName, [_cells(frame, name) for name, frame in flat.items()])


@check(
    "s12_catalog_registration",
    """
SELECT 2024 AS "year", 9 AS "month", d AS "day", c_mktsegment, count(*) AS n_rows
FROM customer, (VALUES (5), (16)) AS days(d) GROUP BY d, c_mktsegment
""",
)
def catalog_registration(tables):
    root = _two_days(tables, "customer")
    database = "sales_" + root.rsplit("-", 1)[-1]
    (table,) = register(tables.spark, root, ["customer"], database, DAY)
    return tables.spark.sql(
        "SELECT year, month, day, c_mktsegment, count(*) AS n_rows"
        f" FROM {table} GROUP BY year, month, day, c_mktsegment"
    )
