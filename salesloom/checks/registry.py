"""Collects the registered queries of all families."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from salesloom.sources.given import GivenTables


@dataclass(frozen=True)
class Check:
    run: Callable[[GivenTables], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None):
    """Register a query over the given tables, with SQL for the same rows."""

    def add(run: Callable[[GivenTables], DataFrame]):
        CHECKS[name] = Check(run, sql)
        return run

    return add


# The completions of salesloom.sources.given, in SQL.
COMPLETED = """
offers AS (
  SELECT ps_partkey, ps_suppkey,
         1 + (ps_partkey * 31 + ps_suppkey * 17) % 9999 AS ps_availqty,
         CAST(CAST((100 + (ps_partkey * 7 + ps_suppkey * 13) % 99900) AS DECIMAL(12,2))
              * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS ps_supplycost
  FROM (SELECT DISTINCT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey FROM lineitem)
),
parts AS (
  SELECT *, 'Manufacturer#' || CAST(1 + (CAST(substring(p_brand, 7) AS INTEGER) - 1) // 5 AS VARCHAR)
            AS p_mfgr
  FROM part
),
items AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l_discount AS DECIMAL(4,2)) AS discount,
         CAST(l_shipdate AS DATE) AS shipped,
         CAST(l_shipdate AS DATE)
           + CAST((l_orderkey * 13 + l_linenumber * 7) % 61 - 30 AS INTEGER) AS l_commitdate
  FROM lineitem
)
"""


def completed(select: str, steps: str = "") -> str:
    """SQL over offers, parts and items; ``steps`` are further WITH entries."""
    return f"WITH {COMPLETED.strip()}{', ' + steps.strip() if steps else ''}\n{select.strip()}"
