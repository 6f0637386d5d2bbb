"""The supplied test tables, completed with the columns and table they lack.

The completions are made up for testing, by whole-number formulas on keys, so
that an SQL engine can compute the same values:

- ``partsupp``: one offer for each (part, supplier) that occurs on a line;
- ``part.p_mfgr``: five makers, from the number of the brand;
- ``lineitem.l_commitdate``: the ship date moved by -30 to 30 days.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class GivenTables(Mapping):
    """Tables of one folder, by name, opened when asked for."""

    names = ("region", "nation", "customer", "supplier", "part", "partsupp", "orders", "lineitem")

    def __init__(self, spark: SparkSession, folder: str, offers: str | None = None):
        """``offers`` names a Parquet copy of the derived partsupp, if one was written."""
        self.spark, self.folder, self.offers = spark, folder.rstrip("/"), offers
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name == "partsupp":
            return self._open(self.offers) if self.offers else self._partsupp()
        frame = self.raw(name)
        if name == "part":
            return frame.withColumn("p_mfgr", _maker())
        if name == "lineitem":
            return frame.withColumn("l_commitdate", _commit_date())
        return frame

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)

    def raw(self, name: str) -> DataFrame:
        """A supplied table as it is."""
        return self._open(f"{self.folder}/{name}.parquet")

    def _open(self, path: str) -> DataFrame:
        # opening lists files and reads a footer, once per table
        if path not in self._opened:
            self._opened[path] = self.spark.read.parquet(path)
        return self._opened[path]

    def _partsupp(self) -> DataFrame:
        offer = self.raw("lineitem").select(
            F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")
        )
        return offer.distinct().select(
            "ps_partkey",
            "ps_suppkey",
            F.expr("1 + (ps_partkey * 31 + ps_suppkey * 17) % 9999").alias("ps_availqty"),
            F.expr(
                "cast((100 + (ps_partkey * 7 + ps_suppkey * 13) % 99900)"
                " * cast(0.01 as decimal(3,2)) as decimal(12,2))"
            ).alias("ps_supplycost"),
        )


def _maker():
    number = "cast(substring(p_brand, 7) as int)"
    return F.expr(f"concat('Manufacturer#', cast(1 + ({number} - 1) div 5 as string))")


def _commit_date():
    return F.expr(
        "date_add(cast(l_shipdate as date),"
        " cast((l_orderkey * 13 + l_linenumber * 7) % 61 as int) - 30)"
    )
