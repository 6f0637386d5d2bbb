"""The corpus tables, and joins that stand a frequent key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.session import stored

SALTS = 16


def corpus_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, so that no other column can clash; null text is empty."""
    return docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )


def salt_of(column: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")


def join_salted(
    rows: DataFrame, lookup: DataFrame, key: str, spread: str, how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join ``lookup``, unique by ``key``, to rows of which any share may have one key.

    The rows of a key are dealt over ``salts`` groups by the column ``spread``,
    and the lookup row is repeated for each, so no key has one task to itself.
    """
    dealt = rows.withColumn("_salt", salt_of(F.col(spread), salts))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [key, "_salt"], how).drop("_salt")


def sums_before(rows: DataFrame, order: list[Column], **numbers: Column) -> DataFrame:
    """Rows with, for each number, its sum over all rows that come before in an order.

    Rows are sorted in range partitions; only the totals of these, one row a
    partition, are gathered. ``order`` tells all rows apart.
    """
    ranges = rows.withColumns({f"_{name}": number for name, number in numbers.items()})
    ranges = stored(ranges.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    totals = ranges.groupBy("_part").agg(*[F.sum(f"_{name}") for name in numbers]).collect()
    starts, before = [], [0.0] * len(numbers)
    for part, *sums in sorted(totals):
        starts.append((part, *before))
        before = [a + b for a, b in zip(before, sums, strict=True)]
    layout = ", ".join(["_part int", *[f"_start_{name} double" for name in numbers]])
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, layout))
    earlier = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = {name: F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)) for name in numbers}
    found = ranges.withColumns({f"_in_{name}": column for name, column in inside.items()}).join(starts, "_part")
    return found.select(
        *rows.columns, *[(F.col(f"_start_{name}") + F.col(f"_in_{name}")).alias(name) for name in numbers]
    )
