"""The answers against their SQL on small random tables full of awkward rows.

Missing dimension rows, null prices, discounts and dates, equal names, repeated
parts and many ties: cases that the given tables hardly have.
"""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from salesloom.plans import ANSWERS

QUERIES, SQL = entry.queries(), entry.oracle_sql()
TYPES = {
    "key": pa.int64(),
    "int": pa.int32(),
    "num": pa.float64(),
    "str": pa.string(),
    "ts": pa.timestamp("us"),
}
OTHERS = ("events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def write(folder, name, columns, rows):
    names, kinds = zip(*(c.split() for c in columns.split(", ")), strict=True)
    arrays = [pa.array([r[i] for r in rows], TYPES[kind]) for i, kind in enumerate(kinds)]
    pq.write_table(pa.table(arrays, names=names), f"{folder}/{name}.parquet")


def make(folder, seed):
    rng = random.Random(seed)

    def maybe(value, p=0.05):
        return None if rng.random() < p else value

    def day():
        return datetime(1995, 12, 1) + timedelta(days=rng.randrange(1200))

    def price():
        return rng.choice([rng.randrange(1, 6) * 10.0, rng.randrange(100, 10_000_000) / 100])

    write(folder, "region", "r_regionkey int, r_name str", [(i, f"R{i}") for i in range(3)])
    write(
        folder,
        "nation",
        "n_nationkey int, n_name str, n_regionkey int",
        [(i, f"N{i}", rng.randrange(4)) for i in range(6)],
    )
    write(
        folder,
        "customer",
        "c_custkey key, c_name str, c_nationkey int, c_acctbal num, c_mktsegment str",
        [(i, f"C{i % 12}", maybe(rng.randrange(7)), 1.0, "S") for i in range(15)],
    )
    write(
        folder,
        "supplier",
        "s_suppkey key, s_name str, s_nationkey int, s_acctbal num",
        [(i, maybe(f"S{i % 4}"), 1, 1.0) for i in range(6)],
    )
    write(
        folder,
        "part",
        "p_partkey key, p_name str, p_brand str, p_type str, p_size int, p_retailprice num",
        [(i, f"P{i % 7}", f"Brand#{rng.randrange(1, 26)}", f"T{i % 3}", 1, 1.0) for i in range(10)],
    )
    write(
        folder,
        "orders",
        "o_orderkey key, o_custkey key, o_orderstatus str, o_totalprice num, o_orderdate ts,"
        " o_orderpriority str",
        [(i, rng.randrange(17), "O", 1.0, maybe(day()), "1") for i in range(40)],
    )
    write(
        folder,
        "lineitem",
        "l_orderkey key, l_partkey key, l_suppkey key, l_linenumber int, l_quantity num,"
        " l_extendedprice num, l_discount num, l_tax num, l_returnflag str, l_linestatus str,"
        " l_shipdate ts",
        [
            (
                rng.choice([1, rng.randrange(44)]),
                rng.randrange(12),
                rng.randrange(7),
                rng.randrange(1, 8),
                float(rng.randrange(1, 4)),
                maybe(price()),
                maybe(rng.randrange(11) / 100),
                0.0,
                "N",
                "O",
                maybe(day()),
            )
            for _ in range(rng.choice([5, 60, 250]))
        ],
    )
    for name in OTHERS:
        write(folder, name, "x int", [(1,)])


@pytest.mark.parametrize("seed", range(6))
def test_answers_match_sql(spark, tmp_path, seed):
    make(tmp_path, seed)
    connection = connect(str(tmp_path))
    problems = {
        name: compare(spark, str(tmp_path), name, QUERIES[name], SQL[name], connection)
        for name in ANSWERS
    }
    assert {name: p for name, p in problems.items() if p} == {}
