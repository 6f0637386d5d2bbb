"""Archives, text, snapshots, catalog and the daily run."""

from __future__ import annotations

import shutil
import time
import zipfile
from datetime import date
from decimal import Decimal
from hashlib import md5
from pathlib import Path
from threading import Barrier
from types import SimpleNamespace

import pyarrow as pa
import pytest
from conftest import plan, table
from pyspark.sql import functions as F

import salesloom.checks.landing as checks_landing
import salesloom.plans.daily as daily
import salesloom.plans.sold as sold_base
from salesloom.checks.landing import clear_away, land, whole_rows
from salesloom.checks.sources import _cells, amounts_kept_or_refused
from salesloom.functions.dates import date_text, parse_date
from salesloom.operators.joining import planned_bytes
from salesloom.plans import ANSWERS, Answer
from salesloom.plans.products import campaign_revenue
from salesloom.plans.sold import sold_offers, stored_by_part
from salesloom.schemas import LAYOUT, columns, enforce, schema
from salesloom.session import fresh_folder, little_disk, shared_folder, stored
from salesloom.sources import archives
from salesloom.sources.archives import list_members, read_lines, split_fields
from salesloom.sources.catalog import register
from salesloom.sources.given import GivenTables
from salesloom.sources.ingest import (
    Refused,
    ingest,
    missing_sources,
    read_source,
    rejected_rows,
    source_path,
    typed_rows,
)
from salesloom.sources.snapshots import (
    Staged,
    commit,
    draft,
    on_day,
    read_day,
    read_snapshots,
    snapshot_path,
    write_snapshot,
)
from salesloom.sources.text import read_delimited

DAY, OTHER = date(2024, 9, 5), date(2024, 10, 12)
GIVEN = "/root/testdata/sf0.001"


def zipped(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return str(path)


def lines(spark, path):
    return sorted(r.line for r in read_lines(spark, path).collect())


class TestArchives:
    def test_members_blank_lines_and_closing_pipes(self, spark, tmp_path):
        path = zipped(tmp_path / "a.zip", one="1|a|2.50|\n\n2|b|3.75|\n", two="3|c||")
        assert lines(spark, path) == ["1|a|2.50|", "2|b|3.75|", "3|c||"]
        fields = {tuple(r.fields) for r in split_fields(read_lines(spark, path)).collect()}
        assert ("3", "c", "", "") in fields

    def test_folder_of_archives(self, spark, tmp_path):
        for i in range(5):
            zipped(tmp_path / f"{i}.zip", rows=f"{i}|\n")
        assert lines(spark, str(tmp_path)) == [f"{i}|" for i in range(5)]
        assert list_members(spark, str(tmp_path / "[12].zip")).count() == 2

    def test_a_member_larger_than_many_pieces(self, spark, tmp_path):
        text = "".join(f"{i}|žlutý kůň {'x' * (i % 700)}|\r\n" for i in range(12_000))
        path = zipped(tmp_path / "big.zip", rows=text)
        assert len(text) > 3 * archives.PIECE
        assert lines(spark, path) == sorted(text.splitlines())

    @pytest.mark.parametrize("size", [1, 2, 5, 7])
    def test_pieces_may_end_anywhere(self, size):
        class Slow:
            def __init__(self, data):
                self.data = data

            def read(self, _):
                head, self.data = self.data[:size], self.data[size:]
                return head

        text = "a|é|\r\n\nb|\u2028c\rd\x0b\x85e\nlast"
        blocks = [block for block, broken in archives._whole_lines(Slow(text.encode())) if not broken]
        assert all(block.endswith("\n") for block in blocks[:-1])
        found = [line for block in blocks for line in block.split("\n")]
        assert [x for x in found if x] == [x for x in text.splitlines() if x]

    def test_every_kind_of_line_end(self, spark, tmp_path):
        text = "".join(f"{i}|{end}" for i, end in enumerate("\n" + archives.OTHER_LINE_ENDS)) + "last\r\n"
        path = zipped(tmp_path / "a.zip", rows=text)
        assert lines(spark, path) == sorted(text.splitlines())

    def test_bad_utf8_is_an_error(self, spark, tmp_path):
        path = zipped(tmp_path / "bad.zip", rows=b"1|\xff\xfe|\n")
        with pytest.raises(Exception, match="not utf-8: .*bad.zip rows 1"):
            read_lines(spark, path).collect()

    @pytest.mark.parametrize("size", [1, 2, 3, 5, 64])
    def test_bad_bytes_mark_their_line_wherever_pieces_end(self, size, monkeypatch):
        class Slow:
            def __init__(self, data):
                self.data = data

            def read(self, _):
                head, self.data = self.data[:size], self.data[size:]
                return head

        text = "1|é|\r\n".encode() + b"2|\xff\xfe|\n\n3|\xc3|\r" + "4|\u20ac|\n".encode() + b"5|\xe2\x82\n6|z|\n7|\xe2"
        found = []
        for block, broken in archives._whole_lines(Slow(text)):
            found += [(line, i in broken) for i, line in enumerate(block.removesuffix("\n").split("\n"))]
        assert [(line[0], broken) for line, broken in found if line] == [
            ("1", False), ("2", True), ("3", True), ("4", False), ("5", True), ("6", False), ("7", True)
        ]
        assert found[2][0] == "" and found[4][0] == "4|\u20ac|"
        assert all((archives.BAD_BYTE in line) == broken for line, broken in found)

    def test_lines_know_where_they_stand(self, spark, tmp_path):
        text = "".join(f"{i}|\r\n" if i % 5 else "\n" for i in range(1, 200_001))
        zipped(tmp_path / "a.zip", one=text, two="x|\n\ny|")
        rows = archives.read_numbered_lines(spark, str(tmp_path)).collect()
        assert {(r.number, r.line) for r in rows if r.member == "one"} == {(i, f"{i}|") for i in range(1, 200_001) if i % 5}
        assert [(r.number, r.line) for r in rows if r.member == "two"] == [(1, "x|"), (3, "y|")]
        assert all(r.archive.endswith("/a.zip") and r.broken is False for r in rows)

    def test_listing_does_not_read_contents(self, spark, tmp_path):
        path = zipped(tmp_path / "a.zip", rows="1|\n")
        text = plan(spark.read.format("binaryFile").load(path).select("path"))
        assert "ReadSchema: struct<path:string>" in text

    def test_names_with_odd_characters(self, spark, tmp_path):
        path = zipped(tmp_path / "a b#1%20.zip", rows="1|\n")
        assert lines(spark, str(tmp_path)) == ["1|"] and path


class TestTyping:
    def fields(self, spark, *texts):
        return split_fields(table(spark, "line string", *[(t,) for t in texts]))

    def test_types_and_empty_text(self, spark):
        rows = typed_rows(self.fields(spark, "1|2|30|4.50||"), "partsupp")
        assert rows.schema == schema("partsupp")
        assert rows.selectExpr("ps_availqty", "cast(ps_supplycost as string)", "ps_comment").first() == (30, "4.5000", "")

    @pytest.mark.parametrize("bad", ["1|2|x|4.50||", "1|2||4.50||", "1|2|3", "1|2|3|4.x|c"])
    def test_bad_rows(self, spark, bad):
        fields = self.fields(spark, "1|2|30|4.50|c|", bad)
        with pytest.raises(Exception, match="bad value"):
            typed_rows(fields, "partsupp").collect()
        assert typed_rows(fields, "partsupp", strict=False).count() == 2
        assert [r.fields for r in rejected_rows(fields, "partsupp").collect()] == [bad.split("|")]

    def test_strict_does_not_depend_on_ansi_mode(self, spark):
        spark.conf.set("spark.sql.ansi.enabled", "false")
        try:
            with pytest.raises(Exception, match="bad value"):
                typed_rows(self.fields(spark, "1|2|x|4.50||"), "partsupp").collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")

    def test_a_bad_date_is_null_and_kept_as_text_elsewhere(self, spark):
        row, empty = "1|2|O|3.50|1997-13-01|p|c|0|text|", "1|2|O|3.50||p|c|0|text|"
        assert typed_rows(self.fields(spark, row), "orders").first().o_orderdate is None
        assert [r.refused for r in rejected_rows(self.fields(spark, row, empty), "orders").collect()] == [["o_orderdate"]]

    @pytest.mark.parametrize("amount", ["2.675", "12345678901.00", "250", "-0.0001", "4.50000000", "00012.5", " 7 ", "1e3", "1.25E+02"])
    def test_amounts_are_kept_exactly(self, spark, amount):
        row = typed_rows(self.fields(spark, f"1|2|30|{amount}|c|"), "partsupp").first()
        assert row.ps_supplycost == Decimal(amount.strip())

    @pytest.mark.parametrize("amount", ["2.67501", "123456789012345.00", "1e-3", "1e15", "", "1,5", "NaN", "."])
    def test_amounts_that_do_not_fit_are_refused(self, spark, amount):
        fields = self.fields(spark, f"1|2|30|{amount}|c|")
        with pytest.raises(Exception, match="bad value"):
            typed_rows(fields, "partsupp").collect()
        assert typed_rows(fields, "partsupp", strict=False).first().ps_supplycost is None
        assert rejected_rows(fields, "partsupp").first().refused == ["ps_supplycost"]

    def test_enforce_does_not_alter_amounts(self, spark):
        given = table(spark, "ps_partkey int, ps_suppkey int, ps_availqty int, ps_supplycost double, ps_comment string", (1, 2, 3, 2.675, "c"))
        assert enforce(given, "partsupp").first().ps_supplycost == Decimal("2.675")
        with pytest.raises(Exception, match="bad value"):
            enforce(given.withColumn("ps_supplycost", F.lit(2.67555)), "partsupp").collect()

    def test_plain_text_keeps_quotes_and_ignores_the_closing_pipe(self, spark, tmp_path):
        path = tmp_path / "nation.tbl"
        path.write_text('1|A|2|c|\n2|"BR|3|zz|\n3|C|4||\n')
        assert [tuple(r) for r in read_delimited(spark, str(path), "nation").collect()] == [
            (1, "A", 2, "c"),
            (2, '"BR', 3, "zz"),
            (3, "C", 4, None),
        ]

    def test_enforce_orders_and_casts(self, spark):
        given = table(spark, "R_NAME string, r_comment string, R_REGIONKEY int, x int", ("E", "c", 1, 5))
        assert enforce(given, "region").schema == schema("region")
        with pytest.raises(ValueError, match="r_comment"):
            enforce(given.drop("r_comment"), "region")


class TestSnapshots:
    def test_dates_are_separate_and_prune(self, spark, tmp_path):
        root = f"{tmp_path}/"
        write_snapshot(spark.range(3), root, "t", DAY)
        write_snapshot(spark.range(4), root, "t", OTHER)
        write_snapshot(spark.range(5), root, "t", DAY)
        every = read_snapshots(spark, root, "t")
        assert on_day(every, DAY).count() == 5
        assert on_day(every, OTHER).count() == 4
        assert on_day(every, date(2020, 1, 1)).count() == 0
        assert on_day(every, DAY).columns == ["id"]
        assert "PartitionFilters: [isnotnull(year" in plan(on_day(every, DAY))
        assert snapshot_path(root, "t", DAY).endswith("/t/year=2024/month=09/day=05")
        assert read_day(spark, root, "t", OTHER).count() == 4


    def test_a_write_that_fails_leaves_the_old_day(self, spark, tmp_path):
        root = str(tmp_path)
        write_snapshot(spark.range(3), root, "t", DAY)
        bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error("no").cast("long")).otherwise(F.col("id")).alias("id"))
        with pytest.raises(Exception, match="no"):
            write_snapshot(bad, root, "t", DAY)
        assert read_day(spark, root, "t", DAY).count() == 3
        assert [p.name for p in (tmp_path / "_drafts").iterdir()] == []

    def test_a_reader_during_a_write_sees_the_old_day(self, spark, tmp_path):
        root = str(tmp_path)
        write_snapshot(spark.range(3), root, "t", DAY)
        with draft(spark, root, "t") as folder:
            spark.range(8).write.parquet(folder)
            assert read_day(spark, root, "t", DAY).count() == 3
            assert read_snapshots(spark, root, "t").count() == 3
            commit(spark, folder, root, "t", DAY)
        assert read_day(spark, root, "t", DAY).count() == 8

    def test_what_cannot_take_its_place_does_not_cost_the_old_day(self, spark, tmp_path):
        root = str(tmp_path)
        write_snapshot(spark.range(3), root, "t", DAY)
        with pytest.raises(FileNotFoundError):
            commit(spark, f"{root}/_drafts/never-written", root, "t", DAY)
        assert read_day(spark, root, "t", DAY).count() == 3


class TestCatalog:
    def test_a_column_called_year_keeps_its_values(self, spark, tmp_path):
        root = str(tmp_path / "results")
        for day, year in ((DAY, 1997), (OTHER, 1998)):
            write_snapshot(table(spark, "YEAR int, x int", (year, 1)), root, "t", day)
            register(spark, root, ["t"], "sales_year_test", day)
        found = spark.sql("SELECT YEAR, load_year, load_month, load_day FROM sales_year_test.t")
        assert sorted(map(tuple, found.collect())) == [(1997, 2024, 9, 5), (1998, 2024, 10, 12)]

    def test_a_query_on_one_date_lists_one_folder(self, spark, tmp_path):
        root = str(tmp_path / "results")
        for day, year in ((DAY, 1997), (OTHER, 1998)):
            write_snapshot(table(spark, "YEAR int, x int", (year, 1)), root, "t", day)
            register(spark, root, ["t"], "sales_prune_test", day)
        shutil.rmtree(snapshot_path(root, "t", OTHER))  # a date that is not asked for is not looked at
        found = spark.sql("SELECT YEAR, x FROM sales_prune_test.t WHERE load_year = 2024 AND load_month = 9 AND load_day = 5")
        assert [tuple(r) for r in found.collect()] == [(1997, 1)]
        assert "PartitionFilters: [isnotnull(load_year" in plan(found)
        assert all("/month=09/day=05/" in file for file in found.inputFiles())

    def test_columns_may_be_added_and_widened(self, spark, tmp_path):
        root, third = str(tmp_path / "staging"), date(2024, 11, 1)
        write_snapshot(table(spark, "a int, d decimal(9,2)", (1, Decimal("1.25"))), root, "t", DAY)
        register(spark, root, ["t"], "sales_change_test", DAY)
        write_snapshot(table(spark, "a int, d decimal(9,2), b string", (2, Decimal("2.50"), "x")), root, "t", OTHER)
        register(spark, root, ["t"], "sales_change_test", OTHER)
        rows = spark.sql("SELECT a, d, b, day FROM sales_change_test.t ORDER BY a").collect()
        assert [tuple(r) for r in rows] == [(1, Decimal("1.25"), None, 5), (2, Decimal("2.50"), "x", 12)]
        write_snapshot(table(spark, "b string, a bigint, d decimal(18,4)", ("y", 2**40, Decimal("3.1234"))), root, "t", third)
        register(spark, root, ["t"], "sales_change_test", third)
        rows = spark.sql("SELECT a, d, b FROM sales_change_test.t ORDER BY a").collect()
        assert [tuple(r) for r in rows] == [
            (1, Decimal("1.2500"), None), (2, Decimal("2.5000"), "x"), (2**40, Decimal("3.1234"), "y")
        ]
        # an earlier date written again, with the narrow type, changes nothing in the table's layout
        write_snapshot(table(spark, "a int, d decimal(9,2)", (5, Decimal("1.25"))), root, "t", DAY)
        register(spark, root, ["t"], "sales_change_test", DAY)
        assert spark.table("sales_change_test.t").schema["a"].dataType.simpleString() == "bigint"
        assert spark.sql("SELECT sum(a) FROM sales_change_test.t").first()[0] == 5 + 2 + 2**40

    def test_a_declared_column_that_no_file_has_is_null(self, spark, tmp_path):
        root = str(tmp_path / "staging")
        write_snapshot(table(spark, "r_regionkey bigint, r_name string", (1, "E")), root, "region", DAY)
        register(spark, root, ["region"], "sales_declared_test", DAY, {"region": schema("region")})
        assert [tuple(r) for r in spark.sql("SELECT r_name, r_comment FROM sales_declared_test.region").collect()] == [("E", None)]

    def test_types_that_do_not_fit_are_an_error(self, spark, tmp_path):
        root = str(tmp_path / "staging")
        write_snapshot(table(spark, "a int", (1,)), root, "t", DAY)
        register(spark, root, ["t"], "sales_misfit_test", DAY)
        write_snapshot(table(spark, "a string", ("x",)), root, "t", OTHER)
        with pytest.raises(ValueError, match="t.a is int and string"):
            register(spark, root, ["t"], "sales_misfit_test", OTHER)
        assert spark.sql("SELECT a FROM sales_misfit_test.t").first()[0] == 1

    def test_a_table_in_another_folder_is_replaced(self, spark, tmp_path):
        for n, root in ((3, str(tmp_path / "a")), (4, str(tmp_path / "b"))):
            write_snapshot(spark.range(n), root, "t", DAY)
            register(spark, root, ["t"], "sales_moved_test", DAY)
            assert spark.table("sales_moved_test.t").count() == n
        write_snapshot(table(spark, "year int", (1,)), str(tmp_path / "c"), "t", DAY)
        for root, n in (("c", 1), ("a", 3)):  # to a view and back
            register(spark, str(tmp_path / root), ["t"], "sales_moved_test", DAY)
            assert spark.table("sales_moved_test.t").count() == n

    def test_the_database_lies_apart_from_the_snapshots(self, spark, tmp_path):
        write_snapshot(spark.range(3), str(tmp_path), "t", DAY)
        register(spark, str(tmp_path), ["t"], "sales_place_test", DAY)
        assert str(tmp_path) not in spark.catalog.getDatabase("sales_place_test").locationUri

    def test_new_dates_and_rewritten_dates_show(self, spark, tmp_path):
        root = str(tmp_path / "staging")
        write_snapshot(spark.range(3), root, "t", DAY)
        assert register(spark, root, ["t"], "sales_test", DAY) == ["`sales_test`.`t`"]
        assert spark.table("sales_test.t").count() == 3
        write_snapshot(spark.range(4), root, "t", OTHER)
        write_snapshot(spark.range(2), root, "t", DAY)
        register(spark, root, ["t"], "sales_test", OTHER)
        assert spark.sql("SELECT count(*) FROM sales_test.t WHERE day = 5").first()[0] == 2
        assert spark.table("sales_test.t").count() == 6


@pytest.fixture(scope="module")
def landing(spark):
    return land(GivenTables(spark, GIVEN))


class TestIngest:
    def test_round_trip_of_all_tables(self, spark, landing, tmp_path):
        paths = ingest(spark, landing, str(tmp_path), DAY)
        assert set(paths) == set(LAYOUT)
        staged, given = Staged(spark, str(tmp_path), DAY), GivenTables(spark, GIVEN)
        for name in LAYOUT:
            before, after = whole_rows(given, name), staged[name]
            if name in ("region", "nation"):  # the text reader takes empty text as null
                after = after.fillna("")
            assert after.exceptAll(before).isEmpty() and before.exceptAll(after).isEmpty(), name

    def test_parsing_a_large_member_is_shared(self, spark, landing, tmp_path):
        text = "1|2|30|4.50|some words about it|\n" * 500_000
        zipped(tmp_path / "partsupp.tbl.zip", rows=text)
        frame = read_source(spark, str(tmp_path), "partsupp")
        assert frame.rdd.getNumPartitions() == 4  # 16 MB, four for each task
        assert frame.count() == 500_000
        assert read_source(spark, landing, "customer").rdd.getNumPartitions() == 1

    def test_members_are_dealt_one_to_a_task(self, spark, tmp_path):
        for i in range(16):
            zipped(tmp_path / f"{i}.zip", **{f"m{j}": f"{i}|{j}|\n" * (i * j + 1) for j in range(4)})
        members = archives.list_members(spark, str(tmp_path))
        sizes = archives.dealt(members, 64).rdd.glom().map(len).collect()
        assert sizes == [1] * 64
        loads = archives.dealt(members, 8).rdd.glom().map(lambda rows: (len(rows), sum(r["size"] for r in rows))).collect()
        assert {n for n, _ in loads} == {8}
        assert max(s for _, s in loads) < 1.3 * min(s for _, s in loads)
        assert read_lines(spark, str(tmp_path)).rdd.getNumPartitions() == 64

    def test_small_members_share_a_task(self, spark, tmp_path):
        for i in range(25):
            zipped(tmp_path / f"{i}.zip", **{f"m{j}": f"{i}|{j}|\n" for j in range(4)})
        frame = read_lines(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() == archives.FEWEST_PER_CORE * spark.sparkContext.defaultParallelism == 64
        assert sorted(row.line for row in frame.collect()) == sorted(f"{i}|{j}|" for i in range(25) for j in range(4))

    def test_rejects_lie_beside_the_table(self, spark, tmp_path):
        good, bad = "1|2|O|3.50|1997-01-01|p|c|0|text|", "2|2|O|x|1997-01-01|p|c|0|text|"
        undated = "3|2|O|3.50|1997-13-01|p|c|0|text|"
        zipped(tmp_path / "orders.tbl.zip", rows="\n".join([good, undated]))
        staging = str(tmp_path / "staging")
        loaded = ingest(spark, str(tmp_path), staging, DAY, ("orders",))["orders"]
        assert loaded.rejected == 1 and spark.read.parquet(loaded.path).count() == 2
        reject = spark.read.parquet(loaded.rejects).first()
        assert (reject.line, reject.refused, reject.member, reject.number) == (undated, ["o_orderdate"], "rows", 2)
        assert reject.archive.endswith("/orders.tbl.zip")
        zipped(tmp_path / "orders.tbl.zip", rows="\n".join([good, undated, bad]))
        with pytest.raises(Refused, match="2 lines are refused"):
            ingest(spark, str(tmp_path), staging, OTHER, ("orders",))
        kept = read_day(spark, staging, "orders_rejects", OTHER).collect()
        assert {r.line: r.refused for r in kept} == {undated: ["o_orderdate"], bad: ["o_totalprice"]}
        loaded = ingest(spark, str(tmp_path), staging, OTHER, ("orders",), strict=False)["orders"]
        assert loaded.rejected == 2 and spark.read.parquet(loaded.path).count() == 3

    def test_an_archive_is_opened_once_for_its_lines(self, spark, tmp_path, monkeypatch):
        good, bad = "1|2|O|3.50|1997-01-01|p|c|0|text|", "2|2|O|x|1997-01-01|p|c|0|text|"
        source, log = tmp_path / "orders.tbl.zip", str(tmp_path / "log")
        source.mkdir()
        for i in range(6):
            zipped(source / f"{i}.zip", rows="\n".join([good] * 50 + [bad] * (i % 2)))
        whole_lines = archives._whole_lines

        def logged(file):
            with open(log, "a") as out:
                out.write("read\n")
            return whole_lines(file)

        monkeypatch.setattr(archives, "_whole_lines", logged)
        staging = str(tmp_path / "staging")
        for strict in (False, True):
            Path(log).write_text("")
            if strict:
                with pytest.raises(Refused, match="3 lines"):
                    ingest(spark, str(tmp_path), staging, DAY, ("orders",))
            else:
                loaded = ingest(spark, str(tmp_path), staging, DAY, ("orders",), strict=False)["orders"]
                assert loaded.rejected == 3 and spark.read.parquet(loaded.path).count() == 303
            assert Path(log).read_text().count("read") == 6
            assert read_day(spark, staging, "orders_rejects", DAY).count() == 3

    def test_a_bad_byte_costs_its_field(self, spark, tmp_path):
        rows = [b"1|2|O|3.50|1997-01-01|p|c|0|t\xc3\xa9xt|", b"2|2|O|3.50|1997-01-01|p|\xff|0|t|", b"3|2|O|3.\xfe|1997-01-01|p|c|0|t|"]
        zipped(tmp_path / "orders.tbl.zip", rows=b"\n".join(rows))
        staging = str(tmp_path / "staging")
        with pytest.raises(Refused, match="2 lines"):
            ingest(spark, str(tmp_path), staging, DAY, ("orders",))
        loaded = ingest(spark, str(tmp_path), staging, DAY, ("orders",), strict=False)["orders"]
        staged = {r.o_orderkey: r for r in spark.read.parquet(loaded.path).collect()}
        assert staged[1].o_comment == "t\u00e9xt" and staged[2].o_orderclerk is None and staged[2].o_comment == "t"
        assert staged[3].o_totalprice is None and staged[3].o_orderclerk == "c"
        rejects = {r.number: (r.line, r.refused) for r in spark.read.parquet(loaded.rejects).collect()}
        assert rejects == {
            2: ("2|2|O|3.50|1997-01-01|p|\ufffd|0|t|", ["o_orderclerk"]),
            3: ("3|2|O|3.\ufffd|1997-01-01|p|c|0|t|", ["o_totalprice"]),
        }

    def test_a_refused_ingest_leaves_the_old_day(self, spark, tmp_path):
        good, bad = "1|2|O|3.50|1997-01-01|p|c|0|text|", "2|2|O|x|1997-01-01|p|c|0|text|"
        staging = str(tmp_path / "staging")
        zipped(tmp_path / "orders.tbl.zip", rows=good)
        ingest(spark, str(tmp_path), staging, DAY, ("orders",))
        zipped(tmp_path / "orders.tbl.zip", rows="\n".join([good] * 9 + [bad]))
        with pytest.raises(Refused):
            ingest(spark, str(tmp_path), staging, DAY, ("orders",))
        assert Staged(spark, staging, DAY)["orders"].count() == 1
        assert read_day(spark, staging, "orders_rejects", DAY).count() == 1
        zipped(tmp_path / "orders.tbl.zip", rows="\n".join([good] * 4))
        ingest(spark, str(tmp_path), staging, DAY, ("orders",))
        assert Staged(spark, staging, DAY)["orders"].count() == 4
        assert not Path(snapshot_path(staging, "orders_rejects", DAY)).exists()
        assert list((tmp_path / "staging" / "_drafts").iterdir()) == []

    def test_an_empty_archive_makes_an_empty_table(self, spark, tmp_path):
        zipped(tmp_path / "orders.tbl.zip", rows="\n\n")
        loaded = ingest(spark, str(tmp_path), str(tmp_path / "staging"), DAY, ("orders",))["orders"]
        assert spark.read.parquet(loaded.path).schema == schema("orders")
        assert spark.read.parquet(loaded.path).count() == 0

    def test_plain_tables_have_rejects_too(self, spark, tmp_path):
        (tmp_path / "nation.tbl").write_text('1|A|2|c|\n2|"BR|x|zz|\n3|C|4||\n4|D\n')
        loaded = ingest(spark, str(tmp_path), str(tmp_path / "staging"), DAY, ("nation",))["nation"]
        assert loaded.rejected == 1
        assert spark.read.parquet(loaded.rejects).first().refused == ["n_regionkey"]

    def test_missing_sources_are_named(self, spark, landing, tmp_path):
        assert missing_sources(spark, landing) == []
        assert missing_sources(spark, str(tmp_path), ("region", "part")) == ["region", "part"]
        with pytest.raises(FileNotFoundError, match="region, nation, customer"):
            daily.run_day(spark, str(tmp_path), str(tmp_path / "s"), str(tmp_path / "r"), DAY)
        assert not (tmp_path / "s").exists()

    def test_paths(self):
        assert source_path("/in/", "part") == "/in/part.tbl.zip"
        assert source_path("/in", "nation") == "/in/nation.tbl"


class TestDailyRun:
    def test_run_reports_and_registers(self, spark, landing, tmp_path):
        staging, results = str(tmp_path / "staging"), str(tmp_path / "results")
        outcomes = daily.run_day(spark, landing, staging, results, DAY, database="daily_test")
        assert [o.answer for o in outcomes] == list(ANSWERS)
        assert [o.error for o in outcomes] == [None] * 10
        given = GivenTables(spark, GIVEN)
        for name in ("q02_sales_per_by_region", "q08_most_profit_pairs", "q06_cust_behavior"):
            written, direct = read_day(spark, results, name, DAY), ANSWERS[name](given)
            assert written.exceptAll(direct).isEmpty() and direct.exceptAll(written).isEmpty(), name
        assert spark.table("daily_test_staging.orders").count() == given["orders"].count()
        assert spark.table("daily_test_results.q03_delay_ords_pct_by_cust").count() == 5
        years = spark.sql("SELECT min(YEAR) FROM daily_test_results.q02_sales_per_by_region")
        assert years.first()[0] == 1995

    def test_a_rerun_goes_on_where_the_last_one_stopped(self, spark, landing, tmp_path, monkeypatch):
        source, staging, results = str(tmp_path / "source"), str(tmp_path / "staging"), str(tmp_path / "results")
        shutil.copytree(landing, source)

        def run():
            return {o.answer: o for o in daily.run_day(spark, source, staging, results, DAY)}

        def broken(**_):
            raise ValueError("no luck")

        whole = ANSWERS["q07_effect_mkt_campaigns"]
        monkeypatch.setitem(ANSWERS, "q07_effect_mkt_campaigns", Answer(broken, whole.tables))
        first = run()
        assert [name for name, o in first.items() if o.error] == ["q07_effect_mkt_campaigns"]
        monkeypatch.setitem(ANSWERS, "q07_effect_mkt_campaigns", whole)
        ingested = []
        monkeypatch.setattr(daily, "ingest", lambda *args, **more: ingested.append(args[4]) or ingest(*args, **more))
        second = run()
        assert [name for name, o in second.items() if not o.reused] == ["q07_effect_mkt_campaigns"]
        assert ingested == [] and not any(o.error for o in second.values())
        assert all(o.reused and Path(o.path).exists() for o in run().values())

        # new files of one table: it alone is ingested, and what reads it is answered anew
        file = next(Path(source, "supplier.tbl.zip").glob("*.zip"))
        shutil.copy(file, file.with_name("more.zip"))
        third = run()
        assert ingested == [("supplier",)]
        assert {name for name, o in third.items() if not o.reused} == {
            name for name, answer in ANSWERS.items() if "supplier" in answer.tables
        }
        # an answer that was removed is open again, and so is all without a readable record
        shutil.rmtree(third["q06_cust_behavior"].path)
        assert [name for name, o in run().items() if not o.reused] == ["q06_cust_behavior"]
        record = daily.Manifest.of_day(spark, results, DAY)
        assert record.open_tables(staging, DAY, daily.fingerprints(spark, source)) == ()
        Path(results, "_runs", f"{DAY}.json").write_text("{")
        assert daily.Manifest.of_day(spark, results, DAY).staged == {}

    def test_tables_beside_a_refused_one_are_not_ingested_again(self, spark, landing, tmp_path):
        source, staging, results = str(tmp_path / "source"), str(tmp_path / "staging"), str(tmp_path / "results")
        shutil.copytree(landing, source)
        bad = zipped(Path(source, "part.tbl.zip", "bad.zip"), rows="x|y|\n")
        with pytest.raises(Refused, match="part"):
            daily.run_day(spark, source, staging, results, DAY)
        record = daily.Manifest.of_day(spark, results, DAY)
        assert set(record.staged) == set(LAYOUT) - {"part"}
        assert daily.Manifest.last(spark, results).staged == {}
        Path(bad).unlink()
        assert record.open_tables(staging, DAY, daily.fingerprints(spark, source)) == ("part",)

    def test_a_run_leaves_nothing_in_the_scratch_folder(self, spark, landing, tmp_path):
        before = set(Path(shared_folder(spark)).iterdir())
        daily.run_day(spark, landing, str(tmp_path / "staging"), str(tmp_path / "results"), DAY)
        assert set(Path(shared_folder(spark)).iterdir()) == before

    def test_a_failed_answer_does_not_stop_the_rest(self, spark, landing, tmp_path, monkeypatch):
        def broken(**_):
            raise ValueError("no luck")

        monkeypatch.setitem(ANSWERS, "q05_disc_on_sales", Answer(broken, ()))
        outcomes = daily.answer_all(
            GivenTables(spark, GIVEN),
            str(tmp_path),
            DAY,
            ("q05_disc_on_sales", "q10_chg_supp_perf"),
        )
        assert outcomes[0].error == "ValueError: no luck" and outcomes[0].path is None
        assert outcomes[1].error is None


    def test_answers_run_side_by_side(self, spark, tmp_path, monkeypatch):
        names, both = ("q05_disc_on_sales", "q10_chg_supp_perf"), Barrier(2)

        def waits_for_the_other():
            both.wait(60)
            return spark.range(1)

        for name in names:
            monkeypatch.setitem(ANSWERS, name, Answer(waits_for_the_other, ()))
        outcomes = daily.answer_all(GivenTables(spark, GIVEN), str(tmp_path), DAY, names)
        assert [(o.answer, o.error) for o in outcomes] == [(name, None) for name in names]

    def test_answers_that_wait_for_the_base_share_it(self, spark, tmp_path, monkeypatch):
        made = []
        monkeypatch.setattr(daily, "sold_offers", lambda *tables: made.append(1) or sold_offers(*tables))
        names = ("q01_most_profit_prods", "q04_top_supp_by_prod_cat", "q05_disc_on_sales")
        outcomes = daily.answer_all(GivenTables(spark, GIVEN), str(tmp_path), DAY, names)
        assert [o.error for o in outcomes] == [None] * 3 and made == [1]

    def test_a_written_answer_is_summed_up_in_one_pass(self, spark, tmp_path):
        rows = table(spark, "name string, n int, x double", ("a", 1, 0.5), (None, 3, None))
        rows.write.parquet(str(tmp_path / "rows"))
        cells = _cells(spark.read.parquet(str(tmp_path / "rows")), "some")
        assert plan(cells).count("FileScan") == 1
        digest = int(md5(b"a").hexdigest()[:8], 16) + int(md5(b"").hexdigest()[:8], 16)
        assert sorted(map(tuple, cells.collect())) == [
            ("some", "n", 2, 2, 4000, 0), ("some", "name", 2, 1, 0, digest), ("some", "x", 2, 1, 500, 0)
        ]


class TestLanding:
    def test_members_hold_whole_lines_up_to_their_limit(self, monkeypatch):
        monkeypatch.setattr(checks_landing, "MEMBER_LINES", 4)
        batches = [pa.record_batch([pa.array(some, pa.string())], names=["value"]) for some in (["a", "é"], [], list("bcdefgh"))]
        assert list(checks_landing._members(iter(batches))) == [("a\né\nb\nc\n".encode(), 4), (b"d\ne\nf\ng\n", 4), (b"h\n", 1)]

    def test_amounts_are_checked_by_doubles_where_these_are_exact(self, spark):
        frame = table(spark, "s_suppkey bigint, s_acctbal double", (1, 0.1), (2, -999.99), (3, 0.0001), (4, 2.0**36 + 0.01), (5, None))
        kept = enforce(frame, "supplier", fill_missing=True).select("s_acctbal").collect()
        assert [r[0] and str(r[0]) for r in kept] == ["0.1000", "-999.9900", "0.0001", "68719476736.0100", None]
        for bad in (0.00001, 1.00005, float("nan"), float("inf")):
            with pytest.raises(Exception):
                enforce(table(spark, "s_suppkey bigint, s_acctbal double", (1, bad)), "supplier", fill_missing=True).collect()

    def test_plain_dates_skip_the_pattern_and_mean_the_same(self, spark):
        texts = ["1996-02-29", "1997-02-29", "0000-01-01", "9999-12-31", "1996-2-9", " 1996-02-09", "1996-02-09\n", "12024-01-01", "", None]
        frame = table(spark, "t string", *[(t,) for t in texts])
        both = frame.select(parse_date("t").alias("a"), F.try_to_date("t", "yyyy-MM-dd").alias("b"))
        assert "RLIKE" in plan(both)
        assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).isEmpty()
        days = spark.sql("SELECT date_add(date'0990-01-01', CAST(id * 97 AS INT)) AS d FROM range(40000)")
        assert days.filter(date_text(F.col("d")) != F.col("d").cast("string")).isEmpty()


class TestPlans:
    def test_lead_time_reads_the_lines_once_and_writes_nothing(self, spark):
        before = set(Path(shared_folder(spark)).iterdir()) if Path(shared_folder(spark)).exists() else set()
        frame = ANSWERS["q09_sale_lead_time"](GivenTables(spark, GIVEN))
        frame.collect()
        assert set(Path(shared_folder(spark)).iterdir()) == before
        final = plan(frame).split("== Initial Plan ==")[0]
        assert sum("FileScan" in x and "/lineitem.parquet" in x for x in final.splitlines()) == 1

    def test_names_are_joined_to_the_best_pairs_only(self, spark):
        text = plan(ANSWERS["q08_most_profit_pairs"](GivenTables(spark, GIVEN)))
        assert "part.parquet" not in text  # the names are in the stored pairs
        assert sum("FileScan" in x and "/lineitem.parquet" in x for x in text.splitlines()) == 1

    @pytest.mark.parametrize("name", sorted(ANSWERS))
    def test_no_python_and_narrow_scans(self, spark, name):
        given = GivenTables(spark, GIVEN)
        text = plan(ANSWERS[name](given))
        for word in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text
        width = {table: len(given.raw(table).columns) for table in ("orders", "lineitem")}
        for line in text.splitlines():
            for source, n in width.items():
                if "FileScan" in line and f"/{source}.parquet" in line:
                    assert line.split("[", 1)[1].split("]")[0].count(",") + 1 < n

    def test_order_years_are_pushed_to_the_scan(self, spark):
        text = plan(ANSWERS["q06_cust_behavior"](GivenTables(spark, GIVEN)))
        assert "GreaterThanOrEqual(o_orderdate,1996" in text


class TestSharedFolder:
    def test_cluster_setting_wins(self, spark):
        settings = {"spark.checkpoint.dir": "hdfs://cluster/shared/"}
        context = SimpleNamespace(getConf=lambda: settings, master="yarn")
        session = SimpleNamespace(sparkContext=context, conf=settings)
        assert shared_folder(session) == "hdfs://cluster/shared"
        settings.clear()
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session)

    def test_folders_are_fresh(self, spark):
        assert fresh_folder(spark, "a") != fresh_folder(spark, "a")


def test_layout_matches_schema():
    for name in LAYOUT:
        assert [f.name for f in schema(name)] == [c for c, _ in columns(name)]
    assert {k for name in LAYOUT for _, k in columns(name)} == {"key", "int", "money", "rate", "text", "date"}
    assert F


def test_amounts_are_stored_field_by_field(spark, tmp_path):
    spark.sql(
        "SELECT 1L AS l_orderkey, 2L AS l_partkey, 3L AS l_suppkey, n AS l_linenumber, 5D AS l_quantity,"
        " 10.25D AS l_extendedprice, 0.05D AS l_discount, 0.01D AS l_tax, 'R' AS l_returnflag, 'F' AS l_linestatus,"
        " timestamp'1997-01-02' AS l_shipdate FROM (SELECT explode(sequence(1, 4)) AS n)"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = amounts_kept_or_refused(GivenTables(spark, str(tmp_path)))
    assert sorted(map(tuple, found.collect()), key=lambda row: row[1]) == [
        (1, 1, 10.255, 0.05, "l_shipdate"),
        (1, 2, 12345678911.25, 0.05, ""),
        (1, 3, 10.25, 250.0, ""),
        (1, 4, None, 0.05, "l_extendedprice"),
    ]
    used = "ReadSchema: struct<l_orderkey:string,l_linenumber:string,l_extendedprice:string,l_discount:string>"
    assert "fields:array" not in plan(found) and used in plan(found)


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {found.apply(i).getName() for i in range(found.size())}
    return {name for name in names if name.startswith("shuffle_")}


class TestDisk:
    def test_shuffle_files_go_with_the_answer_that_wrote_them(self, spark, tmp_path):
        before = shuffle_files(spark)
        names = ("q02_sales_per_by_region", "q06_cust_behavior", "q08_most_profit_pairs")
        outcomes = daily.answer_all(GivenTables(spark, GIVEN), str(tmp_path), DAY, names)
        assert [o.error for o in outcomes] == [None] * 3
        until = time.monotonic() + 20
        while (left := shuffle_files(spark) - before) and time.monotonic() < until:
            time.sleep(0.2)  # Spark removes them in the background
        assert not left

    def test_settings_hold_for_the_run_only(self, spark, tmp_path):
        codec = "spark.sql.parquet.compression.codec"
        before = spark.conf.get(codec)
        with little_disk(spark):
            assert spark.conf.get(codec) == "zstd"
        assert spark.conf.get(codec) == before
        spark.conf.set(codec, "gzip")
        try:
            with little_disk(spark):
                assert spark.conf.get(codec) == "gzip"
            assert spark.conf.get(codec) == "gzip"
        finally:
            spark.conf.unset(codec)

    def test_large_answers_take_turns(self):
        anytime, in_turn = daily.turns([*ANSWERS, "q99"])
        assert anytime == ["q06_cust_behavior", "q08_most_profit_pairs", "q10_chg_supp_perf", "q99"]
        assert [[name[:3] for name in turn] for turn in in_turn] == [["q01", "q04", "q05"], ["q02", "q03"], ["q07", "q09"]]

    def test_the_sold_base_is_gone_before_the_next_turn(self, spark, tmp_path, monkeypatch):
        seen = []

        def looks(**_):
            seen.append([path.name for path in Path(shared_folder(spark)).glob("sold-*")])
            return spark.range(1)

        before = [path.name for path in Path(shared_folder(spark)).glob("sold-*")]
        monkeypatch.setitem(ANSWERS, "q02_sales_per_by_region", Answer(looks, ("orders", "lineitem")))
        names = ("q02_sales_per_by_region", "q05_disc_on_sales")
        outcomes = daily.answer_all(GivenTables(spark, GIVEN), str(tmp_path), DAY, names)
        assert [(o.answer, o.error) for o in outcomes] == [(name, None) for name in names] and seen == [before]

    def test_source_files_may_go_once_their_table_is_staged(self, spark, tmp_path):
        given, gone = GivenTables(spark, GIVEN), []
        source = land(given)

        def staged(name):
            assert Path(source_path(source, name)).exists()
            clear_away(given, source, name)
            gone.append(name)

        outcomes = daily.run_day(spark, source, str(tmp_path / "s"), str(tmp_path / "r"), DAY, done=staged)
        assert [o.error for o in outcomes] == [None] * len(ANSWERS) and sorted(gone) == sorted(LAYOUT)
        assert not any(Path(source).iterdir())
        assert Staged(spark, str(tmp_path / "s"), DAY)["orders"].count() == given["orders"].count()

    def test_some_parts_at_a_time_give_the_same_rows(self, spark, monkeypatch):
        money = "CAST(%s AS decimal(18,4))"
        # parts 0 to 6 and none, lines that repeat, offers that repeat, lines without an offer
        lines = spark.sql(
            f"SELECT id % 11 AS l_orderkey, CASE WHEN id % 8 < 7 THEN id % 8 END AS l_partkey, id % 3 AS l_suppkey,"
            f" {money % 'id + 0.25'} AS l_extendedprice, CAST(0.05 AS decimal(9,4)) AS l_discount FROM range(90)"
        )
        offers = spark.sql(
            f"SELECT CASE WHEN id % 7 < 6 THEN id % 7 END AS ps_partkey, id % 2 AS ps_suppkey, 5 AS ps_availqty,"
            f" {money % '2.5'} AS ps_supplycost, 'x' AS ps_comment FROM range(21)"
        )
        tables = {
            "lineitem": stored(lines, "lines"),
            "partsupp": offers,
            "orders": spark.sql("SELECT id AS o_orderkey, id % 4 AS o_custkey FROM range(10)"),
            "customer": spark.sql("SELECT id AS c_custkey FROM range(3)"),
        }
        for build, names in (
            (sold_offers, ("partsupp", "lineitem")),
            (campaign_revenue, ("partsupp", "lineitem", "orders", "customer")),
        ):
            asked = []

            def counted(*frames, build=build, asked=asked):
                asked.append(1)
                return build(*frames)

            monkeypatch.setattr(sold_base, "LINES_AT_ONCE", planned_bytes(tables["lineitem"]) // 3 + 1)
            some = stored_by_part(counted, tables, names, "some")
            whole = build(*[tables[name] for name in names])
            assert len(asked) == 3 and whole.count() > 0 and some.columns == whole.columns
            assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.collect()))
            assert "ps_comment" not in whole.columns
            monkeypatch.setattr(sold_base, "LINES_AT_ONCE", planned_bytes(tables["lineitem"]))
            stored_by_part(counted, tables, names, "all")
            assert len(asked) == 4
