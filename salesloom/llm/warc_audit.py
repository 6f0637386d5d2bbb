"""Fixity audit of archive replicas by Merkle trees.

A record's leaf holds its offset, length and SHA-256. A node covers the offset
range of ``FAN_OUT`` neighbours and hashes their hashes in the order of their
offsets; the root stands for the whole archive. Replicas are compared by their
roots, and only below roots that differ by the children, down to the records.
What is compared is so in proportion to the damage, not to the archive, and a
node gathers ``FAN_OUT`` children, however many records an archive has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.tables import sums_before
from salesloom.session import stored

FAN_OUT = 16
ARCHIVE_PAGES = 1000


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            damage: Column | None = None, archive_pages: int = ARCHIVE_PAGES) -> DataFrame:
    """The response records of ``pages``, by id and then by hash, in archives of ``archive_pages``.

    One row per page: archive, place (from 0), offset and length in the archive,
    and the record's SHA-256. Null html is empty, null urls are empty, null ids
    come first; archives are cut by running number, so that no id makes a large
    one. Repeated rows are as many records; html of any length is hashed whole; an
    empty table gives no records. Other columns are not read. ``damage`` makes a replica:
    where it is ``changed`` the record's first byte of html is another one, where
    it is ``lost`` the record cannot be read; offsets stay those of the index.
    """
    body = F.coalesce(pages[html_col], F.lit(""))
    damage = F.lit(None).cast("string") if damage is None else damage

    def record(content: Column) -> Column:
        return F.concat(
            F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(pages[url_col], F.lit("")),
            F.lit("\r\nWARC-Record-ID: "), F.coalesce(pages[id_col].cast("string"), F.lit("-")),
            F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), content,
            F.lit("\r\n\r\n"),
        )

    whole = record(body)
    held = F.when(damage == "changed", record(F.concat(F.lit("\x00"), F.substr(body, F.lit(2))))).otherwise(whole)
    slim = pages.select(
        pages[id_col].alias("page_id"),
        F.octet_length(whole).cast("long").alias("length"),
        F.sha2(whole, 256).alias("index_sha256"),
        F.when(F.coalesce(damage != "lost", F.lit(True)), F.sha2(held, 256)).alias("sha256"),
    )
    placed = sums_before(slim, [F.col("page_id").asc_nulls_first(), F.col("index_sha256")], number=F.lit(1))
    number = F.col("number").cast("long")
    placed = placed.withColumn("archive", F.expr(f"cast(number as bigint) div {archive_pages}"))
    placed = placed.withColumn("place", F.pmod(number, F.lit(archive_pages)).cast("long"))
    # an archive has no more rows than it has pages
    before = Window.partitionBy("archive").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.select("archive", "place", "offset", "length", "page_id", "sha256").where("sha256 IS NOT NULL")


def tree(leaves: DataFrame, fan_out: int = FAN_OUT, levels: int | None = None) -> DataFrame:
    """All nodes: archive, level (0 the records), place, start, stop (offsets) and hash.

    ``leaves`` have archive, place, offset, length and sha256. There are as many
    levels as the longest archive needs for a single root.
    """
    hash_ = F.sha2(F.concat_ws(":", "offset", "length", "sha256"), 256)
    level = leaves.select(
        "archive", F.lit(0).alias("level"), "place", F.col("offset").alias("start"),
        (F.col("offset") + F.col("length")).alias("stop"), hash_.alias("hash"),
    )
    if levels is None:
        levels = levels_for((leaves.agg(F.max("place")).first()[0] or 0) + 1, fan_out)
    nodes = level
    for i in range(1, levels + 1):
        children = F.array_sort(F.collect_list(F.struct("start", "place", "hash")))
        level = (
            level.groupBy("archive", F.floor(F.col("place") / fan_out).alias("place"))
            .agg(children.alias("children"), F.min("start").alias("start"), F.max("stop").alias("stop"))
            .select("archive", F.lit(i).alias("level"), "place", "start", "stop",
                    F.sha2(F.concat_ws("|", F.col("start").cast("string"), F.col("stop").cast("string"),
                                       F.array_join(F.transform("children", lambda c: c["hash"]), "|")), 256).alias("hash"))
        )
        nodes = nodes.unionByName(level)
    return nodes


def levels_for(records_: int, fan_out: int = FAN_OUT) -> int:
    levels, reach = 1, fan_out
    while reach < records_:
        levels, reach = levels + 1, reach * fan_out
    return levels


def audit(index: DataFrame, replica: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """The records of which the replica does not hold what the index says.

    Both have archive, place, offset, length and sha256, unique by archive and
    place. One row per damaged record: archive, place, offset, length,
    expected_sha256, found_sha256 and status: ``changed``, ``lost`` or ``extra``
    (the index does not know it; offset and length are then the replica's).
    Replicas that agree, and empty ones on both sides, give no rows; records that
    are alike but for their place are compared place by place.
    """
    leaves = [stored(side.select("archive", "place", "offset", "length", "sha256"), "leaves") for side in (index, replica)]
    last = max((side.agg(F.max("place")).first()[0] or 0) + 1 for side in leaves)
    levels = levels_for(last, fan_out)
    trees = [stored(tree(side, fan_out, levels), "merkle") for side in leaves]

    def differing(level: int, parents: DataFrame | None) -> DataFrame:
        sides = []
        for nodes, name in zip(trees, ("a", "b"), strict=True):
            side = nodes.where(F.col("level") == level).select(
                F.coalesce(F.col("archive").cast("string"), F.lit("-")).alias("key"), "archive", "place", F.col("hash").alias(name)
            )
            if parents is not None:
                above = F.floor(F.col("place") / fan_out)
                side = side.withColumn("parent", above).join(parents, ["key", "parent"], "left_semi").drop("parent")
            sides.append(side)
        both = sides[0].join(sides[1].drop("archive"), ["key", "place"], "full")
        return both.where("NOT (a <=> b)").select("key", "place")

    frontier = None
    for level in range(levels, -1, -1):
        frontier = differing(level, frontier)
        if level:
            frontier = stored(frontier.select("key", F.col("place").alias("parent")), "frontier")
    key = F.coalesce(F.col("archive").cast("string"), F.lit("-"))
    a, b = (side.withColumn("key", key).select("key", "place", F.struct(*side.columns).alias(name)) for side, name in zip(leaves, "ab", strict=True))
    rows = frontier.join(a, ["key", "place"], "left").join(b, ["key", "place"], "left")
    held = F.coalesce("a", "b")
    status = F.when(F.col("b").isNull(), "lost").when(F.col("a").isNull(), "extra").otherwise("changed")
    return rows.select(
        held["archive"].alias("archive"), "place", held["offset"].alias("offset"), held["length"].alias("length"),
        F.col("a.sha256").alias("expected_sha256"), F.col("b.sha256").alias("found_sha256"), status.alias("status"),
    )


def sampled_damage(page_id: Column) -> Column:
    """The damage that the registered query plants: one page of 256 changed, one lost."""
    mark = F.substring(F.md5(F.coalesce(page_id.cast("string"), F.lit("-"))), 1, 2)
    return F.when(mark == "00", "changed").when(mark == "01", "lost")


SQL = f"""
WITH raw AS (
  SELECT page_id, coalesce(html, '') AS html,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
           || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: ' || coalesce(CAST(page_id AS VARCHAR), '-')
           || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR)
           || chr(13) || chr(10) || chr(13) || chr(10) AS head,
         chr(13) || chr(10) || chr(13) || chr(10) AS tail,
         substr(md5(coalesce(CAST(page_id AS VARCHAR), '-')), 1, 2) AS mark
  FROM pages),
hashed AS (SELECT page_id, mark, CAST(strlen(head || html || tail) AS BIGINT) AS length,
                  sha256(head || html || tail) AS expected_sha256,
                  sha256(head || chr(0) || substr(html, 2) || tail) AS altered FROM raw),
numbered AS (SELECT *, row_number() OVER (ORDER BY page_id NULLS FIRST, expected_sha256) - 1 AS number FROM hashed),
cut AS (SELECT *, number // {ARCHIVE_PAGES} AS archive, number % {ARCHIVE_PAGES} AS place FROM numbered),
placed AS (SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY archive ORDER BY place
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM cut)
SELECT archive, place, "offset", length, expected_sha256,
       CASE WHEN mark = '00' THEN altered END AS found_sha256,
       CASE WHEN mark = '00' THEN 'changed' ELSE 'lost' END AS status
FROM placed WHERE mark IN ('00', '01')
"""
