"""Importance resampling towards a target corpus, with repeated lines worked once.

A document's features are its words and pairs of consecutive words, hashed into
buckets. A bucket gains by how much more frequent it is in the target than in
the documents, a document's weight is its mean gain, and the documents with the
highest weight plus Gumbel noise are drawn.

Newlines separate words, so a text is its lines and the pairs that cross them.
Distinct lines are cut into features once; corpus counts multiply each line's
counts by its occurrences, and a document's total adds up those of its lines.
Pairs across lines are taken from the document itself and added to both.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.tables import ids_and_texts
from salesloom.session import stored

BUCKETS = 10_000
SCALE = 1000
MIN_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
# a line with more than this share of all lines is one of at most as many as the share's inverse
FREQUENT_SHARE = 1 / 2000
BLOCK = 65_536  # copies of one row made at a time

# Words are runs of 0-9, a-z and all beyond ASCII, whose UTF-8 has only bytes from 0x80.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def line_buckets(line: bytes) -> np.ndarray:
    """Buckets of the words and pairs of words of one line, repeats included."""
    words = WORD.findall(line.lower())  # of bytes, so that only A-Z change
    hashes = list(map(zlib.crc32, words))
    # the hash of a pair goes on from the hash of its first word
    pairs = map(zlib.crc32, [b" " + word for word in words[1:]], hashes)
    return _buckets([*hashes, *pairs])


def across_buckets(text: bytes) -> np.ndarray:
    """Buckets of the pairs of a text whose words lie on different lines."""
    hashes, last = [], None
    for line in text.lower().split(b"\n"):
        first = WORD.search(line)
        if first is None:
            continue
        if last is not None:
            hashes.append(zlib.crc32(b" " + first.group(), zlib.crc32(last)))
        last = WORD.search(line[::-1]).group()[::-1]
    return _buckets(hashes)


def _buckets(hashes: list[int]) -> np.ndarray:
    return (np.array(hashes, dtype=np.uint32) % BUCKETS).astype("<u2")


@F.pandas_udf(T.BinaryType())
def _line_buckets(lines: pd.Series) -> pd.Series:
    return pd.Series([line_buckets(line).tobytes() for line in lines])


@F.pandas_udf(T.BinaryType())
def _across_buckets(texts: pd.Series) -> pd.Series:
    return pd.Series([across_buckets(text).tobytes() for text in texts])


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def split_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents as digests of their lines, and the distinct lines as buckets; both stored.

    Documents: ``row`` (a number of its own for each row), ``doc_id``, ``lines``
    (digests) and ``across`` (buckets of pairs across lines, null without any).
    Lines: ``line`` (digest), ``n`` (occurrences), ``buckets``. ``docs`` has
    doc_id and text. Lines without a word are left out.
    """
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[0-9a-zA-Z]|[^\x00-\x7F]"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.transform(lines, _digest).alias("lines"),
        F.when(F.contains("text", F.lit("\n")), _across_buckets(F.col("text").cast("binary"))).alias("across"),
    )
    distinct = docs.select(F.explode(lines).alias("line")).groupBy("line").agg(F.count("*").alias("n"))
    buckets = distinct.select(
        _digest(F.col("line")).alias("line"), "n", _line_buckets(F.col("line").cast("binary")).alias("buckets")
    )
    return stored(rows, "documents"), stored(buckets, "lines")


def bucket_counts(rows: DataFrame, lines: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all documents; at most one row a bucket leaves a task."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            buckets = batch.column("buckets").to_pylist()
            n = np.repeat(batch.column("n").to_numpy(), [len(b) // 2 for b in buckets])
            np.add.at(total, np.frombuffer(b"".join(buckets), dtype="<u2"), n)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    across = rows.where("across IS NOT NULL").select(F.lit(1).cast("long").alias("n"), F.col("across").alias("buckets"))
    every = lines.select("n", "buckets").unionByName(across)
    sums = every.mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in sums.collect():  # no more rows than buckets
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floor of 1000 times the log of its frequency ratio, each smoothed by one."""
    in_source, in_target = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array(
        [
            math.floor(SCALE * math.log((t + 1.0) * in_source / ((s + 1.0) * in_target)))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def weights(rows: DataFrame, lines: DataFrame, gain: np.ndarray) -> DataFrame:
    """``row``, ``doc_id``, ``n_features`` and ``weight`` of every document.

    The lines that hold a large share of all are few and meet the documents by
    broadcast; the rest are joined by their digest, of which no one is frequent.
    """

    @F.pandas_udf("features long, gain long")
    def totals(buckets: pd.Series) -> pd.DataFrame:
        held = [np.frombuffer(b, dtype="<u2") for b in buckets]
        return pd.DataFrame({"features": [len(h) for h in held], "gain": [int(gain[h].sum()) for h in held]})

    valued = stored(lines.select("line", "n", totals("buckets").alias("t")).select("line", "n", "t.*"), "line-gains")
    least = (valued.agg(F.sum("n")).first()[0] or 0) * FREQUENT_SHARE
    known = valued.select("line", "features", "gain")
    frequent = F.broadcast(known.where(valued["n"] > least))  # at most 1 / FREQUENT_SHARE rows
    held = rows.select("row", F.explode("lines").alias("line"))
    parts = held.join(frequent, "line").unionByName(
        held.join(frequent, "line", "left_anti").join(known.where(valued["n"] <= least), "line")
    )
    own = rows.where("across IS NOT NULL").select("row", totals("across").alias("t")).select("row", "t.*")
    sums = parts.drop("line").unionByName(own).groupBy("row").agg(
        F.sum("features").alias("features"), F.sum("gain").alias("gain")
    ).where("features > 0")
    # whole-number division that rounds down
    mean = F.expr("(gain - pmod(gain, features)) div features")
    return rows.select("row", "doc_id").join(sums, "row", "left").select(
        "doc_id",
        F.coalesce("features", F.lit(0).cast("long")).alias("n_features"),
        F.coalesce(mean, F.lit(0).cast("long")).alias("weight"),
    )


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise from a hash of seed and id, in thousandths, rounded down; a null id is empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column], number: str) -> DataFrame:
    """Rows with ``rank``, their first place in the order; a row with ``number`` n takes n places.

    Rows are sorted in range partitions, whose totals give each its first place;
    only those totals, one row a partition, are gathered.
    """
    ranges = stored(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    starts, before = [], 0
    for part, n in sorted(ranges.groupBy("part").agg(F.sum(number)).collect()):
        starts.append((part, before))
        before += n
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "part int, before long"))
    sofar = F.sum(number).over(Window.partitionBy("part").orderBy(*order))
    return (
        ranges.withColumn("sofar", sofar)
        .join(starts, "part")
        .withColumn("rank", F.col("before") + F.col("sofar") - F.col(number) + 1)
        .drop("part", "before", "sofar")
    )


def one_row_each(rows: DataFrame, number: str) -> DataFrame:
    """Every row as often as ``number`` says, with ``copy`` from 0 on in its place.

    Copies are made in blocks, and those of very frequent rows are dealt over tasks.
    """
    few = rows.where(F.col(number) <= BLOCK).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col(number) - 1)))
    blocks = rows.where(F.col(number) > BLOCK).withColumn(
        "block", F.explode(F.expr(f"sequence(0L, {number} - 1, {BLOCK}L)"))
    )
    last = F.least(F.col("block") + BLOCK, F.col(number)) - 1
    many = blocks.repartition("block", "doc_id").withColumn("copy", F.explode(F.sequence("block", last))).drop("block")
    return few.unionByName(many).drop(number)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_id: str = "item_id",
    target_text: str = "text",
    percent: int = DRAWN_PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Documents drawn by importance for a target corpus.

    One row per document with ``doc_id``, ``n_features``, ``weight``, ``score`` and
    ``rank``: 1, 2, 3... by falling score among the ``percent`` of the documents
    with at least 20 words, rounded down, that are drawn; null for all others. Ties
    go to the smaller id, null ids last, then to fewer features.

    Null texts and texts without words have no features and weight 0. Texts of any
    length count whole, line by line. A null id takes part in the noise as empty
    text. Rows that repeat an id have the same noise; rows alike in all columns of
    the result are as many rows with ranks that follow each other. An empty table
    gives no rows, an empty target leaves the smoothed gains. Other columns are not read.
    """
    rows, lines = split_lines(ids_and_texts(docs, id_col, text_col))
    gain = gains(bucket_counts(rows, lines), bucket_counts(*split_lines(ids_and_texts(target, target_id, target_text))))
    scored = weights(rows, lines, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    columns = ["doc_id", "n_features", "weight", "score"]
    alike = stored(scored.groupBy(*columns).agg(F.count("*").alias("n")), "scores")

    # w words make w words and w - 1 pairs
    long_enough = F.col("n_features") >= 2 * MIN_WORDS - 1
    drawn = percent * (alike.where(long_enough).agg(F.sum("n")).first()[0] or 0) // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("weight").asc()]
    places = ranked(alike.where(long_enough), order, "n")
    rest = alike.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    rank = F.col("rank") + F.col("copy")
    return one_row_each(places.unionByName(rest), "n").select(*columns, F.when(rank <= drawn, rank).alias("rank"))
