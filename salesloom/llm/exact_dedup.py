"""Exact duplicates by a tree of merged digest runs.

Documents are dealt into ``RUNS`` runs. Each run is sorted by digest and reduced
to one entry per text: the row that stays and the number of rows. Then partner
runs are merged in binomial rounds: in the first, run 8 goes to run 0, 9 to 1 and
so on, in the next, run 4 of the merged ones to 0, until one is left. For a round
the runs are exchanged by ranges of run and digest, and every task sorts its range
and merges equal digests that come to lie next to each other, so a range holds
entries of any number of digests but no digest makes a large group: a text that
fills a third of the table is one entry per run from the first level on.

The verdict goes back to the rows by a join on the digest, of which the few that
hold a large share of all rows are broadcast, so that no task has them to itself.

An entry is verified by two more facts than its SHA-256: the length and an
independent 64-bit hash must agree too, or the texts stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.tables import ids_and_texts
from salesloom.operators.joining import broadcast_if_small
from salesloom.session import stored

ENTRY = ["digest", "n_chars", "other_hash"]
RUNS = 16  # a power of two
# a text with more than this share of all rows is one of at most as many as the share's inverse
FREQUENT_SHARE = 1 / 2000


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def leaves(docs: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    """A row per document with a number of its own. Stored: several steps read them, and texts are read once."""
    rows = ids_and_texts(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        text_digest(F.col("text")).alias("digest"),
        F.length("text").alias("n_chars"),
        F.xxhash64("text").alias("other_hash"),
    )
    return stored(rows.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs))), "digests")


def merged_runs(level: DataFrame) -> DataFrame:
    """One entry per run and digest: runs of a range are sorted, and equal neighbours merge.

    The entry that stays is a struct, which Spark aggregates in sorted order only.
    """
    ranges = level.repartitionByRange("run", *ENTRY).sortWithinPartitions("run", *ENTRY)
    return ranges.groupBy("run", *ENTRY).agg(F.max("keep").alias("keep"), F.sum("rows").alias("rows"))


def root_of(rows: DataFrame, runs: int) -> DataFrame:
    """One entry per text of all rows, from runs merged two by two in each round."""
    keep = F.struct("doc_id", "row").alias("keep")  # null ids are the least
    level = rows.groupBy("run", *ENTRY).agg(F.max(keep).alias("keep"), F.count("*").alias("rows"))
    level = stored(level, "runs")
    while runs > 1:
        runs //= 2
        partner = F.when(F.col("run") >= runs, F.col("run") - runs).otherwise(F.col("run"))
        level = stored(merged_runs(level.withColumn("run", partner)), "runs")
    return level.drop("run")


def verdicts(docs: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    """``exact_groups`` with the digest as bytes."""
    rows = leaves(docs, id_col, text_col, runs)
    root = root_of(rows, runs)
    least = rows.count() * FREQUENT_SHARE
    several = root.where("rows > 1")
    frequent = F.broadcast(several.where(F.col("rows") > least))  # at most 1 / FREQUENT_SHARE entries
    entries = rows.drop("run")
    often = entries.join(frequent, ENTRY)
    seldom = entries.join(frequent, ENTRY, "left_anti").join(several.where(F.col("rows") <= least), ENTRY, "left")
    stays = F.coalesce("keep", F.struct("doc_id", "row"))
    return often.unionByName(seldom).select(
        "doc_id",
        stays["doc_id"].alias("keep_id"),
        F.coalesce("rows", F.lit(1).cast("long")).alias("group_size"),
        (stays["row"] == F.col("row")).alias("kept"),
        "digest",
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = RUNS
) -> DataFrame:
    """Which document stays of those with an identical text.

    One row per row of ``docs`` with ``doc_id``, ``keep_id`` (largest id of the
    text), ``group_size`` (rows with the text), ``kept`` and ``text_sha256``. Null
    text is empty text, and empty texts are equal; texts of any length are
    compared whole. A null id never wins over another. Of rows that repeat both id
    and text one is kept, no matter which, as they do not differ. An empty table
    gives no rows. Other columns are not read.
    """
    found = verdicts(docs, id_col, text_col, runs)
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Of rows that repeat both id and text one stays, whichever Spark meets first;
    null text is empty text. What goes is stored as ids and digests, and texts stay
    where they are while that is no more than a broadcast may be; beyond it they are
    shuffled once.
    """
    found = verdicts(docs, id_col, text_col, RUNS).where("group_size > 1")
    pairs = found.groupBy("doc_id", "digest").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("kept"), 1)).alias("kept")
    )
    gone = broadcast_if_small(stored(pairs.where("n > kept"), "exact-copies"))
    digest = text_digest(docs[text_col])

    def same(verdicts):
        return docs[id_col].eqNullSafe(verdicts["doc_id"]) & (digest == verdicts["digest"])

    single = docs.join(gone, same(gone), "left_anti")
    repeated = gone.where("kept > 0")
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    rows = docs.join(repeated, same(repeated), "left_semi")
    rows = rows.select(whole, docs[id_col].alias("doc_id"), digest.alias("digest"))
    one_of_each = rows.dropDuplicates(["doc_id", "digest"])
    return single.unionByName(one_of_each.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns]))


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(body) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""
