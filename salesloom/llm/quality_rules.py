"""Quality rules with a verdict on hosts.

Every document is measured whole and held against rules. Their failures are
counted per host, and each host's failure rate is shrunk towards the rate of
all documents by a beta prior. The prior's strength is fitted to the hosts by the
moments of the beta-binomial: hosts differ by their own rates and by the chance of
few documents, and what chance explains is taken off, so that many small hosts of
one rate give a strong prior. A host with three documents says little, one with a
million speaks for itself. The verdict comes back to the documents by a join:

- ``trusted``: the host is less likely than ``WATCH`` to be worse than the mean;
  only the base rules reject.
- ``watched``: it is as likely or likelier; a document that fails any rule goes,
  one that fails none stays.
- ``rejected``: the shrunk rate is ``REJECT`` or more, that is, all but a few
  documents fail; the host's documents go.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import count
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from salesloom.llm.tables import join_salted
from salesloom.session import stored

MIN_WORDS = 50
REPEAT_PERCENT = 50  # of the words, base rule
SYMBOLS = "#*$%&|<>"
SYMBOL_PERCENT = 10  # symbols per 100 words
DUP_LINE_PERCENT = 50  # lines equal to an earlier one, of the lines with a word
MEAN_WORD = (2, 15)  # code points
WATCH = 0.5  # probability that a host is worse than the mean
REJECT = 0.95  # shrunk rate of failures
MAX_STRENGTH = 1e6  # documents that the prior counts for, if hosts differ by chance only

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a 3-word window that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen = dict(zip(dict.fromkeys(words), count(), strict=False))
    if len(seen) == n:
        return 0
    ids = np.fromiter(map(seen.__getitem__, words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(seen) + ids[2:]
    _, at, counts = np.unique(windows, return_inverse=True, return_counts=True)
    often = counts[at] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= often
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    words = text.encode().split()  # bytes split at \x20 and \x09-\x0D only
    space = sum(map(text.count, " \t\n\r\x0b\x0c"))
    lines = [line for line in text.encode().split(b"\n") if line.split()]
    return (
        len(words),
        len(text) - space,
        sum(map(text.count, SYMBOLS)),
        len(lines),
        sum(n - 1 for n in Counter(lines).values()),
        repeated_words(words),
    )


@F.pandas_udf(StructType([StructField(name, LongType()) for name in MEASURES]))
def _measures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure(t or "") for t in texts], columns=MEASURES)


def measured(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", carry: list[str] | None = None
) -> DataFrame:
    """The columns ``carry`` of ``docs``, by default all, in a struct ``doc``; its host, measures and failures."""
    rows = docs.select(
        F.struct(*[docs[c] for c in carry or docs.columns]).alias("doc"),
        F.coalesce(F.concat(F.lit("="), docs[host_col].cast("string")), F.lit("")).alias("host"),
        _measures(docs[text_col]).alias("m"),
    ).select("doc", "host", "m.*")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    low, high = MEAN_WORD
    failed = (
        base_failed
        | (100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("n_words"))
        | (100 * F.col("n_dup_lines") > DUP_LINE_PERCENT * F.col("n_lines"))
        | (F.col("word_chars") < low * F.col("n_words"))
        | (F.col("word_chars") > high * F.col("n_words"))
    )
    return rows.withColumn("base_failed", base_failed).withColumn("rule_failed", failed)


def fitted_strength(n_hosts: int, n_docs: int, n_failed: int, squares: float, sizes: float) -> float:
    """How many documents the beta prior counts for, by the moments of the beta-binomial.

    ``squares`` is the sum of failed^2 / documents of the hosts, ``sizes`` that of
    documents^2. Weighted by documents, rates that differ by chance alone would
    spread by hosts - 1 times p (1 - p); what is beyond is between the hosts.
    """
    rate = n_failed / n_docs if n_docs else 0.0
    variance = rate * (1 - rate)
    room = n_docs - sizes / n_docs - (n_hosts - 1) if n_docs else 0.0
    if variance <= 0 or room <= 0:
        return MAX_STRENGTH
    between = ((squares - n_failed * rate) / variance - (n_hosts - 1)) / room
    return MAX_STRENGTH if between <= 0 else min(MAX_STRENGTH, max(1.0, 1 / between - 1))


def host_verdicts(rows: DataFrame, watch: float = WATCH, reject: float = REJECT) -> DataFrame:
    """One row per host with ``n_docs``, ``n_failed``, ``shrunk_rate`` and ``verdict``.

    ``rows`` have host and rule_failed. With hosts that differ no more than by
    chance, or a single one, the prior has its largest strength. A host that is
    exactly as the mean is as likely worse as better.
    """
    hosts = stored(
        rows.groupBy("host").agg(
            F.count("*").alias("n_docs"), F.sum(F.col("rule_failed").cast("long")).alias("n_failed")
        ),
        "hosts",
    )
    n, failed = F.col("n_docs"), F.col("n_failed")
    seen = hosts.agg(
        F.count("*"), F.sum(n), F.sum(failed), F.sum(failed.cast("double") * failed / n), F.sum(n.cast("double") * n)
    ).first()
    n_hosts, n_docs, n_failed, squares, sizes = (value or 0 for value in seen)
    strength = fitted_strength(n_hosts, n_docs, n_failed, squares, sizes)
    mean = n_failed / n_docs if n_docs else 0.0
    shrunk = (failed + F.lit(mean * strength)) / (n + F.lit(strength))
    # whole numbers, so that a host exactly as the mean is on no side of it by rounding
    worse_by = failed.cast("decimal(19,0)") * F.lit(n_docs).cast("decimal(19,0)") - n.cast(
        "decimal(19,0)"
    ) * F.lit(n_failed).cast("decimal(19,0)")
    deviation = F.sqrt(shrunk * (1 - shrunk) / (n + F.lit(strength + 1))) * (n + F.lit(strength)) * n_docs
    worse = worse_by.cast("double") >= F.lit(NormalDist().inv_cdf(watch)) * deviation
    verdict = F.when(shrunk >= reject, "rejected").when(worse, "watched").otherwise("trusted")
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("verdict", verdict)


def _stays() -> Column:
    return ~F.col("base_failed") & (
        (F.col("verdict") == "trusted") | ((F.col("verdict") == "watched") & ~F.col("rule_failed"))
    )


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
           watch: float = WATCH, reject: float = REJECT, carry: list[str] | None = None) -> DataFrame:
    """Measures, host verdict and ``kept`` of every document, one row each.

    The document's columns ``carry``, by default all, are in the struct ``doc``.
    They are stored with the measures, so that texts are measured once. Null text
    is empty and fails the base rules; texts of any length are measured whole;
    documents without a host share one; repeated rows are judged each and all
    counted. An empty table gives no rows.
    """
    rows = docs.withColumn("_doc_id", docs[id_col])
    carried = ["_doc_id", *(carry or docs.columns)]
    rows = stored(measured(rows, text_col, host_col, carried), "measures")
    verdicts = host_verdicts(rows, watch, reject).select("host", "verdict")
    rows = rows.withColumn("doc_id", F.col("doc._doc_id")).withColumn("doc", F.col("doc").dropFields("_doc_id"))
    return join_salted(rows, verdicts, "host", "doc_id").withColumn("kept", _stays())


def passed(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that rules and hosts let pass, with all their columns.

    Documents that fail a base rule are stored as counts of their host only.
    """
    rows = measured(docs, text_col, host_col)
    rows = stored(
        rows.select(F.when(~F.col("base_failed"), F.col("doc")).alias("doc"), "host", "base_failed", "rule_failed"),
        "measures",
    )
    verdicts = host_verdicts(rows).select("host", "verdict")
    spread = rows.withColumn("_spread", F.monotonically_increasing_id())
    kept = join_salted(spread, verdicts, "host", "_spread").where(_stays())
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS body FROM documents),
words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT r, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS w FROM texts)),
windows AS (
  SELECT r, i, word, lead(word) OVER o AS second, lead(word, 2) OVER o AS third FROM words
  WINDOW o AS (PARTITION BY r ORDER BY i)),
often AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, word, second, third) AS n FROM windows
                    WHERE third IS NOT NULL) WHERE n > 1),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM often, (VALUES (0), (1), (2)) s(k) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(body, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
counts AS (
  SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY r),
measures AS (
  SELECT doc_id, host, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM texts LEFT JOIN counts USING (r) LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words
           OR 100 * n_symbols > {SYMBOL_PERCENT} * n_words OR 100 * n_dup_lines > {DUP_LINE_PERCENT} * n_lines
           OR word_chars < {MEAN_WORD[0]} * n_words OR word_chars > {MEAN_WORD[1]} * n_words AS rule_failed
  FROM measures),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE rule_failed) AS f FROM judged GROUP BY host),
totals AS (SELECT count(*) AS k, CAST(sum(n) AS HUGEINT) AS docs, CAST(sum(f) AS HUGEINT) AS failed,
           sum(f::DOUBLE * f / n) AS squares, sum(n::DOUBLE * n) AS sizes FROM hosts),
moments AS (SELECT *, failed / docs AS mean, failed / docs * (1 - failed / docs) AS variance,
                   docs - sizes / docs - (k - 1) AS room FROM totals),
spread AS (SELECT *, CASE WHEN variance > 0 AND room > 0
                          THEN ((squares - failed * mean) / variance - (k - 1)) / room ELSE 0 END AS between FROM moments),
prior AS (SELECT *, CASE WHEN between > 0 THEN least({MAX_STRENGTH}::DOUBLE, greatest(1.0::DOUBLE, 1 / between - 1))
                         ELSE {MAX_STRENGTH}::DOUBLE END AS strength FROM spread),
verdicts AS (SELECT host, (f + mean * strength) / (n + strength) AS rate,
                    CAST(f AS HUGEINT) * docs >= CAST(n AS HUGEINT) * failed AS worse FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate < {REJECT} AND NOT (worse AND rule_failed) AS kept,
       CASE WHEN rate >= {REJECT} THEN 'rejected' WHEN worse THEN 'watched' ELSE 'trusted' END AS verdict
FROM judged JOIN verdicts USING (host)
"""
