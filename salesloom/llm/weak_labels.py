"""A quality classifier from heuristic labellers that overlap and disagree.

Each labeller looks at a whole text and votes junk, good or nothing. No labels
are needed: expectation-maximisation estimates how often each labeller votes
what for good and for junk documents, from all documents of the corpus. They
come in as counts per pattern of votes, of which there are at most 3 to the
number of labellers, so the estimate sees every document at any size. A
pattern's posterior then is the label of its documents. A linear scorer on
hashed features of words and their shapes learns these soft labels from a
bounded sample and scores all documents, so that documents on which every
labeller is silent are judged too.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from salesloom.llm.quality_rules import SYMBOLS, measure
from salesloom.llm.tables import ids_and_texts

LABELLERS = ("symbols", "repeats", "variety", "capitals", "words", "lines", "cells", "sentences", "shouts")
JUNK, GOOD, SILENT = 1, 0, 2
BUCKETS = 1 << 14
SAMPLE = 8000  # bound of the training sample
SAMPLE_FEATURES = 2000  # a text with more features than this is not in the sample
PRIOR_JUNK = 0.1
#: Votes good, junk, silent on a good and on a junk document, before anything is seen.
START = np.array([[0.6, 0.05, 0.35], [0.15, 0.5, 0.35]])
STEPS = 100
EPOCHS = 8
RATE = 0.3
SEED = 5

_SHAPE = bytes(
    ord("X") if 65 <= c <= 90 else ord("x") if 97 <= c <= 122 or c >= 128 else ord("9") if 48 <= c <= 57 else c
    for c in range(256)
)


#: Whole words of letters, with one closing mark at most.
_CLEAN_WORD = re.compile(rb"(?<![^\x20\x09-\x0D])[A-Za-z\x80-\xff]+[.,;:?]?(?![^\x20\x09-\x0D])")


def votes(text: str) -> str:
    """One digit per labeller: 1 junk, 0 good, 2 silent. Without words all are silent but one."""
    n_words, _, n_symbols, n_lines, n_dup_lines, n_repeat = measure(text)
    if not n_words:
        return "".join(str(JUNK if name == "words" else SILENT) for name in LABELLERS)
    data = text.encode()
    distinct = len(set(data.split()))
    clean = len(_CLEAN_WORD.findall(data))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    capitals = int(counts[65:91].sum())
    letters = capitals + int(counts[97:123].sum())
    ends = sum(map(text.count, (". ", ".\n", ", "))) + text.endswith(".")

    def high(value: float, junk: float, of: float = n_words) -> int:
        return JUNK if of and value >= junk * of else SILENT

    return "".join(map(str, (
        high(n_symbols, 0.1),
        high(n_repeat, 0.4),
        JUNK if n_words >= 20 and distinct < 0.25 * n_words else GOOD if distinct >= 0.5 * n_words else SILENT,
        JUNK if capitals >= 0.3 * letters else GOOD if capitals <= 0.1 * letters else SILENT,
        JUNK if clean < 0.7 * n_words else GOOD if clean >= 0.9 * n_words else SILENT,
        high(n_dup_lines, 0.3, n_lines if n_lines > 3 else 0),
        high(text.count("|") + text.count("\t"), 0.1),
        GOOD if 0.02 * n_words <= ends <= 0.3 * n_words else SILENT,
        high(text.count("!"), 0.1),
    )))


_votes = F.pandas_udf(lambda texts: pd.Series([votes(t) for t in texts], dtype=object), StringType())


class LabelModel:
    """``table[j, c, v]``: how likely labeller j votes v on a document of class c."""

    def __init__(self, prior: float, table: np.ndarray):
        self.prior, self.table = prior, table

    @staticmethod
    def as_array(patterns: list[str]) -> np.ndarray:
        return np.array([[int(v) for v in p] for p in patterns], np.int64).reshape(len(patterns), -1)

    def posterior(self, patterns: list[str]) -> np.ndarray:
        """Probability of junk. Silence counts as a vote: a labeller that sees only junk speaks less on good text."""
        rows = self.as_array(patterns)
        logs = np.log([1 - self.prior, self.prior]) * np.ones((len(rows), 2))
        for j in range(rows.shape[1]):
            logs += np.log(self.table[j][:, rows[:, j]]).T
        logs -= logs.max(axis=1, keepdims=True)
        odds = np.exp(logs)
        return odds[:, 1] / odds.sum(axis=1)

    def accuracies(self) -> dict[str, float]:
        """Of each labeller: how likely a vote of its own, not silence, is right at the estimated share of junk."""
        out = {}
        for name, t in zip(LABELLERS, self.table, strict=True):
            joint = t * [[1 - self.prior], [self.prior]]
            out[name] = float((joint[GOOD, GOOD] + joint[JUNK, JUNK]) / joint[:, :SILENT].sum())
        return out

    @classmethod
    def fitted(cls, counts: dict[str, int], steps: int = STEPS) -> LabelModel:
        """Expectation-maximisation from the start that labellers are more often right than wrong.

        Votes are smoothed by one document, so no probability is zero; the
        share of junk stays within 0.1 and 50 per cent, which tells the two classes apart.
        """
        width = len(LABELLERS)
        model = cls(PRIOR_JUNK, np.tile(START, (width, 1, 1)))
        patterns = sorted(counts)
        if not patterns:
            return model
        rows, weight = cls.as_array(patterns), np.array([counts[p] for p in patterns], float)
        for _ in range(steps):
            junk = model.posterior(patterns)
            table = np.tile(START, (width, 1, 1))
            for c, share in ((GOOD, 1 - junk), (JUNK, junk)):
                for v in (GOOD, JUNK, SILENT):
                    table[:, c, v] += ((rows == v) * (share * weight)[:, None]).sum(axis=0)
            table /= table.sum(axis=2, keepdims=True)
            prior = float(np.clip((junk * weight).sum() / weight.sum(), 0.001, 0.5))
            done = abs(prior - model.prior) < 1e-9 and np.abs(table - model.table).max() < 1e-9
            model = cls(prior, table)
            if done:
                break
        return model


@lru_cache(100_000)
def _buckets(shape: bytes) -> tuple[int, ...]:
    """What a word of this shape looks like: its ends and its length."""
    names = (b"ends " + shape[-3:], b"starts " + shape[:2], b"long %d" % min(len(shape) // 4, 6))
    return tuple(zlib.crc32(name) % BUCKETS for name in names)


def features(text: str) -> dict[int, float]:
    """Hashed shares of word shapes, symbols and repeats: the root of each share, so at most 1."""
    data = text.encode()
    words = data.split()
    n = len(words)
    times: Counter[int] = Counter()
    for shape, count in Counter(data.translate(_SHAPE).split()).items():
        for at in _buckets(shape):
            times[at] += count
    named = {b"again": n - len(set(words)), b"same as before": sum(map(eq, words, words[1:]))}
    named |= {b"symbol " + c.encode(): text.count(c) for c in SYMBOLS + "!\t"}
    for name, count in named.items():
        if count:
            times[zlib.crc32(name) % BUCKETS] += count
    found = {at: (count / n) ** 0.5 if n else 0.0 for at, count in times.items()}
    found[zlib.crc32(b"bias") % BUCKETS] = 1.0
    found[zlib.crc32(b"size %d" % n.bit_length()) % BUCKETS] = 1.0
    return found


def fit(rows: list[tuple[list[int], list[float]]], soft: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> np.ndarray:
    """Weights of a logistic scorer of junk, by Adagrad on soft labels."""
    weights, sums = np.zeros(BUCKETS), np.full(BUCKETS, 1e-3)
    chance = np.random.default_rng(seed)
    ready = [(np.array(i, np.int64), np.array(v, float)) for i, v in rows]
    for _ in range(epochs):
        for n in chance.permutation(len(ready)):
            at, value = ready[n]
            step = (1 / (1 + np.exp(-np.clip(weights[at] @ value, -30, 30))) - soft[n]) * value
            sums[at] += step * step
            weights[at] -= rate * step / np.sqrt(sums[at])
    return weights


def sample(docs: DataFrame, limit: int = SAMPLE) -> list[tuple[list[int], list[float], str]]:
    """Features and votes of at most ``limit`` documents, those least by a hash of the id.

    The ids are chosen first, so only their texts are measured; a repeated id has one text.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = docs.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(*order).limit(limit)
    chosen = docs.join(F.broadcast(ids.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))
    chosen = chosen.groupBy("doc_id").agg(F.min("text").alias("text"))

    @F.pandas_udf("at array<int>, value array<double>")
    def cut(texts: pd.Series) -> pd.DataFrame:
        found = [features(t) for t in texts]
        return pd.DataFrame({"at": [list(f) for f in found], "value": [list(f.values()) for f in found]})

    rows = chosen.select("doc_id", cut("text").alias("f"), _votes("text").alias("votes"))
    rows = rows.where(F.size("f.at") <= SAMPLE_FEATURES).orderBy(*order)
    return [(r.f["at"], r.f["value"], r.votes) for r in rows.collect()]


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``votes``, ``label`` (posterior of good), ``score`` and ``kept``, one row per row.

    ``score`` is the scorer's probability that the document is good, ``kept``
    that it is 0.5 or more. Null and empty texts are voted junk by the labeller of words.
    Where classes tie a document is kept. Repeated rows count in the estimate
    and are scored alike. An empty table gives no rows. Other columns are not read.

    The estimate takes all documents; the scorer learns from at most ``limit``
    texts of at most ``SAMPLE_FEATURES`` features. Every text is voted on and
    scored whole, however long.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    counts = {r["votes"]: r["n"] for r in rows.groupBy(_votes("text").alias("votes")).agg(F.count("*").alias("n")).collect()}
    model = LabelModel.fitted(counts)
    drawn = sample(rows, limit)
    weights = fit([(at, value) for at, value, _ in drawn], model.posterior([v for _, _, v in drawn]) if drawn else np.zeros(0))
    patterns = sorted(counts)
    labels = dict(zip(patterns, (1 - model.posterior(patterns)).tolist(), strict=True)) if patterns else {}
    shared = docs.sparkSession.sparkContext.broadcast((labels, weights))

    @F.pandas_udf("votes string, label double, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, learned = shared.value
        for texts in batches:
            out = []
            for text in texts:
                pattern, found = votes(text), features(text)
                logit = sum(learned[at] * value for at, value in found.items())
                out.append((pattern, known[pattern], 1 / (1 + np.exp(np.clip(logit, -30, 30)))))
            yield pd.DataFrame(out, columns=["votes", "label", "score"])

    scored = rows.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")
    return scored.withColumn("kept", F.col("score") >= 0.5)
