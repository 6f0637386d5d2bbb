"""Spelling variants: words one edit apart, grouped under their most frequent form.

A bit-sliced position index holds, for each place and letter, the set of words
that have the letter there, as one bit per word. A query word is compared with
all words of the index at once. Reading its letters one by one, four sets are
carried along: words equal so far, words with one letter replaced, with one
letter more, and with one letter less. Each step is one conjunction of a set
with that of a place and letter, where the place is shifted by one to the right
or left once a letter was added or missing.

Words are dealt into shards in which any two that are one edit apart meet
exactly once. Such a pair has a shorter length k and a common beginning of e
letters; for a range lo <= e < hi both words begin with the same lo letters and
end with the same k - hi. So a shard is a range with these letters, and takes
the pairs whose common beginning ends in its range. The first ranges are the two
halves of a word; a shard with too many words is dealt out again by the halves
of its range, down to one place, where all letters but one are given.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.tables import ids_and_texts
from salesloom.session import stored

RUNS = r"[A-Za-zÀ-ÿ]+"  # as the regular expressions of the JVM read it
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOSES_A_LETTER = 97
MIN_LETTERS = 5
MIN_COUNT = 3
FORM_RATIO = 2
SHARD_WORDS = 2048

SHARD = ["k", "lo", "hi", "head", "tail"]


class PositionIndex:
    """Bitsets over a list of words: those with a letter at a place, and those of a length."""

    def __init__(self, words: list[str]):
        self.every = (1 << len(words)) - 1
        self.long: dict[int, int] = {}
        # two places more than letters, as queries look one place ahead
        self.at: list[dict[str, int]] = [{} for _ in range(max(map(len, words), default=0) + 2)]
        for number, word in enumerate(words):
            bit = 1 << number
            self.long[len(word)] = self.long.get(len(word), 0) | bit
            for letters, letter in zip(self.at, word, strict=False):
                letters[letter] = letters.get(letter, 0) | bit

    def near(self, word: str, k: int, lo: int, hi: int) -> int:
        """The set of words one edit from ``word``, as pairs of shorter length k.

        Only those whose common beginning with ``word`` has lo to hi - 1 letters;
        all words of the index share its first ``lo`` letters.
        """
        at, n = self.at, len(word)
        same, replaced, more, less, beyond = self.every, 0, 0, 0, 0
        for i in range(lo, n):
            letter = word[i]
            here = at[i].get(letter, 0)
            # a letter more: the words stand one place further right, and may skip a place anywhere
            more = (more | same) & at[i + 1].get(letter, 0)
            # a letter less: one place to the left, or this letter is the one they lack
            less = less & at[i - 1].get(letter, 0) | same if i > lo else same
            replaced = replaced & here | same & ~here
            same &= here
            if i + 1 == hi:
                beyond = same
            if not (same or replaced or more or less):
                return 0
        if n == k:
            found = replaced & self.long.get(k, 0) | (more | same) & self.long.get(k + 1, 0)
        else:
            found = less & self.long.get(k, 0)
        return found & ~beyond


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the words long and frequent enough; ``docs`` has doc_id and text."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUNS), F.lit(0))).alias("run"))
    run = F.col("run")
    # lower() is quick for ASCII; other words keep all letters but A-Z
    ascii_only = F.length(run) == F.octet_length(run)
    runs = runs.withColumn("run", F.when(ascii_only, F.lower(run)).otherwise(F.translate(run, CAPITALS, SMALL)))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run"))
    runs = runs.withColumn("h", h)
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.left("run", place), F.substring("run", place + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % LOSES_A_LETTER == 0, shorter).otherwise(F.col("run")).alias("word"))
    long_enough = words.where(F.length("word") >= MIN_LETTERS)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def _dealt(rows: DataFrame, lo: Column, middle: Column, hi: Column) -> DataFrame:
    """Words with the two halves of a range, and the letters that the words of these shards share."""

    def half(lo: Column, hi: Column) -> Column:
        return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))

    ranges = rows.select("word", "n", "k", F.inline(F.array(half(lo, middle), half(middle, hi))))
    tail = F.right("word", F.greatest(F.col("k") - F.col("hi"), F.lit(0)))
    return ranges.withColumns({"head": F.left("word", F.col("lo")), "tail": tail})


def shards(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The words of each shard, the most frequent first, for shards of at least two.

    ``words`` has word and n and is read several times. A shard has at most
    ``shard_words`` words, or the words that differ in one place or two next to
    each other, no more than the square of the alphabet.
    """
    length = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("k"))
    rows = _dealt(rows.where(F.col("k") >= MIN_LETTERS), F.lit(0), F.expr("k div 2"), F.col("k") + 1)
    settled = None
    while True:
        sizes = rows.groupBy(*SHARD).agg(F.count("*").alias("words"))
        large = stored(sizes.where((F.col("words") > shard_words) & (F.col("hi") - F.col("lo") > 1)).select(*SHARD), "large")
        fitting = rows if (done := large.isEmpty()) else rows.join(large, SHARD, "left_anti")
        settled = fitting if settled is None else settled.unionByName(fitting)
        if done:
            break
        again = rows.join(large, SHARD, "left_semi")
        rows = stored(_dealt(again, F.col("lo"), F.expr("(lo + hi) div 2"), F.col("hi")), "halves")
    held = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "word"))).alias("held")
    together = settled.groupBy(*SHARD).agg(held).where(F.size("held") > 1)
    return together.select("k", "lo", "hi", F.col("held.word").alias("words"), F.transform("held.n", lambda n: -n).alias("ns"))


FOUND = T.StructType(
    [
        T.StructField("word", T.ArrayType(T.StringType())),
        T.StructField("n_near", T.ArrayType(T.LongType())),
        T.StructField("best", T.ArrayType(T.StringType())),
        T.StructField("best_n", T.ArrayType(T.LongType())),
    ]
)


@F.pandas_udf(FOUND)
def _near_words(k: pd.Series, lo: pd.Series, hi: pd.Series, words: pd.Series, ns: pd.Series) -> pd.DataFrame:
    rows = []
    for shard, held, counts in zip(zip(k, lo, hi, strict=True), words, ns, strict=True):
        held, found = list(held), []
        index = PositionIndex(held)
        for word in held:
            if near := index.near(word, *shard):
                best = (near & -near).bit_length() - 1  # the first is the most frequent
                found.append((word, near.bit_count(), held[best], counts[best]))
        rows.append([list(column) for column in zip(*found, strict=True)] or [[], [], [], []])
    return pd.DataFrame(rows, columns=["word", "n_near", "best", "best_n"])


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word``, ``n_near`` and the most frequent near word, ``best`` with ``best_n``, where there is one."""
    found = shards(words, shard_words).select(_near_words("k", "lo", "hi", "words", "ns").alias("f"))
    each = found.select(F.inline(F.arrays_zip("f.word", "f.n_near", "f.best", "f.best_n")))
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("first")
    return each.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("first.word").alias("best"), (-F.col("first.n")).alias("best_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of the chain of forms; ``forms`` has word and form, none null.

    Each round doubles the steps that every word has gone, so rounds grow with
    the logarithm of the longest chain, itself at most the logarithm of a count.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(now.join(ahead, "root", "left").select("word", "root", "further"), "roots")
        if step.where("further IS NOT NULL").isEmpty():
            return now
        now = step.select("word", F.coalesce("further", "root").alias("root"))


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS
) -> DataFrame:
    """Words of all texts with the form they are a variant of.

    One row per word of at least 5 letters and 3 occurrences: ``word``, ``n``,
    ``n_near`` (words one edit away), ``form`` (the most frequent of these, of
    equal ones the first in code-point order, if at least twice as frequent as the
    word, else null) with ``form_n``, and ``root`` (where following forms ends, the
    word itself without a form).

    Null texts have no words. A null id counts as empty text in the hash that
    decides which runs lose a letter. Repeated rows count again. Texts and words
    of any length are read whole. No words, as of an empty table, give no rows.
    Other columns are not read.
    """
    words = stored(word_counts(ids_and_texts(docs, id_col, text_col)), "words")
    near = near_words(words, shard_words)
    is_form = F.col("best_n") >= FORM_RATIO * F.col("n")
    known = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
