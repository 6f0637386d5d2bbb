"""From raw documents to token ids: rules, exact and near copies, the mix, encoding.

Every stage is a function of (spark, docs, folder), is written as Parquet and
read again as the documents of the next one, so that a stage is worked once and
a lost executor costs no more than its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import bpe, exact_dedup, mixing, near_texts, quality_rules
from salesloom.llm.queries import word_vocabulary
from salesloom.llm.tables import corpus_table
from salesloom.session import stored


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rules and their host's verdict let pass.

    Null and empty texts have too few words and go; documents without a source
    are one host; repeated rows are judged each; an empty table stays empty.
    """
    return quality_rules.passed(docs)


def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each text.

    That with the largest id, null ids last; null text is empty text, and rows
    alike in id and text leave one. Texts of any length are compared whole.
    """
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: texts that share 0.8 of their runs of five words.

    That with the smallest id, null ids last. Null, empty and wordless texts are
    copies of each other; rows alike in id and text leave one.
    """
    return near_texts.drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them, up to twice.

    Every row is drawn for itself, also of repeated ids; null is a source of its
    own; documents without words come as often as their source is whole.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of every document of the mix, a row per row; null text has no tokens."""
    return bpe.digests(docs, word_vocabulary())


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]

# SimHash, the mix's draw from what it leaves and the encoding have no SQL; the
# pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = corpus_table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
