"""The registered queries of the corpus operators, each with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import (
    bpe,
    byte_bpe,
    exact_dedup,
    html_text,
    importance,
    mixing,
    pii,
    quality_rules,
    simhash,
    spelling,
    toxicity,
    warc_audit,
    weak_labels,
)
from salesloom.llm.tables import corpus_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def word_vocabulary() -> str:
    """The vocabulary file that op7 and the pipeline use, where the box keeps it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_semi_markov_pii")
def semi_markov_pii(spark, folder):
    return pii.found(corpus_table(spark, folder, "documents"))


@query("op2_host_rules", quality_rules.SQL)
def host_rules(spark, folder):
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept verdict"
    rows = quality_rules.judged(corpus_table(spark, folder, "documents"), carry=["doc_id"])
    return rows.select(*columns.split())


@query("op3_pareto_mix", mixing.SQL)
def pareto_mix(spark, folder):
    taken = mixing.mix(corpus_table(spark, folder, "documents"), carry=["doc_id"])
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_toxicity_cnn")
def toxicity_cnn(spark, folder):
    return toxicity.scored(
        corpus_table(spark, folder, "documents"), corpus_table(spark, folder, "labels")
    )


@query("op5_simhash_groups")
def simhash_groups(spark, folder):
    return simhash.near_groups(corpus_table(spark, folder, "documents"))


@query("op6_merkle_audit", warc_audit.SQL)
def merkle_audit(spark, folder):
    pages = corpus_table(spark, folder, "pages")
    index = warc_audit.records(pages)
    replica = warc_audit.records(pages, damage=warc_audit.sampled_damage(pages["page_id"]))
    return warc_audit.audit(index, replica)


@query("op7_word_bpe")
def word_bpe(spark, folder):
    return bpe.digests(corpus_table(spark, folder, "documents"), word_vocabulary())


@query("op8_tag_path_text")
def tag_path_text(spark, folder):
    return html_text.extracted(corpus_table(spark, folder, "pages"))


@query("op9_weak_label_quality")
def weak_label_quality(spark, folder):
    return weak_labels.judged(corpus_table(spark, folder, "documents"))


@query("op10_digest_runs", exact_dedup.SQL)
def digest_runs(spark, folder):
    return exact_dedup.exact_groups(corpus_table(spark, folder, "documents"))


@query("op11_byte_bpe")
def byte_bpe_tokens(spark, folder):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(corpus_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query("op12_importance_lines")
def importance_lines(spark, folder):
    return importance.resampled(
        corpus_table(spark, folder, "documents"), corpus_table(spark, folder, "benchmark")
    )


@query("op13_spelling_variants")
def spelling_variants(spark, folder):
    return spelling.variants(corpus_table(spark, folder, "documents"))
