from __future__ import annotations

import hashlib
import struct
from collections import defaultdict

import corpus_pipeline
import duckdb
import pytest
from llm.corpus import FOLDER, edge, nothing, slow_components
from llm.test_near_texts import slow_jaccard, slow_set
from tokenizers import Tokenizer

import __spark_entry__ as entry
from salesloom.llm import mixing, quality_rules
from salesloom.llm.queries import QUERIES, word_vocabulary
from salesloom.session import stored


def slow_pipeline(folder):
    documents = duckdb.sql(f"SELECT * FROM '{folder}/documents.parquet'")  # noqa: F841
    kept = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM ({quality_rules.SQL}) WHERE kept").fetchall()}
    docs = {r[0]: r for r in duckdb.sql("SELECT doc_id, text, source FROM documents").fetchall() if r[0] in kept}
    last = {}
    for doc_id in sorted(docs):
        last[docs[doc_id][1]] = doc_id
    docs = {i: docs[i] for i in sorted(last.values())}
    order = sorted(docs)
    labels = slow_components([slow_set(docs[i][1]) for i in order], lambda a, b: slow_jaccard(a, b) >= 0.8)
    first = defaultdict(list)
    for i, label in zip(order, labels, strict=True):
        first[label].append(i)
    docs = {min(ids): docs[min(ids)] for ids in first.values()}
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?)", list(docs.values()))
    taken = connection.execute(f"SELECT doc_id, size, taken FROM ({mixing.SQL})").fetchall()
    library, out = Tokenizer.from_file(word_vocabulary()), []
    for doc_id, size, words in taken:
        ids = library.encode(docs[doc_id][1], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        row = (
            doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )
        out += [row] * (words // size)
    return sorted(out)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_against_plain_version(spark, folder):
    found = sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).collect())
    assert found == slow_pipeline(folder)


def test_every_stage_takes_awkward_tables(spark):
    for docs in (edge(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stored(stage(spark, docs, FOLDER), "stage")
            assert out.columns == docs.columns, name
            assert out.count() <= 2 * docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()


def test_registered():
    names = {*QUERIES, "pipeline"}
    assert names <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
