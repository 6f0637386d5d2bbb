from __future__ import annotations

import hashlib
import struct

from llm.corpus import edge, edge_rows, given_docs, nothing
from tokenizers import Tokenizer

from salesloom.llm import bpe
from salesloom.llm.queries import word_vocabulary

HARD = [
    "", "   ", "ΑΣ ΟΔΟΣ. Σ", "İstanbul ǅ ſ ẞ ﬁ", "<|startoftext|>Hi<|endoftext|> <|ENDOFTEXT|> x<|endoftext|",
    "don't we'LL  I'VE\t\n\x0b\x1c\x85\xa0 z's", "日本語 123 ４５ ½ Ⅷ", "🙂🙂!!??", "﻿​\x00 a", "a" * 3000,
    "ẛ̣ ̈́ é", "abab" * 200, "aaaaaaab " * 50,
]


def library():
    return Tokenizer.from_file(word_vocabulary())


def test_ids_and_text_are_the_library_s():
    theirs, ours = library(), bpe.tokenizer(bpe._read(word_vocabulary()))
    for text in HARD + [t or "" for _, t, _ in given_docs()]:
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert list(ours.encode(text)) == ids
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_words_survive_the_round_trip():
    ours = bpe.tokenizer(bpe._read(word_vocabulary()))
    back = ours.decode(ours.encode("plain words survive the trip")).replace(" ", "").replace("</w>", " ")
    assert back.strip() == "plain words survive the trip"


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    ours = bpe.Bpe(bpe._read(word_vocabulary()))
    for _, text, _ in given_docs()[:20]:
        assert list(ours.encode(text or "")) == library().encode(text or "", add_special_tokens=False).ids


def test_edges(spark):
    theirs = library()
    want = []
    for doc_id, text, *_ in edge_rows():
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        want.append((
            doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        ))
    found = [tuple(r) for r in bpe.digests(edge(spark), word_vocabulary()).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    whole = {r.doc_id: r for r in bpe.encoded(edge(spark), word_vocabulary()).collect()}
    assert list(whole[4].ids) == theirs.encode("x y z", add_special_tokens=False).ids
    assert whole[2].ids == [] and whole[2].decoded == ""
    assert bpe.digests(nothing(spark), word_vocabulary()).count() == 0


def test_texts_reach_python_in_small_batches_and_few_words_are_remembered(spark, monkeypatch):
    for run in (bpe.digests, bpe.encoded):
        plan = run(edge(spark), word_vocabulary())._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    monkeypatch.setattr(bpe, "CACHED_WORDS", 5)
    ours = bpe.Bpe(bpe._read(word_vocabulary()))
    for text in ["a b c d e f g h", "a a b i j k l m n o p q a"]:
        assert list(ours.encode(text)) == library().encode(text, add_special_tokens=False).ids
    assert len(ours.known) <= 5 and len(ours.older) <= 5
