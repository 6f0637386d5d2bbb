from __future__ import annotations

import hashlib
import random

import public_tokenizers
import tiktoken
from llm.corpus import edge, edge_rows, given_docs, nothing

from salesloom.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
HARD = [
    "", "   ", " \x1c\x1d\x1e\x1f x", "a\x85b\xa0 c 　d", "don't we'LL  I'VE\t\n\x0b\x1c z's",
    "日本語 123 ４５ ½ Ⅷ ٣", "🙂🙂!!?? 👩‍👩‍👧", "﻿​\x00 a", "a" * 3000, "ẛ̣ ̈́ é", "abab" * 200, "aaaaaaab " * 50,
    "<|endoftext|>", "\n\n\n  x", "é" * 501, " " * 700 + "x", "=-" * 400,
]


def library():
    import base64

    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ours():
    with open(RANKS, "rb") as file:
        return byte_bpe.ByteBpe(file.read(), public_tokenizers.PATTERN)


def test_ids_and_bytes_are_the_library_s():
    theirs, mine = library(), ours()
    for text in HARD + [t or "" for _, t, _ in given_docs()]:
        ids = theirs.encode_ordinary(text)
        assert mine.encode(text).tolist() == ids
        assert mine.decode(mine.encode(text)) == theirs.decode_bytes(ids)


def test_random_texts_of_any_letters():
    theirs, mine, dice = library(), ours(), random.Random(5)
    pools = ["ab", "abcdefgh ", " \n\t\r\x0b\x85\xa0 ", "'stremvld ", "éßñ ÀÿĀ", "".join(map(chr, range(0x20, 0x3000, 7)))]
    for _ in range(4000):
        pool = dice.choice(pools) + dice.choice(pools)
        text = "".join(dice.choices(pool, k=dice.randrange(120)))
        assert mine.encode(text).tolist() == theirs.encode_ordinary(text), repr(text)


def plainly_merged(piece, ranks):
    tokens = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(tokens, tokens[1:], strict=False)) if a + b in ranks]
        if not pairs:
            return tokens
        _, i = min(pairs)
        tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]


def test_merges_take_the_leftmost_of_the_lowest_rank(monkeypatch):
    """Any ranks, also of tokens longer than their parts reach, with trees as lists and as arrays."""
    dice = random.Random(2)
    for short in (0, 4096):
        monkeypatch.setattr(byte_bpe, "SHORT", short)
        for _ in range(400):
            words = {bytes(dice.choices(b"abc", k=dice.randrange(2, 7))) for _ in range(30)}
            ranks = {word: rank for rank, word in enumerate(dice.sample(sorted(words), len(words)))}
            piece = bytes(dice.choices(b"abc", k=dice.randrange(1, 50)))
            assert byte_bpe.merged(piece, ranks.get) == plainly_merged(piece, ranks)


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 3)
    mine = ours()
    for _, text, _ in given_docs()[:20]:
        assert mine.encode(text or "").tolist() == library().encode_ordinary(text or "")


def test_edges(spark):
    theirs = library()

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    want = []
    for doc_id, text, *_ in edge_rows():
        ids = theirs.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())))
    found = [tuple(r) for r in byte_bpe.digests(edge(spark), RANKS, public_tokenizers.PATTERN).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    whole = byte_bpe.encoded(edge(spark), RANKS, public_tokenizers.PATTERN).collect()
    texts = {(r.doc_id, bytes(r.decoded).decode()) for r in whole}
    assert texts == {(doc_id, text or "") for doc_id, text, *_ in edge_rows()}
    assert byte_bpe.digests(nothing(spark), RANKS, public_tokenizers.PATTERN).count() == 0
