"""Byte-level byte-pair encoding and decoding, with a segment tree over byte positions.

Text is cut into pieces by a pattern, and each piece is encoded on its own. A
piece that is a token is that token. In any other, every byte starts as a token,
and a segment tree over the byte positions keeps, for each token that is still
there, the rank of the pair it makes with the next one; every node holds the
least rank below it and the leftmost place of it. A merge takes the root's pair,
and then the only pairs that changed are those of the merged token and of its
neighbour on the left, so three leaves are set, each in logarithmic time.
Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.tables import ids_and_texts

CACHED_PIECES = 500_000  # twice as many are remembered, all short, by each worker
CACHED_CHARS = 64
NEVER = (1 << 63) - 1
SHORT = 1 << 12  # bytes up to which a tree is a list, which is quicker than an array but takes more room


def merged(piece: bytes, rank_of: Callable[[bytes], int | None]) -> list[bytes]:
    """The tokens of a piece after all merges: the lowest rank first, of equal ones the leftmost."""
    n = len(piece)
    bits = max(1, (n - 1).bit_length())
    size = 1 << bits
    # rank and place in one number: the least is the leftmost pair of the lowest rank
    tree = [NEVER] * (2 * size) if n <= SHORT else array("q", [NEVER]) * (2 * size)
    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << bits | i
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    # a token lies at its first byte; before and after are its live neighbours
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    while (least := tree[1]) != NEVER:
        i = least & size - 1
        j = after[i]
        k = after[i] = after[j]
        rank = None
        if k < n:
            before[k] = i
            rank = rank_of(piece[i : after[k]])
        changes = [(j, NEVER), (i, NEVER if rank is None else rank << bits | i)]
        h = before[i]
        if h >= 0:
            rank = rank_of(piece[h:k])
            changes.append((h, NEVER if rank is None else rank << bits | h))
        for place, value in changes:
            node = place + size
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                if other < value:
                    value = other
                if tree[node] == value:
                    break  # nothing above changes either
                tree[node] = value
    tokens, i = [], 0
    while i < n:
        tokens.append(piece[i : after[i]])
        i = after[i]
    return tokens


class KnownPieces(dict):
    """Ids of pieces, as bytes of 32-bit numbers; short pieces are remembered.

    Once full, what is known becomes the older half, of which a piece comes back when it is met again.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.older = ranks, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode()
            tokens = [data] if data in self.ranks else merged(data, self.ranks.get)
            ids = array("I", [self.ranks[token] for token in tokens]).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class ByteBpe:
    """A rank file (one base64 token and its rank a line), and the pattern that cuts text."""

    def __init__(self, content: bytes, pattern: str):
        self.ranks: dict[bytes, int] = {}
        for line in content.splitlines():
            if line.strip():
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.known = KnownPieces(self.ranks)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.pieces(text))), dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@cache
def tokenizer(content: bytes, pattern: str) -> ByteBpe:
    return ByteBpe(content, pattern)


def encoded(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``ids`` (token ids) and ``decoded`` (bytes) of every whole text.

    ``ranks`` is the path of the rank file on the driver; its content, of a fixed
    size, goes to the tasks. Null and empty texts have no ids and decode to no
    bytes. A very long text, or a very long piece of one, is encoded whole, in time
    that grows as n log n and some 60 bytes of memory per byte of the piece. What
    the pattern doesn't match is left out, as the library does. Repeated rows give
    repeated rows, an empty table none, and no other column is read.
    """

    def result(bpe: ByteBpe, ids: np.ndarray) -> tuple:
        return ids.tolist(), bpe.decode(ids)

    return _each_text(docs, ranks, pattern, id_col, text_col, result, "ids array<int>, decoded binary")


def digests(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """As ``encoded``, with ``n_tokens`` and digests in place of ids and bytes.

    ``ids_sha256`` is that of the decimal ids joined by one space, ``decoded_sha256``
    that of the decoded bytes.
    """

    def result(bpe: ByteBpe, ids: np.ndarray) -> tuple:
        return len(ids), _sha(" ".join(map(str, ids.tolist())).encode()), _sha(bpe.decode(ids))

    layout = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _each_text(docs, ranks, pattern, id_col, text_col, result, layout)


def _each_text(docs, ranks, pattern, id_col, text_col, result, layout) -> DataFrame:
    with open(ranks, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf(layout)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(content.value, pattern)
        names = [column.split()[0] for column in layout.split(", ")]
        for texts in batches:
            yield pd.DataFrame([result(bpe, bpe.encode(text)) for text in texts], columns=names)

    rows = ids_and_texts(docs, id_col, text_col)
    return rows.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
