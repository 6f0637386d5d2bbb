"""Byte-pair encoding and decoding.

The symbols of a word form a doubly linked list. A priority queue holds the
merges that are possible now, by rank and then by place; a merge joins two
neighbours, links the result and queues the two pairs it makes. An entry whose
symbols have changed since it was queued is stale and skipped. Decoding
concatenates the vocabulary strings of the ids.

Text is cut into words as the vocabulary file says: special tokens, then NFC,
white space to one space, lower case, and the file's pattern of words; bytes
are written as the printable letters of the byte-level alphabet.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Callable
from functools import cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.tables import ids_and_texts

CACHED_WORDS = 100_000  # a worker remembers as many words, and those it met in the same number before


def byte_letters() -> list[str]:
    """The letter of each byte: itself where printable in Latin-1, else from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Bpe:
    """A vocabulary file of the tokenizers library: BPE with a mark at the end of words."""

    def __init__(self, content: str):
        file = json.loads(content)
        model = file["model"]
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.suffix = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.special = special
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in special.items()}
        longest_first = sorted(special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if special else None
        pattern = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        letters = byte_letters()
        self.letters = {b: letters[b] for b in range(256)}
        # ids of words as bytes, which take less than half of an array's room
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges, always the lowest rank and then the leftmost first."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.ranks
        queue = [
            (ranks[pair], i, *pair) for i, pair in enumerate(zip(symbols, symbols[1:], strict=False)) if pair in ranks
        ]
        heapq.heapify(queue)
        alive = symbols[:]  # an absorbed symbol becomes empty
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if alive[i] != left or j >= n or alive[j] != right:
                continue  # stale
            alive[i], alive[j] = left + right, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair = (alive[i], alive[k])
                if pair in ranks:
                    heapq.heappush(queue, (ranks[pair], i, *pair))
            h = before[i]
            if h >= 0:
                pair = (alive[h], alive[i])
                if pair in ranks:
                    heapq.heappush(queue, (ranks[pair], h, *pair))
        return [s for s in alive if s]

    def word(self, word: str) -> bytes:
        """The ids of a word as the bytes of an array."""
        ids = self.known.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                symbols = [self.letters[b] for b in word.encode()]
                symbols[-1] += self.suffix
                vocab = self.vocab
                ids = array("I", [vocab[s] for s in self.merge(symbols)]).tobytes()
            if len(self.known) >= CACHED_WORDS:
                self.known, self.older = {}, self.known
            self.known[word] = ids
        return ids

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = regex.sub(r"\s+", " ", _nfc(text))
        return lower(text)

    def encode(self, text: str) -> array:
        ids = array("I")
        for piece in self.cut.split(text) if self.cut else [text]:
            if piece in self.special:
                ids.append(self.special[piece])
            elif piece:
                for word in self.words(self.normal(piece)):
                    ids.frombytes(self.word(word))
        return ids

    def decode(self, ids) -> str:
        """Vocabulary strings joined by a space, as the library does where a file names no decoder."""
        return " ".join(map(self.strings.__getitem__, ids))


def _nfc(text: str) -> str:
    import unicodedata

    return unicodedata.normalize("NFC", text)


def lower(text: str) -> str:
    """Lower case letter by letter, without the rule for a final sigma."""
    if "Σ" in text:
        return "".join(map(str.lower, text))
    return text.lower()


@cache
def tokenizer(content: str) -> Bpe:
    return Bpe(content)


def encoded(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (token ids) and ``decoded`` of every whole text.

    ``vocabulary`` is the path of the vocabulary file on the driver; its content
    goes to the tasks. Null and empty texts have no ids and decode to an empty
    text. Repeated rows give repeated rows, an empty table none.
    """

    def both(bpe: Bpe, text: str) -> tuple[list[int], str]:
        ids = bpe.encode(text)
        return ids.tolist(), bpe.decode(ids)

    return _each(docs, vocabulary, id_col, text_col, both, "ids array<int>, decoded string")


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encoded``, with digests in place of ids and text, made where they arise.

    ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers)
    and ``decoded_sha256`` (UTF-8).
    """

    def short(bpe: Bpe, text: str) -> tuple[int, str, str]:
        ids = bpe.encode(text)
        data = ids.tobytes() if little_endian else bytes_swapped(ids)
        return len(ids), sha(data), sha(bpe.decode(ids).encode())

    return _each(docs, vocabulary, id_col, text_col, short, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _each(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, found: Callable, layout: str) -> DataFrame:
    """``doc_id`` and what ``found`` makes of every text.

    Texts go to Python a hundred at a time: an Arrow batch would hold ten
    thousand whole texts, in the executor and again in each of its workers.
    """
    content = docs.sparkSession.sparkContext.broadcast(_read(vocabulary))
    bpe: list[Bpe] = []  # the tokenizer, once the task has its first text

    @F.udf(layout, useArrow=False)
    def run(text: str):
        if not bpe:
            bpe.append(tokenizer(content.value))
        return found(bpe[0], text)

    rows = ids_and_texts(docs, id_col, text_col)
    return rows.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


little_endian = array("I", [1]).tobytes() == b"\x01\x00\x00\x00"


def bytes_swapped(ids: array) -> bytes:
    turned = array("I", ids)
    turned.byteswap()
    return turned.tobytes()


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()
