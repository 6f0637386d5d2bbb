"""A convolutional text classifier for toxicity, trained in numpy.

A word's embedding is the sum of rows of one table, picked by hashes of the
word and of its first letters, so that inflected forms share what they learn.
Filters over one, two and three neighbouring words are max-pooled over the
text, and a linear layer gives a logit. Gradients reach only the places that
won the pooling. Words, not documents, are the unit of cost when scoring: a
word's products with all filters are computed once and kept.

Thresholds are calibrated by language on rows that training did not see. The
language is read off the text by its letters; the column ``lang`` is not used.
The score is the logistic function of the distance to the threshold, so 0.5 is
the cut in every language.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.tables import ids_and_texts

BUCKETS = 1 << 16
DIM = 16
FILTERS = 8  # of each width
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5, 6)
SAMPLE_PER_CLASS = 4000  # bound of the training sample
SAMPLE_CHARS = 50_000  # longest text of the training sample
EPOCHS = 4
RATE = 0.05
SEED = 11
FOLDS = 5
KEPT_WORDS = 150_000

# Letters that tell the languages apart; none of them is taken as English.
LETTERS = {"de": "äöüß", "es": "ñáíóú", "fr": "éèêàçùâîô"}
LANGUAGES = ("en", "de", "es", "fr")

_OFFSETS = [(w, k) for w in WIDTHS for k in range(w)]
_CLEAN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-case words, without ASCII punctuation."""
    return text.lower().encode().translate(_CLEAN).split()


def buckets_of(word: bytes) -> list[int]:
    letters = word.decode()
    parts = [letters, *(f"{n}^{letters[:n]}" for n in PREFIXES)]
    return [zlib.crc32(p.encode()) % BUCKETS for p in parts]


def language_of(text: str) -> int:
    """Index in ``LANGUAGES``: whose letters are most frequent, at least one in 200."""
    low = text.lower()
    counts = {lang: sum(map(low.count, letters)) for lang, letters in LETTERS.items()}
    best = max(counts, key=lambda lang: (counts[lang], lang))
    return LANGUAGES.index(best) if counts[best] * 200 > len(low) else 0


class Convolution:
    """The network; ``tables`` has the products of all buckets with all filters."""

    def __init__(self, seed: int = SEED):
        chance = np.random.default_rng(seed)
        self.embedding = (chance.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
        self.filters = {o: (chance.standard_normal((DIM, FILTERS)) * 0.25).astype(np.float32) for o in _OFFSETS}
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.dense = (chance.standard_normal(len(WIDTHS) * FILTERS) * 0.25).astype(np.float32)
        self.shift = np.float32(0)

    def train(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> None:
        """Adagrad on the logistic loss, a document at a time; texts are rows of bucket numbers per word."""
        chance = np.random.default_rng(seed)
        sums = [np.full(BUCKETS, 1e-4, np.float32), {o: np.full((DIM, FILTERS), 1e-4, np.float32) for o in _OFFSETS},
                np.full(self.bias.shape, 1e-4, np.float32), np.full(self.dense.shape, 1e-4, np.float32)]
        for _ in range(epochs):
            for n in chance.permutation(len(texts)):
                ids = texts[n]
                if len(ids) < 1:
                    continue
                x = self.embedding[ids].sum(axis=1)
                pooled = np.zeros((len(WIDTHS), FILTERS), np.float32)
                won = np.zeros((len(WIDTHS), FILTERS), np.int64)
                for i, w in enumerate(WIDTHS):
                    m = len(x) - w + 1
                    if m < 1:
                        continue
                    out = sum(x[k : k + m] @ self.filters[w, k] for k in range(w)) + self.bias[i]
                    won[i] = out.argmax(axis=0)
                    pooled[i] = np.maximum(out[won[i], np.arange(FILTERS)], 0)
                flat = pooled.ravel()
                error = 1 / (1 + np.exp(-np.clip(flat @ self.dense + self.shift, -30, 30))) - labels[n]
                back = (error * self.dense).reshape(pooled.shape) * (pooled > 0)
                step = error * flat
                sums[3] += step * step
                self.dense -= rate * step / np.sqrt(sums[3])
                self.shift -= np.float32(0.1 * rate) * error
                sums[2] += back * back
                self.bias -= rate * back / np.sqrt(sums[2])
                touched, grads = [], []
                for i, w in enumerate(WIDTHS):
                    active = np.flatnonzero(back[i])
                    if not len(active):
                        continue
                    g = back[i][active]
                    for k in range(w):
                        at = won[i][active] + k
                        table = self.filters[w, k]
                        touched.append(at)
                        grads.append(g[:, None] * table[:, active].T)
                        step = x[at].T * g
                        total = sums[1][w, k]
                        total[:, active] += step * step
                        table[:, active] -= rate * step / np.sqrt(total[:, active])
                if touched:
                    rows = ids[np.concatenate(touched)]
                    grad = np.concatenate(grads)
                    for column in range(rows.shape[1]):
                        np.add.at(sums[0], rows[:, column], (grad * grad).mean(axis=1))
                        np.add.at(self.embedding, rows[:, column], -rate * grad / np.sqrt(sums[0][rows[:, column], None]))

    def tables(self) -> np.ndarray:
        """Buckets by (offset, filter): what a word at this offset of a window adds to each filter."""
        return np.concatenate([self.embedding @ self.filters[o] for o in _OFFSETS], axis=1)


class Scorer:
    """Logits of whole texts from the products of their words."""

    def __init__(self, tables: np.ndarray, bias: np.ndarray, dense: np.ndarray, shift: float):
        self.tables, self.bias, self.dense, self.shift = tables, bias, dense, shift
        self.place: dict[bytes, int] = {}
        self.products = np.zeros((1024, tables.shape[1]), np.float32)

    @staticmethod
    def of(net: Convolution) -> Scorer:
        return Scorer(net.tables(), net.bias, net.dense, float(net.shift))

    def _places(self, words: list[bytes]) -> list[int]:
        place = self.place
        new = [w for w in dict.fromkeys(words) if w not in place]
        if new:
            if len(place) + len(new) > KEPT_WORDS and place:
                place.clear()
                new = list(dict.fromkeys(words))
            start = len(place)
            need = start + len(new)
            if need > len(self.products):
                grown = np.zeros((max(need, 2 * len(self.products)), self.products.shape[1]), np.float32)
                grown[:start] = self.products[:start]
                self.products = grown
            self.products[start:need] = self.tables[np.array([buckets_of(w) for w in new])].sum(axis=1)
            place.update(zip(new, range(start, need), strict=True))
        return [place[w] for w in words]

    def logit(self, text: str) -> float:
        words = words_of(text)
        pooled = np.zeros((len(WIDTHS), FILTERS), np.float32)
        if words:
            places = self._places(words)
            rows = self.products[places]
            for i, w in enumerate(WIDTHS):
                m = len(words) - w + 1
                if m < 1:
                    continue
                first = _OFFSETS.index((w, 0)) * FILTERS
                out = rows[:m, first : first + FILTERS]
                for k in range(1, w):
                    out = out + rows[k : k + m, first + k * FILTERS : first + (k + 1) * FILTERS]
                pooled[i] = np.maximum(out.max(axis=0) + self.bias[i], 0)
        return float(pooled.ravel() @ self.dense + self.shift)


def threshold(logits: np.ndarray, labels: np.ndarray, weight_of_zero: float) -> float:
    """The cut with the best F1 where a row of class 0 stands for ``weight_of_zero`` rows, halfway between its neighbours."""
    order = np.argsort(-logits, kind="stable")
    scores, hits = logits[order], labels[order].astype(float)
    caught = np.cumsum(hits)
    false = np.cumsum((1 - hits) * weight_of_zero)
    f1 = 2 * caught / np.maximum(caught + false + hits.sum(), 1e-9)
    last = np.append(scores[1:] != scores[:-1], True)  # a cut does not part equal scores
    best = int(np.argmax(np.where(last, f1, -1)))
    below = scores[best + 1] if best + 1 < len(scores) else scores[best] - 2
    return float((scores[best] + below) / 2)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[list, dict[int, int]]:
    """Texts and labels for training, the least by hash of each class, and how many rows each class has.

    Ids are chosen from ``labels`` alone, so that at most 2 * ``per_class`` ids
    are sent to the scan of the texts.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [usable.where(F.col("toxic") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    ids = F.broadcast(parts[0].unionByName(parts[1]).withColumnRenamed("doc_id", "_id"))
    short = docs.where(F.length("text") <= SAMPLE_CHARS)
    # one text per id, however often the id is repeated
    chosen = short.join(ids, F.col("doc_id") == F.col("_id")).groupBy("doc_id", "toxic")
    rows = chosen.agg(F.min("text").alias("text")).collect()
    return sorted((r.doc_id, r.text, r.toxic) for r in rows), counts


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[Scorer, np.ndarray]:
    """The network and a threshold per language, from a bounded sample of the labelled rows."""
    rows, counts = sample(docs, labels, per_class)
    known: dict[bytes, list[int]] = {}

    def ids_of(text):
        words = words_of(text)
        for w in words:
            if w not in known:
                known[w] = buckets_of(w)
        return np.array([known[w] for w in words], np.int32).reshape(len(words), 1 + len(PREFIXES))

    apart = np.array([zlib.crc32(f"cut {i}".encode()) % 4 == 0 for i, _, _ in rows], bool)
    toxic = np.array([t for _, _, t in rows], np.int64)
    net = Convolution()
    learn = [n for n in range(len(rows)) if not apart[n]]
    net.train([ids_of(rows[n][1]) for n in learn], toxic[learn])
    scorer = Scorer.of(net)
    seen = [n for n in range(len(rows)) if apart[n]]
    cuts = np.zeros(len(LANGUAGES))
    if seen and 0 < toxic[seen].sum() < len(seen):
        logits = np.array([scorer.logit(rows[n][1]) for n in seen])
        language = np.array([language_of(rows[n][1]) for n in seen])
        zeros = max(1, int((toxic == 0).sum()))
        weight = max(1.0, counts.get(0, 0) / zeros)
        cuts[:] = threshold(logits, toxic[seen], weight)
        for i in range(len(LANGUAGES)):
            own = language == i
            if toxic[seen][own].sum() >= 20 and (own.sum() - toxic[seen][own].sum()) >= 20:
                cuts[i] = threshold(logits[own], toxic[seen][own], weight)
    return scorer, cuts


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document, one row per row.

    Labels with other values than 0 and 1, or without an id, are not used; a
    document with two labels counts as toxic if one says so. Without labels of
    both classes scores mean nothing, but are given. Null and empty texts get
    the score of a text without words. Repeated rows score alike; an empty table
    gives no rows. ``lang``, ``source`` and other columns are not read.

    Learned from at most ``SAMPLE_PER_CLASS`` texts of each label, of at most
    ``SAMPLE_CHARS`` characters; every text is scored whole, however long.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    scorer, cuts = train(rows, labels)
    model = docs.sparkSession.sparkContext.broadcast(
        (scorer.tables.astype(np.float16), scorer.bias, scorer.dense, scorer.shift, cuts)
    )

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables, bias, dense, shift, cut = model.value
        own = Scorer(tables.astype(np.float32), bias, dense, shift)
        for texts in batches:
            gaps = np.array([own.logit(t) - cut[language_of(t)] for t in texts], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(gaps, -30, 30))))

    out = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), run("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
