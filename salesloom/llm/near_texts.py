"""Near copies by SimHash sketches, verified on the texts, and an exact search for what sketches miss.

Fingerprints of 64 bits that differ by 3 (``simhash``) miss most texts that
share four fifths of their shingles: such fingerprints differ by 10 bits, give or
take 3. Here a text's sketch has 256 bits over its distinct shingles, on which a
share of shingles shows as a share of differing bits with little spread.

1. Every text goes to one shard of each of a forest of vantage-point trees, by
   its Hamming distances to the vantage points. A ball as wide as this similarity
   needs would overlap nearly every border, so each tree measures on a few sampled
   bits only, where the ball is 0. The number of trees follows from the number
   of texts, so that a pair exactly at the similarity shares no shard with odds of
   ``MISSED``; more similar pairs are missed less.
2. A shard returns a least spanning forest of its pairs within the radius instead
   of all pairs. Such a forest joins what all pairs would join at every distance,
   so a group of any size gives fewer links than it has texts.
3. Both texts of a link are compared, and links below the similarity go.
4. An exact search adds the links between the groups found so far (``missed_pairs``):
   texts that share four fifths of their shingles share one of the first fifth of
   these, in any order that all texts have in common. Pairs inside a group are not
   listed, so large groups cost little, and no pair at the similarity is lost,
   whatever the sketches did. The order has frequent shingles last, by their counts
   in a bounded sample of texts; another order would cost time, but no pair.
5. Texts that meet so share a passage, and mostly no more. Only those that meet a text
   of another group take part in a second meeting, with a bitmap of all their shingles:
   two bitmaps differ in no more bits than the texts differ in shingles, so a pair that
   differs in more than the similarity allows is never listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import acos, ceil, log, log2, pi

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from salesloom.llm.components import components
from salesloom.llm.simhash import SEED, Union, cells, one_row_of_each
from salesloom.llm.tables import join_salted
from salesloom.operators.joining import broadcast_if_small, is_small
from salesloom.session import stored

SHINGLE = 5
SIMILARITY = 0.8
MISSED = 0.02  # odds that a pair at the similarity shares no shard
DEVIATIONS = 2.5  # the radius reaches so far beyond the expected distance
BITS = 256
CROWD = 512  # texts of a shard, about
CELL = 1024  # texts of a chunk; a task compares two chunks
KEY = 16  # bytes of the digest that name a text
TREES = 6  # of the forest that an exact search follows
SAMPLED = 20_000  # texts, about, whose shingles are counted for the order of all
FREQUENT = 1 << 15  # shingles that the order tells apart by their counts
PAIRS = 1 << 20  # pairs that a task lists at a time
BITMAP = 256, 1 << 13  # least and most bits of a text's bitmap
PIECE = 1 << 24  # bytes of bitmaps that a task compares at a time

DEALT = "shingle long, number long, grp long, size int, place int"

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACES = np.arange(8) * 256
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit over all."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``size`` words; of fewer words, of the whole run."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    size = min(size, len(words))
    runs = np.zeros(len(words) - size + 1, np.uint64)
    for place in range(size):
        runs = _mixed(runs * _STEP + hashes[place : place + len(runs)])
    return np.unique(runs)


def sketch(text: str, size: int = SHINGLE) -> bytes:
    return sketch_of(shingles(text, size))


def sketch_of(hashes: np.ndarray) -> bytes:
    parts = []
    for part in range(BITS // 64):
        hashes = _mixed(hashes + _STEP)
        places = hashes.view(np.uint8).reshape(-1, 8) + _PLACES
        counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS
        parts.append(_POWERS[2 * counts.ravel() > len(hashes)].sum(dtype=np.uint64))
    return np.array(parts, np.uint64).tobytes()


def bitmap_of(hashes: np.ndarray) -> bytes:
    """Whether the number of shingles is odd in each of about as many buckets of their hashes."""
    least, most = BITMAP
    bits = min(most, max(least, 1 << max(0, len(hashes) - 1).bit_length()))
    counts = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def jaccard(a: str, b: str, size: int = SHINGLE) -> float:
    """Shared share of the distinct shingles; texts without words are alike."""
    one, other = shingles(a, size), shingles(b, size)
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return shared / (len(one) + len(other) - shared) if len(one) + len(other) else 1.0


def _sketches(text, size):
    @F.pandas_udf(BinaryType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: sketch(t, size)).astype(object)

    return run(text)


def _similarity(a, b, size):
    @F.pandas_udf(DoubleType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for one, other in batches:
            yield pd.Series([jaccard(x, y, size) for x, y in zip(one, other, strict=True)], dtype="float64")

    return run(a, b)


@dataclass(frozen=True)
class Grove:
    """Vantage-point trees on sampled bits of the sketches, for pairs of at least a similarity."""

    measured: int  # bits a tree measures on
    trees: int
    radius: int

    @staticmethod
    def for_texts(n: int, similarity: float = SIMILARITY) -> Grove:
        differ = acos(2 * similarity / (1 + similarity)) / pi  # share of bits in which such sketches differ
        radius = ceil(BITS * differ + DEVIATIONS * (BITS * differ * (1 - differ)) ** 0.5)
        measured = max(0, ceil(log2(max(n, 1) / CROWD)))
        met = (1 - differ) ** measured
        return Grove(measured, 1 if met == 1 else ceil(log(MISSED) / log(1 - met)), radius)

    @staticmethod
    def for_groups(n: int, similarity: float = SIMILARITY) -> Grove:
        """Few trees however many texts there are, for groups that an exact search completes."""
        grove = Grove.for_texts(n, similarity)
        return Grove(grove.measured, min(TREES, grove.trees), grove.radius)

    def masks(self) -> np.ndarray:
        chance, masks = np.random.default_rng(SEED), np.zeros((self.trees, BITS), np.uint8)
        for mask in masks:
            mask[chance.choice(BITS, self.measured, replace=False)] = 1
        return np.packbits(masks, axis=1).view(np.uint64)

    def vantages(self) -> np.ndarray:
        """A vantage point for every level of every tree."""
        chance = np.random.default_rng(SEED + 1)
        shape = (self.trees, 8 + self.measured // 2, BITS // 64)
        return chance.integers(0, 2**64, shape, np.uint64)


def _sketch_of(points: pd.Series) -> np.ndarray:
    rows = np.frombuffer(b"".join(points), np.uint8).reshape(len(points), BITS // 8 + KEY)
    return np.ascontiguousarray(rows[:, : BITS // 8]).view(np.uint64)


def _planter(grove: Grove):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        masks, vantages = grove.masks(), grove.vantages()
        for batch in batches:
            if batch.empty:
                continue
            sketches = _sketch_of(batch["fp"])
            for tree, mask in enumerate(masks):
                shard = np.full(len(batch), tree, np.uint64)
                for vantage in vantages[tree]:
                    distance = np.bitwise_count((sketches ^ vantage) & mask).sum(axis=1, dtype=np.uint64)
                    shard = _mixed(shard * _STEP + distance)
                yield pd.DataFrame({"fp": batch["fp"], "shard": shard.view(np.int64), "home": True})

    return run


def spanning(a: np.ndarray, b: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Indices of the edges of a least spanning forest over nodes 0 to n - 1."""
    order = np.argsort(weight, kind="stable")
    union, live, chosen = Union(n), np.arange(len(order)), []
    while True:
        left, right = union.label[a[order[live]]], union.label[b[order[live]]]
        apart = left != right
        live, left, right = live[apart], left[apart], right[apart]
        if not len(live):
            return np.concatenate(chosen) if chosen else np.empty(0, np.int64)
        best = np.full(n, len(order))  # the first edge, by weight, that leaves each tree
        np.minimum.at(best, left, live)
        np.minimum.at(best, right, live)
        first = order[np.unique(best[best < len(order)])]
        union.link(a[first], b[first])
        chosen.append(first)


def _pairs(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs within the radius, and their distances; most fall out after half of the bits."""
    found = []
    for start in range(0, len(points), 256):
        block, others = points[start : start + 256], points[start:]
        half = np.bitwise_count(block[:, None, 0] ^ others[:, 0]) + np.bitwise_count(block[:, None, 1] ^ others[:, 1])
        i, j = np.nonzero(half <= radius)
        i, j = i[i < j], j[i < j]
        rest = np.bitwise_count(block[i, 2:] ^ others[j, 2:]).sum(axis=1, dtype=np.int16)
        distance = half[i, j] + rest
        near = distance <= radius
        found.append(((i[near] + start).astype(np.int32), (j[near] + start).astype(np.int32), distance[near]))
    a, b, distance = zip(*found, strict=True)
    return np.concatenate(a), np.concatenate(b), np.concatenate(distance)


def _links_in(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
    sketches = _sketch_of(frame["fp"])
    keys = frame["fp"].str.slice(BITS // 8).to_numpy()
    shard, cell = frame["shard"].to_numpy(), frame["cell"].to_numpy()
    new = (shard[1:] != shard[:-1]) | (cell[1:] != cell[:-1])
    bounds = np.concatenate(([0], np.flatnonzero(new) + 1, [len(frame)]))
    ends = [(np.empty(0, np.int64),) * 2]
    for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
        if stop - start > 1:
            a, b, distance = _pairs(sketches[start:stop], radius)
            tree = spanning(a, b, distance, stop - start)
            ends.append((a[tree] + start, b[tree] + start))
    a, b = (keys[np.concatenate(side)] for side in zip(*ends, strict=True))
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}, dtype=object).drop_duplicates()


def _linker(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the group that the next batch may go on with
        for batch in batches:
            if batch.empty:
                continue
            if rest is not None:
                batch = pd.concat((rest, batch), ignore_index=True)
            last = (batch["shard"] == batch["shard"].iloc[-1]) & (batch["cell"] == batch["cell"].iloc[-1])
            rest = batch[last]
            if not last.all():
                yield _links_in(batch[~last], radius)
        if rest is not None:
            yield _links_in(rest, radius)

    return run


def candidates(points: DataFrame, grove: Grove, cell: int = CELL) -> DataFrame:
    """Links (a, b) between keys of texts whose sketches are within the radius, a spanning forest a shard."""
    work = cells(points.mapInPandas(_planter(grove), "fp binary, shard long, home boolean"), cell)
    work = work.repartition("shard", "cell").sortWithinPartitions("shard", "cell", "fp")
    return work.mapInPandas(_linker(grove.radius), "a binary, b binary").distinct()


def similar_links(
    docs: DataFrame, points: DataFrame, text_col: str = "text", similarity: float = SIMILARITY, size: int = SHINGLE,
    grove: Grove | None = None,
) -> DataFrame:
    """Links (a, b) between keys of texts of at least the similarity, compared on the whole texts."""
    found = stored(candidates(points, grove or Grove.for_texts(points.count(), similarity)), "candidates")
    return _verified(found, docs, text_col, similarity, size)


def _verified(found: DataFrame, docs: DataFrame, text_col: str, similarity: float, size: int) -> DataFrame:
    """The stored pairs (a, b) of keys whose texts have at least the similarity."""
    ends = found.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    text = F.coalesce(docs[text_col], F.lit(""))
    texts = docs.select(_key(text).alias("key"), text.alias("text"))
    texts = texts.join(broadcast_if_small(stored(ends, "candidate-keys")), "key", "left_semi")
    texts = stored(texts.dropDuplicates(["key"]), "candidate-texts")
    pairs = found.join(texts.select(F.col("key").alias("a"), F.col("text").alias("one")), "a")
    pairs = pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("other")), "b")
    return pairs.where(_similarity(F.col("one"), F.col("other"), size) >= similarity).select("a", "b")


def frequent_shingles(texts: DataFrame, size: int = SHINGLE, sampled: int = SAMPLED) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent shingles in a sample of ``texts`` (columns text, key)."""
    n = texts.count()
    share = min(1.0, sampled / max(n, 1))
    some = texts.where(F.pmod(F.xxhash64(F.lit("sample"), F.col("key")), F.lit(1 << 30)) < int(share * (1 << 30)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                found = np.concatenate([shingles(t, size) for t in batch["text"].iloc[start : start + 256]])
                yield pd.DataFrame({"shingle": found.view(np.int64)})

    counts = some.select("text").mapInPandas(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    found = counts.where("n > 2").orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas()
    hashes = found["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found["n"].to_numpy(np.int64)[order]


def prefix(hashes: np.ndarray, similarity: float, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first of a text's shingles, frequent ones last: texts of at least the similarity share one of them."""
    n = len(hashes)
    if not n:
        return hashes
    known, counts = frequent
    rank = np.zeros(n, np.int64)
    if len(known):
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        rank = np.where(known[place] == hashes, counts[place], 0)
    length = n - max(1, ceil(similarity * n - 1e-9)) + 1
    return hashes[np.lexsort((hashes, rank))[:length]]


def _sketched(text, similarity: float, size: int, frequent: tuple[np.ndarray, np.ndarray]):
    """A text's sketch, its number of distinct shingles, the first of these as bytes, and their bitmap."""
    @F.pandas_udf("sketch binary, size int, first binary, bitmap binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = []
            for one in texts:
                hashes = shingles(one, size)
                first = prefix(hashes, similarity, frequent).tobytes()
                found.append((sketch_of(hashes), len(hashes), first, bitmap_of(hashes)))
            yield pd.DataFrame(found, columns=["sketch", "size", "first", "bitmap"])

    return run(text)


def _dealer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each of the first shingles of a text."""
    for batch in batches:
        if batch.empty:
            continue
        lengths = batch["first"].str.len().to_numpy() // 8
        starts = np.cumsum(lengths) - lengths
        yield pd.DataFrame({
            "shingle": np.frombuffer(b"".join(batch["first"]), np.int64),
            "number": np.repeat(batch["number"].to_numpy(), lengths),
            "grp": np.repeat(batch["grp"].to_numpy(), lengths),
            "size": np.repeat(batch["size"].to_numpy(), lengths),
            "place": (np.arange(lengths.sum()) - np.repeat(starts, lengths)).astype(np.int32),
        })


def _needed(size_a, size_b, similarity: float) -> np.ndarray:
    """The fewest shingles that texts of these sizes share at the similarity."""
    return np.ceil(similarity / (1 + similarity) * (size_a + size_b) - 1e-6)


def _may_reach(size_a, size_b, place_a, place_b, similarity: float) -> np.ndarray:
    """Whether texts can have the similarity whose first common shingle is at these places of their orders."""
    return np.minimum(size_a - place_a, size_b - place_b) >= _needed(size_a, size_b, similarity)


def _encounters(frame: pd.DataFrame, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of texts of different groups that meet at a shingle, of a frame sorted by it."""
    shingle, grp = (frame[c].to_numpy() for c in ("shingle", "grp"))
    size, place = frame["size"].to_numpy(np.int64), frame["place"].to_numpy(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(shingle)])))

    def pairs(i, j):
        apart = (grp[i] != grp[j]) & _may_reach(size[i], size[j], place[i], place[j], similarity)
        return i[apart], j[apart]

    left = np.repeat(starts + sizes, sizes)  # end of the bucket of each row
    small = np.repeat(sizes <= 64, sizes)
    at, step = np.flatnonzero(small), 1
    while len(at := at[at + step < left[at]]):
        yield pairs(at, at + step)
        step += 1
    for start, n in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
        if (grp[start : start + n] == grp[start]).all():
            continue
        rows = max(1, PAIRS // n)
        for i in range(start, start + n, rows):
            own, others = np.arange(i, min(i + rows, start + n)), np.arange(i, start + n)
            x, y = (side.ravel() for side in np.meshgrid(own, others, indexing="ij"))
            yield pairs(x[x < y], y[x < y])


def _accompanied(frame: pd.DataFrame, similarity: float) -> Iterator[pd.DataFrame]:
    """The rows that meet a text of another group."""
    meets = np.zeros(len(frame), bool)
    for i, j in _encounters(frame, similarity):
        meets[i] = meets[j] = True
    yield frame[meets]


class _Bitmaps:
    """The bitmaps of a frame's rows, compared at the length of the shorter of two."""

    def __init__(self, frame: pd.DataFrame, similarity: float):
        self.bitmaps, self.similarity = frame["bitmap"], similarity
        self.size, self.length = frame["size"].to_numpy(np.int64), frame["bitmap"].str.len().to_numpy()
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _at(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of this many bytes or more, as words of the folded ones, and the place of each row among them."""
        if length not in self.folded:
            place, parts, n = np.zeros(len(self.length), np.int64), [], 0
            for longer in np.unique(self.length[self.length >= length]):
                rows = np.flatnonzero(self.length == longer)
                bits = np.frombuffer(b"".join(self.bitmaps.iloc[rows]), np.uint64)
                parts.append(np.bitwise_xor.reduce(bits.reshape(len(rows), longer // length, length // 8), axis=1))
                place[rows] = np.arange(n, n + len(rows))
                n += len(rows)
            self.folded[length] = np.concatenate(parts), place
        return self.folded[length]

    def may_reach(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the texts differ in no more bits than those of the similarity can differ in shingles."""
        size_a, size_b = self.size[i], self.size[j]
        most = size_a + size_b - 2 * _needed(size_a, size_b, self.similarity)
        shorter, reach = np.minimum(self.length[i], self.length[j]), np.zeros(len(i), bool)
        for length in np.unique(shorter).tolist():
            bits, place = self._at(length)
            of = np.flatnonzero(shorter == length)
            for some in np.array_split(of, len(of) * length // PIECE + 1):
                differ = np.bitwise_count(bits[place[i[some]]] ^ bits[place[j[some]]]).sum(axis=1, dtype=np.int64)
                reach[some] = differ <= most[some]
        return reach


def _meetings(frame: pd.DataFrame, similarity: float) -> Iterator[pd.DataFrame]:
    """Pairs of texts of different groups that meet at a shingle and whose bitmaps, if there, are near enough."""
    number = frame["number"].to_numpy()
    bitmaps = _Bitmaps(frame, similarity) if "bitmap" in frame else None
    for i, j in _encounters(frame, similarity):
        if bitmaps:
            near = bitmaps.may_reach(i, j)
            i, j = i[near], j[near]
        a, b = number[i], number[j]
        yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def _by_shingle(work, similarity: float):
    """A function of batches sorted by shingle that hands all rows of a shingle to ``work`` at once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []  # rows of the shingle that the next batch may go on with
        for batch in batches:
            if batch.empty:
                continue
            last = batch["shingle"].iloc[-1]
            if parts and batch["shingle"].iloc[0] == last and parts[-1]["shingle"].iloc[-1] == last:
                parts.append(batch)
                continue
            ends = batch["shingle"] == last
            yield from work(pd.concat((*parts, batch[~ends]), ignore_index=True), similarity)
            parts = [batch[ends]]
        if parts:
            yield from work(pd.concat(parts, ignore_index=True), similarity)

    return run


def _meeter(similarity: float):
    return _by_shingle(_meetings, similarity)


def missed_pairs(rows: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of numbers of rows in different groups, with all that have at least the similarity.

    ``rows`` has number, fp, digest, size, first and bitmap; ``roots`` the group of
    each fp that has one. A pair of the similarity shares one of its first shingles;
    at the one that is first of all, neither text has too few left. A shingle's
    texts meet in one task, without their bitmaps, as most meet no other group. Those
    that do meet again with them, and the task lists pairs piece by piece. Texts
    without words have no shingles; they have one sketch, and so one group.
    """
    bitmaps = rows.select("number", "bitmap")
    groups = stored(roots.select(F.col("node").alias("fp"), F.xxhash64("root").alias("grp")), "groups")
    rows = rows.select("number", "fp", "digest", "size", "first")
    rows = rows.join(F.broadcast(groups), "fp", "left") if is_small(groups) else join_salted(rows, groups, "fp", "digest")
    rows = rows.select("number", F.coalesce("grp", "number").alias("grp"), "size", "first")
    dealt = rows.mapInPandas(_dealer, DEALT).repartition("shingle").sortWithinPartitions("shingle")
    met = dealt.mapInPandas(_by_shingle(_accompanied, similarity), DEALT)
    met = met.join(bitmaps, "number").repartition("shingle").sortWithinPartitions("shingle")
    return met.mapInPandas(_meeter(similarity), "a long, b long").distinct()


def missed_links(
    docs: DataFrame, rows: DataFrame, roots: DataFrame, text_col: str, similarity: float, size: int
) -> DataFrame:
    """Links (a, b) between keys of texts of different groups: all that have at least the similarity."""
    found = stored(missed_pairs(rows, roots, similarity), "missed")
    ends = stored(found.select(F.explode(F.array("a", "b")).alias("number")).distinct(), "missed-numbers")
    keys = stored(rows.select("number", "fp").join(broadcast_if_small(ends), "number"), "missed-keys")
    pairs = found.join(keys.select(F.col("number").alias("a"), F.col("fp").alias("one")), "a")
    pairs = pairs.join(keys.select(F.col("number").alias("b"), F.col("fp").alias("other")), "b")
    pairs = pairs.select(F.least("one", "other").alias("a"), F.greatest("one", "other").alias("b")).distinct()
    return _verified(stored(pairs, "missed-pairs"), docs, text_col, similarity, size)




def _key(text):
    return F.substring(F.unhex(F.sha2(text, 256)), 1, KEY)


def drop_similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
    size: int = SHINGLE,
) -> DataFrame:
    """One row of every group of similar texts, with all its columns.

    Texts are linked when they share at least ``similarity`` of their distinct
    runs of ``size`` words (A-Z lowered; fewer words: the whole run); a group is
    what links reach. Sketches find most links; an exact search then finds all
    that join different groups of these, so no pair at the similarity is lost, and
    no pair below it is linked.

    The row with the smallest id stays, of several texts under that id the one
    with the smallest SHA-256; null ids come last. Null text is empty text; texts
    without words are copies of each other. Rows are told apart by id and text;
    of rows that repeat both, one stays. Texts of any length are compared whole.
    An empty table stays empty.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    frequent = frequent_shingles(docs.select(text.alias("text"), _key(text).alias("key")), size)
    seen = _sketched(text, similarity, size, frequent).alias("seen")
    rows = docs.select(docs[id_col].alias("doc_id"), digest.alias("digest"), seen)
    rows = stored(rows.select("doc_id", "digest", "seen.*", F.monotonically_increasing_id().alias("number")), "row-sketches")
    points = rows.select(F.concat("sketch", F.substring("digest", 1, KEY)).alias("fp")).distinct()
    points = stored(points, "points")
    links = similar_links(docs, points, text_col, similarity, size, Grove.for_groups(points.count(), similarity))
    roots = components(links)
    rows = rows.withColumn("fp", F.substring("digest", 1, KEY))
    more = missed_links(docs, rows, roots, text_col, similarity, size)
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    return one_row_of_each(docs, rows.select("doc_id", "digest", "fp"), roots, id_col, text_col)
