"""Near duplicates by SimHash, linked by vantage-point trees.

A text's fingerprint has 64 bits. Equal fingerprints are one point. The points
are searched for pairs within ``RADIUS`` bits by vantage-point trees in two
layers:

1. Shards. At every level of a tree a point goes to a child by its Hamming
   distance to the level's vantage point, and by the triangle inequality a
   partner within r is in a child whose distances are at most r away, so a
   point also visits every child its ball overlaps. Over all 64 bits this
   prunes little: distances of unrelated points crowd around 32 and a ball of
   3 overlaps more than half of all borders. So there is a forest: the bits are
   cut into blocks, and each tree measures on some of them. Two points within 3
   bits agree on at least ``blocks - 3`` blocks, so with one tree for each such
   choice the ball shrinks to 0 on the right tree. Fewer blocks with a larger
   ball are possible (``Forest``) and tested; they visit more shards.
2. Inside a shard, a tree over all 64 bits finds the exact pairs; small leaves
   are compared pair by pair, visitors only where their ball overlaps.

A shard gives back a star per component, not its pairs. A shard above ``CELL``
points is cut into chunks, and each pair of chunks is a task of its own, so no
pair is lost and no shard is one task. Points of all shards together are a few
per document, whatever the number of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from salesloom.llm.components import components
from salesloom.llm.tables import ids_and_texts, join_salted
from salesloom.operators.joining import broadcast_if_small
from salesloom.session import stored

RADIUS = 3
SHINGLE = 3
CELL = 4096
LEAF = 128
SEED = 42

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACES = np.arange(8) * 256
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the text's shingles of 3 words, repeats included, as a signed 64-bit integer."""
    words = text.encode().lower().split()  # bytes: A-Z only, and \x20, \x09-\x0D only
    n = len(words)
    if not n:
        return 0
    body = b" ".join(words)
    if n <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(body, SEED)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (
            digest(body[s:e], SEED)
            for s, e in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        ),
        np.uint64,
        n - shingle + 1,
    )
    places = hashes.view(np.uint8).reshape(-1, 8) + _PLACES
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = 2 * counts.ravel() > n - shingle + 1
    return int(_POWERS[bits].sum(dtype=np.uint64).astype(np.int64))


def _fingerprints(text, shingle: int = SHINGLE):
    @F.pandas_udf(LongType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return run(text)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = ids_and_texts(docs, id_col, text_col)
    return rows.select("doc_id", _fingerprints("text").alias("fp"))


@dataclass(frozen=True)
class Forest:
    """Trees that measure on ``chosen`` of ``blocks`` blocks of bits, with balls of ``ball`` bits.

    Exact if ``radius`` differing bits cannot leave every choice of blocks with
    more than ``ball`` of them; others are refused.
    """

    blocks: int
    chosen: int
    ball: int = 0
    levels: int = 8
    radius: int = RADIUS

    @staticmethod
    def for_points(n: int, radius: int = RADIUS) -> Forest:
        """More points need more measured bits; more blocks have them, at the price of more trees."""
        spare = 1
        while spare < 3 and n > 2 ** (8 + 64 * spare / (radius + spare)):
            spare += 1
        return Forest(radius + spare, spare, 0, (8, 10, 12)[spare - 1], radius)

    def __post_init__(self):
        # bits that differ are worst when spread evenly; some tree measures on the blocks with the fewest
        each, more = divmod(self.radius, self.blocks)
        worst = self.chosen * each + max(0, self.chosen - (self.blocks - more))
        assert self.ball >= worst, "a pair could be missed"

    def masks(self) -> list[int]:
        bounds = [64 * i // self.blocks for i in range(self.blocks + 1)]
        block = [(1 << hi) - (1 << lo) for lo, hi in zip(bounds, bounds[1:], strict=False)]
        return [sum(c) for c in combinations(block, self.chosen)]

    @property
    def width(self) -> int:
        """Distances per child; wider children than the ball visit fewer neighbours."""
        return 1 if self.ball == 0 else 4 * self.ball


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _vantage(tree: int, level: int) -> int:
    """A fixed point of the space for each level of each tree."""
    return xxhash.xxh64_intdigest(f"vantage {tree} {level}", SEED)


def shards(points: DataFrame, forest: Forest) -> DataFrame:
    """``points`` (column fp) by ``shard``; ``home`` tells where a point lives, else it visits.

    A shard is a tree and the child taken at every level, as an array of small numbers.
    """
    parts = []
    for tree, mask in enumerate(forest.masks()):
        rows = points.select("fp", F.array(F.lit(tree).cast("byte")).alias("shard"), F.lit(True).alias("home"))
        for level in range(forest.levels):
            vantage = F.lit(_signed(_vantage(tree, level)))
            distance = F.bit_count(F.col("fp").bitwiseXOR(vantage).bitwiseAND(F.lit(_signed(mask))))
            child = F.floor(distance / forest.width).cast("byte")
            if forest.ball == 0:
                rows = rows.withColumn("shard", F.concat("shard", F.array(child)))
                continue
            lowest = F.floor(F.greatest(distance - forest.ball, F.lit(0)) / forest.width)
            highest = F.floor((distance + forest.ball) / forest.width)
            rows = rows.withColumn("_visit", F.explode(F.sequence(lowest, highest)))
            rows = rows.select(
                "fp",
                F.concat("shard", F.array(F.col("_visit").cast("byte"))).alias("shard"),
                (F.col("home") & (F.col("_visit") == child)).alias("home"),
            )
        parts.append(rows)
    whole = parts[0]
    for rows in parts[1:]:
        whole = whole.unionByName(rows)
    return whole.select("fp", F.xxhash64("shard").alias("shard"), "home")


def cells(rows: DataFrame, cell: int = CELL) -> DataFrame:
    """Shards as units of work: one cell, or a cell for each pair of chunks of a large shard."""
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > cell)
    sizes = sizes.select("shard", F.ceil(F.col("n") / cell).cast("int").alias("chunks"))
    dealt = join_salted(rows, sizes, "shard", "fp")
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), F.col("fp")), F.col("chunks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.least(chunk, other) * F.lit(1 << 15) + F.greatest(chunk, other),
    )
    cell_of = F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(pairs))
    return dealt.select("fp", "shard", "home", cell_of.alias("cell"))


def close_pairs(points: np.ndarray, home: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``radius`` of each other, one of them at home, by a tree over all bits.

    A branch holds its own points and, as guests, those outside whose ball
    reaches into it.
    """
    def compare(own, guests):
        for start in range(0, len(own), 1024):
            part = own[start : start + 1024]
            others = np.concatenate((own[start:], guests))
            near = np.bitwise_count(points[part][:, None] ^ points[others]) <= radius
            near[np.arange(len(part)), np.arange(len(part))] = False
            i, j = np.nonzero(near)
            if len(i):
                yield part[i], others[j]

    todo = [(np.flatnonzero(home), np.flatnonzero(~home))]
    while todo:
        own, guests = todo.pop()
        if len(own) <= LEAF:
            yield from compare(own, guests)
            continue
        vantage = points[own[len(own) // 2]]
        mine = np.bitwise_count(points[own] ^ vantage).astype(np.int64)
        theirs = np.bitwise_count(points[guests] ^ vantage).astype(np.int64)
        border = int(np.median(mine)) or 1
        inner = mine < border
        if inner.all() or not inner.any():
            yield from compare(own, guests)  # one crowd around the vantage point
            continue
        reach = np.concatenate((own[~inner & (mine < border + radius)], guests[theirs < border + radius]))
        todo.append((own[inner], reach))
        todo.append((own[~inner], guests[theirs >= border - radius]))


class Union:
    """Labels that fall to the least index of a component as links come in."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label[:] = label[label]


def links_in(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Links that join the components of every (shard, cell) of a sorted frame."""
    points = frame["fp"].to_numpy().view(np.uint64)
    home = frame["home"].to_numpy(bool)
    same_group = (frame["shard"].to_numpy()[1:] == frame["shard"].to_numpy()[:-1]) & (
        frame["cell"].to_numpy()[1:] == frame["cell"].to_numpy()[:-1]
    )
    starts = np.flatnonzero(np.concatenate(([True], ~same_group)))
    sizes = np.diff(np.concatenate((starts, [len(points)])))
    union = Union(len(points))
    small = sizes <= 64
    # many small groups at once: each point with the next, the one after, ...
    at = np.concatenate([np.arange(len(points))[np.repeat(small, sizes)]])
    left = np.repeat(starts + sizes, sizes)  # end of the group of each point
    step = 1
    while len(at):
        at = at[at + step < left[at]]
        a, b = at, at + step
        near = (np.bitwise_count(points[a] ^ points[b]) <= radius) & (home[a] | home[b])
        union.link(a[near], b[near])
        step += 1
    for start, size in zip(starts[~small], sizes[~small], strict=True):
        for a, b in close_pairs(points[start : start + size], home[start : start + size], radius):
            union.link(a + start, b + start)
    joined = np.flatnonzero(union.label != np.arange(len(points)))
    signed = points.view(np.int64)
    links = pd.DataFrame({"a": signed[joined], "b": signed[union.label[joined]]})
    return links[links["a"] != links["b"]].drop_duplicates()


def linker(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the group that the next batch may go on with
        for batch in batches:
            if rest is not None:
                batch = pd.concat((rest, batch), ignore_index=True)
            last = (batch["shard"] == batch["shard"].iloc[-1]) & (batch["cell"] == batch["cell"].iloc[-1])
            rest = batch[last]
            if not last.all():
                yield links_in(batch[~last], radius)
        if rest is not None:
            yield links_in(rest, radius)

    return run


def links(points: DataFrame, forest: Forest, cell: int = CELL) -> DataFrame:
    """Links (a, b) that join the same components as all pairs of points within the radius."""
    work = cells(shards(points, forest), cell)
    work = work.repartition("shard", "cell").sortWithinPartitions("shard", "cell")
    return work.mapInPandas(linker(forest.radius), "a long, b long").distinct()


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", forest: Forest | None = None
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, a row per row of ``docs``.

    ``component_id`` is the smallest id that can be reached by links of at most
    3 bits, the row's own included. Null and empty texts have the fingerprint
    zero, which links like any other. Null ids are never smallest; a component
    of null ids only has a null ``component_id``. Repeated rows give repeated
    rows, an empty table none.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    points = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "points"
    )
    roots = components(links(points.select("fp"), forest or Forest.for_points(points.count())))
    linked = points.select("fp", "first_id").join(roots.select(F.col("node").alias("fp"), "root"), "fp")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = join_salted(linked.select("fp", "root"), least, "root", "fp", "inner").select("fp", "component_id")
    # a point of one document that no link reaches needs no look-up
    shared = points.where("n > 1").join(linked, "fp", "left_anti").select("fp", F.col("first_id").alias("component_id"))
    found = join_salted(prints, linked.unionByName(shared), "fp", "doc_id")
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row of every group of near copies, with all its columns.

    Copies are texts whose fingerprints over ``shingle`` words are linked by
    steps of at most ``radius`` bits; the texts themselves are not compared.

    The row with the smallest id stays, of several texts under that id the one
    with the smallest SHA-256; null ids come last. Rows are told apart by id and
    text, so a null or repeated id takes no other text with it. Of rows that
    repeat both, one stays, whichever Spark meets first. Null text is empty text.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    prints = docs.select(docs[id_col].alias("doc_id"), digest.alias("digest"), _fingerprints(text, shingle).alias("fp"))
    prints = stored(prints, "row-fingerprints")
    points = stored(prints.select("fp").distinct(), "points")
    roots = components(links(points, Forest.for_points(points.count(), radius)))
    return one_row_of_each(docs, prints, roots, id_col, text_col)


def one_row_of_each(
    docs: DataFrame, prints: DataFrame, roots: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of every group, as ``drop_near_copies`` has it.

    ``prints`` has the doc_id, the SHA-256 ``digest`` of the text and the point ``fp``
    of every row; ``roots`` the ``root`` of every point (``node``) that is linked.
    """
    digest = F.unhex(F.sha2(F.coalesce(docs[text_col], F.lit("")), 256))
    rooted = join_salted(prints, roots.select(F.col("node").alias("fp"), "root"), "fp", "digest")
    texts = rooted.groupBy("doc_id", "digest", F.coalesce("root", "fp").alias("root")).agg(F.count("*").alias("n"))
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")
    shared = texts.groupBy("root").agg(F.min(row).alias("first"), F.sum("n").alias("rows")).where("rows > 1")
    judged = join_salted(texts, shared.select("root", "first"), "root", "digest", "inner")
    judged = judged.select("doc_id", "digest", "n", (row == F.col("first")).alias("stays"))
    judged = broadcast_if_small(stored(judged.where("NOT stays OR n > 1"), "near-copies"))

    def same(verdicts):
        return docs[id_col].eqNullSafe(verdicts["doc_id"]) & (digest == verdicts["digest"])

    single = docs.join(judged, same(judged), "left_anti")
    repeated = judged.where("stays")
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    rows = docs.join(repeated, same(repeated), "left_semi")
    one_of_each = rows.select(whole, docs[id_col].alias("doc_id"), digest.alias("digest"))
    one_of_each = one_of_each.dropDuplicates(["doc_id", "digest"])
    return single.unionByName(one_of_each.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns]))
