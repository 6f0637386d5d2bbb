from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from llm.corpus import edge, given_docs, nothing, slow_components, words
from pyspark.sql import functions as F

from salesloom.llm import near_texts
from salesloom.llm.near_texts import Grove, drop_similar, jaccard, sketch, spanning


def slow_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow_jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def slow_kept(rows):
    """Ids that stay of (id, text) with distinct ids in order."""
    sets = [slow_set(text) for _, text in rows]
    labels = slow_components(sets, lambda a, b: slow_jaccard(a, b) >= 0.8)
    return {rows[i][0] for i in set(labels)}


def edited(text, chance, share):
    return " ".join(f"new{chance.random()}" if chance.random() < share else w for w in text.split())


def family(chance, copies, share, n_words=200):
    base = " ".join(f"w{chance.randrange(5000)}" for _ in range(n_words))
    return [base] + [edited(base, chance, share) for _ in range(copies)]


def test_similarity_equals_that_of_sets():
    chance = random.Random(1)
    texts = ["", " \n", "a", "A", "a b c d", "a b c d e", "é É a b c d", *family(chance, 6, 0.02), *family(chance, 3, 0.2)]
    for a, b in combinations(texts, 2):
        assert jaccard(a, b) == pytest.approx(slow_jaccard(slow_set(a), slow_set(b)))


def test_sketches_differ_by_the_angle():
    chance, radius = random.Random(2), Grove.for_texts(100).radius
    near, apart = [], []
    for _ in range(150):
        a, b = family(chance, 1, 0.015)
        distance = (int.from_bytes(sketch(a)) ^ int.from_bytes(sketch(b))).bit_count()
        if jaccard(a, b) >= 0.8:
            near.append(distance <= radius)
        apart.append((int.from_bytes(sketch(a)) ^ int.from_bytes(sketch(family(chance, 0, 0)[0]))).bit_count())
    assert len(near) > 50 and np.mean(near) > 0.95
    assert min(apart) > radius + 20


def test_spanning_forest_joins_as_all_edges_do_at_every_weight():
    chance = np.random.default_rng(3)
    for n in (2, 10, 60):
        a, b = chance.integers(0, n, (2, 4 * n))
        a, b = a[a != b], b[a != b]
        weight = chance.integers(0, 9, len(a))
        tree = spanning(a, b, weight, n)

        def parts(edges, a=a, b=b, n=n):
            ends = {(a[e], b[e]) for e in edges}
            return slow_components(range(n), lambda x, y: (x, y) in ends or (y, x) in ends)

        for most in range(9):
            assert parts(np.flatnonzero(weight <= most)) == parts([e for e in tree if weight[e] <= most])
        assert len(tree) < n


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_given_documents(spark, folder):
    rows = sorted({text: (i, text) for i, text, _ in sorted(given_docs(folder), reverse=True)}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in drop_similar(docs).collect()} == slow_kept(rows)


def test_forests_of_many_trees_and_large_groups_in_chunks(spark):
    chance = random.Random(4)
    texts = [t for _ in range(60) for t in family(chance, 3, 0.01)] + family(chance, 400, 0.004)
    texts = [*dict.fromkeys(texts)]
    sets = [slow_set(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    text = F.col("text")
    points = docs.select(F.concat(near_texts._sketches(text, 5), near_texts._key(text)).alias("fp"))
    grove = Grove(9, Grove.for_texts(512 * 2**9).trees, Grove.for_texts(1).radius)
    assert grove.trees > 10
    found = near_texts.candidates(points, grove, cell=32).count()
    assert found < 30 * len(texts)  # and not the 80,000 pairs of the large group
    links = near_texts.similar_links(docs, points, grove=grove)
    number = {r.key: r.doc_id for r in docs.select("doc_id", near_texts._key(text).alias("key")).collect()}
    linked = {frozenset((number[r.a], number[r.b])) for r in links.collect()}
    assert all(slow_jaccard(*(sets[i] for i in pair)) >= 0.8 for pair in linked)
    want = slow_components(range(len(sets)), lambda i, j: slow_jaccard(sets[i], sets[j]) >= 0.8)
    got = slow_components(range(len(sets)), lambda i, j: frozenset((i, j)) in linked)
    together = [want[i] == i or got[i] != i for i in range(len(sets))]
    assert np.mean(together) > 0.97
    assert all(want[i] == want[j] for i, j in enumerate(got))


def test_awkward_tables(spark):
    docs = edge(spark)
    kept = drop_similar(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 7, 9, 10]
    assert drop_similar(nothing(spark)).count() == 0


def test_rows_are_dropped_by_text_and_not_by_id_alone(spark):
    first, other, third = (" ".join(f"{c}{i}" for i in range(300)) for c in "abc")
    near, far = first + " end", " ".join(first.split()[:200] + other.split()[:100])
    rows = [
        (1, first), (None, near), (None, other), (7, near), (7, third), (8, far), (9, first.upper()),
        (None, None), (None, ""), (None, " "),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in drop_similar(docs).collect()]
    empty = [r for r in kept if not (r[1] or "").strip()]
    assert len(empty) == 1
    assert sorted((r for r in kept if r not in empty), key=str) == sorted(
        [(1, first), (None, other), (7, third), (8, far)], key=str
    )


def test_pairs_whose_sketches_lie_beyond_the_radius_are_found(spark):
    chance, radius, rows = random.Random(5), Grove.for_texts(100).radius, []

    def bits(a, b):
        return (int.from_bytes(sketch(a)) ^ int.from_bytes(sketch(b))).bit_count()

    pairs = [family(chance, 1, 0.015) for _ in range(1500)]  # texts of 200 words
    short = [" ".join(f"w{chance.randrange(5000)}" for _ in range(n)) for n in range(8, 15) for _ in range(200)]
    pairs += [[text, text + " end"] for text in short]
    for a, b in pairs:
        if slow_jaccard(slow_set(a), slow_set(b)) >= 0.8 and bits(a, b) > radius:
            rows += [(len(rows), a), (len(rows) + 1, b)]
    assert len(rows) > 10
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in drop_similar(docs).collect()) == list(range(0, len(rows), 2))


def test_exact_search_alone_finds_the_groups_of_all_pairs(spark):
    chance = random.Random(6)
    common = " ".join(f"c{i}" for i in range(120))
    texts = [t for _ in range(30) for t in family(chance, 4, 0.012, 90)] + family(chance, 150, 0.008, 90)
    texts += [f"{common} {' '.join(f'w{chance.randrange(9000)}' for _ in range(n))}" for n in range(5, 60) for _ in range(3)]
    texts += [" ".join("ab"[chance.randrange(2)] for _ in range(n)) for n in range(1, 13) for _ in range(6)]
    texts = [*dict.fromkeys(texts)]
    chance.shuffle(texts)
    sets = [slow_set(t) for t in texts]
    want = slow_components(range(len(sets)), lambda i, j: slow_jaccard(sets[i], sets[j]) >= 0.8)
    frequent = near_texts.frequent_shingles(
        spark.createDataFrame(list(enumerate(texts)), "key long, text string").select(F.col("key").cast("string"), "text")
    )
    for order in (frequent, (np.empty(0, np.uint64), np.empty(0, np.int64))):
        docs = spark.createDataFrame(list(enumerate(texts)), "number long, text string")
        seen = near_texts._sketched(F.col("text"), 0.8, 5, order).alias("seen")
        rows = docs.select("number", near_texts._key(F.col("text")).alias("fp"), F.sha("text").alias("digest"), seen)
        rows = rows.select("number", "fp", "digest", "seen.*")
        none = spark.createDataFrame([], "node binary, root binary")
        found = near_texts.missed_pairs(rows, none, 0.8).collect()
        linked = {(r.a, r.b) for r in found if slow_jaccard(sets[r.a], sets[r.b]) >= 0.8}
        assert slow_components(range(len(sets)), lambda i, j, linked=linked: (min(i, j), max(i, j)) in linked) == want
        both = {(i, j) for i, j in combinations(range(len(sets)), 2) if slow_jaccard(sets[i], sets[j]) >= 0.8}
        assert linked == both


def test_large_meetings_are_listed_in_pieces(monkeypatch):
    monkeypatch.setattr(near_texts, "PAIRS", 1000)
    n = 300
    frame = pd.DataFrame({"shingle": 7, "number": np.arange(n), "grp": np.arange(n) // 2, "size": 10, "place": 0})
    pieces = [*near_texts._meeter(0.8)(frame.iloc[i : i + 70] for i in range(0, n, 70))]
    assert max(map(len, pieces)) <= 1000
    assert {(a, b) for p in pieces for a, b in zip(p["a"], p["b"], strict=True)} == {
        (a, b) for a, b in combinations(range(n), 2) if a // 2 != b // 2
    }


def test_bitmaps_rule_out_no_pair_at_the_similarity(monkeypatch):
    monkeypatch.setattr(near_texts, "PIECE", 200)
    chance = random.Random(7)
    texts = ["a", "a b c d e"]
    for n in (30, 240, 262, 300, 600, 1100):
        texts += family(chance, 6, 0.02, n)
        texts += [" ".join(texts[-1].split()[: n * share // 100]) for share in (81, 85, 90, 95)]
    for most in (1 << 13, 512):
        monkeypatch.setattr(near_texts, "BITMAP", (256, most))
        found = [near_texts.shingles(t) for t in texts]
        frame = pd.DataFrame({"bitmap": [near_texts.bitmap_of(f) for f in found], "size": [len(f) for f in found]})
        assert frame["bitmap"].str.len().nunique() == len({min(most, 1 << k) for k in (8, 9, 10, 11)})
        i, j = np.triu_indices(len(texts), 1)
        alike = np.array([jaccard(texts[a], texts[b]) for a, b in zip(i, j, strict=True)])
        ratio = frame["size"].to_numpy()[i] / frame["size"].to_numpy()[j]
        reach = near_texts._Bitmaps(frame, 0.8).may_reach(i, j)
        assert (alike >= 0.8).sum() > 60 and reach[alike >= 0.8].all()
        apart = (alike < 0.4) & (0.8 < ratio) & (ratio < 1.25)
        assert apart.any() and reach[apart].mean() < 0.2


def test_texts_that_share_a_passage_are_not_listed_in_pairs(spark):
    chance = random.Random(8)
    passage = " ".join(f"c{i}" for i in range(100))
    texts = [f"{passage} {' '.join(f'w{chance.randrange(9000)}' for _ in range(100))}" for _ in range(200)]
    texts += [f"{text} end" for text in texts[:20]]
    sets = [slow_set(t) for t in texts]
    want = {(i, j) for i, j in combinations(range(len(sets)), 2) if slow_jaccard(sets[i], sets[j]) >= 0.8}
    assert len(want) == 20
    unordered = (np.empty(0, np.uint64), np.empty(0, np.int64))
    docs = spark.createDataFrame(list(enumerate(texts)), "number long, text string")
    seen = near_texts._sketched(F.col("text"), 0.8, 5, unordered).alias("seen")
    rows = docs.select("number", near_texts._key(F.col("text")).alias("fp"), F.sha("text").alias("digest"), seen)
    none = spark.createDataFrame([], "node binary, root binary")
    found = near_texts.missed_pairs(rows.select("number", "fp", "digest", "seen.*"), none, 0.8).collect()
    assert want <= {(r.a, r.b) for r in found} and len(found) < 2 * len(texts)  # of 24,090 pairs
