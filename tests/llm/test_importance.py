from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from llm.corpus import FOLDER, edge, edge_rows, nothing, with_clashes
from pyspark.sql import functions as F

from salesloom.llm import importance
from salesloom.llm.queries import QUERIES

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def buckets(text):
    return [zlib.crc32(f.encode()) % 10_000 for f in features(text)[1]]


def plain(docs, target, seed=7):
    """(doc_id, n_features, weight, score, rank) of every document, text by text."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    in_s, in_t = s.total() + 10_000, t.total() + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * in_s / ((s[b] + 1) * in_t))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        held = buckets(text)
        weight = sum(gain[b] for b in held) // len(held) if held else 0
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(held), weight, score, None, len(features(text)[0])])
    able = [r for r in rows if r[5] >= 20]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_all_rows_of_the_given_tables(spark):
    for folder in (FOLDER, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
        target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
        assert rows_of(QUERIES["op12_importance_lines"](spark, folder)) == plain([tuple(r) for r in docs], target)


def test_edges(spark):
    target = with_clashes(spark.createDataFrame([(1, "x y\nz plain1"), (2, None), (None, "")], "item_id long, text string"))
    docs = [(r[0], r[1]) for r in edge_rows()]
    assert rows_of(importance.resampled(edge(spark), target)) == plain(docs, ["x y\nz plain1"])
    assert rows_of(importance.resampled(edge(spark), target.limit(0))) == plain(docs, [])
    assert importance.resampled(nothing(spark), target).count() == 0


def test_repeated_rows_are_numbered_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 4)
    words = " ".join(f"w{i}" for i in range(30))
    docs = [(7, words)] * 50 + [(7, words + " more")] * 3 + [(i, f"{words} a{i}\nb{i}") for i in range(20)] + [(None, words)] * 30
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    target = spark.createDataFrame([(1, "w1 w2")], "item_id long, text string")
    found = rows_of(importance.resampled(frame, target))
    assert found == plain(docs, ["w1 w2"])
    ranks = sorted(r[4] for r in found if r[4] is not None)
    assert ranks == list(range(1, 25 * len(docs) // 100 + 1))


def test_a_frequent_line_meets_the_documents_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(importance, "FREQUENT_SHARE", 0.2)
    docs = [(i, f"the same old line\n\n  \nother {i} é{i}\nthe same old line\nEND {i % 3}") for i in range(90)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    target = spark.createDataFrame([(1, "same old other")], "item_id long, text string")
    assert rows_of(importance.resampled(frame, target)) == plain(docs, ["same old other"])
    _, lines = importance.split_lines(frame)
    assert lines.agg(F.sum("n"), F.count("*")).first() == (360, 94)


def test_lines_and_crossings_make_the_features_of_a_text():
    for text in ("", "\n", "a\nb", "a b\n\n-\nc d\ne", "Ünï Öd\n\n x1 2y\n", "one\r\ntwo\rthree", "\n\nA\n"):
        lines = [b for line in text.split("\n") for b in importance.line_buckets(line.encode()).tolist()]
        assert sorted(lines + importance.across_buckets(text.encode()).tolist()) == sorted(buckets(text))
