from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from llm.corpus import FOLDER, edge, edge_rows, nothing

from salesloom.llm import spelling
from salesloom.llm.queries import QUERIES

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def plain(n):
    """(word, form, root, n, n_near, form_n) by comparing all words that could be near."""
    by_gap: dict[str, set[str]] = {}
    for word in n:
        for i in range(len(word) + 1):
            by_gap.setdefault(word[:i] + "\0" + word[i + 1 :], set()).add(word)
            by_gap.setdefault(word[:i] + "\0" + word[i:], set()).add(word)
    near = {w: set() for w in n}
    for group in by_gap.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda w: (-n[w], w), default=None)
        if best is not None and n[best] >= 2 * n[word]:
            form[word] = best
    rows = []
    for word in n:
        root = word
        while root in form:
            root = form[root]
        rows.append((word, form.get(word), root, n[word], len(near[word]), n.get(form.get(word))))
    return sorted(rows, key=str)


def rows_of(frame):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_all_words_of_the_given_tables(spark):
    for folder in (FOLDER, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
        found = rows_of(QUERIES["op13_spelling_variants"](spark, folder))
        assert found == plain(plain_counts([tuple(r) for r in docs]))
        assert sum(row[4] for row in found) > 100


def test_edges(spark):
    assert rows_of(spelling.variants(edge(spark))) == plain(plain_counts([r[:2] for r in edge_rows()]))
    assert spelling.variants(nothing(spark)).count() == 0


def test_shards_of_any_size_find_the_same(spark):
    dice = random.Random(9)
    letters = "abéz"
    n = {"".join(dice.choices(letters, k=dice.randrange(5, 9))): dice.choice([3, 4, 7, 20, 41]) for _ in range(1500)}
    n |= {"aa" + "".join(dice.choices("ab", k=dice.randrange(3, 9))): 50 for _ in range(200)}
    n |= {"x" * 300 + "y" * i: 3 + 9 * i for i in range(5)}
    frame = spark.createDataFrame(list(n.items()), "word string, n long")
    want = {row[0]: row[4] for row in plain(n)}
    for size in (2, 40, 100_000):
        found = {r.word: (r.n_near, r.best) for r in spelling.near_words(frame, size).collect()}
        assert {w: found.get(w, (0,))[0] for w in n} == want
    assert spelling.shards(frame, 2).selectExpr("max(size(words))").first()[0] <= 5 * 5
    near = {w: min((b for b in n if one_edit(w, b)), key=lambda b: (-n[b], b)) for w in found}
    assert {w: best for w, (_, best) in found.items()} == near


def test_the_index_equals_comparing_all_words():
    dice = random.Random(4)
    words = sorted({"".join(dice.choices("abc", k=dice.randrange(5, 8))) for _ in range(500)})
    index = spelling.PositionIndex(words)
    for word in words:
        k = len(word)
        near = index.near(word, k, 0, k + 1) | index.near(word, k - 1, 0, k)
        assert {w for i, w in enumerate(words) if near >> i & 1} == {w for w in words if one_edit(word, w)}


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(21)] + [("v", "w3")], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms).collect()} == {f"w{i}": "w21" for i in range(21)} | {"v": "w21"}
