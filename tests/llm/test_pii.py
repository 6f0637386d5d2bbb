from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from llm.corpus import edge, edge_rows, given_docs, nothing

from salesloom.llm import pii


def slow_base(text):
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((*m.span(), "phone"))
    return pii.in_order(out)


def test_base_spans_are_the_patterns():
    chance = random.Random(1)
    texts = ["".join(chance.choice("0123456789..+-() @a1.@b\n") for _ in range(70)) for _ in range(3000)]
    texts += [t or "" for _, t, _ in given_docs()] + ["4111 1111 1111 1111 4111", "é joe@é.com 🙂 a@b.c", "1.2.3.4.5.6.7.8"]
    for text in texts:
        assert pii.base_spans(text) == slow_base(text)


@pytest.fixture(scope="module")
def field():
    chance = random.Random(2)
    zones = []
    for _ in range(150):
        d = [chance.randint(0, 9) for _ in range(16)]
        number = "".join(map(str, d))
        d[15] = next(x for x in range(10) if pii.luhn(number[:15] + str(x)))
        zones += [
            f" +1 ({chance.randint(200, 999)}) 555-{chance.randint(1000, 9999)} ",
            f" {number[:15]}{d[15]} ",
            f" {'.'.join(str(chance.randint(1, 255)) for _ in range(4))} ",
            f" joe{chance.randint(1, 99)}.x@mail{chance.randint(1, 9)}.example.com ",
        ]
    return pii.SemiMarkov.trained(pii.examples(zones))


def test_field_adds_what_patterns_miss_and_leaves_the_rest(field):
    def added(text):
        return [(k, text[s:e]) for s, e, k in pii.added_spans(text, pii.base_spans(text), field)]

    assert added("call (743) 555-3824 now") == [("phone", "(743) 555-3824")]
    assert added("mail joe [at] mail.example.com or so") == [("email", "joe [at] mail.example.com")]
    # the patterns take both numbers for one, and drop it
    assert added("so +1 (269) 555-3296 4111111111111111 it") == [("phone", "+1 (269) 555-3296"), ("card", "4111111111111111")]
    for text in ("on 2024-09-05 at 10", "v 1.2.3.400 x", "4785380592391138", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "@ @ (at)"):
        assert added(text) == []


def segmentations(segments, tokens, start=0):
    """All ways to cut tokens into segments and single tokens, as lists of segment numbers."""
    if start >= tokens:
        yield []
        return
    yield from segmentations(segments, tokens, start + 1)
    for n, (i, j, _) in enumerate(segments):
        if i == start:
            for rest in segmentations(segments, tokens, j):
                yield [n, *rest]


def test_dynamic_programming_against_all_segmentations():
    chance = np.random.default_rng(3)
    field = pii.SemiMarkov(np.zeros((len(pii.KINDS), pii.FEATURES)))
    for _ in range(40):
        tokens = 8
        pairs = {tuple(sorted(chance.choice(tokens + 1, 2, replace=False).tolist())) for _ in range(10)}
        segments = [(i, j, [0]) for i, j in sorted(pairs)]
        scores = chance.normal(0, 2, (len(segments), len(pii.KINDS)))
        best = max(sum(scores[n].max() for n in cut) for cut in segmentations(segments, tokens))
        place = {s[:2]: n for n, s in enumerate(segments)}
        found = field.best(tokens, segments, scores)
        assert sum(scores[place[i, j], k] for i, j, k in found) == pytest.approx(best)


def test_marginals_sum_over_all_segmentations():
    segments, scores = [(0, 2, [0]), (1, 3, [0]), (2, 3, [0])], np.arange(12.0).reshape(3, 4) / 5
    field = pii.SemiMarkov(np.zeros((len(pii.KINDS), pii.FEATURES)))
    e = np.exp(scores)
    whole = 1 + e.sum() + e[0].sum() * e[2].sum()
    want = np.array([e[0] * (1 + e[2].sum()), e[1], e[2] * (1 + e[0].sum())]) / whole
    assert np.allclose(field.marginals(3, segments, scores), want)


def test_edges(spark, field):
    found = pii.found(edge(spark), field=field).collect()
    assert len(found) == len(edge_rows())
    for r in found:
        text = next(t for i, t, *_ in edge_rows() if i == r.doc_id and (i is not None or (t or "") == "" or r.spans == "")) or ""
        base = slow_base(text) if r.doc_id is not None else []
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for *_, k in base) for kind in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(pii.as_text(base).encode()).hexdigest()
        assert set(filter(None, pii.as_text(base).split(","))) <= set(r.spans.split(","))
    assert pii.found(nothing(spark)).count() == 0


def test_given_documents_train_and_score(spark):
    docs = spark.createDataFrame([r[:2] for r in given_docs()], "doc_id long, text string")
    once = {r.doc_id: r.spans for r in pii.found(docs).collect()}
    again = {r.doc_id: r.spans for r in pii.found(docs.repartition(5)).collect()}
    assert once == again
    for doc_id, text, _ in given_docs():
        assert set(pii.as_text(slow_base(text or "")).split(",")) <= set(once[doc_id].split(",")) | {""}


def test_long_texts_without_breaks(field):
    for text in ("a" * 300_000, "1" * 300_000, "a." * 100_000 + "@b.c", "x [at] a" + " [dot] b" * 20_000, "1." * 20_000, "a@" * 20_000, "@" * 20_000, "(at)" * 5_000, "1 2 3 " * 300):
        pii.added_spans(text, pii.base_spans(text), field)


def test_marks_with_blanks_are_one_token_and_zones_reach_the_end(field):
    mail = "john.doe [at] mail [dot] example [dot] co [dot] uk"
    text = f"Write to {mail} today."
    zone = pii.zones(text)
    assert [text[a:b] for a, b in zone] == [mail]
    bounds, segments = pii.candidates(text, *zone[0])
    assert len(bounds) - 1 == 11 and (0, 11) in {(i, j) for i, j, _ in segments}
    assert (text.index("john"), text.index(" today"), "email") in pii.added_spans(text, [], field)
    long = "a" * 90 + "@" + "b" * 90 + ".example.org"
    assert [long[a:b] for a, b in pii.zones(f"x {long} y".strip("x y"))] == [long]
