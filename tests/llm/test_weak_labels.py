from __future__ import annotations

from collections import Counter

import numpy as np
from llm.corpus import edge, edge_rows, nothing

from salesloom.llm import weak_labels as weak


def test_estimation_finds_the_labellers_accuracies():
    chance = np.random.default_rng(1)
    truth = chance.random(20_000) < 0.2
    right = np.linspace(0.65, 0.95, len(weak.LABELLERS))
    speaks = np.linspace(0.9, 0.4, len(weak.LABELLERS))
    hit = chance.random((20_000, len(right))) < right
    votes = np.where(hit, truth[:, None], ~truth[:, None]).astype(int)
    votes = np.where(chance.random(votes.shape) < speaks, votes, weak.SILENT)
    patterns = ["".join(map(str, row)) for row in votes]
    model = weak.LabelModel.fitted(Counter(patterns))
    assert abs(model.prior - 0.2) < 0.02
    assert np.abs(np.array(list(model.accuracies().values())) - right).max() < 0.04
    assert ((model.posterior(patterns) > 0.5) == truth).mean() > 0.96


def test_counts_by_pattern_equal_a_run_over_all_documents():
    chance = np.random.default_rng(2)
    patterns = ["".join(map(str, row)) for row in chance.integers(0, 3, (300, len(weak.LABELLERS)))]
    counts = Counter(patterns)
    model = weak.LabelModel.fitted(counts, steps=5)
    prior, table = weak.PRIOR_JUNK, np.tile(weak.START, (len(weak.LABELLERS), 1, 1))
    for _ in range(5):
        total, junk_sum = np.tile(weak.START, (len(weak.LABELLERS), 1, 1)), 0.0
        for p in patterns:
            like = [1 - prior, prior]
            for j, v in enumerate(map(int, p)):
                like = [like[c] * table[j, c, v] for c in (0, 1)]
            junk = like[1] / sum(like)
            junk_sum += junk
            for j, v in enumerate(map(int, p)):
                total[j, 0, v] += 1 - junk
                total[j, 1, v] += junk
        table = total / total.sum(axis=2, keepdims=True)
        prior = float(np.clip(junk_sum / len(patterns), 0.001, 0.5))
    assert np.allclose(model.table, table) and np.isclose(model.prior, prior)


def test_held_out_labels(spark):
    """The given labels are never used; good documents stay and junk goes."""
    folder = "/root/testdata/sf0.01"
    found = weak.judged(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good, junk = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.97 and np.mean(junk) < 0.1


def test_edges_and_repeated_runs(spark):
    rows = weak.judged(edge(spark)).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 and 0 <= r.label <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    again = weak.judged(edge(spark).repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert weak.judged(nothing(spark)).count() == 0
