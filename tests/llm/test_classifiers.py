from __future__ import annotations

import numpy as np
import pytest

from spendlens.llm import quality, toxicity
from spendlens.llm.labels import labelled_sample
from spendlens.llm.queries import QUERIES


def accuracy(spark, folder, query, target, least):
    found = QUERIES[query](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = found.filter(f"held_out and {target} is not null").select("predicted", target).collect()
    assert sum(p == t for p, t in rows) / len(rows) >= least
    return rows


def test_quality_of_held_out_documents(spark, data_dir):
    accuracy(spark, data_dir, "op6_quality", "quality", 0.9)


def test_toxicity_of_held_out_documents(spark, data_dir):
    rows = accuracy(spark, data_dir, "op10_toxicity", "toxic", 0.9)
    assert all(p == 1 for p, t in rows if t == 1)


def test_held_out_labels_are_never_learnt(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    from zlib import crc32
    ids = {r["doc_id"] for r in labelled_sample(labels, "quality", 1000).collect()}
    assert ids == {i for i in range(200) if crc32(str(i).encode()) % 5}
    assert labelled_sample(labels, "quality", 10).count() == 10


def test_interactions_are_learnt():
    rng = np.random.default_rng(1)
    rows = rng.random((3000, 4))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = quality.fit(rows[:2000], labels[:2000])
    assert (0, 1) in model.pairs
    assert ((model.score(rows[2000:]) > 0.5) == labels[2000:]).mean() > 0.9


@pytest.mark.parametrize("labels", [[], [1.0, 1.0], [0.0]])
def test_one_class_gives_a_constant(labels):
    rows = np.zeros((len(labels), len(quality.FEATURES)))
    model = quality.fit(rows, np.array(labels))
    scores = model.score(np.ones((3, len(quality.FEATURES))))
    assert len(set(scores)) == 1 and 0 < scores[0] < 1


def test_label_model_finds_accuracies_and_correlated_voters():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.2

    def voter(hit, false):
        return np.where(rng.random(truth.size) < np.where(truth, hit, false), 2, 1)

    good, weak, noise = voter(0.9, 0.02), voter(0.6, 0.1), voter(0.3, 0.3)
    votes = np.stack([good, weak, noise, noise, noise], axis=1)
    anchor = np.stack([~truth, truth]).astype(float) * (np.arange(truth.size) < 300)
    model = toxicity.fit_labels(votes, np.ones(truth.size), anchor, 0.2)
    assert any({2, 3} <= set(b) or {3, 4} <= set(b) for b in model.blocks)
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93
