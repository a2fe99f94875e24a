from __future__ import annotations

import numpy as np

from cinderlog.llm import quality
from tests.llm import plain


def test_counts_match_plain_version(documents, edges):
    texts = [r.text for r in documents.select("text").collect()] + [r.text for r in edges.collect() if len(r.text or "") < 10_000]
    for text in texts:
        assert quality.measure(text)[0] == plain.counts(text)


def test_assess_edges(edges, nothing):
    forest = quality.grow(np.zeros((0, len(quality.FEATURES))), np.zeros(0))
    rows = quality.assess(edges, forest).collect()
    assert len(rows) == 12
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality.assess(nothing, forest).count() == 0
    assert quality.keep_good(edges, forest).columns == edges.columns


def test_held_out_accuracy(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    forest = quality.train(documents, labels.where("doc_id % 3 <> 0"))
    held = quality.assess(documents, forest).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    right = [(r.kept or r.base_failed and r.quality == 1) == (r.quality == 1) for r in held]
    assert len(right) > 15 and np.mean(right) > 0.9


def test_score_keeps_directions_and_matches_walking_the_trees():
    rng = np.random.default_rng(3)
    rows = rng.random((400, len(quality.FEATURES)))
    good = (rows[:, 2] + 0.3 * rng.standard_normal(400) > 0.5).astype(float)  # against its direction
    forest = quality.grow(rows, good)
    lower, higher = rows.copy(), rows.copy()
    lower[:, 2], higher[:, 2] = 0.1, 0.9
    assert (forest.score(higher) <= forest.score(lower) + 1e-12).all()

    def walk(row):
        total = forest.base
        for node in forest.roots:
            while forest.left[node] != node:
                node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            total += forest.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(rows[:50]), [walk(r) for r in rows[:50]])


def test_training_without_labels_keeps_all(documents, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert (quality.train(documents, none).score(np.zeros((3, len(quality.FEATURES)))) > 0.5).all()


def test_a_key_that_many_rows_share_comes_to_the_driver_once(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 0), (None, 1)], "doc_id bigint, quality int")
    assert len(quality.train(docs, labels, bound=10).roots) > 0
