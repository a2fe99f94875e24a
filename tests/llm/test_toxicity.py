from __future__ import annotations

import numpy as np

from cinderlog.llm import toxicity

CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1"}


def _chain(documents, labels):
    return toxicity.train(documents, labels, CATEGORIES)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    chain = _chain(documents, labels.where("doc_id % 3 <> 0"))
    held = toxicity.score(documents, chain).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    said, true = np.array([r.p_toxic >= 0.5 for r in held]), np.array([r.toxic == 1 for r in held])
    assert len(held) > 80 and (said == true).mean() > 0.93
    assert (said & true).sum() >= 0.6 * true.sum()


def test_reading_for_scores_is_reading_for_training(documents):
    texts = [r.text for r in documents.limit(50).collect()] + [None, "", "Worthless worthless WORTHLESS worth"]
    chosen = sorted({b for t in texts for b in toxicity.buckets_of(t)})[::3]
    chain = toxicity.Chain(("a",), {b: i for i, b in enumerate(chosen)}, np.zeros((1, len(chosen))), (np.zeros(0),), np.zeros(1))
    memory = {}
    for text in texts:
        assert chain.read(text, memory) == sorted(chain.columns[b] for b in toxicity.buckets_of(text) if b in chain.columns)


def test_later_categories_read_earlier_ones():
    rng = np.random.default_rng(2)
    first = rng.random(400) < 0.5
    buckets = [[1] if x else [2] for x in first]
    chain = toxicity.fit_chain(["a", "b"], buckets, np.stack([first, first], 1).astype(float), [1, 2])
    assert len(chain.earlier[0]) == 0 and chain.earlier[1][0] > 0


def test_edges_and_nothing_to_learn_from(spark, edges, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    chain = _chain(edges, none)
    rows = toxicity.score(edges, chain).collect()
    assert len(rows) == 12 and all(r.p_toxic < 0.01 and r.p_junk < 0.01 for r in rows)
    assert toxicity.score(nothing, chain).count() == 0
    some = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (9, 1, 0), (None, 1, 1)], none.schema)
    assert toxicity.score(edges, _chain(edges, some)).count() == 12


def test_words_that_a_task_remembers_are_not_hashed_again(monkeypatch):
    text = "Worthless worthless worthy, plain words and worthlessness"
    chosen = toxicity.buckets_of("worthless worthy worthless")
    chain = toxicity.Chain(("a",), {b: i for i, b in enumerate(chosen)}, np.zeros((1, len(chosen))), (np.zeros(0),), np.zeros(1))
    memory: dict = {}
    found = chain.read(text, memory)
    assert found == list(range(len(chosen)))
    monkeypatch.setattr(toxicity.zlib, "crc32", None)
    assert chain.read(text, memory) == found
    monkeypatch.undo()
    monkeypatch.setattr(toxicity, "MEMORY", 1)
    assert chain.read(text, {}) == found
