from __future__ import annotations

import numpy as np

from cinderlog.llm import language
from tests.llm import plain


def test_held_out_documents(documents):
    model = language.train(documents, language.held_out())
    found = {r.doc_id: r for r in language.identify(documents, model).collect()}
    known = {r.doc_id: r.lang for r in documents.collect()}
    assert set(found) == set(known)
    assert {i for i, r in found.items() if r.held_out} == {i for i in known if plain.held_out(i)}
    held = [found[i].lang_pred == known[i] for i in known if plain.held_out(i)]
    assert len(held) > 20 and np.mean(held) > 0.98
    assert all(0 <= r.score <= 1 for r in found.values())


def test_only_text_decides_and_edges(spark, documents, edges, nothing):
    model = language.train(documents, language.held_out())
    rows = language.identify(edges, model).collect()
    assert len(rows) == 12 and {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert language.identify(nothing, model).count() == 0
    digits = spark.createDataFrame([(1, "12 ²³ ..."), (2, "ab")], "doc_id bigint, text string")
    assert [r.lang_pred == "und" for r in language.identify(digits, model).orderBy("doc_id").collect()] == [True, False]


def test_nothing_to_learn_from(spark, edges):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    model = language.train(docs, language.held_out())
    assert model.languages == ()
    assert {r.lang_pred for r in language.identify(edges, model).collect()} == {"und"}


def test_stretches_of_a_long_text_count_each_gram_once(monkeypatch):
    text = "Die Straße und der Fluß, abc" * 40
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "CHUNK", 37)
    assert (language.gram_counts(text) == whole).all()
    assert whole.sum() == sum(len(text.lower()) - n + 1 for n in language.ORDERS)


def test_sparse_scores_match_the_formula():
    rng = np.random.default_rng(0)
    log_share = np.log(rng.dirichlet(np.ones(language.BUCKETS), 2).T).astype(np.float32)
    model = language.Model(("a", "b"), log_share, np.log([0.3, 0.7]))
    name, score = (x[0] for x in model.predict(["hello there"]))
    total = language.gram_counts("hello there") @ log_share.astype(float) + np.log([0.3, 0.7])
    share = np.exp(total - total.max())
    assert name == "ab"[int(np.argmax(total))] and abs(score - share.max() / share.sum()) < 1e-4
