from __future__ import annotations

import itertools
import random

import corpus_pipeline
from cinderlog.llm import simhash, similar
from tests.llm import plain


def _texts():
    """Copies of a few texts with words replaced, at similarities on both sides of 0.8, and a passage that all share."""
    pick = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    rows, passage = [], " ".join(words[:30])
    for n in (9, 24, 60, 300):
        base = pick.choices(words, k=n)
        for changes in (0, 0, 1, 1, 2, 3, 4, 5, 6, 8, 12):
            own = list(base)
            for at in pick.sample(range(n), min(changes, n)):
                own[at] = pick.choice(words)
            rows.append(" ".join(own))
    rows += [f"{passage} {' '.join(pick.choices(words, k=12))}" for _ in range(20)]
    return list(enumerate(rows + ["", None, "  \n", "one two", "One\ttwo", "one two three"]))


def test_stage_finds_near_copies_that_fingerprints_miss(spark):
    rows = _texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = plain.kept_of_near_copies(rows)
    assert sorted(r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, "").collect()) == expected
    assert len(simhash.keep_one(docs).collect()) > len(expected)


def test_groups_in_large_buckets(spark, monkeypatch):
    """Buckets in many blocks, and rounds that each meet few neighbours."""
    rows = _texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = similar.components
    monkeypatch.setattr(similar, "components", lambda found: sets(found, block=3))
    for rounds in (similar.ROUNDS, ((1, None),), ((1, 2), (3, None))):
        monkeypatch.setattr(similar, "ROUNDS", rounds)
        assert sorted(r.doc_id for r in similar.keep_one(docs).collect()) == plain.kept_of_near_copies(rows)


def test_prefixes_alone_find_all(spark, monkeypatch):
    rows = _texts()
    monkeypatch.setattr(similar, "by_fingerprint", lambda sets: sets.sparkSession.createDataFrame([], "a bigint, b bigint"))
    found = similar.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in found.collect()) == plain.kept_of_near_copies(rows)


def test_documents_match_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    kept = similar.keep_one(documents)
    assert kept.columns == documents.columns and sorted(r.doc_id for r in kept.collect()) == plain.kept_of_near_copies(rows)


def test_edges_and_empty_table(edges, nothing):
    kept = similar.keep_one(edges)
    assert kept.columns == edges.columns and similar.keep_one(nothing).count() == 0
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 4, 6, 7, 8, 9, 10, None], key=str)


def test_buckets_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        rows = [(i, "a b c d e f g") for i in range(3)] + [(3, "a b c d e f g h"), (4, "b c d e f g h i j k l m n")]
        found = similar.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert sorted(r.doc_id for r in found.collect()) == plain.kept_of_near_copies(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_prefixes_of_alike_sets_meet():
    pick = random.Random(5)
    for n, m in itertools.product((1, 4, 5, 9, 10, 50), (0, 1, 2, 10)):
        base = pick.sample(range(1000), n + m)
        a, b = (similar.np.array(sorted(x), similar.np.uint64) for x in (base[:n], base[m:]))
        common = similar.np.array(sorted(pick.sample(range(1000), 300)), similar.np.uint64)
        if similar.alike(a, b):
            assert set(similar.prefix(a, common)) & set(similar.prefix(b, common))
            ones = similar.np.unpackbits(similar.np.frombuffer(similar.sketch(a), "u1") ^ similar.np.frombuffer(similar.sketch(b), "u1"))
            assert ones.sum() <= len(similar.np.setxor1d(a, b))


def test_prefixes_of_alike_sets_share_as_many_as_are_needed():
    pick = random.Random(7)
    for n, less, more in itertools.product((1, 2, 3, 9, 20, 21, 80, 200), (0, 1, 2, 10, 40), (0, 1, 2, 10)):
        base = pick.sample(range(4000), n + more)
        a, b = (similar.np.array(sorted(x), similar.np.uint64) for x in (base[:n], base[min(less, n - 1):]))
        for often in (0, 1000, 4000):
            common = similar.np.array(sorted(pick.sample(range(4000), often)), similar.np.uint64)
            met = len(set(similar.prefix(a, common)) & set(similar.prefix(b, common)))
            assert not similar.alike(a, b) or met >= similar.needed(len(a), len(b)) >= 1


def test_sets_that_share_little_are_no_candidates(spark, monkeypatch):
    """Sketches rule out no large sets; texts of pairs that share a passage would move with each pair."""
    pick, tried, verified = random.Random(11), [], similar.verified
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"{passage} {' '.join(f'w{i}x{pick.random()}' for _ in range(2000))}") for i in range(12)]
    rows += [(12, rows[0][1] + " and more"), (13, " ".join(rows[1][1].split()[:1700]))]
    monkeypatch.setattr(similar, "by_fingerprint", lambda sets: sets.sparkSession.createDataFrame([], "a bigint, b bigint"))
    monkeypatch.setattr(similar, "verified", lambda pairs, sets: tried.append(pairs.count()) or verified(pairs, sets))
    kept = similar.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == plain.kept_of_near_copies(rows) == list(range(12))
    assert sum(tried) == 2


def test_buckets_meet_in_slices(spark, monkeypatch):
    """Pairs are counted over all slices and rounds."""
    rows = _texts()
    docs, met, sizes = spark.createDataFrame(rows, "doc_id bigint, text string"), similar.met, []
    monkeypatch.setattr(similar, "SLICE", 100)
    monkeypatch.setattr(similar, "SLICES", 3)
    monkeypatch.setattr(similar, "met", lambda shared, *rest: sizes.append(shared.count()) or met(shared, *rest))
    for rounds in (similar.ROUNDS, ((1, None),), ((1, 2), (3, None))):
        sizes.clear()
        monkeypatch.setattr(similar, "ROUNDS", rounds)
        assert sorted(r.doc_id for r in similar.keep_one(docs).collect()) == plain.kept_of_near_copies(rows)
        assert len(sizes) == 3 * len(rounds) and min(sizes) > 0 and max(sizes[:3]) < sum(sizes[:3]) / 2
