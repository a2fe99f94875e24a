from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cinderlog.llm import queries, substrings
from tests.llm import plain


def _plain(rows, length=35):
    """(id, n_words, n_removed, kept) by counting every window."""
    words = [plain.WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (key, _), w in zip(rows, words, strict=True):
        gone = {j for i in range(len(w) - length + 1) if count[tuple(w[i:i + length])] > 1 for j in range(i, i + length)}
        out.append((key, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def _found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def _texts():
    """Texts that share passages of lengths about the window's, at all offsets, within and between them."""
    pick = random.Random(4)
    vocabulary = [f"w{i}" for i in range(4000)]
    shared = [pick.choices(vocabulary, k=n) for n in (20, 34, 35, 36, 50, 80, 300)]
    rows = []
    for _ in range(60):
        words: list[str] = []
        for _ in range(pick.randint(0, 4)):
            words += pick.choices(vocabulary, k=pick.randint(0, 60))
            passage = pick.choice(shared)
            a = pick.randint(0, max(0, len(passage) - 35)) if pick.random() < 0.5 else 0
            words += passage[a:a + pick.choice([34, 35, 36, 60, 400])]
        rows.append(pick.choice([" ", "\n", "  \t"]).join(words))
    rows += ["word " * 100, "word " * 35, "word " * 36, "a b " * 40, rows[3], rows[3] + " more", "x " + rows[5], None, ""]
    return list(enumerate(rows))


def test_passages_match_brute_force(spark):
    rows = _texts()
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert _found(found) == _plain(rows)
    for r in found.collect():
        words = plain.WORD.findall(dict(rows)[r.doc_id] or "")
        gone = {i for s in r.spans for i in range(s.start, s.end)}
        assert len(gone) == r.n_removed and r.kept == " ".join(w for i, w in enumerate(words) if i not in gone)
        assert all(s.end - s.start >= 35 for s in r.spans)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


@pytest.mark.parametrize("length, anchor", [(3, 1), (5, 5), (8, 3)])
def test_other_lengths(spark, length, anchor):
    pick = random.Random(length)
    rows = [(i, " ".join(pick.choices("abcd", k=pick.randint(0, 40)))) for i in range(25)]
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), length=length, anchor=anchor)
    assert _found(found) == _plain(rows, length)


def test_query_matches_brute_force(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    expected = [(k, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for k, n, gone, kept in _plain(rows)]
    found = queries.op13_substring_dedup(spark, sf_dir)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == expected and any(r[2] for r in expected)


def test_edges_and_empty_table(edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert _found(substrings.remove_repeats(edges)) == _plain(rows)
    assert substrings.remove_repeats(nothing).count() == 0


def test_blocks_and_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = _texts()
        assert _found(substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))) == _plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = [(t or "").encode().split() for _, t in _texts()]
    hashes = substrings._Hashes()
    whole = substrings.stretches(docs, hashes, 35, 12)
    monkeypatch.setattr(substrings, "BLOCK", 50)
    parts = [substrings.stretches([d], hashes, 35, 12) for d in docs]
    for name in ("start", "count", "anchor", "whole", "edges"):
        assert np.array_equal(getattr(whole, name), np.concatenate([getattr(p, name) for p in parts]))


def test_rolling_hashes():
    words = np.random.default_rng(1).integers(0, 2**63, 100).astype(np.uint64)
    for size in (1, 2, 3, 12, 35, 99, 100, 101):
        found = substrings.rolling(words, size)
        assert len(found) == max(0, 101 - size)
        for i in (0, len(found) - 1):
            if len(found):
                total = 0
                for w in words[i:i + size].tolist():
                    total = (total * substrings._BASE + w) % 2**64
                assert int(found[i]) == total
