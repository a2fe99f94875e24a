from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cinderlog.llm import perfect, queries, tokens

NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def _byte_letters():
    """The letter that stands for each byte in the vocabulary file: itself if it can be seen, else the next from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ends(pieces):
    ends, at = [], 0
    for p in pieces:
        at += len(p)
        ends.append(at)
    return ends


def _plain(rows, coders):
    letters = _byte_letters()
    done, count = [], Counter()
    for key, text in rows:
        ids, groups, links = ([], []), [], []
        if text:
            a = coders[0].encode(" " + text, add_special_tokens=False).ids
            b = coders[1].encode(text)
            pieces = [bytes(letters[c] for c in coders[0].id_to_token(i)) for i in a], []
            for i in b:
                name = coders[1].id_to_piece(i)
                byte = re.fullmatch("<0x(..)>", name)
                pieces[1].append(bytes([int(byte[1], 16)]) if byte else name.replace("▁", " ").encode())
            if all(b"".join(p) == (" " + text).encode() for p in pieces):
                ids = a, b
                ends = [_ends(p) for p in pieces]
                i = j = start = other = 0
                while i < len(a) and j < len(b):
                    links.append((a[i], b[j]))
                    x, y = ends[0][i], ends[1][j]
                    i, j = i + (x <= y), j + (y <= x)
                    if x == y:
                        groups.append((a[start:i], b[other:j]))
                        start, other = i, j
        count.update(links)
        done.append((key, ids, groups, links))
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for key, ids, groups, links in done:
        text = ";".join("|".join(",".join(map(str, x)) for x in g) for g in groups)
        out.append((
            key, len(ids[0]), len(ids[1]), len(groups), len(links), sum(count[x] == best[x[1]] for x in links),
            sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=str), count


def _found(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


def _texts():
    texts = [
        "Hello world", "hello  two  blanks ", " leading", "tab\tand\nline\r\n", "Straße für 😀 naïve", "▁ lower block",
        "<|endoftext|> and <s> </s> <unk> <0x41>", "日本語のテキスト", "a" * 3000, "x", " ", "\n", "", None, "Hello world",
        "word " * 500, "zero\u0000byte", " hard blank", "é composed ﬁ",
    ]
    return list(enumerate(texts))


def test_texts_match_brute_force(spark, coders):
    rows = _texts()
    found = tokens.alignment(spark.createDataFrame(rows, "doc_id bigint, text string"), with_groups=True)
    expected, count = _plain(rows, coders)
    assert _found(found.documents) == expected and found.documents.columns == [*NAMES, "groups"]
    assert {(r.a, r.b): r.n for r in tokens.pair_table(found.counts).collect()} == dict(count)
    for r in found.documents.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")


def test_query_matches_brute_force(spark, sf_dir, documents, coders):
    expected, _ = _plain([(r.doc_id, r.text) for r in documents.collect()], coders)
    found = queries.op11_token_alignment(spark, sf_dir)
    assert found.columns == NAMES and _found(found) == expected


def test_blocks_of_shards_and_trees_give_the_same(spark, documents, coders, monkeypatch):
    some = documents.limit(60)
    expected, _ = _plain([(r.doc_id, r.text) for r in some.collect()], coders)
    monkeypatch.setattr(tokens, "FAN_IN", 2)
    found = tokens.alignment(some.repartition(7), block_bytes=20_000).documents
    assert _found(found) == expected


def test_edges_and_empty_table(edges, nothing, coders):
    expected, _ = _plain([(r.doc_id, r.text) for r in edges.collect()], coders)
    assert _found(tokens.alignment(edges).documents) == expected
    assert tokens.alignment(nothing).documents.count() == 0


def test_batches_of_one_text(spark, coders):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        rows = _texts()
        found = tokens.alignment(spark.createDataFrame(rows, "doc_id bigint, text string")).documents
        assert _found(found) == _plain(rows, coders)[0]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_perfect_hash():
    pick = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 1000, 50_000):
        keys = np.unique(pick.integers(0, 2**32, n))
        found = perfect.PerfectHash.of(keys)
        assert sorted(found.index(keys).tolist()) == list(range(len(keys)))
        assert len(found.words) * 64 <= 5 * len(keys) + 64 * 40
        others = found.index(pick.integers(2**32, 2**33, 100))
        assert ((others >= -1) & (others < max(1, len(keys)))).all()
