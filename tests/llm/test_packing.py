from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest

from cinderlog.llm import packing


def _check(docs, packed, capacity=1024):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in packed.collect():
        pieces[r.doc_id].append((r.start, r.piece, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    for key, texts in docs.items():
        expected = []
        for text in texts:
            ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
            first = len(ids) % capacity or capacity
            at = [0, *range(first, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
            for i, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                expected.append((a, i, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
        assert sorted(pieces[key]) == sorted(expected)
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return sum(length for p in bins.values() for _, length in p), len(bins)


def test_documents_are_packed_whole_and_densely(documents):
    docs = {r.doc_id: [r.text] for r in documents.collect()}
    tokens, bins = _check(docs, packing.pack(documents))
    assert bins <= -(-tokens // 1024) * 1.02 + 2


def test_rounds_up_the_tree(documents):
    """Many tiny partitions still give sequences that hold every piece once."""
    docs = {r.doc_id: [r.text] for r in documents.collect()}
    tokens, bins = _check(docs, packing.pack(documents.repartition(40)))
    assert bins <= -(-tokens // 1024) * 1.2 + 2


def test_edges_and_empty_table(edges, nothing):
    docs = defaultdict(list)
    for r in edges.collect():
        docs[r.doc_id].append(r.text)
    _check(docs, packing.pack(edges))
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("sizes", [[600] * 9, [512] * 8, [1, 1023, 1024, 5, 1019], []])
def test_best_fit(sizes):
    bins = packing.best_fit(sizes)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 1024 for b in bins)
    assert sum(sum(sizes[i] for i in b) <= 512 for b in bins) <= 1


def test_ranks_give_the_ids_of_the_tokenizers_file(documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.tokenizer_of()
    texts = [r.text for r in documents.collect()] + ["", " ", "\n\n  x", "a<|endoftext|>b", "😀 ﷽ don't  \t1234 ..!!"]
    assert [encode(t) for t in texts] == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_each_folder_of_tokenizers_has_its_own(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Hello hello")], "doc_id bigint, text string").coalesce(1)
    assert packing.pack(docs).count() == 1
    with pytest.raises(Exception, match="No such file"):  # not the tokenizer that the worker holds already
        packing.pack(docs, tokenizers=str(tmp_path / "none")).count()
