from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from cinderlog.llm import manifest, midstate

NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(*values):
    return _hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([_hash(*found[-1][i:i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def _plain(rows):
    """Every column by rebuilding the trees; rows are tuples of NAMES."""
    leaves = {r: _leaf(*r) for r in rows}
    order = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted((r for r in rows if r[1] == s), key=lambda r: r[0]) for s in order}
    trees = {s: _levels([leaves[r] for r in groups[s]]) for s in order}
    top = _levels([trees[s][-1][0] for s in order])
    out = []
    for s in order:
        for i, r in enumerate(groups[s]):
            found = r
            if zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                found = (*r[:4], r[4].replace("\n", ""))
            own, proof = _leaf(*found), []
            for levels, at in ((trees[s], i), (top, order.index(s))):
                for level in levels[:-1]:
                    run = list(level[at // 3 * 3:at // 3 * 3 + 3])
                    proof += run[:at % 3] + run[at % 3 + 1:]
                    run[at % 3] = own
                    own, at = _hash(*run), at // 3
            root = top[-1][0]
            out.append((r[0], leaves[r], trees[s][-1][0], root, _hash(*proof), own, own == root))
    return sorted(out)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")


@pytest.fixture(params=[6, 1, 2])
def steps(request, monkeypatch):
    """Chunks of several heights, so that small trees take several rounds; tasks get the module by value."""
    monkeypatch.setattr(manifest, "STEP", request.param)
    monkeypatch.setattr(manifest, "WIDTH", 3**request.param)
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules["cinderlog.llm.manifest"])
    yield
    cloudpickle.unregister_pickle_by_value(sys.modules["cinderlog.llm.manifest"])


def test_trees_of_all_shapes(spark, steps):
    pick = random.Random(2)
    rows = []
    for n, source in ((1, None), (2, "b"), (3, "é"), (4, "a"), (28, "z"), (85, "hot"), (9, "B")):
        for _ in range(n):
            text = pick.choice([None, "", "one\ntwo", "no break", "Straße\n"])
            rows.append((len(rows), source, pick.choice([None, "de"]), pick.choice([None, 7]), text))
    found = manifest.audit(_frame(spark, rows)).collect()
    assert sorted(map(tuple, found)) == _plain(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_few_rows(spark, n):
    rows = [(i, "s", "en", i, f"t\n{i}") for i in range(n)]
    assert sorted(map(tuple, manifest.audit(_frame(spark, rows)).collect())) == _plain(rows)


def test_many_small_groups(spark):
    rows = [(i, f"s{i}", "en", i, f"t\n{i}") for i in range(900)]
    assert sorted(map(tuple, manifest.audit(_frame(spark, rows)).collect())) == _plain(rows)


def test_documents(documents):
    rows = [tuple(r[c] for c in NAMES) for r in documents.collect()]
    assert sorted(map(tuple, manifest.audit(documents).collect())) == _plain(rows)


def test_chunks_across_batches(spark):
    rows = [(i, "s" if i % 3 else None, "en", i, f"t\n{i}") for i in range(800)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert sorted(map(tuple, manifest.audit(_frame(spark, rows)).collect())) == _plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repeated_rows_null_keys_clashing_columns_and_empty_table(spark):
    rows = [(1, "s", "en", 1, "a\n", "x"), (1, "s", "en", 1, "a\n", "y"), (None, "s", None, None, None, "z"), (2, None, None, 2, "", "q")]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string, levels string")
    for df in (frame, frame.withColumn("_part", frame.levels).withColumn("leaf", frame.levels)):
        found = manifest.audit(df).collect()
        assert len(found) == 4 and len({r.root for r in found}) == 1
        assert all(r.verified for r in found if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 2)
    assert manifest.audit(frame.where("false")).count() == 0


def test_resumed_states_give_the_hash_of_the_library():
    texts = [hashlib.sha256(bytes([i])).hexdigest() for i in range(50)]
    data = np.frombuffer("".join(texts).encode(), np.uint8).reshape(-1, 64)
    kept = midstate.absorb(midstate.started(50), midstate.as_blocks(data))
    more = midstate.absorb(kept, midstate.as_blocks(data[::-1]))
    for states, blocks, join in ((kept, 1, lambda i: texts[i]), (more, 2, lambda i: texts[i] + texts[49 - i])):
        found = midstate.as_text(midstate.finished(states, np.full(50, blocks)))
        assert [bytes(x).decode() for x in found] == [hashlib.sha256(join(i).encode()).hexdigest() for i in range(50)]
