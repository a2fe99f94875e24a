"""A replay takes records out of quarantine exactly once, wherever it dies."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cinderlog.operators import binding
from cinderlog.sinks import changes, generations, index as log_index

KEEP = "client_id string"


def _record(i, size=0):
    # times every third hour, so that records fall on several dates; some have none
    stamp = "" if i % 7 == 0 else f'"timestamp":"2024-01-{i % 3 + 1:02d}T00:00:00Z",'
    return f'{{"logId":"{i}",{stamp}"service":"s","level":"INFO","message":"{"x" * size}"}}'


def _batches(spark, base):
    """Batches of ten: three are too large for the first limit, two are no JSON."""
    index, kept_out = str(base / "index"), str(base / "quarantine")
    for batch in range(3):
        ids = range(batch * 10, batch * 10 + 10)
        texts = [(_record(i, 300 if i % 10 < 3 else 0) if i % 10 < 8 else f"broken {i}", f"c{i % 2}") for i in ids]
        bound = binding.bind(spark.createDataFrame(texts, f"value string, {KEEP}"), "json", max_bytes=200)
        log_index.write_index_batch(binding.valid_events(bound, "client_id"), index, batch)
        log_index.write_batch_folder(binding.quarantine(bound, "client_id"), kept_out, batch)
    return kept_out, index


def _state(spark, kept_out, index):
    left = Counter(r["raw"] for r in generations.read_quarantine(spark, kept_out, KEEP).collect())
    return Counter(r["log_id"] for r in log_index.read_index(spark, index).collect()), left


VALID = Counter(str(i) for i in range(30) if i % 10 < 8)
BROKEN = Counter(f"broken {i}" for i in range(30) if i % 10 >= 8)


def test_valid_ones_leave_and_others_stay(spark, tmp_path):
    kept_out, index = _batches(spark, tmp_path)
    before = {r["raw"]: (r["seen_at"], r["client_id"]) for r in generations.read_quarantine(spark, kept_out, KEEP).collect()}
    assert generations.replay_out(spark, kept_out, index, keep=KEEP) == (6, 4)  # the newest batch waits
    assert generations.replay_out(spark, kept_out, index, keep=KEEP, stopped=True) == (3, 6)
    assert _state(spark, kept_out, index) == (VALID, BROKEN)
    assert generations.replay_out(spark, kept_out, index, keep=KEEP, stopped=True) == (0, 6)
    assert _state(spark, kept_out, index) == (VALID, BROKEN)
    rows = generations.read_quarantine(spark, kept_out, KEEP).collect()
    assert {(r["seen_at"], r["client_id"]) for r in rows} == {before[r["raw"]] for r in rows}
    assert {(r["reason"], r["first_reason"]) for r in rows} == {("not_json_object", "not_json_object")}
    clients = log_index.read_index(spark, index).groupBy("client_id").count().collect()
    assert {r["client_id"]: r["count"] for r in clients} == {"c0": 12, "c1": 12}


@pytest.mark.parametrize("step, call, meanwhile", [
    ("begin", 2, False), ("plan", 1, False), ("finish", 1, True), ("finish", 2, False), ("finish", 2, True), ("sweep", 2, True),
])
def test_replay_that_dies_neither_loses_nor_doubles(spark, tmp_path, monkeypatch, step, call, meanwhile):
    """It dies before a step; a compaction of the index may come before the next replay."""
    kept_out, index = _batches(spark, tmp_path)
    original, calls = getattr(changes.Changes, step), []

    def wrapped(self, *args):
        calls.append(step)
        if len(calls) == call:
            raise OSError("the driver is gone")
        return original(self, *args)

    with monkeypatch.context() as m:
        m.setattr(changes.Changes, step, wrapped)
        with pytest.raises(OSError):
            generations.replay_out(spark, kept_out, index, keep=KEEP, stopped=True)
    if meanwhile:
        log_index.compact_index(spark, index, stopped=True)
    # also before the next replay no record is lost, and none is in the index twice
    there, left = _state(spark, kept_out, index)
    assert set(there.values()) == {1}
    assert set(VALID) <= set(there) | {json.loads(raw)["logId"] for raw in left if raw.startswith("{")}
    generations.recover(spark, kept_out, index)
    for _ in range(2):
        generations.replay_out(spark, kept_out, index, keep=KEEP, stopped=True)
        assert _state(spark, kept_out, index) == (VALID, BROKEN)
    assert not changes.Changes(spark, kept_out).open()


def test_empty_quarantine(spark, tmp_path):
    kept_out, index = str(tmp_path / "quarantine"), str(tmp_path / "index")
    assert generations.replay_out(spark, kept_out, index, keep=KEEP) == (0, 0)
    assert generations.read_quarantine(spark, kept_out, KEEP).count() == 0


def test_compaction_takes_replayed_folders(spark, tmp_path):
    kept_out, index = _batches(spark, tmp_path)
    log_index.compact_index(spark, index, stopped=True)
    generations.replay_out(spark, kept_out, index, keep=KEEP, stopped=True)
    log_index.compact_index(spark, index, stopped=True)
    assert _state(spark, kept_out, index) == (VALID, BROKEN)
    children = changes.Changes(spark, index).visible()
    assert len([c for c in children if c.startswith("event_date=2024-01-01")]) == 1
