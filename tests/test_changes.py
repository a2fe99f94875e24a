"""Changes of an index survive a job that dies, and the archive is proven before anything goes."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cinderlog.sinks import changes, index as log_index, terms
from tests.test_index import _events


def _batches(spark, path, n=4, rows=200):
    for batch in range(n):
        log_index.write_index_batch(_events(spark, rows).where(f"CAST(log_id AS BIGINT) % {n} = {batch}"), path, batch)


def _counts(spark, path):
    return Counter(r["log_id"] for r in log_index.read_index(spark, path).collect())


def _dies(*_):
    raise OSError("the driver is gone")


@pytest.mark.parametrize("step", ["finish", "sweep"])
def test_compaction_that_dies_leaves_each_row_once(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "index")
    _batches(spark, path)
    once = Counter(map(str, range(200)))
    original = getattr(changes.Changes, step)
    calls = []

    def wrapped(self, *args):
        calls.append(step)
        # a compaction sweeps before it begins; it is to die the second time
        return _dies() if len(calls) == (2 if step == "sweep" else 1) else original(self, *args)

    with monkeypatch.context() as m:
        m.setattr(changes.Changes, step, wrapped)
        with pytest.raises(OSError):
            log_index.compact_index(spark, path, stopped=True)
    assert _counts(spark, path) == once
    late = _events(spark, 210).where("CAST(log_id AS BIGINT) >= 200")
    log_index.write_index_batch(late, path, 9)
    once.update(map(str, range(200, 210)))
    assert _counts(spark, path) == once
    for _ in range(2):
        log_index.compact_index(spark, path, stopped=True)
        assert _counts(spark, path) == once
    made = changes.Changes(spark, path)
    assert not made.open()
    by_date = Counter(c.partition("/")[0] for c in made.visible())
    assert sorted(by_date.values())[:-1] == [1] * (len(by_date) - 1)


def test_removal_that_dies_halfway(spark, tmp_path):
    path = str(tmp_path / "index")
    _batches(spark, path)
    log_index.compact_index(spark, path, "2026-01-01", stopped=True, sweep=False)
    made = changes.Changes(spark, path)
    hidden = [c for c in made._children() if c not in made.visible()]
    assert len(hidden) == 4 and all(c.startswith("event_date=2026-01-01/") for c in hidden)
    made._files.delete(made._at(hidden[0]), True)
    assert _counts(spark, path) == Counter(map(str, range(200)))
    assert all(f.rpartition("/")[0] not in hidden for f in terms.index_files(spark, path))
    log_index.sweep(spark, path)
    assert not made.open() and _counts(spark, path) == Counter(map(str, range(200)))


def test_a_batch_that_is_written_again_after_a_compaction(spark, tmp_path):
    path = str(tmp_path / "index")
    _batches(spark, path)
    log_index.compact_index(spark, path)
    log_index.write_index_batch(_events(spark, 200).where("CAST(log_id AS BIGINT) % 4 = 3"), path, 3)
    assert _counts(spark, path) == Counter(map(str, range(200)))


def test_only_batches_are_compacted(spark, tmp_path):
    log_index.write_index(_events(spark, 20), str(tmp_path / "plain"))
    with pytest.raises(ValueError):
        log_index.compact_index(spark, str(tmp_path / "plain"))


def test_archived_dates_do_not_shrink(spark, tmp_path):
    path = str(tmp_path / "archive")
    events = _events(spark, 100, days=2)
    early, late = events.where("CAST(log_id AS BIGINT) < 90"), events.where("CAST(log_id AS BIGINT) >= 90")
    log_index.archive(early, path)
    with pytest.raises(ValueError, match="2026-01-02"):
        log_index.archive(late, path)
    assert sum(_counts(spark, path).values()) == 90
    for _ in range(2):
        log_index.archive(late, path, merge=True)
        assert _counts(spark, path) == Counter(map(str, range(100)))
    log_index.archive(events, path)
    assert _counts(spark, path) == Counter(map(str, range(100)))
    log_index.archive(events.where("false"), path)
    assert sum(_counts(spark, path).values()) == 100


def test_only_proven_dates_expire(spark, tmp_path):
    path, archived = str(tmp_path / "index"), str(tmp_path / "archive")
    _batches(spark, path, rows=100)
    events = _events(spark, 100)
    level = F.when(F.col("log_id") == "30", F.lit(None)).otherwise(F.col("level"))
    log_index.archive(events.where("event_time < '2026-01-03'").withColumn("level", level), archived)
    told = {str(r[0]): r[1:] for r in log_index.expire(spark, path, archived, "2026-01-04").collect()}
    assert told == {"2026-01-01": (20, 0, True), "2026-01-02": (20, 1, False), "2026-01-03": (20, 20, False)}
    assert _counts(spark, path) == Counter(map(str, range(20, 100)))
    # late rows of a date that is gone, and a row that comes twice
    log_index.write_index_batch(events.where("log_id IN ('3', '4')"), path, 7)
    log_index.write_index_batch(events.where("log_id = '3'"), path, 8)
    told = {str(r[0]): r[1:] for r in log_index.expire(spark, path, archived, "2026-01-02").collect()}
    assert told == {"2026-01-01": (3, 1, False)}


def test_proofs_see_every_column(spark):
    events = log_index.with_folder(_events(spark, 3, days=1))
    digest = lambda df: df.agg(F.first("digest")).first()[0]
    proof = digest(log_index.date_proofs(events))
    assert proof == digest(log_index.date_proofs(events.orderBy(F.desc("log_id"))))
    moved = events.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 MICROSECOND"))
    swapped = events.withColumns({"host": F.col("pod_name"), "pod_name": F.col("host")})
    for other in (moved, swapped, events.withColumn("attributes", F.lit(None).cast(events.schema["attributes"].dataType))):
        assert digest(log_index.date_proofs(other)) != proof
