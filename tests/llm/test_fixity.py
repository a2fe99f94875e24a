from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from cinderlog.llm import fixity


@pytest.fixture
def replica(spark):
    pages = spark.createDataFrame([(i if i % 9 else None, f"u{i % 5}", "x" * (i % 37) + str(i)) for i in range(300)],
                                  "page_id bigint, url string, html string")
    return fixity.archive(pages, "page_id", F.expr(fixity.warc_record("url", "html")))


def _audit(a, b, **sizes):
    return {(r.volume, r.offset): r for r in fixity.audit(fixity.build_tree(a, **sizes), fixity.build_tree(b, **sizes), **sizes).collect()}


def test_equal_replicas_and_empty_ones(replica):
    assert _audit(replica, replica) == {}
    assert _audit(replica.where("false"), replica.where("false")) == {}
    assert len(_audit(replica, replica.where("false"))) == 300


@pytest.mark.parametrize("sizes", [{}, {"range_bytes": 512, "fan_out": 2}])
def test_damage_is_found_and_nothing_else(replica, sizes):
    damaged = replica.where("NOT (record_id <=> 100)").withColumn(
        "record", F.expr("CASE WHEN record_id IN (5, 250) THEN concat(record, '!') ELSE record END")
    )
    found = _audit(replica, damaged, **sizes)
    assert sorted((r.record_id, r.status) for r in found.values()) == [(5, "changed"), (100, "missing"), (250, "changed")]
    assert {r.status for r in _audit(damaged, replica, **sizes).values()} == {"changed", "extra"}
    record = {(r.volume, r.offset): r.record for r in replica.collect()}
    for at, r in found.items():
        assert r.digest_a == hashlib.sha256(record[at].encode()).hexdigest() and r.length_a == len(record[at])


def test_offsets_have_no_gaps(replica, monkeypatch):
    ends = {}
    for r in replica.orderBy("volume", "offset").collect():
        assert r.offset == ends.get(r.volume, 0)
        ends[r.volume] = r.offset + len(r.record.encode())


def test_edges(spark):
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (None, "ü", ""), (2, "u", "😀" * 100_000)], "page_id bigint, url string, html string")
    stored = fixity.archive(pages, "page_id", F.expr(fixity.warc_record("url", "html")))
    assert stored.count() == 4 and _audit(stored, stored) == {}
