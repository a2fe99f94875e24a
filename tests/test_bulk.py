"""Batch limits, retries, fatal errors and counters of the bulk sink."""

from __future__ import annotations

import json

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cinderlog.operators import bulk
from cinderlog.sinks import bulk as sink


def _brute(sizes, max_count, max_bytes):
    batches, count, used = [], 0, 0
    number = 0
    for size in sizes:
        if count and (count >= max_count or used + size > max_bytes):
            number, count, used = number + 1, 0, 0
        batches.append(number)
        count, used = count + 1, used + size
    return batches


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(1, 40), max_size=60), st.integers(1, 8), st.integers(1, 60), st.integers(1, 9),
)
def test_cut_batches_is_greedy(sizes, max_count, max_bytes, chunk):
    """Cut in runs of any length, the batches are those of one pass record by record."""
    got, base, count, used = [], 0, 0, 0
    for at in range(0, len(sizes), chunk):
        steps, count, used = bulk.cut_batches(np.array(sizes[at:at + chunk]), count, used, max_count, max_bytes)
        got += (base + steps).tolist()
        base = got[-1]
    assert got == _brute(sizes, max_count, max_bytes)


def _documents(spark, n=500, partitions=3):
    return spark.range(n).repartition(partitions).select(
        F.col("id").cast("string").alias("log_id"), F.concat(F.lit('{"i":'), "id", F.lit("}")).alias("document"),
    ).withColumn("bytes", F.octet_length("document").cast("bigint"))


def test_batches_by_size_keep_every_record(spark):
    batched = bulk.batches_by_size(_documents(spark), 40, 300)
    rows = batched.groupBy("lane", "batch_no").agg(F.count("*").alias("n"), F.sum("bytes").alias("b")).collect()
    assert sum(r["n"] for r in rows) == 500
    assert all(r["n"] <= 40 and r["b"] <= 300 for r in rows)
    assert batched.select("log_id").distinct().count() == 500


def test_failed_items_are_sent_again(spark):
    def transport(entries, attempt):
        return ["no" if attempt < 3 and json.loads(e.split("\n")[1])["i"] % 10 == 0 else None for e in entries]

    sent = sink.send_bulk(_documents(spark), transport, max_records=50).collect()
    by_attempt = {}
    for r in sent:
        total = by_attempt.setdefault(r["attempt"], [0, 0])
        total[0] += r["records"]
        total[1] += r["failed"]
    assert by_attempt == {1: [500, 50], 2: [50, 50], 3: [50, 0]}
    assert not any(r["whole_request"] for r in sent)


def test_failed_request_is_sent_whole_again(spark):
    def transport(entries, attempt):
        if attempt == 1:
            raise TimeoutError("slow")
        return [None] * len(entries)

    sent = sink.send_bulk(_documents(spark, 100, 1), transport, max_records=50)
    counters = bulk.sink_counters(sent).first()
    assert (counters["submitted"], counters["out_errors"], counters["partial_failures"]) == (4, 100, 0)


@pytest.mark.parametrize("raised, message", [
    (ConnectionRefusedError("refused"), "IndexUnreachable"), (OSError("No route to host"), "IndexUnreachable"),
    (ValueError("bad"), "RetriesExhausted"),
])
def test_fatal_and_exhausted(spark, raised, message):
    def transport(entries, attempt):
        raise raised

    with pytest.raises(Exception, match=message):
        sink.send_bulk(_documents(spark, 10, 1), transport, max_attempts=2).collect()


def test_record_above_the_limit_stops_the_sink(spark):
    with pytest.raises(Exception, match="RecordTooLarge"):
        sink.send_bulk(_documents(spark, 10, 1), lambda e, a: [None] * len(e), max_record_bytes=3).collect()


def test_bulk_files_pair_actions_and_documents(spark, tmp_path):
    path = str(tmp_path / "bulk")
    sink.write_bulk_files(_documents(spark), path, doc_id=F.col("log_id"))
    lines = [line for file in (tmp_path / "bulk").glob("part-*") for line in file.read_text().splitlines()]
    pairs = list(zip(lines[::2], lines[1::2]))
    assert len(pairs) == 500
    assert all(json.loads(a)["index"]["_id"] == str(json.loads(d)["i"]) for a, d in pairs)


def test_action_without_id(spark):
    row = bulk.action_rows(_documents(spark, 1, 1)).orderBy("seq").collect()
    assert [r["line"] for r in row] == ['{"index":{"_index":"logs"}}', '{"i":0}']
