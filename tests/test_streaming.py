"""Streams: restart, equality with tables, fan-out, strict mode and windows."""

from __future__ import annotations

import json
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cinderlog.operators import aggregate
from cinderlog.operators.binding import bind, quarantine, valid_events
from cinderlog.sinks import index as log_index, terms
from cinderlog.sources import landing
from cinderlog.streaming import jobs, silence


def _record(i: int, **more) -> str:
    return json.dumps({"logId": str(i), "timestamp": f"2026-07-{1 + i % 3:02d}T10:{i % 60:02d}:00Z", "service": f"s{i % 2}",
                       "level": ["INFO", "ERROR"][i % 5 == 0], "message": f"m{i}", **more})


def _put(folder, name: str, lines: list[str]) -> None:
    (folder / "c1").mkdir(parents=True, exist_ok=True)
    (folder / "c1" / name).write_text("\n".join(lines) + "\n")


class Job:
    def __init__(self, spark, root):
        self.spark, self.base = spark, root / "logs"
        self.index, self.bad, self.checkpoint = (str(root / n) for n in ("index", "bad", "checkpoint"))

    def run(self, **options):
        stream = landing.stream_landing(self.spark, str(self.base), max_files_per_trigger=1)
        options = {"keep": ["client_id", "file_name"], "arrival": F.col("landed_at"), "parser": F.col("parser"), **options}
        query = jobs.run_log_stream(stream, self.index, self.bad, self.checkpoint, trigger=None, **options)
        query.awaitTermination()
        return query

    def ids(self) -> Counter:
        return Counter(r["log_id"] for r in log_index.read_index(self.spark, self.index).collect())


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, tmp_path)


def test_restart_loses_and_repeats_nothing(spark, job):
    _put(job.base, "a.json", [_record(i) for i in range(20)] + ["broken"])
    _put(job.base, "b.json", [_record(i) for i in range(20, 30)])
    job.run()
    assert job.ids() == Counter(str(i) for i in range(30))
    _put(job.base, "c.ndjson", [_record(i) for i in range(30, 40)] + ['{"x":1}'])
    job.run()
    job.run()
    assert job.ids() == Counter(str(i) for i in range(40))
    bad = spark.read.parquet(job.bad).collect()
    assert sorted((r["reason"], r["client_id"]) for r in bad) == [("not_json_object", "c1"), ("unknown_field", "c1")]


def test_replay_after_a_failed_sink(spark, job):
    """The batch fails after the index was written; its replay leaves one copy."""
    _put(job.base, "a.json", [_record(i) for i in range(20)])

    def fail(events, batch_id):
        raise RuntimeError("sink down")

    with pytest.raises(Exception, match="sink down"):
        job.run(sinks=[fail])
    assert sum(job.ids().values()) == 20
    job.run()
    assert job.ids() == Counter(str(i) for i in range(20))


def test_stream_equals_table(spark, job):
    _put(job.base, "a.json", [_record(i) for i in range(50)] + ["", "x", '{"level":"no"}'])
    _put(job.base, "b.yaml", ["a: 1"])
    job.run()
    bound = bind(landing.read_landing(spark, str(job.base)), F.col("parser"), arrival=F.col("landed_at"))
    columns = ["log_id", "event_time", "ingestion_time", "service", "level", "message", "attributes"]
    stream = log_index.read_index(spark, job.index).select(columns)
    table = valid_events(bound).select(columns)
    assert sorted(map(str, stream.collect())) == sorted(map(str, table.collect()))
    reasons = lambda df: Counter(r["reason"] for r in df.collect())
    assert reasons(spark.read.parquet(job.bad)) == reasons(quarantine(bound))


def test_strict_stops_the_query(job):
    _put(job.base, "a.json", [_record(1), "broken"])
    with pytest.raises(Exception, match="not_json_object"):
        job.run(strict=True)


def test_bulk_sink_in_a_stream(spark, job, tmp_path):
    _put(job.base, "a.json", [_record(i) for i in range(30)])
    _put(job.base, "b.json", [_record(99, message="x" * 500)])
    counters, rejected = str(tmp_path / "counters"), str(tmp_path / "rejected")

    def transport(entries, attempt):
        return ["no" if attempt == 1 and '"_id":"7"' in e else None for e in entries]

    job.run(sinks=[jobs.bulk_sink(transport, counters, rejected, max_record_bytes=600)])
    totals = spark.read.parquet(counters).agg(F.sum("submitted"), F.sum("out_errors"), F.sum("partial_failures")).first()
    assert totals[0] >= 2 and tuple(totals)[1:] == (1, 1)
    assert [r["reason"] for r in spark.read.parquet(rejected).collect()] == ["oversize"]


def test_observed_counts(spark, job):
    _put(job.base, "a.json", [_record(i) for i in range(10)] + ["broken"])
    counts = jobs.Counts()
    spark.streams.addListener(counts)
    try:
        job.run()
        for _ in range(50):
            if counts.records:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    assert (counts.records, counts.quarantined) == (11, 1)


def test_index_file_sink_restart(spark, tmp_path):
    base, path, checkpoint = tmp_path / "logs", str(tmp_path / "index"), str(tmp_path / "checkpoint")

    def run():
        stream = valid_events(bind(landing.stream_landing(spark, str(base)), "json"))
        jobs.drain(log_index.index_writer(stream, path, checkpoint))

    _put(base, "a.json", [_record(i) for i in range(10)])
    run()
    _put(base, "b.json", [_record(i) for i in range(10, 20)])
    run()
    assert Counter(r["log_id"] for r in log_index.read_index(spark, path).collect()) == Counter(map(str, range(20)))


def test_map_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("straße\nabc\n")
    writer = lambda df: jobs.file_writer(df, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    jobs.run_map_stream(spark.readStream.text(str(source)), F.upper("value"), writer, trigger=None).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["ABC", "STRASSE"]


def test_windows_close_with_the_watermark(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = "event_time timestamp, service string, level string, message string"

    def put(name, rows):
        (source / name).write_text("".join(json.dumps(dict(zip(("event_time", "service", "level", "message"), r))) + "\n" for r in rows))

    def run():
        stream = spark.readStream.schema(schema).json(str(source))
        jobs.drain(jobs.file_writer(jobs.metrics_stream(stream), str(tmp_path / "out"), str(tmp_path / "checkpoint")))
        return sorted((str(r["window_start"])[11:13], r["n"], r["n_error"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    put("a.json", [("2026-07-01T10:05:00Z", "s", "ERROR", "x"), ("2026-07-01T10:50:00Z", "s", "INFO", "x"), ("2026-07-01T11:05:00Z", "s", "INFO", "x")])
    assert run() == []
    put("b.json", [("2026-07-01T10:59:00Z", "s", "INFO", "in time"), ("2026-07-01T11:15:00Z", "s", "INFO", "x")])
    assert run() == [("10", 3, 1)]
    put("c.json", [("2026-07-01T10:59:30Z", "s", "INFO", "late"), ("2026-07-01T12:20:00Z", "s", "INFO", "x")])
    assert run() == [("10", 3, 1), ("11", 2, 0)]


def test_metrics_of_stream_and_table_agree(spark):
    frame = spark.sql("SELECT timestamp'2026-07-01 10:00:00' event_time, 's' service, 'ERROR' level, 'abc' message")
    row = aggregate.metrics(frame).first()
    assert (row["n"], row["n_error"], row["error_ratio"], row["bytes"]) == (1, 1, 1.0, 3)


def _silences(spark, folder, out, checkpoint):
    source = spark.readStream.schema("service string, at bigint").parquet(str(folder))
    events = source.select("service", F.timestamp_seconds("at").alias("event_time"))
    with silence.timer_state(spark):
        jobs.drain(jobs.file_writer(silence.silence_alerts(events, 1, delay="10 minutes", forget_hours=48), str(out), str(checkpoint)))
    rows = spark.read.schema("service string, alert string, at_us bigint").parquet(str(out)).collect()
    return sorted((r.service, r.at_us // 1_000_000, r.alert) for r in rows)


def test_silence_is_told_once_and_clears_over_a_restart(spark, tmp_path):
    hour, start = 3600, 1_767_225_600

    def arrive(*events):
        rows = [(name, start + at) for name, at in events]
        spark.createDataFrame(rows, "service string, at bigint").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def alerts():
        found = _silences(spark, tmp_path / "in", tmp_path / "out", tmp_path / "state")
        return [(name, at - start, alert) for name, at, alert in found]

    arrive(("a", 0), ("a", hour), ("a", 3 * hour), ("b", 0), ("b", 3 * hour - 60))
    first = [("a", 2 * hour, "silent"), ("a", 3 * hour, "back"), ("b", hour, "silent"), ("b", 3 * hour - 60, "back")]
    assert alerts() == first
    arrive(("a", 5 * hour), ("a", 6 * hour))  # after the restart: a is back, b's silence is told by its timer
    second = sorted([*first, ("a", 4 * hour, "silent"), ("a", 5 * hour, "back"), ("b", 4 * hour - 60, "silent")])
    assert alerts() == second
    arrive(("a", 7 * hour), ("b", 7 * hour))
    third = sorted([*second, ("b", 7 * hour, "back")])
    assert alerts() == third
    assert alerts() == third


def test_repeats_of_a_topic_are_dropped_and_the_state_is_bounded(spark, job):
    _put(job.base, "a.json", [_record(i) for i in range(20)] + [_record(3), "broken", "broken"])
    job.run(repeats_within="1 hour")
    _put(job.base, "b.json", [_record(i) for i in range(10, 30)] + ["broken"])  # a replayed slice
    query = job.run(repeats_within="1 hour")
    assert job.ids() == Counter(str(i) for i in range(30))
    assert [r["reason"] for r in spark.read.parquet(job.bad).collect()] == ["not_json_object"]
    states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert states and max(states) <= 31
    with pytest.raises(ValueError, match="arrival"):
        job.run(repeats_within="1 hour", arrival=None)


def test_a_batch_of_a_stream_with_state_leaves_one_file_a_date(spark, job, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    _put(job.base, "a.json", [_record(i) for i in range(60)])
    job.run(repeats_within="1 hour")
    assert job.ids() == Counter(str(i) for i in range(60))
    assert len(list((tmp_path / "index").rglob("*.parquet"))) == 3
    assert spark.conf.get("spark.sql.adaptive.enabled") == before


def test_state_is_kept_in_the_parts_asked_for(spark, job):
    _put(job.base, "a.json", [_record(i) for i in range(20)])
    query = job.run(repeats_within="1 hour", state_partitions=3)
    assert {s["numShufflePartitions"] for p in query.recentProgress for s in p["stateOperators"]} == {3}
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8" and job.ids() == Counter(str(i) for i in range(20))


def test_terms_keep_up_with_the_stream(spark, job, tmp_path):
    words = str(tmp_path / "terms")
    for n, name in enumerate("abc"):
        _put(job.base, f"{name}.json", [_record(100 * n + i) for i in range(20)])
        job.run(terms_path=words)
    found = terms.search_index(spark, job.index, words, ["m105"])
    assert [r["log_id"] for r in found.collect()] == ["105"]
    assert len(terms.opened_files(spark, job.index, words, ["m105"])) == 1 < len(terms.index_files(spark, job.index))
