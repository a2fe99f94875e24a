"""Term index, clustered layout and rollups: the same rows as a scan, with less read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cinderlog.operators import rollups, search
from cinderlog.sinks import clustered, index as log_index, terms


def _events(spark, n, days=5, traces=500):
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("log_id"), F.lit("h").alias("host"),
        F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id") * (86_400 * days) / n).alias("event_time"),
        F.lit(None).cast("timestamp").alias("ingestion_time"), F.concat(F.lit("svc-"), F.col("id") % 7).alias("service"),
        *[F.lit(None).cast("string").alias(c) for c in ("instance_id", "namespace", "pod_name")],
        F.concat(F.lit("t"), F.pmod(F.xxhash64("id"), F.lit(traces))).alias("trace_id"),
        F.when(F.col("id") % 10 == 0, "ERROR").otherwise("INFO").alias("level"),
        F.concat(F.lit("Done number "), F.col("id")).alias("message"),
        F.expr("array(named_struct('id', id, 'logId', 'x', 'key', 'k', 'value', CAST(id % 1000 AS STRING)))").alias("attributes"),
    )
    return rows


@pytest.fixture
def indexed(spark, tmp_path):
    path, words = str(tmp_path / "index"), str(tmp_path / "terms")
    events = _events(spark, 2000)
    for part in range(4):
        log_index.write_index(events.where(f"CAST(log_id AS BIGINT) % 4 = {part}"), path)
    return path, words


def _ids(df):
    return sorted(r["log_id"] for r in df.collect())


def test_rare_words_open_few_files(spark, indexed):
    path, words = indexed
    total = len(terms.index_files(spark, path))
    assert terms.opened_files(spark, path, words, ["number"]) == terms.index_files(spark, path)  # nothing is covered yet
    assert terms.update_terms(spark, path, words) == total and terms.update_terms(spark, path, words) == 0
    assert len(terms.opened_files(spark, path, words, ["done", "1234"])) == 1 and total >= 20
    assert terms.opened_files(spark, path, words, ["nowhere"]) == []
    logs = log_index.read_index(spark, path)
    for query, mode in ((["Done", "1234"], "all"), (["7", "1999"], "any"), (["nowhere"], "all"), (["number"], "all")):
        assert _ids(terms.search_index(spark, path, words, query, mode)) == _ids(search.search(logs, query, mode=mode))
    assert _ids(terms.phrase_in_index(spark, path, words, "number 77")) == ["77"]
    assert _ids(terms.phrase_in_index(spark, path, words, "77 number")) == []
    assert _ids(terms.attribute_in_index(spark, path, words, "k", "5")) == _ids(search.filter_events(logs, attribute=("k", "5")))
    assert len(terms.opened_files(spark, path, words, [terms.attribute_term("k", "5")])) <= 2
    assert terms.opened_files(spark, path, words, ["number"], since="2026-01-02", until="2026-01-02") == [
        f for f in terms.index_files(spark, path) if "2026-01-02" in f
    ]


def test_new_and_removed_files_are_found_out(spark, indexed):
    path, words = indexed
    terms.update_terms(spark, path, words)
    log_index.write_index(_events(spark, 2050).where("CAST(log_id AS BIGINT) >= 2000"), path)
    assert _ids(terms.search_index(spark, path, words, ["2040"])) == ["2040"]  # not covered yet
    # a run whose files were not recorded counts for nothing
    spark.read.schema(terms._POSTINGS).parquet(f"{words}/postings").withColumn("run", F.lit("broken")).write.partitionBy(
        "run", "bucket").mode("append").parquet(f"{words}/postings")
    assert _ids(terms.search_index(spark, path, words, ["40"])) == ["40"]
    assert terms.update_terms(spark, path, words) > 0
    assert len(terms.opened_files(spark, path, words, ["2040"])) == 1


def _read_rows(df):
    """Rows that the scan gave, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getName() else plan
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


def test_clustered_lookups_skip_row_groups(spark, tmp_path):
    path, plain = str(tmp_path / "clustered"), str(tmp_path / "plain")
    events = _events(spark, 60_000, days=2, traces=20_000)
    clustered.write_clustered(events, path, files_a_date=4, row_group_bytes=64 << 10)
    logs = log_index.read_index(spark, path)
    for facets in (
        {"trace_id": "t77"}, {"services": ["svc-3"], "since": "2026-01-01T03:00:00Z", "until": "2026-01-01T06:00:00Z"},
        {"min_level": "ERROR", "services": ["svc-1"]}, {"trace_id": "none"},
    ):
        assert _ids(search.filter_events(logs, **facets)) == _ids(search.filter_events(events, **facets))
    one = logs.where("trace_id = 't77'")
    assert 0 < one.count() <= _read_rows(one) < 60_000 / 3
    log_index.write_index(events, plain)
    box = "service = 'svc-3' AND event_time >= '2026-01-01T03:00:00Z' AND event_time < '2026-01-01T06:00:00Z'"
    assert _read_rows(logs.where(box)) < _read_rows(log_index.read_index(spark, plain).where(box))


def test_layout_of_nulls_and_empty_tables(spark, tmp_path):
    events = _events(spark, 10).withColumn("service", F.lit(None).cast("string")).withColumn(
        "event_time", F.when(F.col("log_id") != "3", F.col("event_time")))
    clustered.write_clustered(events, str(tmp_path / "some"))
    assert _ids(log_index.read_index(spark, str(tmp_path / "some"))) == sorted(map(str, range(10)))
    clustered.write_clustered(events.where("false"), str(tmp_path / "none"))


def test_rollups_merge_to_any_span(spark):
    events = _events(spark, 5000, days=40, traces=3000)
    hours = rollups.hourly(events)
    for unit, by in (("day", ["service"]), ("month", ["service"]), ("month", [])):
        found = rollups.figures(rollups.merged(rollups.merged(hours, "day"), unit, by), by).collect()
        group = [F.date_trunc(unit, "event_time").alias("hour"), *by]
        exact = events.groupBy(*group).agg(
            F.count("*").alias("n"), F.count_if(F.col("level") == "ERROR").alias("n_error"), F.sum(F.octet_length("message")).alias("bytes"),
            F.count_distinct("trace_id").alias("traces"),
        ).collect()
        key = lambda r: (r["hour"], *[r[b] for b in by])
        want = {key(r): r for r in exact}
        assert {key(r) for r in found} == set(want)
        for r in found:
            e = want[key(r)]
            assert (r.n, r.n_error, r.bytes) == (e.n, e.n_error, e.bytes)
            assert abs(r.n_traces - e.traces) <= 0.05 * e.traces + 1 and 13 <= r.p50 <= 16
            assert [(x["item"], x["count"]) for x in r.top_hosts] == [("h", e.n)]


def test_late_events_change_their_hours_only(spark, tmp_path):
    path = str(tmp_path / "hours")
    events = _events(spark, 1000, days=3)
    late = "CAST(log_id AS BIGINT) BETWEEN 40 AND 60"
    rollups.write_hours(rollups.hourly(events.where(f"NOT ({late})")), path)
    before = {r["f"] for r in rollups.read_hours(spark, path).select(F.input_file_name().alias("f")).distinct().collect()}
    for _ in range(2):  # a second run changes nothing
        rollups.update_hours(events, events.where(late), path)
        counts = lambda df: sorted(map(tuple, df.select("hour", "service", *rollups.COUNTS).collect()))
        assert counts(rollups.read_hours(spark, path)) == counts(rollups.hourly(events))
    after = {r["f"] for r in rollups.read_hours(spark, path).select(F.input_file_name().alias("f")).distinct().collect()}
    assert {f for f in before if "on=2026-01-01" not in f} == {f for f in after if "on=2026-01-01" not in f}
