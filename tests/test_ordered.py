"""Ordered operators against brute force, with one hot group and many copies."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from cinderlog.operators import aggregate, ordered, trace


@pytest.fixture(scope="module")
def events(spark):
    """A third of the rows belong to one trace and one service; some are exact copies."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        rows.append((
            f"{i:05d}", "t-hot" if hot else f"t{rng.randrange(200)}", "hot" if hot else f"s{rng.randrange(5)}",
            rng.randrange(100_000), "ERROR" if rng.random() < 0.02 else "INFO",
        ))
    rows += [rows[0]] * 50
    frame = spark.createDataFrame(rows, "log_id string, trace_id string, service string, at int, level string")
    return rows, frame.withColumn("event_time", F.timestamp_seconds(F.col("at"))).drop("at").repartition(5)


def test_row_numbers_follow_the_order(spark, events):
    rows, frame = events
    numbered = ordered.row_numbers(ordered.range_layout(frame, ["log_id"]), "n").select("n", "log_id").collect()
    assert [r["log_id"] for r in sorted(numbered, key=lambda r: r["n"])] == sorted(r[0] for r in rows)
    assert sorted(r["n"] for r in numbered) == list(range(1, len(rows) + 1))


def test_copies_spread_over_ranges(spark):
    copies = spark.range(4000).select(F.lit("same").alias("k"))
    laid = ordered.range_layout(copies, ["k"], ranges=8)
    sizes = [r["count"] for r in laid.groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


def _gaps(rows):
    expected, last = [], {}
    for log_id, trace_id, _, at, _ in sorted(rows, key=lambda r: (r[1], r[3], r[0])):
        expected.append((log_id, (at - last[trace_id]) * 1_000_000 if trace_id in last else None))
        last[trace_id] = at
    return sorted(expected, key=str)


def test_timeline_of_small_and_large_traces(events):
    rows, frame = events
    got = trace.timeline(frame).select("log_id", "gap_us").collect()
    assert sorted(((r[0], r[1]) for r in got), key=str) == _gaps(rows)


def test_around_errors(events):
    rows, frame = events
    expected = []
    ordered_rows = sorted(rows, key=lambda r: (r[2], r[3], r[0]))
    errors = {}
    for r in ordered_rows:
        if r[4] == "ERROR":
            errors.setdefault(r[2], []).append(r)
    for log_id, _, service, at, _ in ordered_rows:
        near = min((abs(e[3] - at) for e in errors.get(service, [])), default=None)
        if near is not None and near <= 60:
            expected.append((log_id, near * 1_000_000))
    got = trace.around_errors(frame, 60).collect()
    assert sorted((r["log_id"], abs(r["gap_us"])) for r in got) == sorted(expected)
    by_id = {r[0]: r for r in rows}
    for r in got:
        assert by_id[r["error_id"]][4] == "ERROR" and by_id[r["error_id"]][2] == r["service"]
        assert (by_id[r["log_id"]][3] - by_id[r["error_id"]][3]) * 1_000_000 == r["gap_us"]


def test_one_trace_in_order(events):
    rows, frame = events
    got = trace.trace_events(frame, "t-hot").collect()
    assert [r["log_id"] for r in got] == [r[0] for r in sorted((r for r in rows if r[1] == "t-hot"), key=lambda r: (r[3], r[0]))]


def test_percentiles_match_the_built_in(spark):
    frame = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.round(F.abs(F.hash("id")) % 1000 / 7, 2).alias("v"),
    ).union(spark.sql("SELECT 'one', 5.0D UNION ALL SELECT CAST(NULL AS STRING), 1.0D UNION ALL SELECT NULL, 2.0D UNION ALL SELECT 'none', NULL"))
    points = [0.0, 0.5, 0.95, 1.0]
    got = {r["g"]: [r[f"p{round(q * 100)}"] for q in points] for r in aggregate.percentiles(frame, "g", "v", points).collect()}
    expected = {
        r["g"]: list(r["p"]) for r in frame.where("v IS NOT NULL").groupBy("g").agg(F.percentile("v", F.array(*[F.lit(q) for q in points])).alias("p")).collect()
    }
    assert got.keys() == expected.keys()
    for g in got:
        assert got[g] == pytest.approx(expected[g])


def test_rows_without_a_trace_are_one_group(spark):
    rows = [(f"{i:03d}", None if i % 2 else "t", i) for i in range(100)]
    frame = spark.createDataFrame(rows, "log_id string, trace_id string, at int").withColumn("event_time", F.timestamp_seconds("at"))
    gaps = sorted((r["log_id"], r["gap_us"]) for r in trace.timeline(frame).collect())
    assert gaps == [(f"{i:03d}", None if i < 2 else 2_000_000) for i in range(100)]


def test_ranges_follow_the_size(spark, monkeypatch):
    frame = spark.range(1000)
    assert ordered.range_count(frame) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(ordered, "RANGE_BYTES", 100)
    assert ordered.range_count(frame) == 80


def test_both_directions_share_their_shuffles(spark, events):
    _, frame = events
    laid = ordered.range_layout(frame.select("service", "log_id"), ["service", "log_id"])
    both = ordered.carry_both(laid, ["service"], F.struct("log_id"), "_a", "_b")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") + plan.count("Window(") <= 4 and plan.count("hashpartitioning(_part") <= 4
    assert "unboundedfollowing" not in plan.lower()


def test_time_grows_with_the_rows_of_a_range(spark):
    """One range and one group; a frame that is read anew for each row would take minutes here."""
    def seconds(n):
        rows = spark.range(n).selectExpr("'s' AS g", "id AS at", "CASE WHEN id % 5000 = 0 THEN id END AS v")
        start = time.perf_counter()
        laid = ordered.range_layout(rows, ["g", "at"], ranges=1)
        both = ordered.carry_both(laid, ["g"], F.col("v"), "before", "after")
        off = both.where("before <> at - at % 5000 OR coalesce(after, -1) NOT IN (-1, at + (5000 - at % 5000) % 5000)")
        assert off.count() == 0
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(400_000) < 60
