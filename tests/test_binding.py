"""Golden records: what binds, and why the others do not."""

from __future__ import annotations

import time

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cinderlog.operators import binding

LOG = "[2026-07-17T10:25:30Z] [INFO] [svc] [h] logId=1 instanceId=i namespace=n podName=p traceId=t - {}"

JSON_CASES = [
    ("{}", None),
    ('{"traceId":"q-17","timestamp":"2026-03-02T08:00:01Z","level":"DEBUG","service":"mailer","message":"Queue drained"}', None),
    ("", "empty"), ("  \t", "empty"),
    ("null", "not_json_object"), ("[{}]", "not_json_object"), ("5", "not_json_object"), ('{"logId":5', "not_json_object"),
    ("{'host':'x'}", "not_json_object"), ("{host:1}", "not_json_object"),
    ('{"log":"x"}', "unknown_field"), ('{"attributes":[{"zz":1}]}', "unknown_field"), ('{"loglevel":"x","level":"bad"}', "unknown_field"),
    ('{"message":{"a":1}}', "type_mismatch"), ('{"message":[1,2]}', "type_mismatch"), ('{"timestamp":{}}', "type_mismatch"),
    ('{"message":"{a}"}', None), ('{"message":"[a"}', None), ('{"message":7,"host":true}', None),
    ('{"message":{"a":1},"message":"b"}', None),
    ('{"level":"info"}', "bad_level"), ('{"level":"FATAL"}', "bad_level"), ('{"level":2}', "bad_level"), ('{"level":null}', None),
    ('{"timestamp":"2026-07-17"}', "bad_timestamp"), ('{"timestamp":"2026-07-17T10:25:30"}', "bad_timestamp"),
    ('{"timestamp":"2026-13-17T10:25:30Z"}', "bad_timestamp"), ('{"timestamp":17842839301234567890}', "bad_timestamp"),
    ('{"ingestionTimestamp":"soon"}', "bad_timestamp"), ('{"timestamp":""}', None),
    ('{"attributes":"k=v"}', "bad_attributes"), ('{"attributes":{}}', "bad_attributes"), ('{"attributes":[1]}', "bad_attributes"),
    ('{"attributes":"[]"}', "bad_attributes"), ('{"attributes":[{"id":"x"}]}', "bad_attributes"),
    ('{"attributes":[{"value":{"a":1}}]}', "bad_attributes"), ('{"attributes":[{"value":"{a"}]}', None),
    ('{"attributes":[{"id":"5","key":1}]}', None), ('{"attributes":[null]}', None), ('{"attributes":null}', None),
    ('{"attributes":[]}', None), ('{"logId":"1"} junk', None),
]


@pytest.fixture(scope="module")
def no_time():
    return lambda: F.lit(None).cast("timestamp")


def _bind(spark, values, parser="json", **options):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, value string")
    return {r["i"]: r for r in binding.bind(rows, parser, **options).collect()}


def test_json_reasons(spark):
    bound = _bind(spark, [value for value, _ in JSON_CASES])
    assert [bound[i]["reason"] for i in range(len(JSON_CASES))] == [reason for _, reason in JSON_CASES]


def test_empty_object_has_only_nulls(spark, no_time):
    event = _bind(spark, ["{}"], arrival=no_time())[0]["event"]
    assert set(event) == {None} and len(event) == 12


@pytest.mark.parametrize("text, expected", [
    ('"2026-07-17T10:25:30Z"', datetime(2026, 7, 17, 10, 25, 30)),
    ('"2026-07-17T10:25:30.123456789Z"', datetime(2026, 7, 17, 10, 25, 30, 123456)),
    ('"2026-07-17T10:25:30+05:30"', datetime(2026, 7, 17, 4, 55, 30)),
    ('"2026-07-17T10:25:30+0530"', datetime(2026, 7, 17, 4, 55, 30)),
    ("1784283930", datetime(2026, 7, 17, 10, 25, 30)),
    ("1784283930.5", datetime(2026, 7, 17, 10, 25, 30, 500000)),
    ("1784283930.123456789", datetime(2026, 7, 17, 10, 25, 30, 123456)),
    ('"1784283930.25"', datetime(2026, 7, 17, 10, 25, 30, 250000)),
    ("-1.5", datetime(1969, 12, 31, 23, 59, 58, 500000)),
])
def test_times(spark, text, expected):
    row = _bind(spark, [f'{{"timestamp":{text}}}'])[0]
    assert row["reason"] is None
    seconds = spark.createDataFrame([(row["event"]["event_time"],)], "t timestamp").select(F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert seconds.first()[0] == expected.strftime("%Y-%m-%d %H:%M:%S.%f")


def test_arrival_fills_ingestion_time(spark):
    arrival = F.lit("2026-01-01T00:00:00Z").cast("timestamp")
    given, missing = (
        '{"ingestionTimestamp":"2026-07-17T10:25:30Z"}', "{}",
    )
    rows = _bind(spark, [given, missing], arrival=arrival)
    assert rows[0]["event"]["ingestion_time"] != rows[1]["event"]["ingestion_time"]
    assert rows[1]["event"]["ingestion_time"] is not None
    assert rows[1]["event"]["event_time"] is None


def test_alias_of_the_two_times(spark):
    early, late = "2026-07-17T10:00:00Z", "2026-07-17T11:00:00Z"
    rows = _bind(spark, [
        f'{{"timestamp":"{early}","ingestionTimestamp":"{late}"}}', f'{{"ingestionTimestamp":"{late}","timestamp":"{early}"}}',
        f'{{"ingestionTimestamp":"{late}"}}', "{}",
    ], compat_ingestion_alias=True)
    times = [(rows[i]["event"]["event_time"], rows[i]["event"]["ingestion_time"]) for i in range(4)]
    assert all(a == b for a, b in times)
    assert times[0] == times[2] and times[1] < times[0] and times[3] == (None, None)


def test_dropped_log_time(spark):
    row = _bind(spark, [LOG.format("m | ")], "log", compat_drop_log_time=True)[0]
    assert row["reason"] is None and row["event"]["event_time"] is None and row["event"]["log_id"] == "1"


def test_oversize(spark):
    rows = _bind(spark, ['{"message":"ééééé"}', '{"message":"eeeee"}'], max_bytes=20)
    assert (rows[0]["reason"], rows[1]["reason"]) == ("oversize", None)


def test_log_lines(spark, no_time):
    rows = _bind(spark, [
        LOG.format("a | b | k=v"), LOG.format("no bar"), LOG.format("m | "), LOG.format('m | {"a":1,"b":"c d"}'),
        LOG.format("m | {broken"), LOG.format("m \u0001x | k=v, x=1=2 solo"), LOG.replace("2026-07", "2026-13").format("m | "),
        LOG.replace("INFO", "NOTE").format("m | "), LOG.replace("30Z", "30.5Z").format("m | "), "",
    ], "log", arrival=no_time())
    assert [rows[i]["reason"] for i in range(10)] == [
        None, "no_match", None, None, "bad_attributes", None, "bad_timestamp", "bad_level", "bad_timestamp", "empty",
    ]
    assert rows[0]["event"]["message"] == "a"
    assert [(a["key"], a["value"]) for a in rows[0]["event"]["attributes"]] == [("b", None), ("|", None), ("k", "v")]
    assert rows[2]["event"]["attributes"] is None
    assert [(a["key"], a["value"]) for a in rows[3]["event"]["attributes"]] == [("a", "1"), ("b", "c d")]
    assert rows[5]["event"]["message"] == "m \u0001x"
    assert [(a["key"], a["value"]) for a in rows[5]["event"]["attributes"]] == [("k", "v"), ("x", "1=2"), ("solo", None)]


def test_csv_lines(spark, no_time):
    good = "1,h,2026-07-17T10:25:30Z,svc,i,n,p,t,INFO,one, two,, three"
    header = "logId,host,timestamp,service,instanceId,namespace,podName,traceId,level,message"
    rows = _bind(spark, [good, header, good.replace("svc", ""), good.replace("INFO,one, two,, three", "INFO,"), "a,b"], "csv", arrival=no_time())
    assert [rows[i]["reason"] for i in range(5)] == [None, "bad_timestamp", "no_match", None, "no_match"]
    assert rows[0]["event"]["message"] == "one, two,, three"
    assert rows[3]["event"]["message"] is None


def test_mixed_formats_and_raw(spark):
    rows = spark.createDataFrame(
        [("json", "{}"), ("log", LOG.format("m | ")), ("raw", "<a/>"), ("raw", ""), ("csv", "x")], "p string, value string"
    )
    bound = {(r["p"], r["value"]): r["reason"] for r in binding.bind(rows, F.col("p")).collect()}
    assert bound == {
        ("json", "{}"): None, ("log", LOG.format("m | ")): None, ("raw", "<a/>"): "unstructured", ("raw", ""): "empty",
        ("csv", "x"): "no_match",
    }


def test_strict_fails_on_the_first_invalid_record(spark):
    rows = spark.createDataFrame([("{}",), ("nope",)], "value string")
    assert binding.strict_events(binding.bind(rows.limit(1))).count() == 1
    with pytest.raises(Exception, match="invalid record \\(not_json_object\\): nope"):
        binding.strict_events(binding.bind(rows)).collect()


def test_split_is_complete(spark):
    rows = spark.createDataFrame([(i, value) for i, (value, _) in enumerate(JSON_CASES)], "i int, value string")
    bound = binding.bind(rows)
    valid, other = binding.valid_events(bound, "i"), binding.quarantine(bound, "i")
    numbers = valid.select("i").union(other.select("i"))
    assert sorted(r["i"] for r in numbers.collect()) == list(range(len(JSON_CASES)))
    assert set(other.columns) == {"raw", "reason", "i", "seen_at"}


def test_record_is_read_once(spark):
    """A filter on the outcome must not copy the parser into the filter."""
    rows = spark.createDataFrame([("{}",)], "value string")
    plan = binding.valid_events(binding.bind(rows))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("from_json" in line for line in filters)


def test_long_runs_of_blanks_cost_no_more_than_their_length(spark):
    head = "[2026-07-17T10:25:30Z] [INFO] [s] [h] logId=1 instanceId=i namespace=n podName=p traceId=t - "
    lines = [head + "a" + " " * 1_000_000, head + " " * 1_000_000 + "| k=v", head + "a |b |  | k=v", head + "a" + " " * 500_000 + "| k=v"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    binding.bind(rows.where("i = 2"), "log").collect()  # compiled before it is timed
    start = time.perf_counter()
    found = {r["i"]: (r["event"]["message"], r["reason"]) for r in binding.bind(rows, "log", max_bytes=1 << 21).select("i", "event", "reason").collect()}
    assert time.perf_counter() - start < 10
    assert found[0][1] == "no_match" and found[2] == ("a |b", None) and found[3] == ("a", None)
