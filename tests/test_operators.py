"""Attributes, enrichment, search, filters, health, index and topic options."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cinderlog.operators import aggregate, attributes, binding, collector, enrich, health, otel, search, versions
from cinderlog.session import clean, freeze, shared_dir, work_path
from cinderlog.sinks import index as log_index, topic as topic_sink
from cinderlog.sources import topic as topic_source


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        (f'{{"logId":"{i}","timestamp":"2026-07-{1 + i % 5:02d}T{i % 24:02d}:00:00Z","service":"s{i % 3}","host":"h{i % 2}",'
         f'"level":"{["TRACE", "DEBUG", "INFO", "WARN", "ERROR"][i % 5]}","traceId":"t{i % 4}","message":"Order {i} paid by user",'
         f'"attributes":[{{"id":1,"logId":"{i}","key":"k","value":"{i % 2}"}}]}}',)
        for i in range(60)
    ] + [('{"message":"no service"}',)]
    return binding.bind_events(spark.createDataFrame(rows, "value string"))


def test_nest_is_the_inverse_of_flatten(events):
    keyed = events.withColumn("record_id", F.coalesce("log_id", F.lit("none")))
    nested = attributes.nest_attributes(keyed, attributes.flatten_attributes(keyed, key="record_id"), key="record_id")
    assert Counter(str(r) for r in nested.select("log_id", "attributes").collect()) == Counter(
        str(r) for r in events.select("log_id", "attributes").collect()
    )


def test_events_without_a_log_id_keep_their_attributes(spark):
    rows = [(i, None if i % 2 else f"l{i}", [(1, None, "k", str(i)), (0, None, "j", "x")]) for i in range(50)]
    events = spark.createDataFrame(
        rows, "record_id long, log_id string, attributes array<struct<id:long,logId:string,key:string,value:string>>")
    nested = attributes.nest_attributes(events.drop("attributes"), attributes.flatten_attributes(events, key="record_id"), key="record_id")
    assert {r["record_id"]: [a["value"] for a in r["attributes"]] for r in nested.collect()} == {i: ["x", str(i)] for i in range(50)}


def test_a_list_of_any_length_is_one_row(spark):
    events = spark.createDataFrame([("hot",), ("cold",), ("none",), (None,)], "log_id string")
    rows = spark.range(100_000).select(
        F.lit("hot").alias("log_id"), F.lit(1).cast("bigint").alias("id"), F.lit("k").alias("key"), F.lit("copy").alias("value")
    ).union(spark.sql("SELECT 'cold', 1L, 'k', 'v'")).union(spark.sql("SELECT NULL, 1L, 'k', 'v'"))
    nested = attributes.nest_attributes(events, rows).select("log_id", F.size("attributes").alias("n")).collect()
    assert {r["log_id"]: r["n"] for r in nested} == {"hot": 100_000, "cold": 1, "none": None, None: None} and len(nested) == 4


def test_flatten_keeps_empty_on_request(events):
    assert attributes.flatten_attributes(events).count() == 60
    assert attributes.flatten_attributes(events, keep_empty=True).count() == 61


def test_dimension_join_leaves_the_choice_to_spark(spark, events):
    owners = spark.createDataFrame([("s0", "a"), ("s1", "b")], "service string, owner string")
    joined = enrich.join_dimension(events, owners, ["service"])
    assert "Hint" not in joined._jdf.queryExecution().analyzed().toString()
    assert Counter(r["owner"] for r in joined.collect()) == Counter({"a": 20, "b": 20, None: 21})


def test_document_id_is_stable(spark):
    rows = spark.sql("SELECT 'x' log_id, 't' topic, 1 partition, 2L offset UNION ALL SELECT NULL, 't', 1, 3L")
    ids = [r[0] for r in rows.select(enrich.document_id("topic", "partition", "offset")).collect()]
    assert ids[0] == "x" and len(ids[1]) == 64
    assert ids == [r[0] for r in rows.select(enrich.document_id("topic", "partition", "offset")).collect()]


def test_level_rank(events):
    ranks = {r["level"]: r["level_rank"] for r in enrich.transform_events(events).collect()}
    assert ranks == {"TRACE": 0, "DEBUG": 1, "INFO": 2, "WARN": 3, "ERROR": 4, None: None}


def test_search(events):
    assert search.search(events, ["ORDER", "user"]).count() == 60
    assert search.search(events, ["service", "user"], mode="any").count() == 61
    assert search.search(events, ["order", "service"]).count() == 0
    assert search.search_phrase(events, "PAID by").count() == 60
    assert search.search_phrase(events, "it's").count() == 0
    for none in ([], ["..."]):
        with pytest.raises(ValueError):
            search.search(events, none)


def test_search_over_letters_and_digits_of_any_script(spark):
    texts = ["code 404, payment2 done", "Die Größe ÄNDERT sich", "standby theme", "by  the\nway", "日本 語", "naïve_name"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, message string")
    for terms, found in ((["404"], [0]), (["PAYMENT2"], [0]), (["payment"], []), (["größe", "ändert"], [1]), (["語"], [4]),
                         (["naïve_name"], [5]), (["the"], [3])):
        assert sorted(r["i"] for r in search.search(rows, terms).collect()) == found
    for phrase, found in (("by the", [3]), ("Größe, ändert!", [1]), ("404 done", []), ("404 payment2", [0])):
        assert sorted(r["i"] for r in search.search_phrase(rows, phrase).collect()) == found


@pytest.mark.parametrize("facets, keep", [
    ({"min_level": "WARN"}, lambda i: i % 5 >= 3),
    ({"services": ["s1"], "hosts": ["h0"]}, lambda i: i % 3 == 1 and i % 2 == 0),
    ({"since": "2026-07-02T00:00:00Z", "until": "2026-07-03T12:00:00Z"}, lambda i: i % 5 == 1 or (i % 5 == 2 and i % 24 < 12)),
    ({"trace_id": "t3", "attribute": ("k", "1")}, lambda i: i % 4 == 3),
])
def test_filters_on_events_and_index(spark, events, facets, keep):
    expected = sorted(str(i) for i in range(60) if keep(i))
    assert sorted(r["log_id"] for r in search.filter_events(events, **facets).collect()) == expected
    path = work_path(spark, "test-index")
    log_index.write_index(events, path)
    found = search.filter_events(log_index.read_index(spark, path), **facets)
    assert sorted(r["log_id"] for r in found.collect()) == expected


def test_filters_prune_index_folders(spark, events):
    path = work_path(spark, "test-index")
    log_index.write_index(events, path)
    found = search.filter_events(log_index.read_index(spark, path), services=["s1"], since="2026-07-02T00:00:00Z")
    scan = next(line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "event_date" in scan.split("PartitionFilters: [")[1].split("], ")[0]
    assert "service" in scan.split("PushedFilters: [")[1]


def test_index_keeps_missing_and_empty_services(spark):
    rows = binding.bind_events(spark.createDataFrame([("{}",), ('{"service":""}',), ('{"service":"7"}',)], "value string"))
    path = work_path(spark, "test-index")
    log_index.write_index(rows, path)
    assert Counter(r["service"] for r in log_index.read_index(spark, path).collect()) == Counter([None, "", "7"])


def test_silent_members(spark, events):
    named = events.where("service IS NOT NULL")
    known = spark.createDataFrame([("s0",), ("new",)], "service string")
    newest = named.agg(F.unix_micros(F.max("event_time"))).first()[0]
    assert health.silent(named, 1000, ["service"]).count() == 0
    found = health.silent(named, 1, ["service"], now_us=newest + 3_600_000_000 * 48, known=known).collect()
    assert {(r["service"], r["last_seen_us"] is None) for r in found} == {("s0", False), ("new", True)}


def test_tags_match_literally(spark):
    frame = spark.createDataFrame([("logs.app",), ("logsxapp",), ("logs.a_b",), ("logs.axb",)], "tag string")
    tags = lambda pattern: [r["tag"] for r in collector.with_tag_like(frame, pattern).collect()]
    assert tags("*") == ["logs.app", "logsxapp", "logs.a_b", "logs.axb"]
    assert tags("logs.*") == ["logs.app", "logs.a_b", "logs.axb"]
    assert tags("logs.a_b") == ["logs.a_b"]


def test_payload_key_and_nested_values(spark):
    bodies = spark.createDataFrame([('[{"b":1.10,"a":{"z":1,"c":null},"date":3,"n":null,"s":"x"},{}]',), ("[]",), ("broken",)], "body string")
    out = collector.payloads(collector.explode_bodies(bodies), key=F.lit(5))
    assert [(r["value"], r["key"]) for r in out.collect()] == [('{"b":1.1,"a":{"c":null,"z":1},"n":null,"s":"x"}', "5"), ("{}", "5")]


def test_bodies_are_records_or_kept_out_with_a_reason(spark):
    bodies = spark.createDataFrame([(1, '[{"a":1},{}]'), (2, '[{"a":1},5]'), (3, "broken"), (4, '{"a":1}'), (5, None), (6, " "), (7, "[]")],
                                   "body_id int, body string")
    assert sorted(r["body_id"] for r in collector.explode_bodies(bodies).collect()) == [1, 1]
    found = {r["body_id"]: (r["raw"], r["reason"]) for r in collector.body_quarantine(bodies).collect()}
    assert found == {2: ('[{"a":1},5]', "not_array_of_objects"), 3: ("broken", "not_json"), 4: ('{"a":1}', "not_array_of_objects"),
                     5: (None, "empty"), 6: (" ", "empty")}


def test_percentile_names():
    assert [aggregate.percentile_name(q) for q in (0.5, 0.95, 0.995, 0.999, 0.9999, 1.0, 0.1)] == [
        "p50", "p95", "p99_5", "p99_9", "p99_99", "p100", "p10"]


def test_archive_and_compaction_can_run_again(spark, events):
    path, index_path = work_path(spark, "test-archive"), work_path(spark, "test-index")
    for _ in range(2):
        log_index.archive(events, path)
    assert log_index.read_index(spark, path).count() == 61
    for batch in range(3):
        log_index.write_index_batch(events.withColumn("client_id", F.lit(f"c{batch}")), index_path, batch)
    for _ in range(2):
        log_index.compact_index(spark, index_path, "2026-07-01", "2026-07-02")
    assert log_index.read_index(spark, index_path).count() == 183
    assert log_index.read_tenant(spark, index_path, "c1").count() == 61
    with pytest.raises(ValueError):
        log_index.read_tenant(spark, index_path, "")


def test_versions_and_unknown_keys(spark):
    rows = spark.createDataFrame([("1", '{"id":"a","msg":"x \\"y\\""}'), ("1", '{"id":"b","zz":1}'), ("1", "broken"), ("2", '{"logId":"c"}'),
                                  (None, '{"logId":"d"}')], "v string, value string")
    bound = versions.bind_by_version(rows, F.col("v"), {"1": {"id": "logId", "msg": "message"}}).collect()
    assert sorted((r["event"]["log_id"], r["event"]["message"], r["reason"]) for r in bound if r["reason"] is None) == [
        ("a", 'x "y"', None), ("c", None, None), ("d", None, None)]
    assert sorted(r["reason"] for r in bound if r["reason"]) == ["not_json_object", "unknown_field"]


def test_otel_levels_and_missing_parts(spark):
    record = '{"resourceLogs":[{"scopeLogs":[{"logRecords":[%s]}]}]}'
    rows = [(record % '{"severityNumber":21,"body":{"stringValue":"m"}},{"severityText":"warn"},{"timeUnixNano":"0"}',), ("broken",), ("{}",), (None,)]
    found = otel.otel_events(spark.createDataFrame(rows, "value string")).collect()
    assert [(r["level"], r["message"], r["event_time"]) for r in found] == [("ERROR", "m", None), ("WARN", None, None), (None, None, None)]


def test_topic_options():
    read = topic_source.read_options("k:9092", min_partitions=64, max_offsets_per_trigger=1000)
    assert read == {
        "kafka.bootstrap.servers": "k:9092", "subscribe": "logs.raw", "startingOffsets": "earliest",
        "minPartitions": "64", "maxOffsetsPerTrigger": "1000",
    }
    write = topic_sink.write_options("k:9092", "out", linger_ms="50")
    assert write["kafka.linger.ms"] == "50" and write["kafka.acks"] == "all" and write["topic"] == "out"


def test_working_tables_can_be_removed(spark):
    from pathlib import Path

    frame = freeze(spark.range(3), "x")
    folder = Path(frame.inputFiles()[0].removeprefix("file:").removeprefix("//")).parent
    assert folder.is_dir() and folder.parent.name == spark.sparkContext.applicationId
    clean(spark)
    assert not folder.parent.exists()


def test_work_path_is_below_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    first, second = work_path(spark, "x"), work_path(spark, "x")
    assert first.startswith(named) and first != second
