"""Owners valid at event time, sessions without a hot task, and exports with reasons."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cinderlog.operators import aggregate, enrich, otel

START = datetime(2026, 1, 1)


def _at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


def test_values_valid_at_event_time(spark):
    rng = random.Random(3)
    # a third of the events has one key; times meet the ends of intervals
    rows = [(i, rng.choice(["hot", "a", "b", "none", None]), rng.choice([None, *range(60)])) for i in range(400)]
    spans = [("hot", None, 5, "w"), ("hot", 5, 20, "x"), ("hot", 25, None, "y"), ("a", 0, 10, "x"), ("a", 10, 30, None),
             ("b", 3, 50, "x"), ("b", 7, 9, "z"), (None, 0, None, "x")]
    events = spark.createDataFrame([(i, k, _at(t), "own") for i, k, t in rows], "id int, service string, event_time timestamp, valid_to string")
    owners = spark.createDataFrame([(k, _at(a), _at(b), o) for k, a, b, o in spans], "service string, since timestamp, until timestamp, owner string")
    found = enrich.join_as_of(events, owners, ["service"], ["owner"], valid_from="since", valid_to="until").collect()

    def expected(key, at):
        own = [s for s in spans if key is not None and s[0] == key and at is not None and (s[1] is None or s[1] <= at)]
        last = max(own, key=lambda s: -1 if s[1] is None else s[1], default=None)
        return last[3] if last and (last[2] is None or at < last[2]) else None

    assert {r.id: r.owner for r in found} == {i: expected(k, t) for i, k, t in rows}
    assert len(found) == len(rows) and {r.valid_to for r in found} == {"own"}
    assert enrich.join_as_of(events.where("false"), owners, ["service"], ["owner"], valid_from="since", valid_to="until").count() == 0
    none = enrich.join_as_of(events, owners.where("false"), ["service"], ["owner"], valid_from="since", valid_to="until")
    assert none.where("owner IS NULL").count() == len(rows)


def test_sessions_of_a_hot_group(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "b", None]), rng.choice([None, *range(0, 4000, 3)])) for _ in range(900)]
    events = spark.createDataFrame([(s, _at(t), "ERROR" if t and t % 2 else "INFO", "mm") for s, t in rows],
                                   "service string, event_time timestamp, level string, message string")
    found = aggregate.session_metrics(events, "9 minutes", ["service"])
    times = defaultdict(list)
    for s, t in rows:
        if t is not None:
            times[s].append(t)
    expected = []
    for s, own in times.items():
        own.sort()
        starts = [i for i in range(len(own)) if not i or own[i] - own[i - 1] > 9] + [len(own)]
        for a, b in zip(starts, starts[1:], strict=False):
            expected.append((_at(own[a]), _at(own[b - 1] + 9), s, b - a, sum(t % 2 for t in own[a:b]), 2 * (b - a)))
    key = lambda r: (r[0], str(r[2]))
    assert sorted([(r[0], r[1], r[2], r[3], r[4], r[6]) for r in found.collect()], key=key) == sorted(expected, key=key)
    assert len(expected) > 50 and aggregate.session_metrics(events.where("false"), "9 minutes", ["service"]).count() == 0
    # no step gathers rows by service alone
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(service" not in plan and "SessionWindow" not in plan


@pytest.mark.parametrize(("text", "reason"), [
    (None, "empty"), (" ", "empty"), ("broken", "not_json_object"), ("[]", "not_json_object"), ("{}", "no_export"),
    ('{"resourceLogs":{}}', "no_export"), ('{"resourceLogs":null}', "no_export"), ('{"resourceLogs":[1]}', "type_mismatch"),
    ('{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"severityNumber":"x"}]}]}]}', "type_mismatch"),
    ('{"resourceLogs":[]}', None), ('{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"new":1}]}]}]}', None),
])
def test_export_or_reason(spark, text, reason):
    rows = spark.createDataFrame([(text, 1)], "value string, reason_of int")
    assert [r["reason"] for r in otel.otel_quarantine(rows, "value", "reason_of").collect()] == ([reason] if reason else [])
    if reason:
        assert otel.otel_events(rows).count() == 0


def test_values_of_all_kinds(spark):
    kinds = ['{"stringValue":"s"}', '{"intValue":"7"}', '{"intValue":7}', '{"doubleValue":1.5}', '{"boolValue":true}',
             '{"arrayValue":{"values":[{"intValue":"1"}]}}', '{"kvlistValue":{"values":[]}}', '{"bytesValue":"AA=="}', "{}"]
    record = '{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"attributes":[%s]}]}]}]}'
    text = record % ",".join(f'{{"key":"k{i}","value":{kind}}}' for i, kind in enumerate(kinds))
    found = otel.otel_events(spark.createDataFrame([(text,)], "value string")).select(F.explode("attributes").alias("a")).collect()
    assert [r.a["value"] for r in found] == ["s", "7", "7", "1.5", "true", '{"values":[{"intValue":"1"}]}', '{"values":[]}', "AA==", None]
