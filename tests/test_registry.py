"""Versions of a schema: what may change, and records of all versions typed as the last one."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cinderlog.operators import registry
from cinderlog.operators.registry import Version

V1 = Version("1", "id INT NOT NULL, svc STRING, n INT, old STRING")
V2 = Version("2", "id BIGINT NOT NULL, service STRING, n INT", {"svc": "service"})
V3 = Version("3", "id BIGINT NOT NULL, owner STRING, n DOUBLE, at DATE", {"service": "owner"})


def test_versions_are_registered_or_refused(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert registry.read_registry(spark, path) == []
    assert registry.register(spark, path, V1) == []
    assert set(registry.register(spark, path, V2)) == {
        ("id", "widened from int to bigint", True), ("svc", "renamed to service", True), ("old", "dropped", True),
    }
    for ddl, told in [
        ("id INT NOT NULL, service STRING, n INT", "id retyped from bigint to int"), ("service STRING, n INT", "id dropped"),
        ("id BIGINT NOT NULL, service STRING NOT NULL, n INT", "service not null any more"),
        ("id BIGINT NOT NULL, service STRING, n INT, x INT NOT NULL", "x added"),
        ("id DOUBLE NOT NULL, service STRING, n INT", "id retyped from bigint to double"),
    ]:
        with pytest.raises(registry.IncompatibleSchema, match=told):
            registry.register(spark, path, Version("3", ddl))
    with pytest.raises(registry.IncompatibleSchema, match="renames nothing"):
        registry.register(spark, path, Version("3", V2.ddl, {"nobody": "n"}))
    registry.register(spark, path, V3)
    with pytest.raises(ValueError, match="already"):
        registry.register(spark, path, V3)
    assert registry.read_registry(spark, path) == [V1, V2, V3]


def test_records_of_all_versions(spark):
    rows = spark.createDataFrame([
        (1, "1", '{"id":1,"svc":"a","n":2,"old":"x"}'), (2, "2", '{"id":5000000000,"service":"b","n":3}'),
        (3, "3", '{"id":3,"owner":"c","n":1.5,"at":"2024-01-02"}'), (4, "1", '{"id":5000000000}'), (5, "2", '{"svc":"a","id":1}'),
        (6, "2", '{"service":"b"}'), (7, "9", '{"id":1}'), (8, None, '{"id":1}'), (9, "3", "[1]"), (10, "3", None), (11, "3", '{"id":1'),
        (12, "3", '{"id":12,"n":null}'), (13, "2", '{"id":13,"n":"three"}'), (14, "3", '{"id":14,"reason":1}'),
    ], "k int, v string, value string")
    found = registry.bind_versions(rows, F.col("v"), [V1, V2, V3])
    assert found.columns == ["k", "v", "value", "record", "reason"]
    got = {r["k"]: r["reason"] or (r["record"]["id"], r["record"]["owner"], r["record"]["n"], str(r["record"]["at"])) for r in found.collect()}
    assert got == {
        1: (1, "a", 2.0, "None"), 2: (5000000000, "b", 3.0, "None"), 3: (3, "c", 1.5, "2024-01-02"), 4: "type_mismatch",
        5: "unknown_field", 6: "missing_field", 7: "unknown_version", 8: "unknown_version", 9: "not_json_object",
        10: "not_json_object", 11: "not_json_object", 12: (12, None, None, "None"), 13: "type_mismatch", 14: "unknown_field",
    }
    assert registry.bind_versions(rows.limit(0), F.col("v"), [V1]).count() == 0
