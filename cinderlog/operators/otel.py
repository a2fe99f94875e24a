"""OpenTelemetry log exports to event columns, by explode and select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.schema import LEVELS

# a value that is no scalar is kept as its JSON text
_ANY = (
    "struct<stringValue:string,intValue:string,doubleValue:double,boolValue:boolean,arrayValue:string,kvlistValue:string,"
    "bytesValue:string>"
)
_ATTRIBUTES = f"array<struct<key:string,value:{_ANY}>>"
# The names of the export format.
EXPORT = (
    f"resourceLogs array<struct<resource:struct<attributes:{_ATTRIBUTES}>,scopeLogs:array<struct<logRecords:array<struct<"
    f"timeUnixNano:string,observedTimeUnixNano:string,severityText:string,severityNumber:int,body:{_ANY},traceId:string,"
    f"attributes:{_ATTRIBUTES}>>>>>>"
)
RESOURCE_NAMES = {
    "host": "host.name", "service": "service.name", "instance_id": "service.instance.id", "namespace": "k8s.namespace.name",
    "pod_name": "k8s.pod.name",
}
RECORD_ID = "log.record.uid"
# Four severity numbers for each level, from 1.
SEVERITY_STEP = 4


def _text(value: Column) -> Column:
    return F.coalesce(
        value["stringValue"], value["intValue"], value["doubleValue"].cast("string"), value["boolValue"].cast("string"),
        value["arrayValue"], value["kvlistValue"], value["bytesValue"],
    )


def _attribute(attributes: str, name: str) -> Column:
    found = F.filter(attributes, lambda a: a["key"] == name)
    return _text(F.try_element_at(found, F.lit(1))["value"])


def _time(nanos: str) -> Column:
    number = F.expr(f"try_cast({nanos} AS decimal(20,0))")
    return F.timestamp_micros(F.when(number > 0, F.floor(number / 1000)).cast("bigint"))


def _level() -> Column:
    named = F.upper("r.severityText")
    place = F.floor((F.col("r.severityNumber") - 1) / SEVERITY_STEP).cast("int")
    numbered = F.try_element_at(F.array(*[F.lit(x) for x in LEVELS]), F.least(place, F.lit(len(LEVELS) - 1)) + 1)
    return F.coalesce(F.when(named.isin(*LEVELS), named), F.when(F.col("r.severityNumber") > 0, numbered))


_BROKEN = "_broken"


def read_exports(df: DataFrame, value: str = "value") -> DataFrame:
    """Add `export` and `reason`, of which one is NULL.

    The first reason that applies: `empty`, `not_json_object`, `no_export` (no array of resourceLogs), `type_mismatch` (a
    known field of another type anywhere in it). Unknown fields are let pass, as the format grows.
    """
    kind = f"schema_of_variant(try_parse_json(`{value}`))"
    logs = f"schema_of_variant(try_variant_get(try_parse_json(`{value}`), '$.resourceLogs', 'variant'))"
    read = F.from_json(value, f"{EXPORT}, {_BROKEN} string", {"columnNameOfCorruptRecord": _BROKEN})
    reason = F.expr(
        f"CASE WHEN coalesce(trim(`{value}`), '') = '' THEN 'empty' "
        f"WHEN NOT coalesce(startswith({kind}, 'OBJECT'), false) THEN 'not_json_object' "
        f"WHEN NOT coalesce(startswith({logs}, 'ARRAY'), false) THEN 'no_export' "
        f"WHEN _read.{_BROKEN} IS NOT NULL THEN 'type_mismatch' END"
    )
    judged = df.withColumn("_read", read).withColumn("reason", reason)
    return judged.withColumn("export", F.when(F.col("reason").isNull(), F.col("_read"))).drop("_read")


def otel_quarantine(df: DataFrame, value: str = "value", *keep: str) -> DataFrame:
    """The texts that are no exports: raw text, reason and the kept columns."""
    return read_exports(df, value).where(F.col("reason").isNotNull()).select(F.col(value).alias("raw"), "reason", *keep)


def otel_events(df: DataFrame, value: str = "value", *keep: str) -> DataFrame:
    """One row per log record of the exports in `value`, as event columns after the kept ones.

    A fatal record counts as ERROR. A text that is no export has no records, see `otel_quarantine`.
    """
    export = read_exports(df, value).select(*keep, F.explode("export.resourceLogs").alias("l"))
    records = export.select(*keep, F.col("l.resource.attributes").alias("resource"), F.explode("l.scopeLogs").alias("s")).select(
        *keep, "resource", F.explode("s.logRecords").alias("r")
    ).withColumn("own", F.col("r.attributes"))
    log_id = _attribute("own", RECORD_ID)
    rest = F.filter("own", lambda a: a["key"] != RECORD_ID)
    attributes = F.transform(rest, lambda a: F.struct(
        F.lit(None).cast("bigint").alias("id"), log_id.alias("logId"), a["key"].alias("key"), _text(a["value"]).alias("value")
    ))
    resource = {column: _attribute("resource", name) for column, name in RESOURCE_NAMES.items()}
    columns = {
        "log_id": log_id, "host": resource["host"], "event_time": _time("r.timeUnixNano"),
        "ingestion_time": _time("r.observedTimeUnixNano"), "service": resource["service"],
        "instance_id": resource["instance_id"], "namespace": resource["namespace"], "pod_name": resource["pod_name"],
        "trace_id": F.col("r.traceId"), "level": _level(), "message": _text(F.col("r.body")), "attributes": attributes,
    }
    return records.select(*keep, *[c.alias(name) for name, c in columns.items()])
