"""Log texts derived from the `events` table: one row per event in each line format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cinderlog.operators.binding import bind, valid_events
from cinderlog.schema import PARSER_BY_EXTENSION
from cinderlog.session import prepare

_TEXT_COLUMNS = {
    "log_id": "CAST(event_id AS STRING)",
    "host": "concat('host-', user_id % 7)",
    "ts_text": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "service": "concat('svc-', user_id % 5)",
    "instance_id": "concat('i-', user_id % 3)",
    "namespace": "concat('ns-', user_id % 2)",
    "pod_name": "concat('pod-', user_id % 11)",
    "trace_id": "concat('t', user_id)",
    "level": (
        "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' WHEN 'view' THEN 'DEBUG' "
        "WHEN 'signup' THEN 'TRACE' ELSE 'INFO' END"
    ),
    "message": "concat(event_type, ' event, user ', user_id)",
    "attr_k": "get_json_object(props, '$.k')",
}

TEXT_FIELDS = (
    ("logId", "log_id"), ("host", "host"), ("timestamp", "ts_text"), ("service", "service"),
    ("instanceId", "instance_id"), ("namespace", "namespace"), ("podName", "pod_name"),
    ("traceId", "trace_id"), ("level", "level"), ("message", "message"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def adapted(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The text columns, event_id, user_id and any further columns of `events`."""
    needed = dict.fromkeys(["event_id", "user_id", "ts", "event_type", "props", *keep])
    source = table(spark, sf_dir, "events").select(*needed)
    return source.selectExpr(
        "event_id", "user_id", *keep, *[f"{sql} AS {name}" for name, sql in _TEXT_COLUMNS.items()]
    )


def text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def log_line() -> Column:
    c = F.col
    return text(
        "[", c("ts_text"), "] [", c("level"), "] [", c("service"), "] [", c("host"), "] logId=", c("log_id"),
        " instanceId=", c("instance_id"), " namespace=", c("namespace"), " podName=", c("pod_name"),
        " traceId=", c("trace_id"), " - ", c("message"), " | k=", c("attr_k"),
    )


def csv_line() -> Column:
    return F.concat_ws(",", *[F.col(column) for _, column in TEXT_FIELDS])


def attribute_json(key: str, value: Column, number: Column) -> Column:
    return text('{"id":', number.cast("string"), ',"logId":"', F.col("log_id"), f'","key":"{key}","value":"', value, '"}')


def json_line(extra: Column | None = None, attributes: Column | None = None, **replaced: Column) -> Column:
    """The JSON record. `replaced` gives other values by column, as JSON text; `extra` goes before attributes."""
    parts: list[str | Column] = ["{"]
    for field, column in TEXT_FIELDS:
        parts += [f'"{field}":', replaced.get(column, text('"', F.col(column), '"')), ","]
    if extra is not None:
        parts += [extra, ","]
    if attributes is None:
        attributes = text("[", attribute_json("k", F.col("attr_k"), F.col("event_id")), "]")
    return text(*parts, '"attributes":', attributes, "}")


def no_time() -> Column:
    """Arrival time for records whose ingestion time is to stay NULL."""
    return F.lit(None).cast("timestamp")


def json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events bound from JSON records."""
    records = adapted(spark, sf_dir).select(json_line().alias("value"))
    return valid_events(bind(records, "json", arrival=no_time()))


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events bound from log lines."""
    lines = adapted(spark, sf_dir).select(log_line().alias("value"))
    return valid_events(bind(lines, "log", arrival=no_time()))


EXTENSIONS = tuple(PARSER_BY_EXTENSION)
RAW_EXTENSIONS = tuple(e for e, parser in PARSER_BY_EXTENSION.items() if parser == "raw")


def pick(values: tuple[str, ...]) -> Column:
    """One of the values for each event, in turn."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.col("event_id") % len(values) + 1).cast("int"))
