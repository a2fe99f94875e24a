"""Fixed names, schemas and limits of the log event model."""

from __future__ import annotations

from pyspark.sql import types as T

# The record's field names and the five level names, in order.
EVENT_FIELDS = (
    "logId", "host", "timestamp", "ingestionTimestamp", "service", "instanceId",
    "namespace", "podName", "traceId", "level", "message", "attributes",
)
ATTRIBUTE_FIELDS = ("id", "logId", "key", "value")
LEVELS = ("TRACE", "DEBUG", "INFO", "WARN", "ERROR")

# Field order of the two text line formats.
LOG_LINE_FIELDS = (
    "timestamp", "level", "service", "host", "logId", "instanceId",
    "namespace", "podName", "traceId", "message", "attributes",
)
CSV_LINE_FIELDS = (
    "logId", "host", "timestamp", "service", "instanceId",
    "namespace", "podName", "traceId", "level", "message",
)

# The line formats as regular expressions with plain groups. `(?s)` lets a dot take
# every character of the line, also the line separators other than a line feed.
LOG_LINE_RE = (
    r"(?s)^\[([^\]]+)\]\s+\[([^\]]+)\]\s+\[([^\]]+)\]\s+\[([^\]]+)\]"
    r"\s+logId=(\S+)\s+instanceId=(\S+)\s+namespace=(\S+)\s+podName=(\S+)\s+traceId=(\S+)"
    # up to the first bar between blanks; a run of blanks is read once, so that a long one costs no more than its length
    r"\s+-\s+(\S*(?:\s++(?!\|\s)\S+)*+)\s+\|\s+(.*)$"
)
CSV_LINE_RE = r"(?s)^([^,]+),([^,]+),([^,]+),([^,]+),([^,]+),([^,]+),([^,]+),([^,]+),([^,]+),(.*)$"

# File extension -> line parser. Files of the `raw` kind carry no records.
PARSER_BY_EXTENSION = {
    "log": "log", "txt": "log",
    "json": "json", "ndjson": "json",
    "csv": "csv",
    "xml": "raw", "yaml": "raw", "yml": "raw", "properties": "raw",
    "conf": "raw", "ini": "raw", "tsv": "raw", "sql": "raw",
}
# Tags are `logs.<extension>`, but `.log` files are tagged `logs.app`.
TAG_PREFIX = "logs."
TAG_BY_EXTENSION = {ext: TAG_PREFIX + ("app" if ext == "log" else ext) for ext in PARSER_BY_EXTENSION}

# Topic, index and bulk limits.
RAW_TOPIC = "logs.raw"
INDEX_NAME = "logs"
MAX_BATCH_RECORDS = 1000
MAX_BATCH_BYTES = 5 * 1024 * 1024
MAX_RECORD_BYTES = 1024 * 1024

ATTRIBUTE_TYPE = T.ArrayType(
    T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("logId", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ])
)

# Canonical column names, in the order of EVENT_FIELDS.
EVENT_COLUMNS = (
    "log_id", "host", "event_time", "ingestion_time", "service", "instance_id",
    "namespace", "pod_name", "trace_id", "level", "message", "attributes",
)
COLUMN_BY_FIELD = dict(zip(EVENT_FIELDS, EVENT_COLUMNS))

EVENT_SCHEMA = T.StructType([
    T.StructField(
        name,
        T.TimestampType() if name.endswith("_time")
        else ATTRIBUTE_TYPE if name == "attributes"
        else T.StringType(),
    )
    for name in EVENT_COLUMNS
])

# Reasons a record is kept out of the index, in order of precedence within a record.
REASONS = (
    "empty", "unstructured", "no_match", "not_json_object", "unknown_field", "type_mismatch",
    "bad_timestamp", "bad_level", "bad_attributes", "oversize",
)
