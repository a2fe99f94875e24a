"""Lines and JSON records to typed events, with one reason for each record that does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.functions import attributes as attr, kept_apart, lines, quoted_list, records, times
from cinderlog.schema import COLUMN_BY_FIELD, EVENT_COLUMNS, LEVELS, MAX_RECORD_BYTES, REASONS


def _later_time(value: str, rec: str) -> str:
    """Text of whichever of the two time keys comes last in the record."""
    plain, ingested = (f"array_position(reverse(json_object_keys({value})), '{f}')" for f in records.TIME_FIELDS)
    return (
        f"CASE WHEN {ingested} > 0 AND ({plain} = 0 OR {ingested} < {plain}) "
        f"THEN {rec}.ingestionTimestamp ELSE {rec}.timestamp END"
    )


def _texts(value: str, alias_times: bool, drop_log_time: bool) -> str:
    """Struct of the text fields, from whichever format the row has."""
    log, csv = lines.log_fields("_read.log"), lines.csv_fields("_read.csv")
    if drop_log_time:
        del log["timestamp"]
    parts = []
    for field in records.TEXT_FIELDS:
        json = f"_read.json.{field}"
        if field in records.TIME_FIELDS:
            if alias_times:
                json = _later_time(value, "_read.json")
            json = f"nullif(trim({json}), '')"
        parts.append(
            f"'{field}', CASE _parser WHEN 'json' THEN {json} WHEN 'log' THEN {log.get(field, 'NULL')} "
            f"WHEN 'csv' THEN {csv.get(field, 'NULL')} END"
        )
    return f"named_struct({', '.join(parts)})"


def _typed(value: str, alias_times: bool) -> str:
    """Struct of the event columns."""
    def moment(field: str) -> str:
        text = f"_text.{'timestamp' if alias_times else field}"
        exact = records.exact_number(value, field)
        return f"CASE WHEN _parser = 'log' THEN {times.parse_log_time(text)} ELSE {times.normalize_timestamp(text, exact)} END"

    log = lines.log_fields("_read.log")
    special = {
        **{field: moment(field) for field in records.TIME_FIELDS},
        "attributes": (
            f"CASE _parser WHEN 'json' THEN {attr.from_attribute_maps('_read.json.attributes')} "
            f"WHEN 'log' THEN {attr.parse_attributes(log['attributes'], '_text.logId')} END"
        ),
    }
    return "named_struct({})".format(
        ", ".join(f"'{c}', {special.get(f, f'_text.{f}')}" for f, c in COLUMN_BY_FIELD.items())
    )


def _reason(value: str, max_bytes: int) -> str:
    """First reason that applies; NULL for a valid record."""
    rec, attributes = "_read.json", lines.log_fields("_read.log")["attributes"]
    unread_time = " OR ".join(
        f"(_text.{field} IS NOT NULL AND _bound.{COLUMN_BY_FIELD[field]} IS NULL)" for field in records.TIME_FIELDS
    )
    checks = {
        "empty": records.is_empty(value),
        "unstructured": "_parser = 'raw'",
        "no_match": "_parser = 'log' AND _read.log IS NULL OR _parser = 'csv' AND _read.csv IS NULL",
        "not_json_object": f"_parser = 'json' AND {records.is_broken(value, rec)}",
        "unknown_field": f"_parser = 'json' AND {records.has_unknown_field(value, rec)}",
        "type_mismatch": f"_parser = 'json' AND {records.has_nested_text(value, rec)}",
        "bad_timestamp": unread_time,
        "bad_level": f"_bound.level NOT IN ({quoted_list(LEVELS)})",
        "bad_attributes": (
            f"_parser = 'json' AND {records.has_bad_attributes(value, rec)} "
            f"OR _parser = 'log' AND {attributes} IS NOT NULL AND _bound.attributes IS NULL"
        ),
        "oversize": f"octet_length({value}) > {max_bytes}",
    }
    return "CASE {} END".format(" ".join(f"WHEN {checks[reason]} THEN '{reason}'" for reason in REASONS))


def bind(
    df: DataFrame,
    parser: Column | str = "json",
    value: str = "value",
    arrival: Column | None = None,
    max_bytes: int = MAX_RECORD_BYTES,
    compat_ingestion_alias: bool = False,
    compat_drop_log_time: bool = False,
) -> DataFrame:
    """Add `event` (struct of the event columns) and `reason` (NULL when the record is valid).

    `parser` names the format of each row: json, log, csv or raw. All formats of a mixed input are
    bound in one pass. A record without an ingestion time takes `arrival`, by default the present.
    With `compat_ingestion_alias` both times carry the value of whichever key comes later; with
    `compat_drop_log_time` log lines lose their time, as they do when it is taken as the line's key.
    """
    read = (
        f"named_struct('json', CASE WHEN _parser = 'json' THEN {records.read_record(value)} END, "
        f"'log', CASE WHEN _parser = 'log' THEN {lines.log_line_captures(value)} END, "
        f"'csv', CASE WHEN _parser = 'csv' THEN {lines.csv_line_captures(value)} END)"
    )
    judged = (
        df.withColumn("_parser", F.lit(parser) if isinstance(parser, str) else parser)
        .selectExpr("*", f"{read} AS _read")
        .selectExpr("*", f"{_texts(value, compat_ingestion_alias, compat_drop_log_time)} AS _text")
        .selectExpr("*", f"{_typed(value, compat_ingestion_alias)} AS _bound")
        .selectExpr("*", f"{kept_apart(_reason(value, max_bytes))} AS reason")
    )
    event = F.col("_bound")
    if not compat_ingestion_alias:
        arrived = F.coalesce("_bound.ingestion_time", F.current_timestamp() if arrival is None else arrival)
        event = F.struct(*[(arrived if c == "ingestion_time" else F.col(f"_bound.{c}")).alias(c) for c in EVENT_COLUMNS])
    return judged.select(*df.columns, event.alias("event"), "reason")


def valid_events(bound: DataFrame, *keep: str) -> DataFrame:
    """The valid records as event columns, after the named source columns."""
    return bound.where(F.col("reason").isNull()).select(*keep, "event.*")


def quarantine(bound: DataFrame, *keep: str, value: str = "value", seen_at: Column | None = None) -> DataFrame:
    """The other records: raw text, reason, named source columns and the time they were seen."""
    seen = F.current_timestamp() if seen_at is None else seen_at
    return bound.where(F.col("reason").isNotNull()).select(
        F.col(value).alias("raw"), "reason", *keep, seen.alias("seen_at")
    )


def strict_events(bound: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """All records as event columns; the first invalid one fails the query."""
    message = F.concat(F.lit("invalid record ("), F.col("reason"), F.lit("): "), F.col(value))
    checked = F.when(F.col("reason").isNotNull(), F.raise_error(message)).otherwise(F.lit(True))
    return bound.where(checked.cast("boolean")).select(*keep, "event.*")


def bind_events(df: DataFrame, **options) -> DataFrame:
    """Valid events of a frame of JSON records."""
    return valid_events(bind(df, "json", **options))


def replay(quarantined: DataFrame, parser: Column | str, *keep: str, **options) -> DataFrame:
    """Bind quarantined records again, for instance after a fix of the limits or the source."""
    return bind(quarantined.select(F.col("raw").alias("value"), *keep), parser, **options)
