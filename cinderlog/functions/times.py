"""Timestamps: the accepted text and number forms, and the forms written to documents."""

from __future__ import annotations

from cinderlog.functions import quoted

# An instant needs a zone; the line format has whole seconds in UTC.
INSTANT_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$"
LOG_TIME_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
EPOCH_RE = r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"
DATE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "HH:mm:ss"


def parse_log_time(text: str) -> str:
    """Time of a log line, `2026-07-17T10:25:30Z`; anything else gives NULL."""
    return f"CASE WHEN {text} RLIKE {quoted(LOG_TIME_RE)} THEN try_cast({text} AS TIMESTAMP) END"


def _cast_instant(text: str) -> str:
    """The cast knows offsets with a colon only."""
    with_colon = f"regexp_replace({text}, {quoted(r'([+-]\d{2})(\d{2})$')}, '$1:$2')"
    return f"try_cast(CASE WHEN endswith({text}, 'Z') THEN {text} ELSE {with_colon} END AS TIMESTAMP)"


def _is_instant(text: str) -> str:
    return f"{text} RLIKE {quoted(INSTANT_RE)}"


def parse_instant(text: str) -> str:
    """ISO time with a zone. The guard keeps out dates and zoneless times, which the cast would take."""
    return f"CASE WHEN {_is_instant(text)} THEN {_cast_instant(text)} END"


def from_epoch_seconds(seconds: str) -> str:
    """Decimal seconds since 1970 to a timestamp, cut to microseconds; out of range gives NULL."""
    return f"timestamp_micros(try_cast(floor(try_cast({seconds} AS DECIMAL(38,9)) * 1000000) AS BIGINT))"


def normalize_timestamp(text: str, exact_number: str | None = None) -> str:
    """UTC timestamp from an ISO instant or from epoch seconds; NULL when neither.

    A JSON number in E notation has already lost digits in `text`; `exact_number` may supply them.
    """
    number = text
    if exact_number is not None:
        plain = f"try_cast({text} AS DECIMAL(38,9))"
        number = f"CASE WHEN contains(upper({text}), 'E') THEN coalesce({exact_number}, {plain}) ELSE {plain} END"
    return (
        f"CASE WHEN {_is_instant(text)} THEN {_cast_instant(text)} "
        f"WHEN {text} RLIKE {quoted(EPOCH_RE)} THEN {from_epoch_seconds(number)} END"
    )


def iso_instant(ts: str) -> str:
    """`2026-07-17T10:25:30.123456Z`; expects the session zone to be UTC."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    return f"date_format({ts}, {quoted(pattern)})"


def epoch_decimal(ts: str) -> str:
    """Seconds since 1970 with nine decimals, the number form of an instant in a document."""
    return f"CAST(CAST(unix_micros({ts}) AS DECIMAL(26,6)) / 1000000 AS DECIMAL(20,9))"


def document_forms(ts: str) -> dict[str, str]:
    """Date-time, date and time texts of a document."""
    forms = {"dt": DATE_TIME_FORMAT, "d": DATE_FORMAT, "t": TIME_FORMAT}
    return {name: f"date_format({ts}, {quoted(form)})" for name, form in forms.items()}
