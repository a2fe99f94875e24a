"""Text line formats. Each line is matched once and its groups are cut apart afterwards."""

from __future__ import annotations

from cinderlog.functions import quoted
from cinderlog.schema import CSV_LINE_FIELDS, CSV_LINE_RE, LOG_LINE_FIELDS, LOG_LINE_RE

_MARK = "\\u0001"


def _captures(line: str, pattern: str, count: int) -> str:
    """Array of the pattern's groups, NULL where the line does not match.

    One replacement writes all groups with a mark between them; a line that does not match stays as it is and
    has no marks. A line that holds the mark itself is cut group by group instead.
    """
    pattern = quoted(pattern)
    groups = range(1, count + 1)
    joined = _MARK.join(f"${i}" for i in groups)
    slow = ", ".join(f"regexp_extract({line}, {pattern}, {i})" for i in groups)
    cut = f"split(regexp_replace({line}, {pattern}, '{joined}'), '{_MARK}', -1)"
    return (
        f"CASE WHEN contains({line}, '{_MARK}') THEN CASE WHEN {line} RLIKE {pattern} THEN array({slow}) END "
        f"ELSE try_element_at(filter(array({cut}), c -> size(c) = {count}), 1) END"
    )


def log_line_captures(line: str) -> str:
    return _captures(line, LOG_LINE_RE, len(LOG_LINE_FIELDS))


def csv_line_captures(line: str) -> str:
    return _captures(line, CSV_LINE_RE, len(CSV_LINE_FIELDS))


def _named(captures: str, names: tuple[str, ...]) -> dict[str, str]:
    return {name: f"nullif({captures}[{i}], '')" for i, name in enumerate(names)}


def log_fields(captures: str) -> dict[str, str]:
    """Captures of a log line by field name; an empty capture counts as absent."""
    return _named(captures, LOG_LINE_FIELDS)


def csv_fields(captures: str) -> dict[str, str]:
    """Captures of a comma-separated line by field name; an empty capture counts as absent."""
    return _named(captures, CSV_LINE_FIELDS)
