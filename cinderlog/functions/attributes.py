"""Attribute text of a log line, and attribute lists of a JSON record."""

from __future__ import annotations

from cinderlog.functions import quoted
from cinderlog.schema import ATTRIBUTE_TYPE

_LIST = ATTRIBUTE_TYPE.simpleString()


def _attribute(number: str, log_id: str, key: str, value: str) -> str:
    return f"named_struct('id', {number}, 'logId', {log_id}, 'key', {key}, 'value', {value})"


def parse_attributes(text: str, log_id: str) -> str:
    """Attribute text to a list: a JSON object, or `k=v` pairs parted by blanks or commas.

    A word without `=` becomes a key without a value. Unreadable JSON gives NULL.
    """
    none = "CAST(NULL AS BIGINT)"
    value = "CASE WHEN contains(w, '=') THEN substr(w, instr(w, '=') + 1) END"
    pair = _attribute(none, log_id, "substring_index(w, '=', 1)", value)
    words = f"filter(split({text}, {quoted(r'[\s,]+')}), w -> w <> '')"
    entries = f"map_entries(from_json({text}, 'map<string,string>', map('allowSingleQuotes', 'false')))"
    member = _attribute(none, log_id, "e.key", "e.value")
    return (
        f"CASE WHEN startswith(ltrim({text}), '{{') THEN CAST(transform({entries}, e -> {member}) AS {_LIST}) "
        f"ELSE CAST(transform({words}, w -> {pair}) AS {_LIST}) END"
    )


def attribute_number(text: str) -> str:
    """Attribute id from its JSON text; a fraction is cut off."""
    whole = f"try_cast({text} AS BIGINT)"
    return f"coalesce({whole}, try_cast(try_cast(nullif(trim({text}), '') AS DECIMAL(38,9)) AS BIGINT))"


def from_attribute_maps(maps: str) -> str:
    """List of JSON objects, read as string maps, to the typed attribute list."""
    member = _attribute(attribute_number("m['id']"), "m['logId']", "m['key']", "m['value']")
    return f"transform({maps}, m -> CASE WHEN m IS NOT NULL THEN {member} END)"
