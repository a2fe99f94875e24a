"""JSON records: reading, strictness checks and writing."""

from __future__ import annotations

from cinderlog.functions import quoted, quoted_list
from cinderlog.functions.attributes import attribute_number
from cinderlog.functions.times import epoch_decimal, iso_instant
from cinderlog.schema import ATTRIBUTE_FIELDS, COLUMN_BY_FIELD, EVENT_FIELDS

TEXT_FIELDS = tuple(f for f in EVENT_FIELDS if f != "attributes")
TIME_FIELDS = ("timestamp", "ingestionTimestamp")
_TEXT_DDL = ", ".join(f"{f} string" for f in TEXT_FIELDS)
_STRICT = "'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false'"


def _read(value: str, ddl: str) -> str:
    options = f"map({_STRICT}, 'mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '_corrupt')"
    return f"from_json({value}, '{ddl}, _corrupt string', {options})"


def _typed(value: str, ddl: str) -> str:
    return f"from_json({value}, '{ddl}', map({_STRICT}))"


def read_record(value: str) -> str:
    """The twelve fields as text (attributes as string maps), plus the corrupt text."""
    return _read(value, f"{_TEXT_DDL}, attributes array<map<string,string>>")


def is_empty(value: str) -> str:
    return f"({value} IS NULL OR {value} RLIKE {quoted(r'^\s*$')})"


def is_broken(value: str, rec: str) -> str:
    """Not one JSON object. A record that only fails on its attributes is not broken."""
    return (
        f"(({rec} IS NULL OR {rec}._corrupt IS NOT NULL) "
        f"AND coalesce({_read(value, _TEXT_DDL)}._corrupt IS NOT NULL, true))"
    )


def has_unknown_field(value: str, rec: str) -> str:
    nested = f"exists(map_keys(m), k -> k NOT IN ({quoted_list(ATTRIBUTE_FIELDS)}))"
    return (
        f"(coalesce(exists(json_object_keys({value}), k -> k NOT IN ({quoted_list(EVENT_FIELDS)})), false) "
        f"OR coalesce(exists({rec}.attributes, m -> coalesce({nested}, false)), false))"
    )


def _opens_nested(text: str) -> str:
    return f"coalesce(ascii({text}) IN ({ord('{')}, {ord('[')}), false)"


def _is_nested(variant: str) -> str:
    return f"coalesce(schema_of_variant({variant}) RLIKE '^(OBJECT|ARRAY)', false)"


def has_nested_text(value: str, rec: str) -> str:
    """A field that takes text was given an object or a list.

    Reading has turned those into text. Only records with text that starts like one are read again,
    this time keeping the JSON types.
    """
    looks = " OR ".join(_opens_nested(f"{rec}.{f}") for f in TEXT_FIELDS)
    typed = _typed(value, ", ".join(f"{f} variant" for f in TEXT_FIELDS))
    nested = " OR ".join(_is_nested(f"t.{f}") for f in TEXT_FIELDS)
    return f"(({looks}) AND exists(array({typed}), t -> {nested}))"


def has_bad_attributes(value: str, rec: str) -> str:
    """Attributes are no list of objects, an id is no number, or a text field in them is nested."""
    number = f"coalesce({attribute_number("m['id']")} IS NULL AND trim(m['id']) <> '', false)"
    looks = f"coalesce(exists(map_values(m), v -> {_opens_nested('v')}), false)"
    nested = f"coalesce(exists(map_values(m), v -> {_is_nested('v')}), false)"
    typed = f"{_typed(value, 'attributes array<map<string,variant>>')}.attributes"
    return (
        f"({rec}._corrupt IS NOT NULL OR coalesce(exists({rec}.attributes, m -> {number}), false) "
        f"OR (coalesce(exists({rec}.attributes, m -> {looks}), false) "
        f"AND coalesce(exists({typed}, m -> {nested}), false)))"
    )


def exact_number(value: str, field: str) -> str:
    """A JSON number with up to nine decimals, read without going through a double."""
    return f"try_variant_get({_typed(value, f'{field} variant')}.{field}, '$', 'decimal(38,9)')"


def read_bodies(body: str) -> str:
    """A request body, a JSON array of objects, to a list of maps that keep nested values and key order."""
    return _typed(body, "array<map<string,variant>>")


def without_key(record: str, key: str) -> str:
    return f"map_filter({record}, (k, v) -> k <> {quoted(key)})"


def event_document(time_form: str = "epoch") -> str:
    """Struct of the event columns under the record's field names, in order.

    `epoch` writes times as decimal seconds, `iso` as text in UTC.
    """
    form = {"epoch": epoch_decimal, "iso": iso_instant}[time_form]
    return "named_struct({})".format(
        ", ".join(f"'{f}', {form(c) if f in TIME_FIELDS else c}" for f, c in COLUMN_BY_FIELD.items())
    )


def to_document(struct: str) -> str:
    """JSON text with absent fields written as null."""
    return f"to_json({struct}, map('ignoreNullFields', 'false'))"


def document_size(document: str) -> str:
    return f"CAST(octet_length({document}) AS BIGINT)"
