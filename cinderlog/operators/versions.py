"""Records of earlier schema versions, brought to the present field names before they are bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.functions import quoted
from cinderlog.operators.binding import bind

Versions = dict[str, dict[str, str]]


def upgraded(value: str, names: dict[str, str]) -> str:
    """SQL: a JSON object with its keys renamed; other keys stay, so that the bind still sees unknown ones."""
    pairs = ", ".join(f"{quoted(old)}, {quoted(new)}" for old, new in names.items())
    entries = f"map_entries(try_variant_get(try_parse_json({value}), '$', 'map<string,variant>'))"
    # the text of a struct with one field is {"k":"name"}; without its ends the quoted name is left
    wrapped = f"to_json(named_struct('k', coalesce(try_element_at(map({pairs}), e.key), e.key)))"
    name = f"substr({wrapped}, 6, length({wrapped}) - 6)"
    fields = f"transform({entries}, e -> concat({name}, ':', coalesce(to_json(e.value), 'null')))"
    renamed = f"concat('{{', array_join({fields}, ','), '}}')"
    return f"coalesce({renamed}, {value})"


def bind_by_version(df: DataFrame, version: Column, versions: Versions, value: str = "value", **options) -> DataFrame:
    """Bind JSON records whose field names depend on their version.

    `versions` has for each old version its names and what they are called now; records of other versions are bound
    as they are. A record that is no JSON object is left to the bind, which gives its reason.
    """
    branches = "".join(f"WHEN {quoted(v)} THEN {upgraded(f'`{value}`', names)} " for v, names in versions.items())
    rows = df.withColumn("_version", version.cast("string"))
    renamed = rows.withColumn(value, F.expr(f"CASE _version {branches} ELSE `{value}` END")) if branches else rows
    return bind(renamed.drop("_version"), "json", value=value, **options)
