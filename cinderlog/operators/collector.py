"""Operators between the landing folder or request bodies and the raw topic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.functions import records
from cinderlog.schema import PARSER_BY_EXTENSION, TAG_BY_EXTENSION

# Fixed value: the key the forwarder adds to each record and the collector takes away.
FORWARDER_DATE_KEY = "date"


def _by_extension(ext: Column, table: dict[str, str]) -> Column:
    """CASE over the extensions, grouped by result."""
    result = None
    for target in dict.fromkeys(table.values()):
        group = ext.isin(*[e for e, t in table.items() if t == target])
        result = F.when(group, target) if result is None else result.when(group, target)
    return result


def parser_of(ext: Column) -> Column:
    """Parser for a file extension; NULL for files that are not picked up."""
    return _by_extension(ext, PARSER_BY_EXTENSION)


def tag_of(ext: Column) -> Column:
    return _by_extension(ext, TAG_BY_EXTENSION)


def route(df: DataFrame, ext: str = "ext") -> DataFrame:
    """Add `parser` and `tag`; drop rows of extensions that are not picked up."""
    return df.withColumns({"parser": parser_of(F.col(ext)), "tag": tag_of(F.col(ext))}).where(
        F.col("parser").isNotNull()
    )


def with_tag_like(df: DataFrame, pattern: str, tag: str = "tag") -> DataFrame:
    """Rows whose tag matches; `*` stands for any text."""
    like = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")
    return df.where(F.col(tag).like(like))


def union_formats(*frames: DataFrame) -> DataFrame:
    """All rows of the frames; columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def explode_bodies(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per record of each request body, in `record` (a map), without the forwarder's date key.

    A body that is not an array of objects has no records here; `body_quarantine` gives it with its reason.
    """
    others = [c for c in df.columns if c != body]
    return df.select(*others, F.expr(f"explode({records.read_bodies(body)})").alias("record")).withColumn(
        "record", F.expr(records.without_key("record", FORWARDER_DATE_KEY))
    )


def body_reason(body: str = "body") -> str:
    """SQL: why a body is not an array of objects; NULL for one that is."""
    return (
        f"CASE WHEN {records.read_bodies(body)} IS NOT NULL THEN NULL WHEN {body} IS NULL OR trim({body}) = '' THEN 'empty' "
        f"WHEN try_parse_json({body}) IS NULL THEN 'not_json' ELSE 'not_array_of_objects' END"
    )


def body_quarantine(df: DataFrame, body: str = "body") -> DataFrame:
    """The bodies that `explode_bodies` gives no records for, whole, with the reason.

    An array with one wrong element is kept out as a whole, as the collector takes a body as a whole or not at all.
    An empty array is a body without records and is not kept out.
    """
    others = [c for c in df.columns if c != body]
    return df.selectExpr(*[f"`{c}`" for c in others], f"`{body}` AS raw", f"{body_reason(f'`{body}`')} AS reason").where("reason IS NOT NULL")


def body_sizes(df: DataFrame, body: str = "body") -> DataFrame:
    """Replace each body by its number of records, `n`."""
    others = [c for c in df.columns if c != body]
    return df.select(*others, F.expr(f"CAST(size({records.read_bodies(body)}) AS BIGINT)").alias("n"))


def payloads(df: DataFrame, record: str = "record", key: Column | None = None) -> DataFrame:
    """Records to topic rows: JSON text in `value`, and `key` if one is wanted."""
    others = [c for c in df.columns if c != record]
    columns = [F.expr(records.to_document(record)).alias("value")]
    if key is not None:
        columns.append(key.cast("string").alias("key"))
    return df.select(*others, *columns)
