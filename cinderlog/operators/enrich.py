"""Transformation and enrichment of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.operators.ordered import carry, range_layout
from cinderlog.schema import LEVELS


def level_rank(level: Column) -> Column:
    """0 for TRACE up to 4 for ERROR."""
    rank = F.array_position(F.array(*[F.lit(name) for name in LEVELS]), level) - 1
    return F.when(level.isin(*LEVELS), rank).cast("bigint")


def transform_events(events: DataFrame) -> DataFrame:
    """Add level_rank, event_date and event_hour (UTC)."""
    return events.withColumns({
        "level_rank": level_rank(F.col("level")),
        "event_date": F.to_date("event_time"),
        "event_hour": F.hour("event_time").cast("bigint"),
    })


def document_id(*source: str) -> Column:
    """The log id, or else a hash of where the record came from; the same on every replay."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in source]
    return F.coalesce(F.col("log_id"), F.sha2(F.concat_ws("\u0001", *parts), 256))


def join_dimension(events: DataFrame, dimension: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a lookup table. Spark broadcasts it if it is small by its size in bytes, as read or as measured at run time;
    otherwise it is a shuffle join whose hot keys adaptive execution splits."""
    return events.join(dimension, on, how)


def join_as_of(
    events: DataFrame, dimension: DataFrame, on: Sequence[str], values: Sequence[str], at: str = "event_time",
    valid_from: str = "valid_from", valid_to: str = "valid_to",
) -> DataFrame:
    """Add the `values` that were valid for an event's key at its time, from `valid_from` on and before `valid_to`.

    NULL in valid_from means since ever, in valid_to until further notice. Of intervals that overlap, the one that
    starts last counts; those that start together are taken by their end and values, the greatest. An event without a key,
    a time or a valid interval stays, with NULLs. Both sides are sorted into ranges together and each range hands its
    last interval on, so that neither a hot key nor a key with many intervals is held in one task.
    """
    kept = F.struct(valid_to, *values)
    known = dimension.where(" AND ".join(f"`{c}` IS NOT NULL" for c in on)).select(
        *on, F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), kept.alias("_valid"),
    )
    rows = events.select(*on, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*events.columns).alias("_row"))
    both = rows.unionByName(known, allowMissingColumns=True)
    held = carry(range_layout(both, [*on, "_at", "_kind", "_valid"]), on, F.col("_valid"), "_held").where("_kind = 1")
    valid = F.col("_at").isNotNull() & (F.col(f"_held.{valid_to}").isNull() | (F.col("_at") < F.col(f"_held.{valid_to}")))
    return held.select("_row.*", *[F.when(valid, F.col(f"_held.{v}")).alias(v) for v in values])
