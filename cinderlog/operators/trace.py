"""Troubleshooting: trace timelines and the surroundings of errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cinderlog.operators.ordered import carry, carry_both, range_layout

def timeline(events: DataFrame) -> DataFrame:
    """Add `gap_us`, the time since the previous event of the same trace.

    Events are sorted into ranges, so that no trace fills one task, however many events it has.
    """
    stamped = events.withColumn("_at", F.unix_micros("event_time"))
    laid = range_layout(stamped, ["trace_id", "_at", "log_id"])
    linked = carry(laid, ["trace_id"], F.struct("_at"), "_previous", strict=True)
    return linked.withColumn("gap_us", F.col("_at") - F.col("_previous._at")).drop("_at", "_previous", "_part", "_pos")


def trace_events(events: DataFrame, trace_id: str) -> DataFrame:
    """One trace in time order."""
    return timeline(events.where(F.col("trace_id") == trace_id)).orderBy("event_time", "log_id")


def around_errors(events: DataFrame, seconds: int = 60, by: str = "service") -> DataFrame:
    """Events within `seconds` of an ERROR of the same service, each once, with its nearest error.

    `gap_us` is the time from that error to the event; on a tie the earlier error is named. Output
    grows with the events, not with the number of error and event pairs.
    """
    at = F.unix_micros("event_time")
    laid = range_layout(
        events.select(by, at.alias("_at"), "log_id", "level").where(F.col("_at").isNotNull()), [by, "_at", "log_id"]
    )
    error = F.when(F.col("level") == "ERROR", F.struct("_at", "log_id"))
    both = carry_both(laid, [by], error, "_before", "_after")
    since = F.col("_at") - F.col("_before._at")
    until = F.col("_after._at") - F.col("_at")
    limit = F.lit(seconds * 1_000_000)
    use_before = (since <= limit) & (F.col("_after").isNull() | (since <= until))
    use_after = until <= limit
    nearest = F.when(use_before, F.col("_before")).when(use_after, F.col("_after"))
    return (
        both.withColumn("_nearest", nearest).where(F.col("_nearest").isNotNull())
        .select(by, "log_id", F.col("_nearest.log_id").alias("error_id"), (F.col("_at") - F.col("_nearest._at")).alias("gap_us"))
    )
