"""Monitoring of services: health, silence, alerts and unusual counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cinderlog.operators.aggregate import error_count


def service_health(events: DataFrame, by: str = "service") -> DataFrame:
    """Last event time and error share per service."""
    return events.groupBy(by).agg(
        F.unix_micros(F.max("event_time")).alias("last_seen_us"),
        (error_count() / F.count("*")).alias("error_share"),
    )


def silent(
    events: DataFrame, hours: float, by: list[str], now_us: int | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Members without an event in the last `hours`, and when they were last seen.

    One row per member is kept, so no event is joined. `known` may list the members, also those
    never seen; by default they are taken from the events. `now_us` defaults to the newest event.
    """
    seen = events.groupBy(*by).agg(F.unix_micros(F.max("event_time")).alias("last_seen_us"))
    newest = seen.agg(F.max("last_seen_us")).scalar() if now_us is None else F.lit(now_us)
    if known is not None:
        seen = known.select(*by).distinct().join(seen, by, "left")
    since = newest - F.lit(int(hours * 3_600_000_000))
    return seen.where(F.col("last_seen_us").isNull() | (F.col("last_seen_us") <= since))


def alerts(metrics: DataFrame, max_error_ratio: float, min_events: int = 1) -> DataFrame:
    """Windows of `aggregate.metrics` whose error ratio is above the limit; works on streams too.

    Windows with fewer than `min_events` events raise no alert.
    """
    return metrics.where((F.col("n") >= min_events) & (F.col("error_ratio") > max_error_ratio))


def anomalies(metrics: DataFrame, by: list[str], history: int = 24, threshold: float = 3.0) -> DataFrame:
    """Windows whose count is at least `threshold` standard deviations off the mean of the previous ones.

    `z` is that distance. Only windows with `history` windows before them are judged. The rows per
    group are windows, not events, so a group grows with time and not with traffic.
    """
    trailing = Window.partitionBy(*by).orderBy("window_start").rowsBetween(-history, -1)
    known, total = F.count("n").over(trailing), F.sum("n").over(trailing)
    squares = F.sum(F.col("n") * F.col("n")).over(trailing)
    judged = metrics.withColumns({"_known": known, "_total": total, "_spread": known * squares - total * total})
    z = (F.col("n") * F.col("_known") - F.col("_total")) / F.sqrt("_spread")
    return (
        judged.where((F.col("_known") == history) & (F.col("_spread") > 0))
        .withColumn("z", z).where(F.abs("z") >= threshold).drop("_known", "_total", "_spread")
    )
