"""Aggregations over events. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cinderlog.operators.ordered import carry, range_layout

ERROR = "ERROR"


def _long(column: Column) -> Column:
    return column.cast("bigint")


def error_count() -> Column:
    return F.count_if(F.coalesce(F.col("level") == ERROR, F.lit(False)))


def metric_columns(size: Column | None = None) -> list[Column]:
    """Count, error count, error ratio and message bytes of a group of events; `size` stands for the bytes of a message."""
    size = F.octet_length("message") if size is None else size
    return [
        _long(F.count("*")).alias("n"),
        _long(error_count()).alias("n_error"),
        (error_count() / F.count("*")).alias("error_ratio"),
        _long(F.coalesce(F.sum(size), F.lit(0))).alias("bytes"),
    ]


def metrics(
    events: DataFrame, width: str = "1 hour", by: Sequence[str] = ("service",), slide: str | None = None
) -> DataFrame:
    """Metrics per time window and group; works on tables and, with a watermark, on streams.

    With `slide` a window starts every so often, and an event counts in every window it falls into.
    """
    return (
        events.groupBy(F.window("event_time", width, slide), *by).agg(*metric_columns())
        .select(F.col("window.start").alias("window_start"), *by, "n", "n_error", "error_ratio", "bytes")
    )


def session_metrics(events: DataFrame, gap: str = "30 minutes", by: Sequence[str] = ("trace_id",)) -> DataFrame:
    """Metrics per session: a run of events of a group without a longer gap between them; `session_end` is the last
    event's time plus the gap. Events without a time belong to no session.

    On a stream Spark's session windows do it. On a table these would bring all events of a group into one task; here the
    times are sorted into ranges, an event opens a session if the one before it is too far, and each takes the start of
    its session from the last that opened one. The last step combines on the map side like any aggregation.
    """
    columns = [F.col("session_start"), F.col("session_end"), *by, "n", "n_error", "error_ratio", "bytes"]
    if events.isStreaming:
        windows = events.groupBy(F.session_window("event_time", gap).alias("session"), *by).agg(*metric_columns())
        return windows.withColumns({"session_start": F.col("session.start"), "session_end": F.col("session.end")}).select(*columns)
    length = F.expr(f"INTERVAL {gap}")
    narrow = events.where(F.col("event_time").isNotNull()).select(*by, "event_time", "level", F.octet_length("message").alias("_size"))
    placed = carry(range_layout(narrow, [*by, "event_time"]), by, F.col("event_time"), "_last", strict=True)
    opens = F.col("_last").isNull() | (F.col("event_time") > F.col("_last") + length)
    started = carry(placed, by, F.when(opens, F.col("event_time")), "session_start")
    sessions = started.groupBy("session_start", *by).agg((F.max("event_time") + length).alias("session_end"), *metric_columns(F.col("_size")))
    return sessions.select(*columns)


def count_by(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(_long(F.count("*")).alias("n"))


def top_groups(events: DataFrame, by: str, k: int) -> DataFrame:
    """The k largest groups, ties by name."""
    return count_by(events, by).orderBy(F.col("n").desc(), F.col(by)).limit(k)


def date_histogram(events: DataFrame, unit: str = "day", by: Sequence[str] = ("level",)) -> DataFrame:
    """Counts per time unit and group; `bucket` is the start of the unit."""
    return events.groupBy(F.date_trunc(unit, "event_time").alias("bucket"), *by).agg(_long(F.count("*")).alias("n"))


def distinct_count(events: DataFrame, by: str, of: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(of) if approximate else F.count_distinct(of)
    return events.groupBy(by).agg(_long(count).alias("n_distinct"))


def cube_counts(events: DataFrame, *by: str) -> DataFrame:
    """Counts for every combination of the groups, with subtotals; `subtotal` tells them apart."""
    return events.cube(*by).agg(
        F.grouping_id().cast("bigint").alias("subtotal"), _long(F.count("*")).alias("n")
    )


def percentile_name(point: float) -> str:
    """The column of a percentile: p50 for 0.5, p99_9 for 0.999."""
    return "p" + format((Decimal(str(point)) * 100).normalize(), "f").replace(".", "_")


def percentiles_approx(
    df: DataFrame, by: str, value: str, points: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """Percentiles per group from a sketch, one column per point; the rank is off by at most 1 / accuracy.

    A sketch is built in each task and merged, so a group of any size takes one small row a task.
    """
    return df.groupBy(by).agg(*[F.percentile_approx(value, q, accuracy).alias(percentile_name(q)) for q in points])


def percentiles(df: DataFrame, by: str, value: str, points: Sequence[float]) -> DataFrame:
    """Exact interpolated percentiles per group, one column per point, see `percentile_name`.

    The built-in function holds all values of a group in one buffer. Here equal values are counted
    first, the counts are sorted into ranges, and each percentile is picked by its rank.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("_n"))
    laid = range_layout(counted, [by, value])
    upto = Window.partitionBy("_part", by).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = laid.groupBy("_part", by).agg(F.sum("_n").alias("_share")).select(
        "_part", F.col(by).alias("_by"),
        F.coalesce(F.sum("_share").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_share").over(Window.partitionBy(by)).alias("_total"),
    )
    same = (laid["_part"] == shares["_part"]) & laid[by].eqNullSafe(shares["_by"])
    ranked = laid.withColumn("_upto", F.sum("_n").over(upto)).join(shares, same).select(
        by, value, "_total",
        (F.col("_before") + F.col("_upto")).alias("_end"),
        (F.col("_before") + F.col("_upto") - F.col("_n")).alias("_start"),
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col(value)))

    def point(q: float) -> Column:
        place = (F.col("_total") - 1) * F.lit(q)
        low, high = at(F.floor(place)), at(F.ceil(place))
        share = F.max(place - F.floor(place))
        return low + (high - low) * share

    # only the rows at a wanted rank go on to the last shuffle
    wanted = [edge((F.col("_total") - 1) * F.lit(q)) for q in points for edge in (F.floor, F.ceil)]
    hit = reduce(lambda a, b: a | b, [(F.col("_start") <= r) & (r < F.col("_end")) for r in wanted])
    return ranked.where(hit).groupBy(by).agg(*[point(q).alias(percentile_name(q)) for q in points])
