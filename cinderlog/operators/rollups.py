"""Mergeable rollups: a small state for each hour and group, from which longer spans are put together without the events.

A state holds exact counts and sketches: distinct traces, the distribution of message sizes, the most frequent hosts.
Sketches merge like counts do, so a day's figures come from 24 states a group and a month's from those of its days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cinderlog.operators.aggregate import error_count, percentile_name
from cinderlog.session import freeze

#: The sketch sizes: 2**LG_K registers (about 1.6 % off), accuracy KLL_K (ranks about 1.3 % off), items tracked for the top.
LG_K = 12
KLL_K = 200
TRACKED = 1_000

COUNTS = ("n", "n_error", "bytes")


def hourly(events: DataFrame, by: Sequence[str] = ("service",)) -> DataFrame:
    """A state for each hour and group. Each task merges its rows into one state a group before anything moves."""
    size = F.octet_length("message").cast("bigint")
    return events.where(F.col("event_time").isNotNull()).groupBy(F.date_trunc("hour", "event_time").alias("hour"), *by).agg(
        F.count("*").alias("n"), error_count().cast("bigint").alias("n_error"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
        F.expr(f"hll_sketch_agg(trace_id, {LG_K})").alias("traces"), F.expr(f"kll_sketch_agg_bigint(CAST(octet_length(message) AS BIGINT), {KLL_K})").alias("sizes"),
        F.expr(f"approx_top_k_accumulate(host, {TRACKED})").alias("hosts"),
    )


def merged(states: DataFrame, unit: str, by: Sequence[str] = ("service",)) -> DataFrame:
    """The states of longer spans, or of fewer groups: `unit` is a unit of time from the hour on, hour is its start."""
    return states.groupBy(F.date_trunc(unit, "hour").alias("hour"), *by).agg(
        *[F.sum(c).alias(c) for c in COUNTS], F.expr("hll_union_agg(traces)").alias("traces"),
        F.expr("kll_merge_agg_bigint(sizes)").alias("sizes"), F.expr("approx_top_k_combine(hosts)").alias("hosts"),
    )


def figures(states: DataFrame, by: Sequence[str] = ("service",), points: Sequence[float] = (0.5, 0.95), k: int = 3) -> DataFrame:
    """Counts and the sketches' answers: n_traces, a column for each percentile of the message sizes, and top_hosts."""
    return states.select(
        "hour", *by, *COUNTS, (F.col("n_error") / F.col("n")).alias("error_ratio"),
        F.expr("hll_sketch_estimate(traces)").alias("n_traces"),
        *[
            F.expr(f"CASE WHEN kll_sketch_get_n_bigint(sizes) > 0 THEN kll_sketch_get_quantile_bigint(sizes, {q}D) END").alias(percentile_name(q))
            for q in points
        ],
        F.expr(f"approx_top_k_estimate(hosts, {k})").alias("top_hosts"),
    )


def write_hours(states: DataFrame, path: str) -> None:
    """Write states in a folder for each date; dates that are there already are replaced, others stay."""
    (
        states.withColumn("on", F.to_date("hour")).hint("rebalance", "on").write.partitionBy("on").mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").parquet(path)
    )


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """The states; a filter on `on`, the date, skips folders."""
    return spark.read.parquet(path)


def touched_hours(arrived: DataFrame) -> DataFrame:
    """The hours that events belong to."""
    return arrived.where(F.col("event_time").isNotNull()).select(F.date_trunc("hour", "event_time").alias("hour")).distinct()


def update_hours(events: DataFrame, arrived: DataFrame, path: str, by: Sequence[str] = ("service",)) -> None:
    """Make the states right after events arrived, in time or late: only the hours they belong to are computed again.

    `events` are all events, those that arrived included, for instance the index; its date folders that no arrival
    touches are not read. The other hours of a date keep the states they have. Those are set aside in the shared folder
    before the date is written, and an hour is replaced as a whole, so running again changes nothing.
    """
    spark = events.sparkSession
    hours = freeze(touched_hours(arrived), "hours")
    wanted = events.withColumn("_hour", F.date_trunc("hour", "event_time")).join(
        hours.withColumnRenamed("hour", "_hour"), "_hour", "left_semi"
    )
    if "event_date" in events.columns:
        days = hours.select(F.to_date("hour").alias("event_date")).distinct()
        wanted = wanted.join(days, "event_date", "left_semi")
    dates = hours.select(F.to_date("hour").alias("on")).distinct()
    kept = read_hours(spark, path).join(dates, "on", "left_semi").join(hours, "hour", "left_anti")
    write_hours(freeze(hourly(wanted, by).unionByName(kept.drop("on")), "rollup"), path)
