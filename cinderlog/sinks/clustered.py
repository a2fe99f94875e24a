"""The log index laid out for lookups by service, time and trace.

Within a date the rows are sorted along a curve that interleaves the bits of the three, so that a row group covers a small
box of all of them, and filters on any skip row groups by their least and greatest values. Trace and log ids, which have
too many values for that, get Bloom filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.sinks.index import FOLDER, with_folder

#: Bits of each column's place; the curve tells 2 to that power of each column apart.
BITS = 6
#: Rows, those of the least hash, whose values give the places; they shape the layout, not what is found in it.
SAMPLE = 10_000
DIMENSIONS = ("service", "event_time", "trace_id")
ROW_GROUP_BYTES = 32 << 20
#: Distinct values of an id in a row group that its Bloom filter is made for.
IDS = 200_000
_TIMES = "spark.sql.parquet.outputTimestampType"


def bounds(events: DataFrame, columns: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> dict[str, list]:
    """Values that cut each column into 2**bits parts of about equal size, from a bounded sample."""
    drawn = events.select(*columns).orderBy(F.xxhash64(*columns)).limit(SAMPLE).collect()
    found = {}
    for c in columns:
        values = sorted(r[c] for r in drawn if r[c] is not None)
        found[c] = sorted({values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)}) if values else []
    return found


def _at_or_below(values: list, column: Column) -> Column:
    """How many of the values are no greater than the column."""
    return F.size(F.filter(F.array(*[F.lit(v) for v in values]), lambda v: v <= column)).cast("bigint")


def curve(cuts: dict[str, list]) -> Column:
    """A row's place on the curve: the bits of the columns' places in turn, highest first. A null comes first."""
    bits = max((len(v) for v in cuts.values()), default=0).bit_length()
    key = F.lit(0).cast("bigint")
    for at, (column, values) in enumerate(cuts.items()):
        place = F.lit(0).cast("bigint")
        if values:
            place = _at_or_below(values, F.col(column))
        # a column with fewer parts has its bits at the top, so that all columns part the rows alike
        own = len(values).bit_length()
        for bit in range(own):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, (bits - own + bit) * len(cuts) + len(cuts) - 1 - at))
    return key


def write_clustered(events: DataFrame, path: str, files_a_date: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write a table of events as an index that `read_index` reads, clustered within its dates.

    Rows are dealt by ranges of date and curve, of equal size whatever the dates' sizes; `events` is read once more for the
    sample and once for the ranges, so give it a table.
    """
    spark = events.sparkSession
    parts = files_a_date or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = with_folder(events).withColumn("_place", curve(bounds(events)))
    writer = (
        placed.repartitionByRange(parts, FOLDER, "_place").sortWithinPartitions(FOLDER, "_place").drop("_place")
        .write.partitionBy(FOLDER).mode("append").option("parquet.block.size", row_group_bytes)
    )
    for name in ("trace_id", "log_id"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.expected.ndv#{name}", IDS)
    before = spark.conf.get(_TIMES)
    spark.conf.set(_TIMES, "TIMESTAMP_MICROS")  # the default kind of time has no least and greatest values
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(_TIMES, before)
