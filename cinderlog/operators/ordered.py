"""Ordered work over groups of any size.

A window over a group puts the whole group into one task. Here the rows are sorted into ranges of
equal size, whatever the group sizes, and only one row per range is passed on to the next ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cinderlog.session import freeze

#: Bytes of a range, and most ranges: their edges meet in one task, one row each.
RANGE_BYTES = 256 << 20
MAX_RANGES = 200_000
#: From here on a size is only a stand-in for one that Spark does not know.
UNKNOWN_SIZE = 1 << 60
_POSITION_BITS = 33  # the low bits of monotonically_increasing_id count within a partition


def range_count(df: DataFrame) -> int:
    """Ranges of about RANGE_BYTES each by the bytes of what `df` is read from, but no fewer than a shuffle has."""
    inputs = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(inputs.apply(i).stats().sizeInBytes())) for i in range(inputs.size())]
    known = sum(size for size in sizes if size < UNKNOWN_SIZE)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MAX_RANGES, -(-known // RANGE_BYTES)))


def range_layout(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Sort `df` into ranges by `order` and add `_part` (range) and `_pos` (position in the range).

    The last sort key is the row's place in the input, so that even equal rows spread over ranges.
    The result is written out: range bounds come from a sample and must not change between uses.
    Sampling reads `df` once more, so give it a table or something cheap to compute.
    """
    keys = [*order, "_tie"]
    placed = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(ranges or range_count(df), *keys)
        .sortWithinPartitions(*keys)
        .drop("_tie")
        .withColumns({
            "_part": F.spark_partition_id(),
            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        })
    )
    return freeze(placed, "ranges")


def _range_order(backward: bool = False) -> Window:
    """Over one row per range: as many rows as there are ranges, whatever the data size."""
    return Window.orderBy(F.desc("_part") if backward else "_part")


def _upto(order: Window, strict: bool) -> Window:
    """The rows up to this one in an order. Such a frame only grows, so it costs no more than its rows; one that ends at
    the last row would be read anew for each row, and is therefore taken as this one in the opposite order."""
    return order.rowsBetween(Window.unboundedPreceding, -int(strict))


def row_numbers(laid: DataFrame, name: str = "row_number") -> DataFrame:
    """Number the rows of a range layout from 1."""
    before = F.sum("_n").over(_range_order().rowsBetween(Window.unboundedPreceding, -1))
    starts = laid.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(before, F.lit(0)).alias("_start")
    )
    return laid.join(starts, "_part").withColumn(
        name, (F.col("_start") + F.col("_pos") + 1).cast("bigint")
    ).drop("_part", "_pos", "_start")


def _edges(laid: DataFrame, key: Column, held: Column) -> DataFrame:
    """For each range its first and last row that holds a value: position, group and value. One aggregation."""
    edge = F.when(held.isNotNull(), F.struct("_pos", key.alias("key"), held.alias("value")))
    # the position comes first and is unique within a range, so that it alone decides
    return laid.groupBy("_part").agg(F.min_by(edge, F.when(held.isNotNull(), F.col("_pos"))).alias("_first"),
                                     F.max_by(edge, F.when(held.isNotNull(), F.col("_pos"))).alias("_last"))


def _passed(edges: DataFrame) -> DataFrame:
    """For each range the last edge of the ranges before it and the first one of those after it."""
    return edges.select(
        "_part", F.last("_last", ignorenulls=True).over(_upto(_range_order(), True)).alias("_from_before"),
        F.last("_first", ignorenulls=True).over(_upto(_range_order(backward=True), True)).alias("_from_after"),
    )


def _carried(laid: DataFrame, group: Sequence[str], value: Column, frames: dict[str, tuple[bool, bool]]) -> DataFrame:
    """Add for each name the nearest value, by (backward, strict); those of one direction share a sort of a range."""
    key = F.struct(*group)
    source = laid.withColumn("_value", value)
    within = Window.partitionBy("_part", *group)
    own = {True: within.orderBy(F.desc("_pos")), False: within.orderBy("_pos")}
    near = source.withColumns({
        f"_near_{name}": F.last("_value", ignorenulls=True).over(_upto(own[backward], strict))
        for name, (backward, strict) in frames.items()
    })
    passed = _passed(_edges(source, key, F.col("_value")))
    joined = near.join(passed, "_part", "left")
    edge = {True: F.col("_from_after"), False: F.col("_from_before")}
    return joined.withColumns({
        name: F.coalesce(f"_near_{name}", F.when(edge[backward]["key"].eqNullSafe(key), edge[backward]["value"]))
        for name, (backward, _) in frames.items()
    }).drop("_value", "_from_before", "_from_after", *[f"_near_{name}" for name in frames])


def carry(
    laid: DataFrame, group: Sequence[str], value: Column, name: str, backward: bool = False, strict: bool = False
) -> DataFrame:
    """Add the nearest non-NULL `value` at or before each row of its group, or at or after it.

    `laid` must be laid out by the group columns first. `strict` leaves out the row itself.
    """
    return _carried(laid, group, value, {name: (backward, strict)})


def carry_both(laid: DataFrame, group: Sequence[str], value: Column, before: str, after: str) -> DataFrame:
    """Add the nearest non-NULL `value` at or before each row and the one at or after it, in one pass."""
    return _carried(laid, group, value, {before: (False, False), after: (True, False)})
