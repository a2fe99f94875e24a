"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cinderlog.session import prepare

#: The white space that parts words, as bytes; `bytes.split()` cuts at the same six.
BLANKS = b" \t\n\r\x0b\x0c"

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of the folder, with the named columns only if any are named."""
    df = prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def raw(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def mapped(df: DataFrame, task: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """Run `task` over the Arrow batches of each partition."""
    return df.mapInArrow(task, schema)


def filtered(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows for which `keep` says so, with all columns of `df` as they are and no shuffle."""
    def task(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch), pa.bool_()))

    return df.mapInArrow(task, df.schema)


def per_worker(name: str, make: Callable):
    """What `make` returns, made once in each Python worker and kept between its tasks.

    Functions travel with their tasks by value, so a global of this module would be new in each task.
    """
    kept = sys.modules.setdefault("_cinderlog_worker", types.ModuleType("_cinderlog_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def least_hashed(df: DataFrame, hashed: str, bound: int) -> DataFrame:
    """Rows whose `hashed` (a bigint column, different in each row) is low: about twice `bound` of them, or all of fewer.

    Taking the least `bound` of these instead of all rows keeps what each task hands on small.
    """
    n = df.count()
    if n <= 2 * bound:
        return df
    return df.where(F.col(hashed) < F.lit(int(2 * bound / n * 2.0**64) - 2**63))


def labelled_sample(labels: DataFrame, key: str, columns: list[str], bound: int) -> DataFrame:
    """At most `bound` labelled rows, those with the least hash of the key; small enough to broadcast.

    Rows without key or label are left out. Of rows with one key, the one with the least labels counts.
    """
    known = labels.select(key, *columns).na.drop().groupBy(key).agg(
        F.min(F.struct(*columns)).alias("_label")
    ).select(key, *[F.col(f"_label.{c}").alias(c) for c in columns], F.xxhash64(key).alias("_hash"))
    return least_hashed(known, "_hash", bound).orderBy("_hash", key).limit(bound).drop("_hash")


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
