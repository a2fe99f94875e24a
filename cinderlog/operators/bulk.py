"""Bulk index requests: actions, batches and counters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.functions import records
from cinderlog.schema import INDEX_NAME, MAX_BATCH_BYTES, MAX_BATCH_RECORDS, MAX_RECORD_BYTES


def with_documents(events: DataFrame, time_form: str = "epoch") -> DataFrame:
    """Add `document` (JSON text of the event) and `bytes`, its size."""
    document = records.to_document(records.event_document(time_form))
    return events.selectExpr("*", f"{document} AS document").selectExpr(
        "*", f"{records.document_size('document')} AS bytes"
    )


def action_line(index: str = INDEX_NAME, doc_id: Column | None = None) -> Column:
    """The line that goes before a document. Without an id the index makes one up."""
    target = [F.lit(index).alias("_index")] + ([] if doc_id is None else [doc_id.alias("_id")])
    return F.to_json(F.struct(F.struct(*target).alias("index")))


def action_rows(documents: DataFrame, index: str = INDEX_NAME, doc_id: Column | None = None) -> DataFrame:
    """Two rows per document: the action (seq 0) and the document (seq 1)."""
    pair = F.array(action_line(index, doc_id), F.col("document"))
    return documents.select("log_id", F.posexplode(pair).alias("seq", "line")).withColumn("seq", F.col("seq").cast("bigint"))


def action_text(index: str = INDEX_NAME, doc_id: Column | None = None) -> Column:
    """Action and document as one value of two lines, which no sort or shuffle can part."""
    return F.concat(action_line(index, doc_id), F.lit("\n"), F.col("document"))


def split_oversize(documents: DataFrame, limit: int = MAX_RECORD_BYTES) -> DataFrame:
    """Add `is_oversize`."""
    return documents.withColumn("is_oversize", F.col("bytes") > limit)


def batches_by_count(df: DataFrame, size: int = MAX_BATCH_RECORDS) -> DataFrame:
    """Add `lane` and `batch_no`: every `size` rows of a partition in arrival order, as each writer task has them."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the low bits count within a partition
    return df.withColumns({"lane": F.spark_partition_id(), "_place": place}).selectExpr(
        "*", f"_place div {size} AS batch_no"
    ).drop("_place")


def cut_batches(sizes: np.ndarray, count: int, used: int, max_count: int, max_bytes: int) -> tuple[np.ndarray, int, int]:
    """Batch steps for one run of records, going on from a batch with `count` records of `used` bytes.

    A batch closes when one more record would break either limit. Returns the number of batches
    opened before each record, and the state of the last one.
    """
    ends = np.cumsum(sizes, dtype=np.int64)
    steps = np.empty(len(sizes), dtype=np.int64)
    at, step = 0, 0
    while at < len(sizes):
        done = int(ends[at - 1]) if at else 0
        stop = min(int(np.searchsorted(ends, done + max_bytes - used, side="right")), at + max_count - count)
        if stop <= at and count == 0:
            stop = at + 1  # one record above the byte limit still goes alone
        stop = max(min(stop, len(sizes)), at)
        steps[at:stop] = step
        count += stop - at
        used += (int(ends[stop - 1]) if stop else 0) - done
        at = stop
        if at < len(sizes):
            step, count, used = step + 1, 0, 0
    return steps, count, used


def batches_by_size(
    documents: DataFrame, max_records: int = MAX_BATCH_RECORDS, max_bytes: int = MAX_BATCH_BYTES
) -> DataFrame:
    """Add `lane` and `batch_no`: batches in arrival order, closed by count or bytes.

    Each partition is one lane with batches of its own, as each writer task has; nothing is
    shuffled, and a task holds one Arrow batch at a time.
    """
    schema = documents.withColumns({"lane": F.lit(0), "batch_no": F.lit(0).cast("bigint")}).schema
    laned = documents.withColumn("lane", F.spark_partition_id())

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count, used = 0, 0, 0
        for part in parts:
            if part.num_rows == 0:
                continue
            sizes = part.column("bytes").to_numpy(zero_copy_only=False).astype(np.int64)
            steps, count, used = cut_batches(sizes, count, used, max_records, max_bytes)
            numbers = base + steps
            base = int(numbers[-1])
            yield part.append_column(pa.field("batch_no", pa.int64()), pa.array(numbers))

    return laned.mapInArrow(assign, schema)


def sink_counters(sent_requests: DataFrame) -> DataFrame:
    """Requests submitted, records with errors, and records the index refused one by one.

    Records of a request that failed as a whole count as errors but not as partial failures.
    """
    partly = F.when(F.col("whole_request"), 0).otherwise(F.col("failed"))
    return sent_requests.agg(
        F.count("*").cast("bigint").alias("submitted"),
        F.coalesce(F.sum("failed"), F.lit(0)).cast("bigint").alias("out_errors"),
        F.coalesce(F.sum(partly), F.lit(0)).cast("bigint").alias("partial_failures"),
    )
