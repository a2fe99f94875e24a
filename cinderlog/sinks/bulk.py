"""Bulk sink: batched requests with retries, over any transport, or request bodies as files."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.operators.bulk import action_text, cut_batches
from cinderlog.schema import INDEX_NAME, MAX_BATCH_BYTES, MAX_BATCH_RECORDS, MAX_RECORD_BYTES

# Takes the entries (action and document, two lines each) and the attempt number; gives one error
# text or None per entry. Raising means that the request failed as a whole.
Transport = Callable[[list[str], int], list[str | None]]

REQUESTS_SCHEMA = "lane int, batch_no bigint, attempt bigint, records bigint, failed bigint, whole_request boolean"
MAX_ATTEMPTS = 5
WAIT_SECONDS = 0.5


class IndexUnreachable(Exception):
    """No connection to the index: not retried, the job stops."""


class RecordTooLarge(Exception):
    """A record above the size limit got as far as the sink."""


class RetriesExhausted(Exception):
    """Some records still failed after the last attempt."""


def is_fatal(error: BaseException) -> bool:
    """Whether the index cannot be reached at all, as opposed to a request that failed."""
    return isinstance(error, (ConnectionRefusedError, ConnectionAbortedError, IndexUnreachable)) or (
        isinstance(error, OSError) and "no route to host" in str(error).lower()
    )


def send_batch(
    entries: list[str], transport: Transport, max_attempts: int, wait_seconds: float = WAIT_SECONDS
) -> Iterator[tuple[int, int, int, bool]]:
    """Send one batch; gives (attempt, records, failed, whole request failed) for each request.

    Before another attempt it waits, twice as long each time.
    """
    pending = entries
    for attempt in range(1, max_attempts + 1):
        if attempt > 1:
            time.sleep(wait_seconds * 2 ** (attempt - 2))
        try:
            errors = transport(pending, attempt)
        except Exception as error:
            if is_fatal(error):
                raise IndexUnreachable(str(error)) from error
            yield attempt, len(pending), len(pending), True
            continue
        failed = [entry for entry, problem in zip(pending, errors, strict=True) if problem is not None]
        yield attempt, len(pending), len(failed), False
        if not failed:
            return
        pending = failed
    raise RetriesExhausted(f"{len(pending)} records failed {max_attempts} times")


def send_bulk(
    documents: DataFrame,
    transport: Transport,
    index: str = INDEX_NAME,
    doc_id: Column | None = None,
    max_records: int = MAX_BATCH_RECORDS,
    max_bytes: int = MAX_BATCH_BYTES,
    max_record_bytes: int = MAX_RECORD_BYTES,
    max_attempts: int = MAX_ATTEMPTS,
    wait_seconds: float = WAIT_SECONDS,
) -> DataFrame:
    """Send `document` of every row; gives one row per request.

    Each partition is sent by its own task, one batch at a time, so a task holds one batch and the
    number of running tasks bounds the requests in flight. Sending happens when the result is used.
    With a `doc_id`, a task that runs again replaces its documents instead of adding copies.
    """
    lanes = documents.select(
        F.spark_partition_id().alias("lane"), F.octet_length("document").alias("bytes"),
        action_text(index, doc_id).alias("entry"),
    )

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, used, number, lane = [], 0, 0, None

        def flush() -> pa.RecordBatch:
            rows = list(send_batch(batch, transport, max_attempts, wait_seconds))
            attempt, records, failed, whole = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lane] * len(rows), pa.int32()), pa.array([number] * len(rows), pa.int64()),
                    pa.array(attempt, pa.int64()), pa.array(records, pa.int64()),
                    pa.array(failed, pa.int64()), pa.array(whole, pa.bool_()),
                ],
                names=["lane", "batch_no", "attempt", "records", "failed", "whole_request"],
            )

        for part in parts:
            if not part.num_rows:
                continue
            lane, sizes = part.column("lane")[0].as_py(), part.column("bytes").to_numpy().astype(np.int64)
            if sizes.max() > max_record_bytes:
                raise RecordTooLarge(f"{sizes.max()} bytes, limit {max_record_bytes}")
            steps, _, used = cut_batches(sizes, len(batch), used, max_records, max_bytes)
            for step in range(int(steps[-1]) + 1):
                if step:
                    yield flush()
                    batch, number = [], number + 1
                first, last = np.searchsorted(steps, [step, step + 1]).tolist()
                batch += part.column("entry").slice(first, last - first).to_pylist()
        if batch:
            yield flush()

    return lanes.mapInArrow(send, REQUESTS_SCHEMA)


def write_bulk_files(documents: DataFrame, path: str, index: str = INDEX_NAME, doc_id: Column | None = None) -> None:
    """Write request bodies as text files: an action line, then its document line."""
    documents.select(action_text(index, doc_id).alias("value")).write.mode("append").text(path)
