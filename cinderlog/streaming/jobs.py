"""Job entry points: lines to the index, a mapped stream, and windowed metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from cinderlog.operators.aggregate import metrics
from cinderlog.operators.binding import bind, quarantine, valid_events
from cinderlog.operators.bulk import sink_counters, split_oversize, with_documents
from cinderlog.operators.enrich import document_id
from cinderlog.schema import MAX_RECORD_BYTES
from cinderlog.session import setting
from cinderlog.sinks.bulk import Transport, send_bulk
from cinderlog.sinks.index import write_batch_folder, write_index_batch
from cinderlog.sinks.terms import update_terms

# Fixed value: a checkpoint every ten seconds; here that is the time between micro-batches.
TRIGGER = "10 seconds"
BatchSink = Callable[[DataFrame, int], None]


def started(writer: DataStreamWriter, trigger: str | None = TRIGGER) -> StreamingQuery:
    """Start a query on a processing-time trigger, or with None take what is there and stop.

    Errors of the query are not swallowed; they surface in `awaitTermination`.
    """
    timed = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return timed.start()


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Take what the source holds now, to the end."""
    query = started(writer, None)
    query.awaitTermination()
    return query


def run_log_stream(
    lines: DataFrame,
    index_path: str,
    quarantine_path: str,
    checkpoint: str,
    parser: Column | str = "json",
    keep: Sequence[str] = (),
    arrival: Column | None = None,
    sinks: Sequence[BatchSink] = (),
    trigger: str | None = TRIGGER,
    strict: bool = False,
    terms_path: str | None = None,
    repeats_within: str | None = None,
    state_partitions: int | None = None,
    **options,
) -> StreamingQuery:
    """Bind a stream of lines; write valid events to the index and the rest to quarantine.

    Each micro-batch is bound once and then feeds all sinks. Index and quarantine folders carry the
    batch number and are overwritten on a replay, so a restart neither loses nor repeats records.
    Further `sinks` get the events with the `keep` columns and must cope with a replay themselves.
    With `strict` the first invalid record stops the query before its batch is written.
    `terms_path` names a term index to keep up with the index. `repeats_within` is the time, by `arrival`, within which a
    record that comes again, as topics deliver at least once, is dropped; see `without_repeats`.
    Its state is kept in `state_partitions` parts, by default the session's shuffle partitions; a checkpoint holds to the
    number it began with. Each part commits files of its own in each batch, so that small batches want few parts.
    """
    bound = bind(lines, parser, arrival=arrival, **options)
    if repeats_within is not None:
        if arrival is None:
            raise ValueError("repeats_within needs the column of the arrival time")
        bound = without_repeats(bound, arrival, repeats_within)
    bound = bound.withColumn("_seen_at", F.current_timestamp())
    counted = bound.observe(
        "log_stream", F.count("*").alias("records"), F.count("reason").alias("quarantined")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        # the session of a stream with state does not plan adaptively, and would pass over hints to rebalance
        with setting(batch.sparkSession, "spark.sql.adaptive.enabled", "true"):
            write_all(batch, batch_id)

    def write_all(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            rejected = quarantine(batch, *keep, seen_at=F.col("_seen_at"))
            if strict:
                first = rejected.select("reason", "raw").first()
                if first is not None:
                    raise ValueError(f"invalid record ({first['reason']}): {first['raw']}")
            write_index_batch(valid_events(batch, *keep), index_path, batch_id)
            write_batch_folder(rejected, quarantine_path, batch_id)
            if terms_path is not None:
                update_terms(batch.sparkSession, index_path, terms_path)
            for sink in sinks:
                sink(valid_events(batch, *keep), batch_id)
        finally:
            batch.unpersist()

    spark, parts = lines.sparkSession, "spark.sql.shuffle.partitions"
    with setting(spark, parts, str(state_partitions or spark.conf.get(parts))):
        return started(counted.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), trigger)


def without_repeats(bound: DataFrame, arrival: Column, within: str, value: str = "value") -> DataFrame:
    """The first of the records with one document id that arrive within a time; the id is the log id, or a hash of the text.

    The state holds an id for each record of that time and no more: the watermark, by arrival, lets older ones go.
    """
    known = F.coalesce(F.col("event.log_id"), F.sha2(F.coalesce(value, F.lit("")), 256))
    marked = bound.withColumns({"_arrived": F.coalesce(arrival, F.current_timestamp()), "_document": known})
    return marked.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_document"]).drop("_arrived", "_document")


def bulk_sink(
    transport: Transport,
    counters_path: str,
    rejected_path: str,
    source: Sequence[str] = (),
    max_record_bytes: int = MAX_RECORD_BYTES,
    **options,
) -> BatchSink:
    """A sink of `run_log_stream` that sends events in bulk and keeps the counters of each batch.

    The document id is the log id, or a hash of the `source` columns; without either, replays of a
    batch may add copies. Documents above the record limit are kept under `rejected_path`.
    """
    def sink(events: DataFrame, batch_id: int) -> None:
        # the documents go to the sink and to the rejected ones, and are made once for both
        judged = split_oversize(with_documents(events), max_record_bytes).persist()
        try:
            send(judged, batch_id)
        finally:
            judged.unpersist()

    def send(judged: DataFrame, batch_id: int) -> None:
        doc_id = document_id(*source) if source else F.col("log_id")
        sent = send_bulk(
            judged.where(~F.col("is_oversize")), transport, doc_id=doc_id, max_record_bytes=max_record_bytes, **options
        )
        write_batch_folder(sink_counters(sent), counters_path, batch_id)
        rejected = judged.where("is_oversize").select(F.col("document").alias("raw"), F.lit("oversize").alias("reason"))
        write_batch_folder(rejected, rejected_path, batch_id)

    return sink


def console_sink(rows: int = 20) -> BatchSink:
    """Print some events of each micro-batch; for looking at a stream, not for use at scale."""
    return lambda events, batch_id: events.show(rows, truncate=False)


def run_map_stream(
    lines: DataFrame, mapped: Column, writer: Callable[[DataFrame], DataStreamWriter], trigger: str | None = TRIGGER
) -> StreamingQuery:
    """Replace `value` by an expression over it and pass the stream on, for example `upper`."""
    return started(writer(lines.withColumn("value", mapped)), trigger)


def file_writer(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append a stream to Parquet files, each row exactly once."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def metrics_stream(
    events: DataFrame, width: str = "1 hour", delay: str = "10 minutes", by: Sequence[str] = ("service",)
) -> DataFrame:
    """Metrics of closed windows. A window closes when the newest event is `delay` past its end; one that is still open
    is not given out. For a table that ends, take `aggregate.metrics` over the table.

    Events later than that are left out of the metrics, but they still reach the index.
    """
    return metrics(events.withWatermark("event_time", delay), width, by)


def whole_metrics_writer(
    events: DataFrame, path: str, checkpoint: str, width: str = "1 hour", by: Sequence[str] = ("service",)
) -> DataStreamWriter:
    """Write the metrics of all windows, open ones too, anew after each micro-batch: for a source that ends.

    The state has one row for each window and group, and none is ever dropped, so late events count as well.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return metrics(events, width, by).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)


class Counts(StreamingQueryListener):
    """Adds up the record counts that `run_log_stream` observes."""

    def __init__(self) -> None:
        self.records = 0
        self.quarantined = 0

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get("log_stream")
        if row is not None:
            self.records += row["records"]
            self.quarantined += row["quarantined"]

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...
