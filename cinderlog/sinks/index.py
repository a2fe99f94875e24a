"""The log index: Parquet in folders by event date, sorted by service and time within each file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from cinderlog.schema import EVENT_SCHEMA
from cinderlog.session import freeze
from cinderlog.sinks.changes import Changes, batch_of

FOLDER = "event_date"
# Where a record came from; columns that a source lacks are NULL.
SOURCE_SCHEMA = T.StructType([
    T.StructField("client_id", T.StringType()), T.StructField("file_path", T.StringType()), T.StructField("tag", T.StringType()),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
])
INDEX_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, *SOURCE_SCHEMA.fields, T.StructField(FOLDER, T.DateType())])


def with_folder(events: DataFrame) -> DataFrame:
    """Event columns, source columns and the folder column."""
    source = [
        (F.col(f.name) if f.name in events.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SOURCE_SCHEMA.fields
    ]
    return events.select(*EVENT_SCHEMA.names, *source, F.to_date("event_time").alias(FOLDER))


def _gathered(events: DataFrame) -> DataFrame:
    """Rows gathered per folder, so that a folder gets few files, and sorted for row group statistics.

    Adaptive execution splits the folder of a hot date over several tasks.
    """
    return with_folder(events).hint("rebalance", FOLDER).sortWithinPartitions(FOLDER, "client_id", "service", "event_time")


def write_index(events: DataFrame, path: str) -> None:
    """Append a table of events."""
    _gathered(events).write.partitionBy(FOLDER).mode("append").parquet(path)


def write_batch_folder(df: DataFrame, path: str, batch_id: int, *folders: str) -> None:
    """Write one micro-batch in folders of its own; a replay overwrites exactly those."""
    (
        df.withColumn("ingest_batch", F.lit(batch_id).cast("bigint"))
        .write.partitionBy(*folders, "ingest_batch").mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").parquet(path)
    )


def write_index_batch(events: DataFrame, path: str, batch_id: int) -> None:
    """Write the events of one micro-batch."""
    write_batch_folder(_gathered(events), path, batch_id, FOLDER)


def write_change(events: DataFrame, path: str, number: int) -> None:
    """Write events as the folders of a change, which are hidden until it is finished."""
    write_batch_folder(_gathered(events), path, -number, FOLDER)


def index_writer(events: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Stream events into the index with the file sink, each record exactly once."""
    return (
        with_folder(events).writeStream.format("parquet").partitionBy(FOLDER)
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index as a table; filters on event_date skip folders, filters on client or service skip row groups.

    Folders that a compaction or an expiry has replaced are passed over, see `changes`.
    """
    made = Changes(spark, path)
    return read_parts(spark, path, made.visible()) if made.open() else spark.read.schema(INDEX_SCHEMA).parquet(path)


def read_parts(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """Some folders or files of the index, named from the date folder on."""
    if not parts:
        return spark.createDataFrame([], INDEX_SCHEMA)
    return spark.read.schema(INDEX_SCHEMA).option("basePath", path).parquet(*[f"{path}/{part}" for part in parts])


def read_tenant(spark: SparkSession, path: str, client_id: str) -> DataFrame:
    """The index as one client sees it; files are sorted by client, so that the rest is mostly not read."""
    if not client_id:
        raise ValueError("a tenant's view needs its client id")
    return read_index(spark, path).where(F.col("client_id") == client_id)


def _by_date(children: Sequence[str]) -> dict[str, list[str]]:
    """Folders by date; rows without a time belong to none."""
    found: dict[str, list[str]] = {}
    for child in children:
        date = child.partition("/")[0].partition("=")[2]
        if date[:1].isdigit():
            found.setdefault(date, []).append(child)
    return found


def compact_index(spark: SparkSession, path: str, *dates: str, stopped: bool = False, sweep: bool = True) -> list[str]:
    """Put the small folders of closed dates, as a stream leaves them, together into few sorted files; returns the dates.

    Without dates, all but the newest are closed. The stream may go on: folders that come meanwhile stay as they are, and so
    does the newest batch, which a restart may write again; with `stopped` that one is taken too. A job that dies at any
    point leaves each row once, and the next call clears up after it. With `sweep=False` the replaced folders stay, hidden,
    for readers that have them open; `sweep` or the next compaction removes them.
    """
    made = Changes(spark, path)
    made.undo_unfinished()
    made.sweep()
    by_date = _by_date(made.visible())
    if any(batch_of(child) is None for children in by_date.values() for child in children):
        raise ValueError(f"{path} was not written in batches")
    newest = max((batch_of(child) for children in by_date.values() for child in children), default=None)
    chosen = {}
    for date in dates or sorted(by_date)[:-1]:
        own = [child for child in by_date.get(date, []) if stopped or batch_of(child) != newest]
        if len(own) > 1 or any(batch_of(child) >= 0 for child in own):  # else it is one compacted folder already
            chosen[date] = own
    if chosen:
        covered = [child for own in chosen.values() for child in own]
        number = made.begin()
        write_change(read_parts(spark, path, covered), path, number)
        made.finish(number, covered)
        if sweep:
            made.sweep()
    return list(chosen)


def sweep(spark: SparkSession, path: str) -> None:
    """Remove folders that a compaction has replaced."""
    Changes(spark, path).sweep()


def _dates_of(spark: SparkSession, path: str) -> list[str]:
    return sorted(_by_date(Changes(spark, path).visible()))


def _on(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    return df.where(F.col(FOLDER).isin([F.lit(d).cast("date") for d in dates]))


def archive(events: DataFrame, path: str, merge: bool = False) -> None:
    """Copy whole dates of events to long-term storage as few large files; running again replaces those dates.

    A date can only grow: if an archived row of it is not among the events, as when only late ones are given, nothing is
    written and the call fails. Arrival times don't count there, as records that are bound again get new ones. With `merge`
    those dates take up the events that they lack instead, by whole rows, so give it rows of an index, whose arrival times
    stay. A job that dies while it replaces a date is to be run again; the events are still there, as `expire` removes only
    what it finds archived.
    """
    spark, rows = events.sparkSession, with_folder(events)
    there = _dates_of(spark, path)
    both = []
    if there:
        both = sorted(str(r[0]) for r in _on(rows.select(FOLDER), there).distinct().collect())
    if both:
        archived, new = _on(read_index(spark, path).select(*INDEX_SCHEMA.names), both), _on(rows, both)
        if merge:
            grown = freeze(archived.unionAll(new.exceptAll(archived)), "archive")
            rows = rows.where(F.col(FOLDER).isNull() | ~F.col(FOLDER).isin([F.lit(d).cast("date") for d in both])).unionAll(grown)
        else:
            gone = archived.drop("ingestion_time").exceptAll(new.drop("ingestion_time"))
            lost = sorted(str(r[0]) for r in gone.select(FOLDER).distinct().collect())
            if lost:
                raise ValueError(f"archived rows of these dates are not among the events: {', '.join(lost)}")
    (
        _gathered(rows).write.partitionBy(FOLDER).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd").parquet(path)
    )


def date_proofs(rows: DataFrame) -> DataFrame:
    """For each date the number of its rows and a digest that does not depend on their order: sums of parts of their hashes."""
    columns = [F.unix_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
               for f in INDEX_SCHEMA.fields if f.name != FOLDER]
    hashed = rows.select(FOLDER, F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256).alias("_hash"))
    parts = [F.sum(F.conv(F.substr("_hash", F.lit(1 + 15 * i), F.lit(15)), 16, 10).cast("decimal(38,0)")) for i in range(4)]
    return hashed.groupBy(FOLDER).agg(F.count("*").alias("n"), F.concat_ws(":", *parts).alias("digest"))


def expire(spark: SparkSession, path: str, archive_path: str, before: str) -> DataFrame:
    """Remove the dates before `before` from the index, each only if all its rows are proven to be archived.

    Counts and digests are compared first, without a shuffle of rows; where they differ, the rows themselves are. Returns
    one row a date: event_date, n, n_missing (rows that the archive lacks) and expired. Rows that arrive meanwhile stay.
    """
    made = Changes(spark, path)
    made.undo_unfinished()
    by_date = {date: own for date, own in _by_date(made.visible()).items() if date < before}
    rows = read_parts(spark, path, [child for own in by_date.values() for child in own]).select(*INDEX_SCHEMA.names)
    kept = sorted(set(_dates_of(spark, archive_path)) & set(by_date))
    archived = _on(read_index(spark, archive_path).select(*INDEX_SCHEMA.names), kept) if kept else rows.limit(0)
    mine, theirs = ({str(r[0]): (r["n"], r["digest"]) for r in date_proofs(df).collect()} for df in (rows, archived))
    unequal = sorted(date for date in mine if mine[date] != theirs.get(date))
    missing = {}
    if unequal:
        lacking = _on(rows, unequal).exceptAll(_on(archived, unequal)).groupBy(FOLDER).count()
        missing = {str(r[0]): r["count"] for r in lacking.collect()}
    gone = [date for date in mine if not missing.get(date)]
    if gone:
        made.finish(made.begin(), [child for date in gone for child in by_date[date]])
        made.sweep()
    told = [(date, n, missing.get(date, 0), date in gone) for date, (n, _) in sorted(mine.items())]
    schema = f"{FOLDER} string, n bigint, n_missing bigint, expired boolean"
    return spark.createDataFrame(told, schema).withColumn(FOLDER, F.col(FOLDER).cast("date"))


def write_by_source(df: DataFrame, path: str, tag: str = "tag") -> None:
    """Append rows in one folder per source tag; a tag with many rows is split over several tasks."""
    df.hint("rebalance", tag).write.partitionBy(tag).mode("append").parquet(path)
