"""Quarantine in generations: a replay takes out the records that are valid now and leaves the others, each exactly once.

A generation is the batches of the stream that came since the replay before, and what that one left. A replay writes the
valid records to the index and the rest as the next generation, both hidden, and then shows them: first the index, by the
record that decides, then the quarantine. A job that dies before the first has done nothing; one that dies between the two
is completed by the next replay, or by `recover`, which finds the note of the first in the index.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cinderlog.operators.binding import quarantine, replay, valid_events
from cinderlog.schema import EVENT_COLUMNS
from cinderlog.session import discard, freeze
from cinderlog.sinks.changes import Changes, batch_of
from cinderlog.sinks.index import write_change, write_batch_folder

_SEEN, _FIRST = "seen_at", "first_reason"


def _schema(keep: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("raw", T.StringType()), T.StructField("reason", T.StringType()), *keep.fields,
        T.StructField(_SEEN, T.TimestampType()), T.StructField(_FIRST, T.StringType()),
    ])


def read_quarantine(spark: SparkSession, path: str, keep: str = "") -> DataFrame:
    """What is in quarantine now: raw text, reason, the columns of `keep` (as DDL), the time it was seen first, and
    `first_reason`, why it was kept out at first if a replay has judged it since.
    """
    return _read(spark, path, Changes(spark, path).visible(), keep)


def _read(spark: SparkSession, path: str, parts: list[str], keep: str) -> DataFrame:
    schema = _schema(T.StructType.fromDDL(keep) if keep else T.StructType())
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{part}" for part in parts]).select(*schema.names)


def recover(spark: SparkSession, path: str, index_path: str) -> None:
    """Complete a replay whose events show in the index already, and undo one that did not get there."""
    made, index = Changes(spark, path), Changes(spark, index_path)
    for number, (note, covered) in made.planned().items():
        if index.noted(note):
            made.finish(number, covered)
    made.undo_unfinished()
    made.sweep()


def replay_out(
    spark: SparkSession, path: str, index_path: str, parser: Column | str = "json", keep: str = "", stopped: bool = False, **options
) -> tuple[int, int]:
    """Bind the records in quarantine again; valid ones go to the index, the rest stay. Returns how many did which.

    The stream may go on: its newest batch, which a restart may write again, is left for the next replay unless the stream
    has `stopped`. `keep` has the source columns of the quarantine, as DDL; those that the index knows go with the events,
    but for names of event columns, which the event has itself. Further options are those of `bind`. One replay of a
    quarantine and one change of the index are made at a time.
    """
    recover(spark, path, index_path)
    made, index = Changes(spark, path), Changes(spark, index_path)
    index.undo_unfinished()
    parts = made.visible()
    newest = max((batch_of(part) for part in parts), default=None)
    covered = [part for part in parts if stopped or batch_of(part) != newest or batch_of(part) < 0]
    if not covered:
        return 0, 0
    names = T.StructType.fromDDL(keep).names if keep else []
    rows = _read(spark, path, covered, keep).withColumn(_FIRST, F.coalesce(_FIRST, "reason")).drop("reason")
    judged = freeze(replay(rows, parser, *names, _SEEN, _FIRST, **options), "replay")
    number, note = made.begin(), uuid.uuid4().hex
    write_batch_folder(quarantine(judged, *names, _FIRST, seen_at=F.col(_SEEN)), path, -number)
    made.plan(number, covered, note)
    shown = index.begin()
    write_change(valid_events(judged, *(n for n in names if n not in EVENT_COLUMNS)), index_path, shown)
    index.finish(shown, [], note)
    made.finish(number, covered)
    told = judged.agg(F.count_if(F.col("reason").isNull()), F.count("reason")).first()
    discard(judged)
    made.sweep()
    index.sweep()
    return told[0], told[1]
