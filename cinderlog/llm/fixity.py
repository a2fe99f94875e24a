"""Fixity audits of web archives by Merkle trees.

Each replica's records are hashed, the hashes of an ordered range of offsets make a leaf node, and nodes of
neighbouring ranges make the level above, up to a root for each volume. Two replicas are compared from the
roots; only below nodes that differ are the children read, down to the records.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.llm.common import Batches, mapped
from cinderlog.session import freeze

#: Bytes of a leaf node's range; a record belongs to the range in which it starts.
RANGE_BYTES = 1 << 20
#: Ranges that make one node of the level above.
FAN_OUT = 16
#: Bytes after which a new volume starts.
VOLUME_BYTES = 1 << 30
#: Levels of a tree; the highest has one node for each 4 GiB of a volume, which is its root.
LEVELS = 4

LEAF = ["volume", "offset", "record_id", "length", "digest"]


def warc_record(url: str, payload: str) -> str:
    """SQL: a WARC/1.1 resource record with the payload as its block; nulls are empty."""
    url, payload = f"coalesce({url}, '')", f"coalesce({payload}, '')"
    return (
        f"concat('WARC/1.1\\r\\nWARC-Type: resource\\r\\nWARC-Target-URI: ', {url}, "
        f"'\\r\\nContent-Type: text/html\\r\\nContent-Length: ', octet_length({payload}), '\\r\\n\\r\\n', {payload}, '\\r\\n\\r\\n')"
    )


def archive(df: DataFrame, key: str, record: Column) -> DataFrame:
    """Records one after another: (volume, offset, record_id, record), no shuffle.

    A volume holds a run of rows of one partition; offsets count bytes. Rows keep the order in which they are read,
    so repeated rows and null keys are records like any other.
    """
    rows = df.select(F.col(key).alias("record_id"), record.alias("record"))
    kind = rows.schema["record_id"].dataType.simpleString()

    def task(batches: Batches) -> Batches:
        volume, offset = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            volumes, offsets = [], []
            lengths = pa.compute.binary_length(batch.column(1)).to_pylist()
            for length in lengths:
                if offset >= VOLUME_BYTES:
                    volume, offset = volume + 1, 0
                volumes.append(volume)
                offsets.append(offset)
                offset += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(volumes, pa.int64()), pa.array(offsets, pa.int64()), *batch.columns],
                names=["volume", "offset", "record_id", "record"],
            )

    return mapped(rows, task, f"volume bigint, offset bigint, record_id {kind}, record string")


@dataclass(frozen=True)
class Tree:
    """Hashes of a replica's records, and the nodes of each level from the ranges up."""

    records: DataFrame
    levels: tuple[DataFrame, ...]


def _text(*columns: str) -> str:
    return "concat_ws(':', " + ", ".join(f"coalesce(CAST(x.{c} AS STRING), '')" for c in columns) + ")"


def _node(members: str, *columns: str) -> str:
    """SQL: the hash of a node over its members in order; a range bounds how many there are."""
    return f"sha2(array_join(transform(array_sort({members}), x -> {_text(*columns)}), ','), 256) AS digest"


def build_tree(replica: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> Tree:
    """Hash a replica given as (volume, offset, record_id, record) and build its tree, in the shared folder."""
    records = freeze(replica.select(
        "volume", "offset", "record_id", F.expr("CAST(octet_length(record) AS BIGINT)").alias("length"),
        F.expr("sha2(encode(record, 'UTF-8'), 256)").alias("digest"),
    ), "records")
    nodes = freeze(records.groupBy("volume", F.expr(f"offset DIV {range_bytes}L").alias("range")).agg(
        F.collect_list(F.struct("offset", "length", "digest")).alias("members")
    ).selectExpr("volume", "range", _node("members", "offset", "length", "digest")), "ranges")
    levels = [nodes]
    for _ in range(LEVELS - 1):
        levels.append(freeze(levels[-1].groupBy("volume", F.expr(f"range DIV {fan_out}L").alias("above")).agg(
            F.collect_list(F.struct("range", "digest")).alias("members")
        ).selectExpr("volume", "above AS range", _node("members", "range", "digest")), "ranges"))
    return Tree(records, tuple(levels))


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(volume, range) of the nodes that only one side has or that differ."""
    left, right = a.withColumnRenamed("digest", "da"), b.withColumnRenamed("digest", "db")
    return left.join(right, ["volume", "range"], "full").where("NOT (da <=> db)").select("volume", "range")


def _below(nodes: DataFrame, bad: DataFrame, above: str) -> DataFrame:
    keyed = bad.select("volume", F.col("range").alias("_above"))
    return nodes.withColumn("_above", F.expr(above)).join(keyed, ["volume", "_above"], "left_semi").drop("_above")


def audit(a: Tree, b: Tree, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """The records that differ: volume, offset, record_id, status, and length and digest on each side.

    status is `changed`, `missing` (only the first replica has a record there) or `extra` (only the second has).
    Equal replicas, empty ones too, give no rows. Both trees need the same range_bytes and fan_out.
    """
    bad = _differing(a.levels[-1], b.levels[-1])
    for i in range(LEVELS - 2, -1, -1):
        above = f"range DIV {fan_out}L"
        bad = _differing(_below(a.levels[i], bad, above), _below(b.levels[i], bad, above))
    inside = f"offset DIV {range_bytes}L"
    sides = [
        _below(t.records, bad, inside).select(
            "volume", "offset", *[F.col(c).alias(f"{c}_{side}") for c in ("record_id", "length", "digest")],
            F.lit(True).alias(f"there_{side}"),
        )
        for t, side in ((a, "a"), (b, "b"))
    ]
    return sides[0].join(sides[1], ["volume", "offset"], "full").where(
        "NOT (digest_a <=> digest_b AND length_a <=> length_b)"
    ).selectExpr(
        "volume", "offset", "CASE WHEN there_a THEN record_id_a ELSE record_id_b END AS record_id",
        "CASE WHEN there_b IS NULL THEN 'missing' WHEN there_a IS NULL THEN 'extra' ELSE 'changed' END AS status",
        "length_a", "length_b", "digest_a", "digest_b",
    )
