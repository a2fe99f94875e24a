"""Best-fit packing of tokenised documents into sequences, by rounds up a tree.

Each partition packs its own pieces by best fit and emits the sequences that are nearly full. The others travel
up a tree as items of their own, many partitions to a node, and are packed again until one node is left.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cinderlog.llm.common import Batches, mapped, per_worker
from cinderlog.session import freeze

CAPACITY = 1024
END = 2
#: Pieces that a task packs at once.
ITEMS = 50_000
#: A sequence with no more than this many free places is nearly full.
SLACK = 8
#: Nodes that meet in one node of the next round.
FAN_IN = 16
#: Underfull sequences that a node passes on: those with most room, the others are emitted as they are. Best fit
#: leaves at most one sequence of half the capacity or less in a node, so only few of them can ever be joined.
CARRY = 2_000

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
BINS = f"round int, node bigint, size bigint, done boolean, items array<struct<{PIECE.replace(' ', ':').replace(',:', ',')}>>"

END_OF_TEXT = "<|endoftext|>"


def tokenizer_of(folder: str | None = None) -> Callable[[str], list[int]]:
    """Token ids of a text in the vocabulary of byte_bpe_50k.json.

    The same vocabulary is read as ranks, which gives the same ids several times faster; only a text that holds
    the name of the special token goes to the tokenizers library. `folder` holds the files if they are not in
    their usual place.
    """
    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer

    def path(name: str) -> str:
        return f"{folder}/{name}" if folder else public.path(name)

    with open(path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    quick = tiktoken.Encoding("byte_bpe_50k", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_file(path("byte_bpe_50k.json"))

    def encode(text: str) -> list[int]:
        if END_OF_TEXT in text:
            return whole.encode(text, add_special_tokens=False).ids
        return quick.encode_ordinary(text)

    return encode


def pieces_of(ids: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids; only the first piece may be shorter than the capacity."""
    data = ids.astype("<u4").tobytes()
    first = len(ids) % capacity or min(capacity, len(ids))
    starts = [0, *range(first, len(ids), capacity)]
    return [
        (i, a, b - a, zlib.crc32(data[4 * a:4 * b]))
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True))
    ]


def best_fit(sizes: Iterable[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Positions of the sizes in each bin: the largest first, each into the fullest bin that has room."""
    sizes = np.fromiter(sizes, np.int64)
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set where some bin has exactly r free places
    for at in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[at])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            found = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[found].append(at)
        else:
            room, found = capacity, len(bins)
            bins.append([at])
        if room > size:
            by_room[room - size].append(found)
            rooms |= 1 << room - size
    return bins


def _pack(items: list[tuple[int, list]], capacity: int, slack: int, last: bool) -> list[tuple[int, bool, list]]:
    """(size, done, contents) of each sequence that the (size, contents) pairs are packed into."""
    packed = []
    for found in best_fit((size for size, _ in items), capacity):
        size = sum(items[i][0] for i in found)
        packed.append([size, last or capacity - size <= slack, [x for i in found for x in items[i][1]]])
    underfull = sorted((b for b in packed if not b[1]), key=lambda b: b[0])
    for b in underfull[CARRY:]:
        b[1] = True
    return packed


def _table(rows: list[tuple[int, int, int, bool, list]], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _bins_schema(key: pa.DataType) -> pa.Schema:
    item = pa.struct([("doc_id", key), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    return pa.schema([("round", pa.int32()), ("node", pa.int64()), ("size", pa.int64()), ("done", pa.bool_()), ("items", pa.list_(item))])


def _first_round(tokenizers: str | None, capacity: int, slack: int, end: int):
    """Task code: tokenise, cut and pack; a node is a run of up to ITEMS pieces of a partition."""
    def task(batches: Batches) -> Batches:
        encode = per_worker(f"encode {tokenizers}", lambda: tokenizer_of(tokenizers))
        waiting: list[tuple[int, list]] = []
        schema, run = None, 0

        def packed() -> pa.RecordBatch:
            return _table([(0, run, *b) for b in _pack(waiting, capacity, slack, False)], schema)

        for batch in batches:
            schema = schema or _bins_schema(batch.schema.field(0).type)
            full = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), end], np.uint32)
                for piece, start, length, crc in pieces_of(ids, capacity):
                    item = {"doc_id": doc_id, "piece": piece, "start": start, "length": length, "ids_crc32": crc}
                    if length == capacity:
                        full.append((0, run, length, True, [item]))
                    else:
                        waiting.append((length, [item]))
            yield _table(full, schema)
            if len(waiting) >= ITEMS:
                yield packed()
                waiting, run = [], run + 1
        if waiting:
            yield packed()

    return task


def _next_round(number: int, capacity: int, slack: int, last: bool):
    """Group code: pack the underfull sequences of one node, each as one item."""
    def pack(group: pa.Table) -> pa.Table:
        items = list(zip(group.column("size").to_pylist(), group.column("items").to_pylist(), strict=True))
        node = group.column("node")[0].as_py()
        rows = [(number, node, *b) for b in _pack(items, capacity, slack, last)]
        return pa.Table.from_batches([_table(rows, _bins_schema(group.schema.field("items").type.value_type.field(0).type))])

    return pack


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, slack: int = SLACK,
    tokenizers: str | None = None, end: int = END,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    A document is its token ids and then `end`; a null text is empty. Only documents over the capacity are cut.
    Repeated rows are packed as often as they come, a null key is kept, an empty table has no pieces.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = BINS.replace("doc_id:bigint", f"doc_id:{kind}")
    local = mapped(docs.select(F.col(key).alias("doc_id"), text), _first_round(tokenizers, capacity, slack, end), schema)
    # a node of the first round is a run within a partition
    local = local.withColumn("node", F.spark_partition_id().cast("bigint") * 1_000_000 + F.col("node"))
    rounds = [freeze(local, "bins")]
    while True:
        waiting = rounds[-1].where("NOT done")
        # the rank of each node among those that still have underfull sequences; one row per node
        nodes = [r["node"] for r in waiting.select("node").distinct().orderBy("node").collect()]
        if not nodes:
            break
        above = F.lit(0).cast("bigint")
        if len(nodes) > FAN_IN:
            ranks = docs.sparkSession.createDataFrame([(n, i // FAN_IN) for i, n in enumerate(nodes)], "node bigint, above bigint")
            grouped = waiting.join(ranks, "node").withColumn("node", F.col("above")).drop("above")
        else:
            grouped = waiting.withColumn("node", above)
        step = _next_round(len(rounds), capacity, slack, len(nodes) <= FAN_IN)
        rounds.append(freeze(grouped.groupBy("node").applyInArrow(step, schema), "bins"))
    done = rounds[0].where("done")
    for more in rounds[1:]:
        done = done.unionByName(more.where("done"))
    laid = done.withColumn("sequence_id", F.monotonically_increasing_id()).select(
        "sequence_id", F.posexplode("items").alias("at", "item"),
        F.transform("items", lambda x: x["length"]).alias("lengths"),
    )
    before = F.aggregate(F.slice("lengths", F.lit(1), F.col("at")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return laid.select(
        F.col("item.doc_id").alias(key), "item.piece", "item.start", "item.length", "item.ids_crc32", "sequence_id",
        before.alias("offset"),
    )
