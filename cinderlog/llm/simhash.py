"""SimHash near-duplicates: fingerprints linked by a generalised pigeonhole search.

Two 64-bit fingerprints within `distance` bits differ, in at least one of m disjoint groups of bits, by no more
than that group's threshold, as long as the thresholds sum to distance - m + 1 (a threshold of -1 leaves a
group out). Bits that go together are put into one group, m and the thresholds are chosen by dynamic
programming on candidate counts estimated from all fingerprints, and each candidate is verified on all bits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cinderlog.llm.common import Batches, mapped, raw, unused
from cinderlog.llm.graph import connected_components
from cinderlog.session import freeze

BITS = 64
SEED = 42
SHINGLE = 4
DISTANCE = 4

#: Fingerprints of one bucket that a task compares at once; a larger bucket is cut into blocks of this size.
BLOCK = 20_000
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16
#: What it costs to send one probe, against comparing one pair.
PROBE_COST = 200.0


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The SimHash of the word shingles, repeats included, as a signed 64-bit number; 0 without words.

    A-Z count as a-z. A bit is set if more than half of the shingles' XXH64 values have it.
    """
    words = raw(text or "").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= size:
        return int.from_bytes(digest(joined, SEED), "big", signed=True)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    n = len(words) - size + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        some = b"".join([
            digest(joined[a:b - 1], SEED)
            for a, b in zip(starts[at:min(n, at + CHUNK)], starts[at + size:], strict=False)
        ])
        counts += np.unpackbits(np.frombuffer(some, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns `keep` and fp of each document; a null text has fingerprint 0."""
    kept = docs.select(*keep, F.col(text).alias("_text"))
    schema = StructType([*kept.schema.fields[:-1], StructField("fp", LongType())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            found = [fingerprint(t) for t in batch.columns[-1].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names=schema.names)

    return mapped(kept, task, schema)


@dataclass(frozen=True)
class Plan:
    """Groups of bits as masks, each with its threshold."""

    masks: tuple[int, ...]
    radii: tuple[int, ...]


def pair_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Over all fingerprints: how many, and for each two bits (from the highest) how many have both set."""
    def task(batches: Batches) -> Batches:
        total, gram = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(">i8")
            for at in range(0, len(values), CHUNK):
                some = values[at:at + CHUNK]
                bits = np.unpackbits(np.frombuffer(some.tobytes(), np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
                gram += bits.T @ bits
                total += len(some)
        cells = np.append(gram.ravel(), total).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells)], names=["cell", "n"])

    cells = np.zeros(BITS * BITS + 1)
    # one row for each two bits, whatever the number of fingerprints
    for row in mapped(nodes.select("fp"), task, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        cells[row["cell"]] = row["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def bit_groups(total: int, gram: np.ndarray, m: int) -> list[list[int]]:
    """m groups of near equal size; bits that are set together go together."""
    share = np.diag(gram) / max(1, total)
    spread = np.sqrt(np.clip(share * (1 - share), 1e-9, None))
    tie = np.abs(gram / max(1, total) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(tie, 0)
    free, groups = list(range(BITS)), []
    for size in [BITS // m + (i < BITS % m) for i in range(m)]:
        group = [max(free, key=lambda b: (tie[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda b: (tie[b, group].sum(), -b)))
            free.remove(group[-1])
        groups.append(group)
    return groups


def within(differ: np.ndarray, most: int) -> np.ndarray:
    """The chance that at most 0..most bits differ, if bit b does with chance differ[b]."""
    chance = np.zeros(most + 1)
    chance[0] = 1
    for p in differ:
        chance[1:] = chance[1:] * (1 - p) + chance[:-1] * p
        chance[0] *= 1 - p
    return np.cumsum(chance)


def allocate(costs: list[list[float]], distance: int) -> tuple[float, tuple[int, ...]]:
    """The thresholds of least cost that sum to distance - m + 1; costs[i][t + 1] is that of threshold t for group i."""
    best = {0: (0.0, ())}
    for group in costs:
        following: dict[int, tuple[float, tuple[int, ...]]] = {}
        for spent, (cost, radii) in best.items():
            for t in range(-1, distance + 1):
                option = (cost + group[t + 1], (*radii, t))
                if option < following.get(spent + t, (math.inf, ())):
                    following[spent + t] = option
        best = following
    return best[distance - len(costs) + 1]


def _costs(total: int, width: int, pairs: np.ndarray, distance: int) -> list[float]:
    """Of each threshold from -1: the probes to send and the pairs to compare."""
    probes = np.cumsum([math.comb(width, r) for r in range(distance + 1)])
    return [0.0, *(PROBE_COST * max(1, total) * probes + pairs)]


def make_plan(nodes: DataFrame, distance: int = DISTANCE) -> Plan:
    """Choose groups and thresholds from statistics of all fingerprints."""
    total, gram = pair_counts(nodes)
    share = np.diag(gram) / max(1, total)
    differ = 2 * share * (1 - share)
    guess, options = total * total / 2, []
    for m in range(2, distance + 2):
        groups = bit_groups(total, gram, m)
        costs = [_costs(total, len(g), guess * within(differ[g], distance), distance) for g in groups]
        options.append((allocate(costs, distance)[0], m, groups))
    _, m, groups = min(options)
    masks = [sum(1 << (BITS - 1 - b) for b in g) for g in groups]
    # the pairs that agree on a group are counted, not guessed, before the thresholds are set
    keys = nodes.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(x))) for x in masks])))
    agree = dict(keys.groupBy("pos", "col").count().groupBy("pos").agg(
        F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2)
    ).collect())
    costs = []
    for i, g in enumerate(groups):
        chance = within(differ[g], distance)
        costs.append(_costs(total, len(g), agree.get(i, 0.0) + guess * (chance - chance[0]), distance))
    return Plan(tuple(masks), allocate(costs, distance)[1])


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _flips(mask: int, radius: int) -> list[int]:
    bits = [1 << b for b in range(BITS) if mask >> b & 1]
    return [sum(some) for r in range(radius + 1) for some in combinations(bits, r)]


def stars(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join all of `values` (different uint64) that are joined by steps of at most `distance` bits.

    A found value is never compared again, so a group of near copies takes few rounds and gives a link for each.
    """
    if len(values) <= 64:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
        if np.count_nonzero(near) == len(values):
            return []
    links, rest = [], np.sort(values)
    while len(rest):
        root, rest = rest[0], rest[1:]
        reached = [root]
        while reached and len(rest):
            near = np.bitwise_count(rest ^ reached.pop()) <= distance
            if near.any():
                found = rest[near]
                links += [(int(root), int(x)) for x in found]
                reached += list(found)
                rest = rest[~near]
    return links


def _link_buckets(distance: int):
    """Task code: rows (pos, key, low, high, fp, home), a bucket's rows in a run, to links (a, b)."""
    def linked(keys: np.ndarray, values: np.ndarray, home: np.ndarray) -> list[tuple[int, int]]:
        edges = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        links = []
        for a, b in zip([0, *edges], [*edges, len(keys)], strict=True):
            if b - a > 1 and home[a:b].any():
                links += stars(values[a:b], distance)
        return links

    def batch_of(links) -> pa.RecordBatch:
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def task(batches: Batches) -> Batches:
        held: list[tuple] = []  # the last bucket so far, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys, values, home = np.stack(columns[:4], 1), columns[4].view(np.uint64), columns[5].astype(bool)
            last = int(np.flatnonzero(np.any(keys != keys[-1], axis=1)).max(initial=-1)) + 1
            if held and (last or np.any(held[-1][0][-1] != keys[0])):
                cut = int(np.argmax(np.append(np.any(keys != held[-1][0][-1], axis=1), True)))
                held.append((keys[:cut], values[:cut], home[:cut]))
                yield batch_of(linked(*(np.concatenate(x) for x in zip(*held, strict=True))))
                held = []
                if cut < last:
                    yield batch_of(linked(keys[cut:last], values[cut:last], home[cut:last]))
            elif last:
                yield batch_of(linked(keys[:last], values[:last], home[:last]))
            held.append((keys[last:], values[last:], home[last:]))
        if held:
            yield batch_of(linked(*(np.concatenate(x) for x in zip(*held, strict=True))))

    return task


def links(nodes: DataFrame, plan: Plan, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join every two fingerprints of `nodes` within `distance` bits, directly or by others.

    Each fingerprint goes to its own bucket of every group and to those within the group's threshold. A bucket
    over `block` is cut into blocks, and each two of its blocks meet in one task.
    """
    probes = [
        F.struct(
            F.lit(i).alias("pos"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).bitwiseXOR(F.lit(_signed(flip))).alias("key"),
            F.lit(flip == 0).alias("home"),
        )
        for i, (mask, radius) in enumerate(zip(plan.masks, plan.radii, strict=True)) for flip in _flips(mask, radius)
    ]
    sent = nodes.select("fp", F.explode(F.array(*probes)).alias("p")).select("p.pos", "p.key", "fp", "p.home")
    large = sent.groupBy("pos", "key").count().where(F.col("count") > block).select(
        "pos", "key", F.ceil(F.col("count") / block).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = sent.join(large, ["pos", "key"], "left").fillna(1, ["blocks"]).withColumn("own", own).select(
        "pos", "key", "fp", "home", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        F.col("pos").cast("bigint"), "key", F.least("own", "other").cast("bigint").alias("low"),
        F.greatest("own", "other").cast("bigint").alias("high"), "fp", "home",
    )
    bucket = ["pos", "key", "low", "high"]
    return mapped(
        met.repartition(*bucket).sortWithinPartitions(*bucket), _link_buckets(distance), "a bigint, b bigint"
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row per document: key, fingerprint (16 hex digits) and component_id.

    component_id is the least key among all documents reachable by steps of at most `distance` bits, the document
    itself included; null keys count for nothing there, and a component without any key has a null component_id.
    Documents without words all have fingerprint zero. Repeated rows each get their row.
    """
    prints = freeze(fingerprints(docs, [F.col(key).alias("id")], text), "fingerprints")
    classes = freeze(components(prints, distance), "classes")
    return prints.join(classes, "fp").select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, component_id) of each different fingerprint of the table `prints`, which has id and fp."""
    nodes = freeze(prints.groupBy("fp").agg(F.min("id").alias("_least")), "nodes")
    found = freeze(links(nodes, make_plan(nodes, distance), distance), "near")
    labels = connected_components(found, "a", "b").withColumnRenamed("node", "fp")
    labelled = nodes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = labelled.groupBy("label").agg(F.min("_least").alias("component_id"))
    return labelled.join(least, "label").select("fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One document of each component, with all its columns: one with the least key, nulls last.

    The documents are written once with a number for each row, so that the choice holds for repeated rows too.
    """
    row = unused(docs, "row")
    numbered = freeze(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    kept = [F.col(row).alias("id"), F.col(key).alias("key")]
    prints = freeze(fingerprints(numbered, kept, text), "fingerprints")
    chosen = (
        prints.join(components(prints, distance), "fp")
        .groupBy("component_id")
        .agg(F.min(F.struct(F.col("key").isNull(), "key", "id")).alias("first"))
        .select(F.col("first.id").alias(row))
    )
    return numbered.join(chosen, row, "left_semi").drop(row)
