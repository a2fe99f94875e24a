"""Near copies by the exact similarity of their word shingles.

SimHash fingerprints of the shingles, found by the generalised pigeonhole search, make the first candidates, which join
most copies at little cost. No distance of fingerprints holds all pairs, though: at a similarity of 0.8 they differ in a
dozen bits and more. The rest is found by prefixes: two sets whose Jaccard similarity is at least LEAST share a shingle
among the first n - ceil(LEAST n) + 1 of each, n being the set's size and the order any one that holds for all sets.
Documents therefore meet in a bucket for each shingle of that prefix, at first those next to each other by size, then
those farther apart, and only while they are not joined already.

One shared shingle is little, and the pairs that have one by chance grow with the square of the documents. Alike sets of
about one size share nearly half of their prefixes, though, so the meetings of a pair are counted over all buckets and
rounds, and only a pair with as many as alike sets have at least is a candidate. A pair whose count is too low in an early
round may be one in a later; the last round has met all. Every candidate is verified on whole sets, so no pair is missed
and none is taken on trust. Equal sets are one node, known by a 64-bit hash.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from cinderlog.llm import simhash
from cinderlog.llm.common import Batches, least_hashed, mapped, raw, unused
from cinderlog.llm.graph import connected_components
from cinderlog.session import discard, freeze

SEED = 42
SIZE = 5
#: The least similarity of near copies, as a fraction.
LEAST = (4, 5)

#: Sets whose shingles are counted, to put the common ones last in the order; it changes the work, not the result.
SAMPLE = 5_000
COMMON = 50_000
COMMON_SETS = 3
#: Sets whose prefix a task has sent lately and does not send again.
RECENT = 100_000
#: Shingles of a prefix beyond those that hold one of every alike set, so that sets of unlike sizes must share several too.
MORE = 2
#: Bits of a sketch.
WIDTH = 512
#: How far apart in a bucket, in the order of sizes, sets meet in each round; the last round has no limit.
ROUNDS = ((1, 1), (2, 8), (9, None))
#: Sets of a bucket that one task holds; a larger bucket is cut into blocks of this size, which meet two by two.
BLOCK = 8_000
#: Rows of buckets that meet in one query, until that would take more than SLICES of them; what a query moves is gone with it.
SLICE = 4_000_000
SLICES = 8


def shingles(text: str | None, size: int = SIZE) -> np.ndarray:
    """The different XXH64 values of the word shingles, in order; a shorter text is one shingle. A-Z count as a-z."""
    words = raw(text or "").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    ends = starts[min(size, len(words)):]
    digest = xxhash.xxh64_digest
    found = b"".join([digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends, strict=False)])
    return np.unique(np.frombuffer(found, ">u8").astype(np.uint64))


def extent(n: np.ndarray | int) -> np.ndarray:
    """The length of the prefix of a set of n shingles."""
    return np.minimum(n, n + LEAST[0] * -n // LEAST[1] + 1 + MORE)


def needed(n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray:
    """How many shingles the prefixes of alike sets of n and m shingles share at least.

    Of the set whose prefix ends first in the order, only shingles behind it can be shared without being in both prefixes.
    """
    both = -(-LEAST[0] * (n + m) // sum(LEAST))
    return np.maximum(1, both - np.maximum(n - extent(n), m - extent(m)))


def prefix(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The shingles by which a set is found: those not in `common` (sorted) come first, each part by hash."""
    k = extent(len(hashes))
    if not len(common):
        return hashes[:k]
    often = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
    return np.concatenate([hashes[~often], hashes[often]])[:k]


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the similarity of two sets of different values is at least LEAST."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return LEAST[1] * both >= LEAST[0] * (len(a) + len(b) - both)


def with_sets(docs: DataFrame, text: str, names: tuple[str, str, str, str]) -> DataFrame:
    """`docs` with a hash of each document's shingle set, the set's size, its sketch and the text's fingerprint."""
    kinds = (LongType(), IntegerType(), BinaryType(), LongType())
    schema = StructType([*docs.schema.fields, *map(StructField, names, kinds)])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            sets = [shingles(t) for t in texts]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            sizes = pa.array([len(s) for s in sets], pa.int32())
            bits = pa.array([sketch(s) for s in sets], pa.binary())
            prints = pa.array([simhash.fingerprint(t, SIZE) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes), sizes, bits, prints], names=schema.names)

    return mapped(docs, task, schema)


def common_shingles(sets: DataFrame) -> np.ndarray:
    """Shingles of several of a bounded sample of `sets` (node, text), the most common of them, sorted."""
    def task(batches: Batches) -> Batches:
        for batch in batches:
            found = [shingles(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))], ["h"])

    some = least_hashed(sets, "node", SAMPLE).dropDuplicates(["node"]).select("text")
    counts = mapped(some, task, "h bigint").groupBy("h").count().where(F.col("count") >= COMMON_SETS)
    found = [r["h"] for r in counts.orderBy(F.desc("count"), "h").limit(COMMON).collect()]
    return np.sort(np.array(found, np.int64).view(np.uint64))


def buckets(sets: DataFrame, common: np.ndarray) -> DataFrame:
    """(h, n, node): a row for each shingle of each set's prefix, if another set has it in its own."""
    def sent(batches: Batches) -> Batches:
        recent: set[int] = set()
        for batch in batches:
            hashes, sizes, nodes = [np.zeros(0, np.uint64)], [0], [0]
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node in recent:
                    continue
                if len(recent) >= RECENT:
                    recent.clear()
                recent.add(node)
                own = shingles(text)
                hashes.append(prefix(own, common))
                sizes.append(len(own))
                nodes.append(node)
            times = [len(x) for x in hashes]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.repeat(np.array(sizes, np.int32), times)),
                pa.array(np.repeat(np.array(nodes, np.int64), times)),
            ], names=["h", "n", "node"])

    def shared(batches: Batches) -> Batches:
        held = None  # the last row so far, and whether it has been given
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)
            if held is not None:
                rows = np.concatenate([held[0][None], rows])
            new = np.append(True, np.any(rows[1:] != rows[:-1], axis=1))
            first = np.flatnonzero(new)
            given, rows = held is not None and held[1], rows[first]
            same = rows[1:, 0] == rows[:-1, 0]
            keep = np.append(same, False) | np.append(False, same)
            last = bool(keep[-1]) or (given and len(rows) == 1)
            if given:
                keep[0] = False
            held = (rows[-1], last)
            out = rows[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[:, 0]), pa.array(out[:, 1].astype(np.int32)), pa.array(out[:, 2])], names=["h", "n", "node"]
            )

    rows = mapped(sets.select("node", "text"), sent, "h bigint, n int, node bigint")
    return mapped(rows.repartition("h").sortWithinPartitions("h", "n", "node"), shared, "h bigint, n int, node bigint")


def sketch(hashes: np.ndarray) -> bytes:
    """A bit for each of WIDTH classes of shingles, set if the set has an odd number of them."""
    odd = np.bincount((hashes % np.uint64(WIDTH)).astype(np.int64), minlength=WIDTH) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def dealt(rows: DataFrame, block: int) -> DataFrame:
    """Rows (h, ...) with the two blocks (low, high) of their bucket that meet and their own; a small bucket is one block."""
    large = freeze(rows.groupBy("h").count().where(F.col("count") > block).select(
        "h", F.ceil(F.col("count") / block).cast("int").alias("blocks")
    ), "large-buckets")
    cut = rows.join(large, "h", "left").fillna(1, ["blocks"]).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cut.select("h", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "n", "node", "label", "bits")


def meet(rows: DataFrame, nearest: int, farthest: int | None, block: int) -> DataFrame:
    """(a, b, least, times): of `rows` (h, n, node, label, bits), each set with those that are `nearest` to `farthest` places
    before it by size in its bucket, or block, if labels differ and neither sizes nor sketches rule the two out; how often
    the two meet, and how often alike sets do.

    Two sets differ in no fewer shingles than their sketches in bits, so no similar pair is ruled out.
    """
    def found(key, own, n, node, label, bits) -> Batches:
        lag = nearest
        i = np.arange(lag, len(n))
        across = key[:, 1] != key[:, 2]
        while len(i) and (farthest is None or lag <= farthest):
            j = i - lag
            near = np.all(key[i] == key[j], axis=1) & (n[j] * LEAST[1] >= n[i] * LEAST[0])
            i, j = i[near], j[near]
            differ = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
            keep = (label[i] != label[j]) & (differ * sum(LEAST) <= (n[i] + n[j]) * (LEAST[1] - LEAST[0]))
            keep &= ~across[i] | (own[i] != own[j])
            if keep.any():
                x, y = node[i[keep]], node[j[keep]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)),
                    pa.array(needed(n[i[keep]], n[j[keep]]).astype(np.int32)),
                ], names=["a", "b", "least"])
            lag += 1
            i = i[i >= lag]

    def task(batches: Batches) -> Batches:
        held: list[tuple] = []  # the last block so far
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:7]]
            rows = (
                np.stack(columns[:3], 1), *columns[3:],
                np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint64).reshape(-1, WIDTH // 64),
            )
            held.append(rows)
            cut = int(np.flatnonzero(np.any(rows[0] != rows[0][-1], axis=1)).max(initial=-1)) + 1
            if cut or (len(held) > 1 and np.any(held[-2][0][-1] != rows[0][0])):
                whole = [np.concatenate(x) for x in zip(*held[:-1], [c[:cut] for c in rows], strict=True)]
                held = [tuple(c[cut:] for c in rows)]
                yield from found(*whole)
        if held:
            yield from found(*[np.concatenate(x) for x in zip(*held, strict=True)])

    bucket = ["h", "low", "high"]
    return mapped(
        dealt(rows, block).repartition(*bucket).sortWithinPartitions(*bucket, "n", "node"), task, "a bigint, b bigint, least int"
    ).groupBy("a", "b").agg(F.max("least").alias("least"), F.count("*").alias("times"))


def met(shared: DataFrame, labels: DataFrame, bits: DataFrame, nearest: int, farthest: int | None, block: int) -> DataFrame:
    """The table of what `meet` gives of the buckets `shared` (h, n, node) that hold sets of different labels."""
    labelled = shared.join(labels, "node", "left").select("h", "n", "node", F.coalesce("label", "node").alias("label"))
    open_buckets = freeze(
        labelled.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("h"),
        "open-buckets",
    )
    left = freeze(labelled.join(open_buckets, "h", "left_semi"), "open")
    found = freeze(meet(left.join(bits, "node"), nearest, farthest, block), "met")
    discard(open_buckets, left)
    return found


def packed_texts(sets: DataFrame) -> DataFrame:
    """(node, text) of each different set, the text compressed, for the way to where it is verified."""
    def task(batches: Batches) -> Batches:
        for batch in batches:
            data = [zstandard.compress(raw(t), 3) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["node", "text"])

    return mapped(sets.select("node", "text"), task, "node bigint, text binary")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the table `pairs` (a, b) that are alike, by the compressed texts of `sets` (node, text).

    A text moves once to each join and once more with each pair that names it second.
    """
    def task(batches: Batches) -> Batches:
        last: tuple[int | None, np.ndarray] = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for a, x, y in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if a != last[0]:
                    last = a, shingles(zstandard.decompress(x).decode("utf-8", "surrogatepass"))
                keep.append(alike(last[1], shingles(zstandard.decompress(y).decode("utf-8", "surrogatepass"))))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    wanted = freeze(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "candidate-nodes")
    # of the copies of a set one is taken before texts move
    one = sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("row").alias("row"))
    texts = freeze(packed_texts(sets.join(one.select("row"), "row", "left_semi")), "texts")
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
    found = freeze(mapped(both.select("a", "b", "text_a", "text_b"), task, "a bigint, b bigint"), "near")
    discard(wanted, texts)
    return found


def by_fingerprint(sets: DataFrame) -> DataFrame:
    """Candidates (a, b) whose SimHash fingerprints are equal or close, as stars of representatives."""
    prints = freeze(sets.groupBy("node").agg(F.min("fp").alias("fp")), "prints")
    nodes = freeze(prints.groupBy("fp").agg(F.min("node").alias("first")), "fingerprint-nodes")
    same = prints.join(nodes, "fp").where("node <> first").select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b"))
    close = simhash.links(nodes, simhash.make_plan(nodes))
    first = nodes.toDF("a", "x")
    near = close.join(first, "a").join(nodes.toDF("b", "y"), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return same.union(near).distinct()


def components(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, label) of the sets that are linked to one of a lesser hash; `sets` is a table of row, node, text, bits and fp."""
    tried = freeze(by_fingerprint(sets), "fingerprint-candidates")
    near = verified(tried, sets)
    labels = freeze(connected_components(near, "a", "b"), "labels")
    shared = freeze(buckets(sets, common_shingles(sets)), "buckets")
    bits = freeze(sets.select("node", "bits").dropDuplicates(["node"]), "sketches")
    slices, meetings = min(SLICES, 1 + shared.count() // SLICE), []
    for nearest, farthest in ROUNDS:
        for i in range(slices):
            own = shared.where(F.pmod(F.col("h"), F.lit(slices)) == i)
            meetings.append(met(own, labels, bits, nearest, farthest, block))
        # a bucket that is closed or a pair that is joined by now stays so, and places in a bucket stay as they are
        often = reduce(DataFrame.union, meetings).groupBy("a", "b").agg(F.max("least").alias("least"), F.sum("times").alias("times"))
        new = freeze(often.where("times >= least").select("a", "b").join(tried, ["a", "b"], "left_anti"), "candidates")
        tried = tried.union(new)
        near = near.union(verified(new, sets))
        labels = freeze(connected_components(near, "a", "b"), "labels")
    return labels


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component of near copies, with all its columns: one with the least key, nulls last.

    Documents without words are copies of each other. The documents are written once with a number for each row,
    so that the choice holds for repeated rows too.
    """
    row, node, size, bits, fp = (unused(docs, x) for x in ("row", "node", "size", "bits", "fp"))
    numbered = freeze(with_sets(docs, text, (node, size, bits, fp)).withColumn(row, F.monotonically_increasing_id()), "documents")
    sets = numbered.where(F.col(size) > 0).select(
        F.col(row).alias("row"), F.col(node).alias("node"), F.col(text).alias("text"), F.col(bits).alias("bits"), F.col(fp).alias("fp")
    )
    named = numbered.select(F.col(node).alias("node"), F.col(row).alias("id"), F.col(key).alias("key"))
    chosen = (
        named.join(components(sets), "node", "left")
        .groupBy(F.coalesce("label", "node"))
        .agg(F.min(F.struct(F.col("key").isNull(), "key", "id")).alias("first"))
        .select(F.col("first.id").alias(row))
    )
    return numbered.join(chosen, row, "left_semi").drop(row, node, size, bits, fp)
