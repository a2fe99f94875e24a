"""A Merkle manifest of a dataset whose parents keep the hash states before each child.

The rows of a group are the leaves of its tree, the roots of the groups those of the last tree. A parent is the hash of up
to three children's digests and keeps the hash state before each of its slots. To see what root a changed leaf gives,
the state of its slot is resumed with the replacement and the siblings to its right only, level by level.

Trees are cut into chunks of STEP levels. A chunk is built, and later folded, in one task; what lies above it is handed
down to it once, so that a tree of n leaves takes about log(n) / (STEP log 3) rounds, each smaller by WIDTH.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cinderlog.llm.common import Batches, mapped
from cinderlog.llm.midstate import START, absorb, as_blocks, as_text, finished, started
from cinderlog.operators.ordered import range_layout
from cinderlog.session import freeze

CHILDREN = 3
#: Levels of a chunk, and the leaves it can have.
STEP = 6
WIDTH = CHILDREN**STEP

#: A parent as a chunk keeps it: its children, the states before its second and third slot, and its digest.
NODE = np.dtype([("count", "u1"), ("before", ">u4", (CHILDREN - 1, 8)), ("digest", ">u4", 8)])
#: A step up from a node: its slot, the run's length, the state before the slot and the siblings as hex text, in order.
RECORD = np.dtype([("slot", "u1"), ("count", "u1"), ("state", ">u4", 8), ("others", "u1", (CHILDREN - 1, 64))])

_CHUNK = "g string, c bigint, levels int, root string, nodes binary"


def field(column: str) -> str:
    """SQL: a value as its UTF-8 byte count, a colon and the value, or `-` for null."""
    text = f"CAST({column} AS STRING)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE concat(octet_length({text}), ':', {text}) END"


def leaf_of(columns: Sequence[str]) -> str:
    """SQL: the hash of a row's values."""
    return f"sha2(concat({', '.join(map(field, columns))}), 256)"


@dataclass(frozen=True)
class Manifest:
    """Leaves (g, c, p, id, leaf, found, levels), chunks with what lies above them, and the root (None if empty)."""

    leaves: DataFrame
    chunks: DataFrame
    root: str | None


# ---- within a chunk

def _places(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each chunk in turn."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _above(sizes: np.ndarray) -> np.ndarray:
    return -(-sizes // CHILDREN)


def climb(text: np.ndarray, sizes: np.ndarray, levels: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The parents of each level over chunks of nodes given as hex text, and the chunks' roots as hex text."""
    found = []
    for _ in range(levels):
        first = np.flatnonzero(_places(sizes) % CHILDREN == 0)
        count = np.diff(np.append(first, len(text)))
        blocks, nodes = as_blocks(text), np.zeros(len(first), NODE)
        state = absorb(started(len(first)), blocks[first])
        for slot in range(1, CHILDREN):
            nodes["before"][:, slot - 1] = state
            more = np.flatnonzero(count > slot)
            if len(more):
                state[more] = absorb(state[more], blocks[first[more] + slot])
        nodes["count"], nodes["digest"] = count, finished(state, count)
        found.append(nodes)
        text, sizes = as_text(nodes["digest"]), _above(sizes)
    return found, text


class _Steps:
    """The levels of chunks of equal height: for each, the nodes below as text, and their parents."""

    def __init__(self, text: np.ndarray, sizes: np.ndarray, blobs: list[bytes], levels: int) -> None:
        kept = [np.frombuffer(b, NODE) for b in blobs]
        self.below, self.place, self.parent, self.first, self.nodes = [], [], [], [], []
        done = np.zeros(len(sizes), np.int64)
        for _ in range(levels):
            place, up = _places(sizes), _above(sizes)
            opens = place % CHILDREN == 0
            nodes = np.concatenate([k[a:a + n] for k, a, n in zip(kept, done, up, strict=True)])
            self.below.append(text)
            self.place.append(place)
            self.parent.append(np.cumsum(opens) - 1)
            self.first.append(np.flatnonzero(opens))
            self.nodes.append(nodes)
            text, sizes, done = as_text(nodes["digest"]), up, done + up

    def records(self, level: int) -> np.ndarray:
        """The step up from every node below a level."""
        nodes, q = self.nodes[level], self.parent[level]
        out = np.zeros(len(q), RECORD)
        slot = self.place[level] % CHILDREN
        out["slot"], out["count"] = slot, nodes["count"][q]
        out["state"] = self.state(level, np.arange(len(q)))
        for k in range(CHILDREN - 1):
            other = self.first[level][q] + k + (k >= slot)
            there = k < out["count"] - 1
            out["others"][there, k] = self.below[level][other[there]]
        return out

    def state(self, level: int, node: np.ndarray) -> np.ndarray:
        slot = self.place[level][node] % CHILDREN
        kept = self.nodes[level]["before"][self.parent[level][node], np.maximum(slot - 1, 0)].astype(np.uint32)
        return np.where((slot == 0)[:, None], START, kept)

    def fold(self, text: np.ndarray) -> np.ndarray:
        """The chunk's root, as text, for each leaf if it alone is replaced by `text`."""
        node = np.arange(len(text))
        for level, below in enumerate(self.below):
            q = self.parent[level][node]
            slot, count = self.place[level][node] % CHILDREN, self.nodes[level]["count"][q]
            state = absorb(self.state(level, node), as_blocks(text))
            for k in range(1, CHILDREN):
                more = np.flatnonzero(slot + k < count)
                if len(more):
                    state[more] = absorb(state[more], as_blocks(below[node[more] + k]))
            text, node = as_text(finished(state, count)), q
        return text

    def siblings(self, above: list[bytes]) -> list[bytes]:
        """For each leaf the siblings' hex texts up to the chunk's root, and then those `above` it."""
        for level in reversed(range(len(self.below))):
            text, first = self.below[level].tobytes(), (64 * self.first[level]).tolist()
            ends = (64 * (self.first[level] + self.nodes[level]["count"])).tolist()
            above = [
                text[first[q]:at] + text[at + 64:ends[q]] + above[q]
                for at, q in zip(range(0, len(text), 64), self.parent[level].tolist(), strict=True)
            ]
        return above


def resumed(text: np.ndarray, steps: list[np.ndarray], chunk: np.ndarray) -> np.ndarray:
    """What `text` of each row becomes by the steps (RECORD arrays, one for each chunk) above its chunk."""
    height = np.array([len(s) for s in steps])
    for level in range(height.max(initial=0)):
        at = np.array([s[level] if len(s) > level else np.zeros((), RECORD) for s in steps], RECORD)
        rows = np.flatnonzero(height[chunk] > level)
        step = at[chunk[rows]]
        state = absorb(step["state"].astype(np.uint32), as_blocks(text[rows]))
        for k in range(CHILDREN - 1):
            more = np.flatnonzero(step["slot"] + k < step["count"] - 1)
            if len(more):
                state[more] = absorb(state[more], as_blocks(step["others"][more, step["slot"][more] + k]))
        text = text.copy()
        text[rows] = as_text(finished(state, step["count"]))
    return text


# ---- tasks over rows in the order of their chunks

def _whole_chunks(batches: Batches, opens: Callable[[pa.Table], np.ndarray]) -> Iterator[pa.Table]:
    """The rows by whole chunks; `opens` tells the first row of each."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        cut = int(np.flatnonzero(opens(rows))[-1])
        if cut:
            yield rows.slice(0, cut).combine_chunks()
        held = rows.slice(cut)
    if held is not None:
        yield held.combine_chunks()


def _numbers(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy().astype(np.int64)


def _hex(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer("".join(column.to_pylist()).encode(), np.uint8).reshape(-1, 64)


def _texts(found: np.ndarray) -> list[str]:
    data = found.tobytes().decode()
    return [data[i:i + 64] for i in range(0, len(data), 64)]


def _by_height(height: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for levels in np.unique(height):
        yield int(levels), np.flatnonzero(height == levels)


def _members(starts: np.ndarray, sizes: np.ndarray, some: np.ndarray) -> np.ndarray:
    """The rows of some chunks."""
    return np.repeat(starts[some], sizes[some]) + _places(sizes[some])


def _build(base: int):
    """Task code: nodes (g, c, p, levels, digest) to chunks."""
    def task(batches: Batches) -> Batches:
        for rows in _whole_chunks(batches, lambda t: _numbers(t, "p") % WIDTH == 0):
            starts = np.flatnonzero(_numbers(rows, "p") % WIDTH == 0)
            sizes = np.diff(np.append(starts, rows.num_rows))
            height = np.clip(_numbers(rows, "levels")[starts] - base, 0, STEP)
            text = _hex(rows.column("digest"))
            roots, blobs = np.zeros((len(starts), 64), np.uint8), [b""] * len(starts)
            for levels, some in _by_height(height):
                parents, roots[some] = climb(text[_members(starts, sizes, some)], sizes[some], levels)
                up = sizes[some]
                for nodes in parents:
                    up = _above(up)
                    for i, end, n in zip(some, np.cumsum(up), up, strict=True):
                        blobs[i] += nodes[end - n:end].tobytes()
            heads = rows.take(pa.array(starts))
            yield pa.RecordBatch.from_arrays([
                *(heads.column(x).combine_chunks() for x in ("g", "c", "levels")), pa.array(_texts(roots)),
                pa.array(blobs, pa.binary()),
            ], names=["g", "c", "levels", "root", "nodes"])

    return task


def _opened(batches: Batches, base: int) -> Iterator[tuple]:
    """Chunks of equal height, each headed by a row with p = -1: (heads, steps, rows below, chunk of each row)."""
    for rows in _whole_chunks(batches, lambda t: _numbers(t, "p") < 0):
        starts = np.flatnonzero(_numbers(rows, "p") < 0)
        sizes = np.diff(np.append(starts, rows.num_rows)) - 1
        height = np.clip(_numbers(rows, "levels")[starts] - base, 0, STEP)
        for levels, some in _by_height(height):
            heads = rows.take(pa.array(starts[some]))
            own = rows.take(pa.array(_members(starts + 1, sizes, some)))
            steps = _Steps(_hex(own.column("digest")), sizes[some], heads.column("nodes").to_pylist(), levels)
            yield heads, steps, own, np.repeat(np.arange(len(some)), sizes[some])


def _hand_down(base: int):
    """Task code: chunks with what lies above them and their nodes, to what lies above each node: (g, c, above)."""
    def task(batches: Batches) -> Batches:
        for heads, steps, own, chunk in _opened(batches, base):
            above = heads.column("above").to_pylist()
            if not steps.below:
                above = [above[i] for i in chunk]
            for level in reversed(range(len(steps.below))):
                records, parent = steps.records(level), steps.parent[level].tolist()
                above = [r.tobytes() + above[q] for r, q in zip(records, parent, strict=True)]
            yield pa.RecordBatch.from_arrays([
                own.column("g").combine_chunks(), own.column("p").combine_chunks(), pa.array(above, pa.binary()),
            ], names=["g", "c", "above"])

    return task


def _fold(root: str, names: list[str]):
    """Task code: chunks and their leaves, to proofs and folded roots."""
    def task(batches: Batches) -> Batches:
        for heads, steps, own, chunk in _opened(batches, 0):
            above = [np.frombuffer(a, RECORD) for a in heads.column("above").to_pylist()]
            folded = _texts(resumed(steps.fold(_hex(own.column("found"))), above, chunk))
            over = [b"".join(s["others"][k].tobytes() for s in a for k in range(int(s["count"]) - 1)) for a in above]
            proofs = steps.siblings(over)
            if not steps.below:
                proofs = [over[c] for c in chunk]
            subroot = heads.column("subroot").take(pa.array(chunk)).combine_chunks()
            yield pa.RecordBatch.from_arrays([
                own.column("id").combine_chunks(), own.column("digest").combine_chunks(), subroot,
                pa.array([root] * len(folded)), pa.array([hashlib.sha256(p).hexdigest() for p in proofs]),
                pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_()),
            ], names=names)

    return task


# ---- trees

def _dealt(rows: DataFrame) -> DataFrame:
    """A chunk's rows in one task, in order; a group of any size spreads by its chunks."""
    return rows.repartition("g", "c").sortWithinPartitions("g", "c", "p")


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add to rows with a column g: p, the place in its group from 0, c, its chunk, and levels, the height of its tree.

    Rows are sorted into ranges of equal size, so a large group doesn't fill a task; the join is by range and group.
    """
    laid = range_layout(rows, ["g", *order])
    shares = laid.groupBy("_part", "g").agg(F.count("*").alias("n"), F.min("_pos").alias("at"))
    before = Window.partitionBy("g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = shares.select(
        F.col("_part").alias("_in"), F.col("g").alias("_of"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("at")).alias("_start"),
        F.sum("n").over(Window.partitionBy("g")).alias("_total"),
    )
    same = (F.col("_part") == F.col("_in")) & F.col("g").eqNullSafe(F.col("_of"))
    levels = f"size(filter(sequence(0, 38), i -> pow({CHILDREN}, i) < _total)) AS levels"
    return laid.join(starts, same).withColumn("p", F.col("_start") + F.col("_pos")).selectExpr(
        "g", f"p DIV {WIDTH} AS c", "p", *[c for c in rows.columns if c != "g"], levels
    )


def _tree(nodes: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """From the leaves up: the nodes (g, c, p, levels, digest) and the chunks over them, STEP levels a round."""
    deepest = nodes.agg(F.max("levels")).first()[0] or 0
    found, base = [], 0
    while not found or base < deepest:
        chunks = freeze(mapped(_dealt(nodes), _build(base), _CHUNK), "chunks")
        found.append((nodes, chunks))
        base += STEP
        nodes = chunks.where(F.col("levels") > base).selectExpr(
            "g", f"c DIV {WIDTH} AS c", "c AS p", "levels", "root AS digest"
        )
    return found


def _roots(tree: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(g, root) of each group."""
    tops = [chunks.where(F.col("levels") <= (i + 1) * STEP).select("g", "root") for i, (_, chunks) in enumerate(tree)]
    return _union(tops)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def _headed(chunks: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes of each chunk behind the chunk itself."""
    return _dealt(_union([chunks.withColumn("p", F.lit(-1).cast("bigint")).drop("root"), nodes]))


def _with_above(tree: list[tuple[DataFrame, DataFrame]], tops: DataFrame) -> DataFrame:
    """The lowest chunks with what lies above them; `tops` (g, above) has it for each group."""
    passed, out = None, None
    for i in reversed(range(len(tree))):
        nodes, chunks = tree[i]
        ends = chunks.where(F.col("levels") <= (i + 1) * STEP).join(
            tops.select(F.col("g").alias("_of"), "above"), F.col("g").eqNullSafe(F.col("_of"))
        ).drop("_of")
        out = ends if passed is None else ends.unionByName(
            chunks.where(F.col("levels") > (i + 1) * STEP).join(
                passed.toDF("_of", "_c", "above"), F.col("g").eqNullSafe(F.col("_of")) & (F.col("c") == F.col("_c"))
            ).drop("_of", "_c")
        )
        if i:
            passed = freeze(mapped(_headed(out, nodes), _hand_down(i * STEP), "g string, c bigint, above binary"), "above")
    return out


def build(rows: DataFrame) -> Manifest:
    """The manifest of rows (g, id, leaf, found): trees by g over the leaves in the order of id.

    `leaf` is a row's hash and `found` the one it has now, for `fold`. A null g is a group of its own and comes first, a
    null id comes first in its group; rows with equal ids are ordered by their hash, and repeated rows are leaves of
    their own.
    """
    spark = rows.sparkSession
    leaves = freeze(numbered(rows, ["id", "leaf"]), "leaves")
    tree = _tree(leaves.select("g", "c", "p", "levels", F.col("leaf").alias("digest")))
    groups = _roots(tree).select(F.lit(None).cast("string").alias("g"), F.col("g").alias("name"), F.col("root").alias("digest"))
    # the groups are leaves of one more tree, in the order of their names
    laid = freeze(numbered(groups.withColumn("has_name", F.col("name").isNotNull()), ["has_name", "name"]), "groups")
    over = _tree(laid.select("g", "c", "p", "levels", "digest"))
    root = _roots(over).first()
    none = spark.createDataFrame([(None, b"")], "g string, above binary")
    handed = mapped(
        _headed(_with_above(over, none), over[0][0]), _hand_down(0), "g string, c bigint, above binary"
    ).select(F.col("c").alias("_p"), "above")
    tops = freeze(laid.join(handed, F.col("p") == F.col("_p")).select(
        F.col("name").alias("g"), "above", F.col("digest").alias("subroot")
    ), "tops")
    chunks = _with_above(tree, tops.select("g", "above")).join(
        tops.select(F.col("g").alias("_of"), "subroot"), F.col("g").eqNullSafe(F.col("_of"))
    ).drop("_of")
    return Manifest(leaves, freeze(chunks, "manifest"), root["root"] if root else None)


def fold(manifest: Manifest, key: str = "doc_id") -> DataFrame:
    """One row per leaf: key, leaf, subroot, root, proof_sha256, folded_root and verified.

    proof_sha256 is the hash of the siblings from the leaf to the root; folded_root is the root that the leaf's `found`
    hash gives with these siblings, and verified tells whether it is the root. No rows for an empty table.
    """
    leaves = manifest.leaves.select("g", "c", "p", "levels", "id", F.col("leaf").alias("digest"), "found")
    kind = leaves.schema["id"].dataType.simpleString()
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    schema = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    folded = mapped(_headed(manifest.chunks, leaves), _fold(manifest.root or "", names), schema)
    return folded.withColumnRenamed("id", key)


#: The columns whose values make up a leaf, and the change that the query tries on every other document.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = "replace(text, '\\n', '')"


def audit(docs: DataFrame, tampered: str = TAMPERED) -> DataFrame:
    """Proofs of all documents by source, and whether they verify after `tampered` took the place of some texts.

    Those are the documents whose doc_id, as decimal text, has an even CRC-32; a null text, or doc_id, stays as it is.
    """
    changed = [f"CASE WHEN crc32(CAST(doc_id AS STRING)) % 2 = 0 THEN {tampered} ELSE text END" if c == "text" else c for c in FIELDS]
    rows = docs.selectExpr(
        "source AS g", "doc_id AS id", f"{leaf_of(FIELDS)} AS leaf", f"{leaf_of(changed)} AS found"
    )
    return fold(build(rows))
