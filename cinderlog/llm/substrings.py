"""Removal of long repeated word sequences by a compacted de Bruijn graph.

A window of LENGTH words is an edge from its first to its last LENGTH - 1 words; an edge that starts at two places is
repeated. Writing out every edge would cost many times the text, so paths are compacted before anything moves:

- Each window has an anchor, the ANCHOR words in it with the least hash. Equal windows have equal anchors, and the
  windows that follow one another with one anchor are a stretch, a path of the graph that is known by one hash.
- Only stretches whose anchor occurs twice can hold a repeated edge; a join by anchors leaves the others out.
- A stretch that occurs twice as a whole repeats all its edges. Only in the rest, where paths branch, are edges counted one
  by one, together with those of one occurrence of each repeated stretch with the same anchor.

Repeated edges go back to where they came from and are glued to maximal spans by their coordinates. Anchor and edge, or
anchor and stretch, are compared by two 64-bit hashes of different words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cinderlog.llm.common import Batches, mapped, raw
from cinderlog.session import discard, freeze

LENGTH = 35
ANCHOR = 12
SEED = 42
#: Words whose windows are hashed at once, and words whose hashes a task remembers.
BLOCK = 200_000
REMEMBERED = 1_000_000

#: What is known of a stretch: nothing, that it is repeated, and that its edges are to be compared with those of others too.
ASKED, KNOWN, LENT = range(3)
MARKS = 3

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    """Hashes of the words met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return found


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` words in a row, by doubling; empty if there are fewer."""
    found, length = None, 0
    power = hashes  # of `width` words
    width = 1
    while True:
        if size & width:
            if found is None:
                found, length = power, width
            else:
                n = max(0, min(len(found), len(power) - length))
                found, length = found[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + power[length:length + n], length + width
        if length == size:
            return found[:max(0, len(hashes) - size + 1)]
        n = max(0, len(power) - width)
        power, width = power[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + power[width:width + n], width * 2


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(32)) * _MIX
    return (values ^ values >> np.uint64(32)) * _MIX


@dataclass(frozen=True)
class Stretches:
    """Runs of windows with one anchor: document, first window in it, number of windows, hashes; and the windows' own."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    whole: np.ndarray
    edges: np.ndarray  # of the windows of all stretches in turn


def stretches(docs: list[list[bytes]], hashes: dict[bytes, int], length: int, anchor: int) -> Stretches:
    """The stretches of documents given as words, in order."""
    sizes = np.array([len(w) for w in docs], np.int64)
    words = np.fromiter((hashes[w] for d in docs for w in d), np.uint64, sizes.sum())
    edges, keys = rolling(words, length), rolling(words, anchor)
    own = np.repeat(np.arange(len(docs)), sizes)
    first = np.cumsum(sizes) - sizes
    # windows that lie within one document
    at = np.flatnonzero(own[:len(edges)] == own[length - 1:]) if len(edges) else np.zeros(0, np.int64)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Stretches(none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(np.uint64))
    width = length - anchor + 1
    ranked = np.lib.stride_tricks.sliding_window_view(mixed(keys), width)
    place = np.concatenate([at[i:i + BLOCK] + ranked[at[i:i + BLOCK]].argmin(1) for i in range(0, len(at), BLOCK)])
    new = np.append(True, (place[1:] != place[:-1]) | (own[at[1:]] != own[at[:-1]]))
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at))
    edges = edges[at]
    # two windows of a stretch overlap, so the first, the last and their distance say all its words
    whole = mixed(mixed(edges[begin]) * np.uint64(_BASE) + edges[end - 1] + (end - begin).astype(np.uint64))
    doc = own[at[begin]]
    return Stretches(doc, at[begin] - first[doc], end - begin, keys[place[begin]], whole, edges)


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """The words of some texts at a time, and which text is the first of them."""
    begin, words, n = 0, [], 0
    for i, text in enumerate(texts):
        words.append(raw(text or "").split())
        n += len(words[-1])
        if n >= BLOCK or i == len(texts) - 1:
            yield begin, words
            begin, words, n = i + 1, [], 0


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def _lists(values: np.ndarray, doc: np.ndarray, docs: int) -> pa.Array:
    """Values in the order of their documents as a list for each document."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(doc, minlength=docs))).astype(np.int32)), pa.array(values))


def _read(length: int, anchor: int):
    """Task code: (row, id, text) to (row, id, n_words, words, anchors, wholes), words being parted by one blank."""
    def task(batches: Batches) -> Batches:
        hashes = _Hashes()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for begin, docs in _blocks(texts):
                found, n = stretches(docs, hashes, length, anchor), len(docs)
                yield pa.RecordBatch.from_arrays([
                    *(c.slice(begin, n) for c in batch.columns[:2]), pa.array([len(w) for w in docs], pa.int64()),
                    pa.array([b" ".join(w) for w in docs], pa.binary()).cast(pa.string()),
                    _lists(_signed(found.anchor), found.doc, n), _lists(_signed(found.whole), found.doc, n),
                ], names=["row", "id", "n_words", "words", "anchors", "wholes"])

    return task


def _ask(length: int, anchor: int):
    """Task code: (row, id, n_words, words, stretches) to the windows that are known to be repeated and those to count.

    `stretches` holds for each that may be repeated its place in the document, times MARKS, and what is known of it.
    """
    def task(batches: Batches) -> Batches:
        hashes = _Hashes()
        for batch in batches:
            told = batch.column(4)
            for begin, docs in _blocks(batch.column(3).to_pylist()):
                found, n = stretches(docs, hashes, length, anchor), len(docs)
                seconds = np.cumsum(np.bincount(found.doc, minlength=n))
                opens = np.append(0, seconds[:-1])
                values = [np.array(told[begin + i].as_py(), np.int64) for i in range(n)]
                marks = np.concatenate([opens[i] * MARKS + v for i, v in enumerate(values)] or [np.zeros(0, np.int64)])
                kind = np.full(len(found.doc), -1)
                kind[marks // MARKS] = marks % MARKS
                each = np.repeat(np.arange(len(found.doc)), found.count)
                within = np.arange(len(each)) - np.repeat(np.cumsum(found.count) - found.count, found.count)
                at, doc = (found.start[each] + within).astype(np.int32), found.doc[each]
                kind = kind[each]
                k, a = kind > ASKED, (kind == ASKED) | (kind == LENT)
                yield pa.RecordBatch.from_arrays([
                    *(c.slice(begin, n) for c in batch.columns[:4]), _lists(at[k], doc[k], n), _lists(at[a], doc[a], n),
                    _lists(_signed(found.anchor[each[a]]), doc[a], n), _lists(_signed(found.edges[a]), doc[a], n), _lists(kind[a] == LENT, doc[a], n),
                ], names=["row", "id", "n_words", "words", "known", "at", "anchors", "edges", "lent"])

    return task


def _cut(length: int):
    """Task code: (id, n_words, words, known, found) to the documents without the repeated spans."""
    def task(batches: Batches) -> Batches:
        for batch in batches:
            removed, kept, spans = [], [], []
            for text, known, found in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                words = raw(text).split()
                change = np.zeros(len(words) + 1, np.int64)
                at = np.array([*(known or ()), *(found or ())], np.int64)
                np.add.at(change, at, 1)
                np.add.at(change, at + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                removed.append(int(gone.sum()))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone)]).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:2], pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ], names=["id", "n_words", "n_removed", "kept", "spans"])

    return task


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """One row per document: key, n_words, n_removed, kept (the words left, parted by one blank) and spans (start and
    end of each removed run of words).

    A word goes if a window of `length` words that covers it also starts elsewhere, in any document or this one; all
    windows are those of the input. A null text has no words, a text under `length` words loses none. Of repeated rows
    each is a document, so those of `length` words or more lose everything. Words are compared as they are.
    """
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    own = f"row bigint, id {kind}, n_words bigint, words string"
    base = freeze(mapped(given, _read(length, anchor), f"{own}, anchors array<bigint>, wholes array<bigint>"), "stretches")

    one = base.select("row", F.posexplode(F.arrays_zip("anchors", "wholes")).alias("at", "s")).select(
        "row", "at", F.col("s.anchors").alias("anchor"), F.col("s.wholes").alias("whole")
    )
    often = freeze(one.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    maybe = freeze(one.join(often, "anchor"), "candidates")
    counted = freeze(maybe.groupBy("anchor", "whole").agg(F.count("*").alias("n"), F.min("row").alias("lender")), "paths")
    branching = counted.where("n = 1").select("anchor").distinct().withColumn("branches", F.lit(True))
    paths = freeze(counted.where("n > 1").join(branching, "anchor", "left"), "repeated-paths")
    mark = F.when(F.col("lender").isNull(), ASKED).when(F.col("branches") & (F.col("lender") == F.col("row")), LENT).otherwise(KNOWN)
    told = maybe.join(paths, ["anchor", "whole"], "left").groupBy("row").agg(
        F.collect_list(F.col("at").cast("bigint") * MARKS + mark).alias("stretches")
    )
    told = freeze(told, "marks")
    discard(often, maybe, counted, paths)

    texts = base.select("row", "id", "n_words", "words")
    asked = freeze(mapped(
        texts.join(told, "row").select("row", "id", "n_words", "words", "stretches"), _ask(length, anchor),
        f"{own}, known array<int>, at array<int>, anchors array<bigint>, edges array<bigint>, lent array<boolean>",
    ), "branches")
    edges = asked.select("row", F.explode(F.arrays_zip("at", "anchors", "edges", "lent")).alias("s")).select("row", "s.*")
    known = freeze(edges.groupBy("anchors", "edges").agg(F.count("*").alias("n"), F.max("lent").alias("lent")).where("n > 1 OR lent").select(
        "anchors", "edges"
    ), "twice")
    found = freeze(edges.join(known, ["anchors", "edges"]).groupBy("row").agg(F.collect_list("at").alias("found")), "edges")
    cut = asked.select("row", "id", "n_words", "words", "known").join(found, "row", "left").select(
        "id", "n_words", "words", "known", "found"
    )
    out = mapped(cut, _cut(length), f"id {kind}, n_words bigint, n_removed bigint, kept string, spans array<struct<start:int,end:int>>")
    whole_texts = texts.join(told.select("row"), "row", "left_anti").selectExpr(
        "id", "n_words", "0L AS n_removed", "words AS kept", "CAST(array() AS array<struct<start:int,end:int>>) AS spans"
    )
    return out.unionByName(whole_texts).withColumnRenamed("id", key)
