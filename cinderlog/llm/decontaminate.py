"""Benchmark decontamination by a positional inverted index.

Documents are cut into segments; each segment stores, for every term, the sorted places where it stands. A benchmark
window is looked up from its rarest terms: the places of a term, moved back by its offset in the window, are
possible starts, and each further term's list thins them out. What is left are exact phrases; places
that are off by a few words give proximity matches. The index is a table, one row a segment, and can be
searched again with other benchmarks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cinderlog.llm.common import Batches, mapped, raw
from cinderlog.session import freeze

WINDOW = 13
#: A document is contaminated if at least one in so many of its words is hit.
SHARE = 20
#: How far a word may stand from its place in a proximity match.
SLOP = 3
#: Words of a segment; a longer document is a segment of its own.
SEGMENT_WORDS = 200_000
#: Benchmark words that tasks hold at once; a larger benchmark is searched block by block.
BLOCK_WORDS = 500_000

#: A-Z become a-z, and every other byte of ASCII that is no letter or digit parts words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

#: A segment: places of its terms as little-endian numbers, and its documents with the place of their first word.
SEGMENT = (
    "terms binary, term_starts binary, places binary, doc_starts binary, n_words bigint, "
    "doc_ids array<{key}>"
)
INTERVALS = "array<struct<start:bigint,end:bigint>>"


def words_of(text: str | None) -> list[bytes]:
    return raw(text or "").translate(_FOLD).split()


def term_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def segment_of(texts: list[list[bytes]]) -> dict[str, np.ndarray]:
    """The postings of a few documents, given as their words."""
    table: dict[bytes, int] = {}
    runs = []
    for words in texts:
        for w in dict.fromkeys(words):
            table.setdefault(w, len(table))
        runs.append(np.fromiter(map(table.__getitem__, words), np.int32, len(words)))
    ids = np.concatenate([np.empty(0, np.int32), *runs])
    hashes = np.fromiter(map(term_hash, table), np.uint64, len(table))
    by_hash = np.argsort(hashes, kind="stable")
    rank = np.empty(len(table), np.int32)
    rank[by_hash] = np.arange(len(table), dtype=np.int32)
    ranked = rank[ids]
    return {
        "terms": hashes[by_hash],
        "term_starts": np.append(0, np.cumsum(np.bincount(ranked, minlength=len(table)))).astype(np.int64),
        "places": np.argsort(ranked, kind="stable").astype(np.int64 if len(ids) > 2**31 else np.int32),
        "doc_starts": np.append(0, np.cumsum([len(w) for w in texts])).astype(np.int64),
    }


def _segments(keys: list, texts: list[str | None]) -> Iterator[tuple[list, list[list[bytes]]]]:
    held, own, n = [], [], 0
    for key, text in zip(keys, texts, strict=True):
        words = words_of(text)
        if held and n + len(words) > SEGMENT_WORDS:
            yield own, held
            held, own, n = [], [], 0
        held.append(words)
        own.append(key)
        n += len(words)
    if held:
        yield own, held


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all words of all documents as a table in the shared folder."""
    kind = docs.schema[key].dataType.simpleString()

    def task(batches: Batches) -> Batches:
        for batch in batches:
            kept = batch.schema.field(0).type
            for keys, texts in _segments(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = segment_of(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([s[k].tobytes()], pa.binary()) for k in ("terms", "term_starts", "places", "doc_starts")),
                     pa.array([int(s["doc_starts"][-1])]), pa.array([keys], pa.list_(kept))],
                    names=["terms", "term_starts", "places", "doc_starts", "n_words", "doc_ids"],
                )

    built = mapped(docs.select(key, text), task, SEGMENT.format(key=kind))
    return freeze(built.withColumn("segment", F.monotonically_increasing_id()), "postings")


class Windows:
    """The windows of some benchmark items, as numbers of their terms."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int = WINDOW):
        table: dict[bytes, int] = {}
        held: dict[tuple[int, ...], set[int]] = {}
        self.names = [name for name, _ in items]
        for number, (_, text) in enumerate(items):
            ids = [table.setdefault(w, len(table)) for w in words_of(text)]
            for at in range(max(1, len(ids) - width + 1) if ids else 0):
                held.setdefault(tuple(ids[at:at + width]), set()).add(number)
        self.windows = list(held)
        self.items = [sorted(x) for x in held.values()]
        self.terms = np.fromiter(map(term_hash, table), np.uint64, len(table))
        # a short window is filled up with its own first term, which changes neither its counts nor its rarest term
        self.padded = np.array([[*w, *[w[0]] * (width - len(w))] for w in self.windows], np.int64).reshape(-1, width)

    def search(self, s: dict[str, np.ndarray], slop: int = SLOP) -> tuple[list, list]:
        """(window, exact starts) and (window, documents of proximity matches) in a segment.

        A match lies within one document, so that what its neighbours in the segment hold makes no difference.
        """
        exact, near = [], []
        if not len(s["terms"]) or not self.windows:
            return exact, near
        slot = np.minimum(np.searchsorted(s["terms"], self.terms), len(s["terms"]) - 1)
        there = s["terms"][slot] == self.terms
        counts = np.where(there, s["term_starts"][slot + 1] - s["term_starts"][slot], 0)
        starts, places, doc_starts = s["term_starts"], s["places"], s["doc_starts"]
        for at in np.flatnonzero((counts[self.padded] > 0).all(1)).tolist():
            window = self.windows[at]
            order = sorted(range(len(window)), key=lambda i: counts[window[i]])
            first = slot[window[order[0]]]
            found = places[starts[first]:starts[first + 1]].astype(np.int64) - order[0]
            doc = np.searchsorted(doc_starts, found + order[0], "right") - 1
            off = np.zeros(len(found), bool)
            for i in order[1:]:
                if not len(found):
                    break
                term = slot[window[i]]
                own = places[starts[term]:starts[term + 1]]
                want = found + i
                left = np.searchsorted(own, np.maximum(want - slop, doc_starts[doc]))
                last = np.minimum(want + slop, doc_starts[doc + 1] - 1)
                kept = (left < len(own)) & (own[np.minimum(left, len(own) - 1)] <= last)
                spot = np.searchsorted(own, want)
                same = (spot < len(own)) & (own[np.minimum(spot, len(own) - 1)] == want)
                # at a border of the document the word may stand in the next one
                same &= (want >= doc_starts[doc]) & (want < doc_starts[doc + 1])
                found, doc, off = found[kept], doc[kept], (off | ~same)[kept]
            if len(found):
                if not off.all():
                    exact.append((at, found[~off]))
                if off.any():
                    near.append((at, doc[off]))
        return exact, near


def _hits(w: Windows, s: dict[str, np.ndarray], slop: int) -> tuple[list, list, list]:
    """For each document of a segment: merged intervals of hit words, items found, items only nearly found."""
    exact, near = w.search(s, slop)
    doc_starts = s["doc_starts"]
    n = len(doc_starts) - 1
    items: list[set] = [set() for _ in range(n)]
    close: list[set] = [set() for _ in range(n)]
    cover = np.zeros(int(doc_starts[-1]) + 1, np.int32)
    for at, docs in near:
        for doc in set(docs.tolist()):
            close[doc].update(w.items[at])
    for at, starts in exact:
        for doc in set((np.searchsorted(doc_starts, starts, "right") - 1).tolist()):
            items[doc].update(w.items[at])
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + len(w.windows[at]), -1)
    intervals: list[list] = [[] for _ in range(n)]
    if exact:
        hit = np.concatenate([[0], np.cumsum(cover[:-1]) > 0, [0]]).astype(np.int8)
        edge = np.diff(hit)
        for a, b in zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist(), strict=True):
            doc = int(np.searchsorted(doc_starts, a, "right")) - 1
            while a < b:  # hits of two documents may touch
                end = min(b, int(doc_starts[doc + 1]))
                if end > a:
                    base = int(doc_starts[doc])
                    intervals[doc].append({"start": a - base, "end": end - base})
                    a = end
                doc += 1

    def named(found: set) -> list[str]:
        return sorted({w.names[i] for i in found if w.names[i] is not None})

    return intervals, [named(x) for x in items], [named(c - i) for i, c in zip(items, close, strict=True)]


def _columns(row: dict) -> dict[str, np.ndarray]:
    kinds = {"terms": np.uint64, "term_starts": np.int64, "doc_starts": np.int64,
             "places": np.int64 if row["n_words"] > 2**31 else np.int32}
    return {k: np.frombuffer(row[k], kind) for k, kind in kinds.items()}


def benchmark_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[list[tuple]]:
    """The different items in blocks of about BLOCK_WORDS words, one block on the driver at a time."""
    named = benchmark.select(F.col(item).cast("string").alias("name"), F.col(text).alias("text")).distinct()
    chars = named.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = int(chars) // (6 * BLOCK_WORDS) + 1
    for i in range(blocks):
        yield [tuple(r) for r in named.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == i).collect()]


def find(index: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    """One row per document of the index: doc_id, n_words, hit intervals, items found and items nearly found.

    Intervals count words from the document's start; `intervals` may overlap between blocks of the benchmark.
    """
    key = index.schema["doc_ids"].dataType.elementType
    schema = (
        f"segment bigint, at int, doc_id {key.simpleString()}, n_words bigint, intervals {INTERVALS}, "
        "items array<string>, near_items array<string>"
    )

    def search(windows: Windows) -> DataFrame:
        held = index.sparkSession.sparkContext.broadcast(windows)

        def task(batches: Batches) -> Batches:
            for batch in batches:
                keys = batch.schema.field("doc_ids").type.value_type
                for i in range(batch.num_rows):  # one segment in memory as Python objects at a time
                    row = batch.slice(i, 1).to_pylist()[0]
                    s = _columns(row)
                    n = len(row["doc_ids"])
                    intervals, items, near = _hits(held.value, s, slop)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["segment"]] * n), pa.array(range(n), pa.int32()), pa.array(row["doc_ids"], keys),
                         pa.array(np.diff(s["doc_starts"])),
                         pa.array(intervals, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         pa.array(items, pa.list_(pa.string())), pa.array(near, pa.list_(pa.string()))],
                        names=["segment", "at", "doc_id", "n_words", "intervals", "items", "near_items"],
                    )

        return mapped(index, task, schema)

    found = None
    for block in benchmark_blocks(benchmark):
        part = search(Windows(block))
        found = part if found is None else found.unionByName(part)
    joined = lambda c: F.flatten(F.collect_list(c)).alias(c)
    return found.groupBy("segment", "at").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        joined("intervals"), joined("items"), joined("near_items"),
    ).drop("segment", "at")


def covered(intervals: str) -> str:
    """SQL: how many places the intervals cover together."""
    return (
        f"aggregate(array_sort({intervals}), named_struct('n', 0L, 'upto', 0L), (a, x) -> named_struct("
        "'n', a.n + greatest(0L, x.end - greatest(x.start, a.upto)), 'upto', greatest(a.upto, x.end)), a -> a.n)"
    )


def judge(found: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and n_near_items.

    A null text has no words; a document without words has no hits. Items without an id count as hits but are not
    listed. n_near_items counts items that only match with words a few places off.
    """
    return found.selectExpr(
        "doc_id", "n_words", f"{covered('intervals')} AS n_hit", "array_sort(array_distinct(items)) AS items",
        "array_except(near_items, items) AS near",
    ).selectExpr(
        "doc_id", "n_words", "n_hit", "CAST(size(items) AS BIGINT) AS n_items",
        "sha2(array_join(items, ','), 256) AS items_sha256", f"n_hit > 0 AND {SHARE} * n_hit >= n_words AS contaminated",
        "CAST(size(near) AS BIGINT) AS n_near_items",
    )


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Index the documents, search the benchmark and judge every document. Repeated rows each get their row."""
    judged = judge(find(build_index(docs, key, text), benchmark))
    return judged.withColumnRenamed("doc_id", key)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    The verdict hangs on the text alone, so that texts stand for their documents: different texts are indexed by
    their SHA-256, and documents with a contaminated one go.
    """
    name = "_text_sha256"
    digest = F.sha2(F.encode(F.col(text), "UTF-8"), 256)
    judged = contamination(docs.select(digest.alias(name), F.col(text).alias("text")), benchmark, name, "text")
    bad = judged.where("contaminated").select(name).distinct()
    return docs.join(bad, digest == bad[name], "left_anti")
