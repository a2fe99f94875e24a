"""Alignment of two tokenizers' tokens over all texts, with corpus-wide counts of the id pairs that overlap.

The first pass tokenizes, aligns and gives each task's different pairs. A tree of merges finds the different pairs of the
corpus, a minimal perfect hash numbers them, and the tasks' counts, as dense vectors over those numbers, are summed up
a tree. The second pass aligns the tokens again and looks counts up; every key that is looked up is verified.

Pairs are dealt over SHARDS by their hash. A shard never has more than its share of all the pairs that two vocabularies
can form, and shards are looked up in blocks of bounded size, each broadcast by itself.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from cinderlog.llm.common import Batches, mapped, per_worker, raw
from cinderlog.llm.perfect import PerfectHash, mixed
from cinderlog.session import discard, freeze

#: Parts of the pairs, by hash.
SHARDS = 256
#: Task outputs, or sums, that are merged into one at each step up a tree.
FAN_IN = 16
#: Bytes of text that are aligned at once; a longer text is aligned by itself.
BLOCK = 4 << 20
#: Different pairs that a task holds before it hands them on.
PENDING = 4_000_000
#: Bytes of counts that are broadcast at once.
BLOCK_BYTES = 64 << 20

_PAIRS = "shard int, node bigint, keys binary, counts binary"
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


@dataclass(frozen=True)
class Vocabulary:
    """How texts become ids, and the bytes of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    pieces: list[bytes]

    @property
    def lengths(self) -> np.ndarray:
        return np.array([len(p) for p in self.pieces], np.int64)


def byte_vocabulary(folder: str | None = None) -> Vocabulary:
    """The vocabulary of byte_bpe_50k.json, read as ranks, which gives the same ids faster; texts get a leading blank."""
    import public_tokenizers as public
    import tiktoken

    with open(_path(folder, "byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    coder = tiktoken.Encoding("byte_bpe_50k", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return Vocabulary(lambda texts: [coder.encode_ordinary(" " + t) for t in texts], pieces)


def piece_vocabulary(folder: str | None = None) -> Vocabulary:
    """The vocabulary of piece_bpe_32k.model, which adds a leading blank itself."""
    import sentencepiece

    coder = sentencepiece.SentencePieceProcessor(model_file=_path(folder, "piece_bpe_32k.model"))

    def piece(i: int) -> bytes:
        name = coder.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", name)
        return bytes([int(byte[1], 16)]) if byte else name.replace("▁", " ").encode()

    return Vocabulary(lambda texts: coder.encode(texts, num_threads=1), [piece(i) for i in range(coder.get_piece_size())])


def _path(folder: str | None, name: str) -> str:
    import public_tokenizers as public

    return f"{folder}/{name}" if folder else public.path(name)


@dataclass(frozen=True)
class Names:
    """Each id in decimal with what may follow it."""

    comma: np.ndarray
    end: np.ndarray

    @staticmethod
    def of(size: int, end: bytes) -> Names:
        return Names(*(np.array([str(i).encode() + x for i in range(size)], object) for x in (b",", end)))


@dataclass(frozen=True)
class Aligned:
    """Tokens of some texts one after another: ids and the text of each; links as positions of tokens."""

    a: np.ndarray
    b: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray
    both: np.ndarray  # the byte offsets at which tokens of both end

    @property
    def link_text(self) -> np.ndarray:
        return self.text_a[self.links_a]


def align(a: list[np.ndarray], b: list[np.ndarray], lengths: tuple[np.ndarray, np.ndarray]) -> Aligned:
    """Align the tokens of texts; of each text both have the same bytes, so that texts can simply be put together."""
    ids = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b)]
    texts = [np.repeat(np.arange(len(x)), [len(t) for t in x]) for x in (a, b)]
    ends = [np.cumsum(n[x]) for n, x in zip(lengths, ids, strict=True)]
    size = int(ends[0][-1]) + 1 if len(ends[0]) else 1
    marks = np.zeros((2, size), bool)
    for mark, end in zip(marks, ends, strict=True):
        mark[end] = True
    # up to each end of any token runs one link, between the tokens that end there or next
    at = np.flatnonzero(marks[0] | marks[1])
    before = [np.cumsum(m, dtype=np.int32) for m in marks]
    links = [n[at] - m[at] for n, m in zip(before, marks, strict=True)]
    return Aligned(*ids, *texts, *ends, *links, np.flatnonzero(marks[0] & marks[1]))


def group_texts(found: Aligned, texts: int, names: tuple[Names, Names]) -> list[bytes]:
    """The groups of each text as `a1,a2|b1;a3|b2,b3`."""
    last = [np.isin(e, found.both, assume_unique=True) for e in (found.ends_a, found.ends_b)]
    group = [np.cumsum(x) - x for x in last]
    sizes = [np.bincount(g, minlength=len(found.both)) for g in group]
    upto = [np.cumsum(n) for n in sizes]
    # a token stands behind those of its own side before it and the other side's of the groups before, or up to, its own
    places = (np.arange(len(found.a)) + (upto[1] - sizes[1])[group[0]], np.arange(len(found.b)) + upto[0][group[1]])
    out = np.empty(len(found.a) + len(found.b), object)
    for place, ids, ends, name in zip(places, (found.a, found.b), last, names, strict=True):
        out[place] = np.where(ends, name.end[ids], name.comma[ids])
    tokens = sum(np.bincount(t, minlength=texts) for t in (found.text_a, found.text_b))
    cuts = np.append(0, np.cumsum(tokens)).tolist()
    out = out.tolist()
    return [b"".join(out[i:j])[:-1] for i, j in zip(cuts, cuts[1:], strict=False)]


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    begin, n = 0, 0
    for i, size in enumerate(sizes):
        n += size
        if n >= BLOCK or i == len(sizes) - 1:
            yield begin, i + 1
            begin, n = i + 1, 0


class _Side:
    """What a worker keeps of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary, end: bytes) -> None:
        self.vocabulary, self.lengths = vocabulary, vocabulary.lengths
        self.names = Names.of(len(vocabulary.pieces), end)

    def tokens(self, texts: list[str], wanted: list[bytes]) -> list[np.ndarray | None]:
        """The ids of each text, or None where their bytes are not those wanted."""
        ids = [np.array(x, np.int64) for x in self.vocabulary.encode(texts)]
        pieces = self.vocabulary.pieces
        same = all(int(self.lengths[x].sum()) == len(w) for x, w in zip(ids, wanted, strict=True))
        if same and b"".join([pieces[i] for x in ids for i in x.tolist()]) == b"".join(wanted):
            return ids
        return [x if b"".join([pieces[i] for i in x.tolist()]) == w else None for x, w in zip(ids, wanted, strict=True)]


def _sides(folder: str | None) -> tuple[_Side, _Side]:
    return per_worker(
        f"sides {folder}", lambda: (_Side(byte_vocabulary(folder), b"|"), _Side(piece_vocabulary(folder), b";"))
    )


def _packed(ids: np.ndarray) -> bytes:
    return zstandard.compress(ids.astype("<u2").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<u2").astype(np.int64)


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A pair of 16-bit ids as one number."""
    return a << 16 | b


def shard_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1_000) % np.uint64(SHARDS)).astype(np.int64)


def _by_shard(keys: np.ndarray, *values: np.ndarray) -> Iterator[tuple]:
    shards = shard_of(keys)
    order = np.argsort(shards, kind="stable")
    cuts = np.searchsorted(shards[order], np.arange(SHARDS + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        some = order[cuts[s]:cuts[s + 1]]
        yield int(s), keys[some], *(v[some] for v in values)


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    codes, unique = pd.factorize(keys)
    return unique, np.bincount(codes, weights, len(unique)).astype(np.int64)


def _first_pass(folder: str | None, with_groups: bool):
    """Task code: (row, id, text) to a row for each text, and rows of pairs and their counts by shard."""
    def task(batches: Batches) -> Batches:
        sides = _sides(folder)
        lengths, names = tuple(s.lengths for s in sides), tuple(s.names for s in sides)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        kind = None

        def texts_of(part: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal held
            texts = part.column(2).to_pylist()
            some = [i for i, t in enumerate(texts) if t]
            wanted = [b" " + raw(texts[i]) for i in some]
            ids = [s.tokens([texts[i] for i in some], wanted) for s in sides]
            a, b = ([np.zeros(0, np.int64)] * len(texts) for _ in sides)
            for i, x, y in zip(some, *ids, strict=True):
                if x is not None and y is not None:
                    a[i], b[i] = x, y
            found = align(a, b, lengths)
            held.append(_counted(pair_keys(found.a[found.links_a], found.b[found.links_b])))
            groups = group_texts(found, len(texts), names)
            spread = np.searchsorted(found.ends_a, found.both)
            counts = (found.text_a, found.text_b, found.text_a[spread], found.link_text)
            return pa.RecordBatch.from_pydict({
                "row": part.column(0), "id": part.column(1),
                **{n: np.bincount(c, minlength=len(texts)).astype(np.int64) for n, c in zip(_COUNTS, counts, strict=True)},
                "groups_sha256": [hashlib.sha256(g).hexdigest() if g else "" for g in groups],
                "groups": pa.array([g.decode() if with_groups else None for g in groups], pa.string()),
                "a": pa.array([_packed(x) for x in a], pa.binary()), "b": pa.array([_packed(x) for x in b], pa.binary()),
                **_nulls(len(texts), shard=pa.int32(), keys=pa.binary(), counts=pa.binary()),
            })

        def pairs() -> pa.RecordBatch:
            nonlocal held
            keys, counts = _counted(*(np.concatenate(x) for x in zip(*held, strict=True)))
            rows = [(s, k.astype("<u4").tobytes(), n.astype("<i8").tobytes()) for s, k, n in _by_shard(keys, counts)]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            held = []
            return pa.RecordBatch.from_pydict({
                **_nulls(len(rows), row=pa.int64(), id=kind, **{n: pa.int64() for n in _COUNTS}, groups_sha256=pa.string(),
                         groups=pa.string(), a=pa.binary(), b=pa.binary()),
                "shard": pa.array(columns[0], pa.int32()), "keys": pa.array(columns[1], pa.binary()),
                "counts": pa.array(columns[2], pa.binary()),
            })

        for batch in batches:
            kind = batch.schema.field(1).type
            sizes = [len(t or "") for t in batch.column(2).to_pylist()]
            for i, j in _blocks(sizes):
                yield texts_of(batch.slice(i, j - i))
                if len(held) > 64:
                    held = [_counted(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                if sum(len(k) for k, _ in held) > PENDING:
                    yield pairs()
        if held:
            yield pairs()

    return task


def _nulls(n: int, **kinds: pa.DataType) -> dict[str, pa.Array]:
    return {name: pa.nulls(n, kind) for name, kind in kinds.items()}


def _up(rows: DataFrame, merge: Callable[[pa.Table], list], names: list[str], schema: str, keep: DataFrame | None = None) -> DataFrame:
    """Merge rows (shard, node, ...) up a tree, FAN_IN nodes to one, until each shard has one row."""
    kept: list[DataFrame] = []
    n = (rows.agg(F.max("node")).first()[0] or 0) + 1

    def task(group: pa.Table) -> pa.Table:
        head = [group.column("shard")[0].as_py(), group.column("node")[0].as_py()]
        row = [*head, *merge(group)]
        return pa.Table.from_pydict({x: [v] for x, v in zip(["shard", "node", *names], row, strict=True)}, schema=pa.schema([
            ("shard", pa.int32()), ("node", pa.int64()), *((x, pa.binary()) for x in names)
        ]))

    while True:
        grouped = rows.withColumn("node", F.expr(f"node DIV {FAN_IN}")).groupBy("shard", "node")
        rows, n = freeze(grouped.applyInArrow(task, schema), "merged"), -(-n // FAN_IN)
        discard(*kept)
        if n == 1:
            return rows
        kept = [rows]


def _keys(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4").astype(np.int64)


def _merge_keys(group: pa.Table) -> list:
    return [np.unique(np.concatenate([_keys(k) for k in group.column("keys").to_pylist()])).astype("<u4").tobytes()]


def _number(batches: Batches) -> Batches:
    """Task code: the different keys of shards to their perfect hash, and the keys in its order."""
    for batch in batches:
        rows = []
        for shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keys = _keys(data)
            found = PerfectHash.of(keys)
            placed = np.zeros(len(keys), "<u4")
            placed[found.index(keys)] = keys
            rows.append((shard, found.words.astype("<u8").tobytes(), list(found.ends), placed.tobytes()))
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = (pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["shard", "words", "ends", "placed"]
        )


def _hash_of(words: bytes, ends: list[int]) -> PerfectHash:
    return PerfectHash.from_words(np.frombuffer(words, "<u8"), tuple(ends))


def _add(group: pa.Table) -> list:
    """One dense vector of a shard's counts: from the tasks' pairs at first, then from the vectors below."""
    total = None
    for row in group.to_pylist():
        if row["vector"] is None:
            found = _hash_of(row["words"], row["ends"])
            vector = np.zeros(int(np.bitwise_count(found.words).sum()), np.int64)
            vector[found.index(_keys(row["keys"]))] = np.frombuffer(row["counts"], "<i8")
        else:
            vector = np.frombuffer(row["vector"], "<i8")
        total = vector if total is None else total + vector
    return [total.astype("<i8").tobytes()]


def _best(batches: Batches) -> Batches:
    """Task code: (placed, vector) of shards to the highest count of each B id."""
    for batch in batches:
        best = np.zeros(1 << 16, np.int64)
        for placed, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            np.maximum.at(best, _keys(placed) & 0xFFFF, np.frombuffer(vector, "<i8"))
        there = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(best[there])], names=["b", "n"])


@dataclass(frozen=True)
class _Lookup:
    """Counts of the pairs of some shards."""

    shards: dict[int, tuple[PerfectHash, np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: list) -> _Lookup:
        return _Lookup({
            r["shard"]: (_hash_of(r["words"], r["ends"]), np.frombuffer(r["placed"], "<u4"), np.frombuffer(r["vector"], "<i8"))
            for r in rows
        })

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The count of each of different keys; 0 for those of other shards."""
        found = np.zeros(len(keys), np.int64)
        for shard, own, place in _by_shard(keys, np.arange(len(keys))):
            if shard not in self.shards:
                continue
            numbers, placed, vector = self.shards[shard]
            at = numbers.index(own)
            if not np.array_equal(placed[at], own):
                raise ValueError("a pair that was not counted")
            found[place] = vector[at]
        return found


def _second_pass(block, best, folder: str | None):
    """Task code: (row, a, b) to (row, n_best, count_sum) over the pairs of a block of shards."""
    def task(batches: Batches) -> Batches:
        lookup, highest = _Lookup.of(block.value), best.value
        lengths = tuple(s.lengths for s in _sides(folder))
        for batch in batches:
            packed = [batch.column(i).to_pylist() for i in (1, 2)]
            for i, j in _blocks([2 * len(x) for x in packed[0]]):
                a, b = ([_unpacked(x) for x in p[i:j]] for p in packed)
                found = align(a, b, lengths)
                codes, keys = pd.factorize(pair_keys(found.a[found.links_a], found.b[found.links_b]))
                counts = lookup.counts(keys)
                top = (counts > 0) & (counts == highest[keys & 0xFFFF])
                sums = [np.zeros(j - i, np.int64) for _ in range(2)]
                for total, values in zip(sums, (top.astype(np.int64), counts), strict=True):
                    np.add.at(total, found.link_text, values[codes])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *map(pa.array, sums)], names=["row", "n_best", "count_sum"]
                )

    return task


def _count_pairs(pairs: DataFrame) -> DataFrame:
    """(shard, words, ends, placed, vector) of the pairs of the table `pairs` (shard, node, keys, counts)."""
    merged = _up(pairs.select("shard", "node", "keys"), _merge_keys, ["keys"], "shard int, node bigint, keys binary")
    numbers = freeze(mapped(
        merged.select("shard", "keys"), _number, "shard int, words binary, ends array<int>, placed binary"
    ), "perfect-hash")
    first = pairs.join(numbers.drop("placed"), "shard").withColumn("vector", F.lit(None).cast("binary"))
    vectors = _up(first, _add, ["vector"], "shard int, node bigint, vector binary")
    return freeze(numbers.join(vectors.drop("node"), "shard"), "pair-counts")


def pair_table(counts: DataFrame) -> DataFrame:
    """(a, b, n) of every pair."""
    def task(batches: Batches) -> Batches:
        for batch in batches:
            for placed, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys = _keys(placed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys >> 16), pa.array(keys & 0xFFFF), pa.array(np.frombuffer(vector, "<i8"))], names=["a", "b", "n"]
                )

    return mapped(counts.select("placed", "vector"), task, "a bigint, b bigint, n bigint")


@dataclass(frozen=True)
class Alignment:
    """A row for each document, and the corpus-wide counts as `pair_table` reads them."""

    documents: DataFrame
    counts: DataFrame


def alignment(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizers: str | None = None, with_groups: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> Alignment:
    """Align the tokens of both vocabularies in every text.

    One row per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256; with `with_groups` also
    groups, the groups' ids as text. A text that is null, empty or not spelled by the tokens of both has no tokens: zeros
    and an empty digest. Repeated rows count as often as they come. A task holds some 40 bytes for each byte of the
    longest text. `tokenizers` is the folder of the vocabularies, if they are not in their usual place.
    """
    spark = docs.sparkSession
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    schema = (
        f"row bigint, id {kind}, {', '.join(f'{n} bigint' for n in _COUNTS)}, groups_sha256 string, groups string, "
        "a binary, b binary, shard int, keys binary, counts binary"
    )
    read = mapped(given, _first_pass(tokenizers, with_groups), schema).withColumn("node", F.spark_partition_id().cast("bigint"))
    read = freeze(read, "tokens")
    pairs = read.where("shard IS NOT NULL").select(*(c.split()[0] for c in _PAIRS.split(", ")))
    counts = _count_pairs(pairs)
    best = np.zeros(1 << 16, np.int64)
    # one row for each id of the second vocabulary
    for r in mapped(counts.select("placed", "vector"), _best, "b int, n bigint").groupBy("b").agg(F.max("n").alias("n")).collect():
        best[r["b"]] = r["n"]
    best = spark.sparkContext.broadcast(best)

    texts = read.where("shard IS NULL")
    sized = counts.select("shard", F.expr("octet_length(words) + octet_length(placed) + octet_length(vector)").alias("n"))
    blocks: list[list[int]] = []
    room = 0
    for r in sized.orderBy("shard").collect():  # SHARDS rows at most
        if not blocks or r["n"] > room:
            blocks.append([])
            room = block_bytes
        blocks[-1].append(r["shard"])
        room -= r["n"]
    sums = []
    for shards in blocks or [[]]:
        block = spark.sparkContext.broadcast(counts.where(F.col("shard").isin(shards)).collect())
        some = mapped(texts.select("row", "a", "b"), _second_pass(block, best, tokenizers), "row bigint, n_best bigint, count_sum bigint")
        sums.append(freeze(some, "sums"))
        block.destroy()
    found = sums[0]
    for more in sums[1:]:
        found = found.unionByName(more)
    found = found.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    names = [*_COUNTS, "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else [])]
    rows = texts.drop("a", "b").join(found, "row").select(F.col("id").alias(key), *names)
    return Alignment(rows, counts)
