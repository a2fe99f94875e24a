"""Toxicity by a classifier chain: one linear model for each category, in turn.

A model reads the words of a document and the probabilities of all earlier categories. Those are made out of
fold in training: a document's probability comes from a model that has not seen it, as at prediction time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cinderlog.llm.common import Batches, labelled_sample, mapped
from cinderlog.session import freeze

#: Buckets that words are hashed into.
BUCKETS = 1 << 20
#: Labelled documents that training uses at most.
TRAINING_DOCUMENTS = 10_000
#: Words that the models may use at most: those that go most with a category, over a least chi-square.
WORDS = 4_096
LEAST_CHI_SQUARE = 12.0
FOLDS = 3
ROUNDS = 250
#: Weight of the sum of absolute weights in the loss.
SPARSITY = 2e-4

#: Words count by their beginnings too, of these lengths, and by whether a beginning comes once, twice or more.
PREFIXES = (4, 5, 6, 7)
REPEATS = 3
#: Words without features, words with some, and beginnings that a task remembers, of each at most so many.
MEMORY = 300_000
_ENDINGS = tuple(f" {k}".encode() for k in range(1, REPEATS + 1))

_WORD = re.compile(r"[^\W\d_]+")


def _bucket(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % BUCKETS


def _counted(text: str | None) -> Counter:
    """Words of letters, lower case, with how often they come."""
    return Counter(_WORD.findall((text or "").lower()))


def _repeats(prefix: str) -> list[int]:
    """The buckets of a beginning that comes at least once, twice, and so on."""
    start = zlib.crc32(prefix.encode("utf-8", "surrogatepass"))
    return [zlib.crc32(ending, start) % BUCKETS for ending in _ENDINGS]


def buckets_of(text: str | None) -> list[int]:
    """Buckets of the different words of a text and of their beginnings."""
    counts, starts = _counted(text), Counter()
    for word, n in counts.items():
        for size in PREFIXES:
            if len(word) > size:
                starts[word[:size]] += n
    found = {_bucket(word) for word in counts}
    for prefix, n in starts.items():
        found.update(_repeats(prefix)[:n])
    return sorted(found)


def _kept(memory: dict, key: str, value: tuple) -> tuple:
    """Remember a value; a full memory begins anew."""
    if len(memory) >= MEMORY:
        memory.clear()
    memory[key] = value
    return value


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Rows:
    """Documents as sparse rows of column numbers, plus dense columns."""

    def __init__(self, columns: Sequence[Sequence[int]], width: int):
        self.row = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
        self.column = np.fromiter((x for c in columns for x in c), np.int64, len(self.row))
        self.n, self.width = len(columns), width

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.n)

    def times_transposed(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, values[self.row], self.width)


def _chained(earlier: np.ndarray) -> np.ndarray:
    """Earlier probabilities as a model reads them: log odds within bounds."""
    p = np.clip(earlier, 0.01, 0.99)
    return np.log(p / (1 - p)) / 2


def fit(rows: Rows, earlier: np.ndarray, target: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sparse logistic regression on the rows marked by `use`: word weights, weights of earlier categories, bias.

    Accelerated proximal gradient; columns are scaled to equal spread.
    """
    n = max(1, int(use.sum()))
    share = rows.times_transposed(use.astype(float)) / n
    scale = 1 / np.sqrt(np.clip(share * (1 - share), 1 / n, None))
    dense = np.hstack([_chained(earlier), np.ones((rows.n, 1))])
    width = rows.width

    def forward(w: np.ndarray) -> np.ndarray:
        return rows.times(w[:width] * scale) + dense @ w[width:]

    def backward(r: np.ndarray) -> np.ndarray:
        r = np.where(use, r, 0) / n
        return np.append(rows.times_transposed(r) * scale, dense.T @ r)

    w = np.ones(width + dense.shape[1])
    for _ in range(15):  # the largest curvature, by power iteration
        w = backward(forward(w))
        top = float(np.linalg.norm(w)) or 1.0
        w = w / top
    step = 1 / (0.25 * top * 1.05 + 1e-9)
    w, ahead, t = np.zeros_like(w), np.zeros_like(w), 1.0
    limit = np.append(np.full(width, SPARSITY * step), np.zeros(dense.shape[1]))
    for _ in range(ROUNDS):
        moved = ahead - step * backward(_sigmoid(forward(ahead)) - target)
        new = np.sign(moved) * np.maximum(np.abs(moved) - limit, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        w, ahead = new, new + (before - 1) / t * (new - w)
    return w[:width] * scale, w[width:-1], float(w[-1])


@dataclass(frozen=True)
class Chain:
    """Categories in order, and for each the weights of words, of earlier categories, and the bias."""

    categories: tuple[str, ...]
    columns: dict[int, int]
    words: np.ndarray
    earlier: tuple[np.ndarray, ...]
    bias: np.ndarray

    def _repeated(self, prefix: str, memory: dict) -> tuple[tuple[int, int], ...]:
        """The columns of a beginning that comes at least so often, as pairs of a number and a column."""
        found = memory.get(prefix)
        if found is None:
            columns = ((k, self.columns.get(b)) for k, b in enumerate(_repeats(prefix), 1))
            found = _kept(memory, prefix, tuple((k, c) for k, c in columns if c is not None))
        return found

    def read(self, text: str | None, memory: dict) -> list[int]:
        """The columns of a text, as `buckets_of` has them; most words have none, which `memory` knows."""
        plain, known, beginnings = (memory.setdefault(part, kind()) for part, kind in (("plain", set), ("known", dict), ("beginnings", dict)))
        counts = _counted(text)
        found, starts = set(), Counter()
        for word in set(counts) - plain:
            own = known.get(word)
            if own is None:
                prefixes = tuple([p for size in PREFIXES if len(word) > size and self._repeated(p := word[:size], beginnings)])
                own = self.columns.get(_bucket(word)), prefixes
                if own == (None, ()):
                    if len(plain) >= MEMORY:
                        plain.clear()
                    plain.add(word)
                    continue
                _kept(known, word, own)
            column, prefixes = own
            if column is not None:
                found.add(column)
            for prefix in prefixes:
                starts[prefix] += counts[word]
        for prefix, n in starts.items():
            for k, column in self._repeated(prefix, beginnings):
                if k <= n:
                    found.add(column)
        return sorted(found)

    def predict(self, texts: list[str | None], memory: dict | None = None) -> np.ndarray:
        """The probability of each category for each text."""
        memory = {} if memory is None else memory
        columns = [self.read(t, memory) for t in texts]
        rows = Rows(columns, len(self.columns))
        found = np.zeros((len(texts), 0))
        for k in range(len(self.categories)):
            score = rows.times(self.words[k]) + _chained(found) @ self.earlier[k] + self.bias[k]
            found = np.hstack([found, _sigmoid(score)[:, None]])
        return found


def fit_chain(categories: Sequence[str], buckets: list[list[int]], targets: np.ndarray, chosen: list[int]) -> Chain:
    """Fit the models in order; a category that all documents have, or none, has that as its probability."""
    columns = {b: i for i, b in enumerate(chosen)}
    rows = Rows([[columns[b] for b in own if b in columns] for own in buckets], len(columns))
    fold = np.arange(rows.n) % FOLDS
    seen = np.zeros((rows.n, 0))
    words, earlier, bias = [], [], []
    for k in range(len(categories)):
        target = targets[:, k] if rows.n else np.zeros(0)
        if not rows.n or target.min() == target.max():
            words.append(np.zeros(len(columns)))
            earlier.append(np.zeros(k))
            bias.append(-30.0 if not rows.n or target.max() == 0 else 30.0)
            out = target
        else:
            out = np.zeros(rows.n)
            for f in range(FOLDS):
                w, e, b = fit(rows, seen, target, fold != f)
                out = np.where(fold == f, _sigmoid(rows.times(w) + _chained(seen) @ e + b), out)
            w, e, b = fit(rows, seen, target, np.ones(rows.n, bool))
            words.append(w)
            earlier.append(e)
            bias.append(b)
        seen = np.hstack([seen, out[:, None]])
    return Chain(tuple(categories), columns, np.array(words).reshape(len(categories), len(columns)), tuple(earlier), np.array(bias))


def train(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str], key: str = "doc_id", text: str = "text",
    bound: int = TRAINING_DOCUMENTS,
) -> Chain:
    """Fit on at most `bound` labelled documents. `categories` gives each category, in chain order, as SQL over labels."""
    names = list(categories)
    marked = labels.select(key, *[F.expr(f"CAST({sql} AS int)").alias(name) for name, sql in categories.items()])
    sample = labelled_sample(marked, key, names, bound)
    known = docs.select(F.col(key), F.col(text).alias("_text")).join(F.broadcast(sample), key).select(key, *names, "_text")
    kind = docs.schema[key].dataType.simpleString()

    def read(batches: Batches) -> Batches:
        for batch in batches:
            own = pa.array([buckets_of(t) for t in batch.columns[-1].to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], own], names=[*batch.schema.names[:-1], "buckets"])

    numbers = ", ".join(f"`{n}` int" for n in names)
    rows = freeze(mapped(known, read, f"`{key}` {kind}, {numbers}, buckets array<int>"), "labelled")
    counts = rows.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    total = max(1, counts["n"])
    tests = []
    for n in names:
        positive = counts[n]
        tests.append(
            f"{total} * pow(`{n}` * {total}D - n * {positive}D, 2) / "
            f"greatest(1D, n * ({total}D - n) * {positive}D * ({total}D - {positive}D))"
        )
    best = rows.select(F.explode("buckets").alias("bucket"), *names).groupBy("bucket").agg(
        F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names]
    ).where("n >= 3").select("bucket", F.expr(f"greatest({', '.join([*tests, '0D'])})").alias("chi_square"))
    chosen = [r["bucket"] for r in best.where(F.col("chi_square") >= LEAST_CHI_SQUARE).orderBy(
        F.desc("chi_square"), "bucket"
    ).limit(WORDS).collect()]
    kept = set(chosen)

    def narrow(batches: Batches) -> Batches:
        for batch in batches:
            own = [[b for b in x if b in kept] for x in batch.columns[-1].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(own, pa.list_(pa.int32()))], names=batch.schema.names)

    # of rows with one key one counts, so that no more than the bound come to the driver
    found = mapped(rows, narrow, rows.schema).groupBy(key).agg(
        F.min(F.struct("buckets", *names)).alias("row")
    ).orderBy(F.xxhash64(key), key).select("row.*").toArrow()
    targets = np.stack([found.column(n).to_numpy() for n in names], 1).astype(float)
    return fit_chain(names, found.column("buckets").to_pylist(), targets, chosen)


def score(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key and p_<category> for each category. A null or empty text has no words; repeated rows
    each get their row."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(chain)
    names = [key, *[f"p_{c}" for c in chain.categories]]

    def task(batches: Batches) -> Batches:
        memory: dict = {}
        for batch in batches:
            found = held.value.predict(batch.column(1).to_pylist(), memory)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found.T.copy())], names=names)

    return mapped(rows, task, ", ".join([f"`{key}` {kind}", *[f"`{n}` double" for n in names[1:]]]))
