"""Quality rules: gradient-boosted trees over document statistics.

The trees are grown here, on a bounded sample of labelled documents, and flattened into node arrays that
score a whole batch of documents at once. A feature may be tied to a direction: the score then never rises
(or never falls) with it, whatever the others are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cinderlog.llm.common import BLANKS, Batches, filtered, labelled_sample, mapped, raw

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Labelled documents that training uses at most.
TRAINING_DOCUMENTS = 20_000

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))

#: Each feature with the direction its score is held to: -1 never rises with it, 0 free.
FEATURES = (
    ("log_words", 0), ("word_length", 0), ("symbol_share", -1), ("dup_line_share", -1), ("repeat_share", -1),
    ("upper_share", -1), ("distinct_share", 0), ("digit_share", 0), ("shout_share", -1), ("pipe_share", -1),
    ("stutter_share", -1), ("line_share", 0), ("period_share", 0),
)
DIRECTIONS = tuple(d for _, d in FEATURES)

COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def repeated_words(ids: np.ndarray, width: int = WINDOW) -> int:
    """How many of the words lie in a window of `width` (a power of two) words found twice or more."""
    span, ranks, counts = 1, ids, None
    while span < width:
        if len(ranks) <= span:
            return 0
        pairs = ranks[:-span] * (int(ranks.max()) + 1) + ranks[span:]
        _, ranks, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(counts) == len(pairs):
            return 0
        span *= 2
    starts = np.flatnonzero(counts[ranks] > 1)
    marks = np.zeros(len(ids) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(marks[:-1])))


def without(data: bytes, drop: bytes) -> int:
    """How many bytes of `data` are among `drop`."""
    return len(data) - len(data.translate(None, drop))


def measure(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The five counts and the features of a text; a null text has none of anything."""
    text = text or ""
    data = raw(text)
    words = data.split()
    n = len(words)
    if not n:
        return (0, 0, without(data, SYMBOLS), 0, 0), (0.0,) * len(FEATURES)
    table = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(table.__getitem__, words), np.int64, n)
    word_chars = len(text) - without(data, BLANKS)
    symbols = without(data, SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(ids)
    letters = without(data, _LETTERS)
    features = (
        float(np.log1p(n)), word_chars / n, symbols / word_chars, dup_lines / max(1, len(lines)), repeats / n,
        without(data, _UPPER) / max(1, letters), len(table) / n, without(data, _DIGITS) / word_chars,
        data.count(b"!") / n, data.count(b"|") / n, float(np.count_nonzero(ids[1:] == ids[:-1])) / n,
        len(lines) / n, data.count(b".") / n,
    )
    return (n, word_chars, symbols, dup_lines, repeats), features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


@dataclass(frozen=True)
class Forest:
    """All trees in one set of node arrays; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of good quality for each row of features."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                goes_left = rows[every, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _best_split(bins, grad, hess, members, directions, low, high, cuts, ridge, least):
    """The split with the most gain that keeps every direction: (gain, feature, bin, left value, right value)."""
    best = None
    g_all, h_all = grad[members].sum(), hess[members].sum()
    for f in range(bins.shape[1]):
        size = len(cuts[f]) + 1
        if size < 2:
            continue
        own = bins[members, f]
        g = np.cumsum(np.bincount(own, grad[members], size))[:-1]
        h = np.cumsum(np.bincount(own, hess[members], size))[:-1]
        n = np.cumsum(np.bincount(own, minlength=size))[:-1]
        left = np.clip(-g / (h + ridge), low, high)
        right = np.clip(-(g_all - g) / (h_all - h + ridge), low, high)
        gain = -(g * left + 0.5 * (h + ridge) * left**2) - (
            (g_all - g) * right + 0.5 * (h_all - h + ridge) * right**2
        )
        bad = (n < least) | (len(members) - n < least)
        if directions[f]:
            bad |= (right - left) * directions[f] < 0
        gain = np.where(bad, -np.inf, gain)
        at = int(np.argmax(gain))
        if np.isfinite(gain[at]) and (best is None or gain[at] > best[0] + 1e-12):
            best = (gain[at], f, at, left[at], right[at])
    return best


def grow(
    rows: np.ndarray, good: np.ndarray, directions=DIRECTIONS, trees: int = 40, depth: int = 3, rate: float = 0.2,
    max_bins: int = 64, ridge: float = 1.0, least: int = 5,
) -> Forest:
    """Boost `trees` regression trees on the logistic loss. Without labels of both kinds every row is kept."""
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, max_bins + 1)[1:-1])) if len(rows) else np.empty(0)
            for f in range(len(directions))]
    bins = np.stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(cuts)], 1) if len(rows) else None
    share = float(np.clip(good.mean(), 1e-3, 1 - 1e-3)) if len(good) else 1.0
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

    def node() -> int:
        at = len(nodes["value"])
        for key, value in (("feature", 0), ("threshold", np.inf), ("left", at), ("right", at), ("value", 0.0)):
            nodes[key].append(value)
        return at

    if not len(good) or good.min() == good.max():
        root = node()
        return Forest(np.array([root]), *(np.array(nodes[k]) for k in nodes), base=30.0 * (share > 0.5), depth=1)
    base = float(np.log(share / (1 - share)))
    total, roots = np.full(len(rows), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - good, p * (1 - p)
        roots.append(node())
        value = np.clip(-grad.sum() / (hess.sum() + ridge), -4, 4)
        open_nodes = [(roots[-1], np.arange(len(rows)), -4.0, 4.0, value)]
        for level in range(depth + 1):
            following = []
            for at, members, low, high, value in open_nodes:
                nodes["value"][at] = rate * value
                split = level < depth and _best_split(bins, grad, hess, members, directions, low, high, cuts, ridge, least)
                if not split:
                    total[members] += rate * value
                    continue
                _, f, cut, left, right = split
                # below a directed split both sides stay on their side of the middle
                middle = (left + right) / 2
                bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(
                    directions[f], ((low, high), (low, high))
                )
                goes_left = bins[members, f] <= cut
                nodes["feature"][at], nodes["threshold"][at] = f, float(cuts[f][cut])
                for side, mask, side_value, bound in (
                    ("left", goes_left, left, bounds[0]), ("right", ~goes_left, right, bounds[1])
                ):
                    child = node()
                    nodes[side][at] = child
                    following.append((child, members[mask], *bound, side_value))
            open_nodes = following
    return Forest(np.array(roots), *(np.array(nodes[k]) for k in nodes), base=base, depth=depth)


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_DOCUMENTS) -> Forest:
    """Fit on at most `bound` labelled documents; labels has doc_id and quality (0 or 1)."""
    sample = labelled_sample(labels, "doc_id", ["quality"], bound)

    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Batches) -> Batches:
        for batch in batches:
            rows = [measure(t)[1] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64())), batch.column(2).cast(pa.int32())],
                names=["doc_id", "features", "quality"],
            )

    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "quality")
    # of rows with one doc_id one counts, so that no more than the bound come to the driver
    found = mapped(known, task, f"doc_id {kind}, features array<double>, quality int").groupBy("doc_id").agg(
        F.min(F.struct("features", "quality")).alias("row")
    ).select("row.*").toArrow()
    rows = np.array(found.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
    good = (found.column("quality").to_numpy() > 0).astype(float)
    order = np.lexsort((good, *rows.T))  # the same trees in whatever order the rows come
    return grow(rows[order], good[order])


def _judged(texts: list[str | None], forest: Forest) -> tuple[list, np.ndarray, np.ndarray]:
    measured = [measure(t) for t in texts]
    counts = [m[0] for m in measured]
    failed = np.array([base_failed(c[0], c[4]) for c in counts], bool)
    score = forest.score(np.array([m[1] for m in measured], float).reshape(-1, len(FEATURES)))
    return counts, failed, score


def assess(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its counts, base_failed, quality_score and kept.

    A null or empty text has no words and fails the base rules. Repeated rows each get their row; other
    columns of `docs` are not read. An empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()

    def task(batches: Batches) -> Batches:
        for batch in batches:
            counts, failed, score = _judged(batch.column(1).to_pylist(), forest)
            columns = list(np.array(counts, np.int64).reshape(-1, 5).T)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns), pa.array(failed), pa.array(~failed & (score >= 0.5)),
                 pa.array(score)],
                names=[key, *(c.split()[0] for c in COUNTS.split(", ")), "base_failed", "kept", "quality_score"],
            )

    return mapped(
        docs.select(key, text), task,
        f"`{key}` {kind}, {COUNTS}, base_failed boolean, kept boolean, quality_score double",
    )


def keep_good(docs: DataFrame, forest: Forest, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    def keep(batch: pa.RecordBatch) -> np.ndarray:
        _, failed, score = _judged(batch.column(text).to_pylist(), forest)
        return ~failed & (score >= 0.5)

    return filtered(docs, keep)
