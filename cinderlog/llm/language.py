"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.llm.common import Batches, labelled_sample, mapped

#: n-grams that are counted, and the buckets they are hashed into.
ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
UNKNOWN = "und"
#: Labelled documents that training uses at most.
TRAINING_DOCUMENTS = 20_000
#: Characters that are scored at once.
CHUNK = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def grams(text: str) -> list[np.ndarray]:
    """Buckets of the n-grams of the whole lower-case text, one array for each order and stretch of the text.

    Stretches of CHUNK characters overlap, so that each n-gram comes once.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found = []
    for at in range(0, len(codes), CHUNK):
        for n in ORDERS:
            part = codes[at:at + CHUNK + n - 1]
            if len(part) < n:
                continue
            value = np.full(len(part) - n + 1, n, np.uint64)
            for i in range(n):
                value = (value ^ part[i:len(part) - n + 1 + i]) * _MIX
            found.append((value >> np.uint64(64 - 15)).astype(np.int32))
    return found


def gram_counts(text: str) -> np.ndarray:
    return sum((np.bincount(b, minlength=BUCKETS) for b in grams(text)), np.zeros(BUCKETS, np.int64))


@dataclass(frozen=True)
class Model:
    """Languages, and the logarithm of each bucket's share in each of them, buckets by languages."""

    languages: tuple[str, ...]
    log_share: np.ndarray
    log_prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its probability; `und` and 0 without letters or languages."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        for at, text in enumerate(texts):
            if not has_letter(text):
                continue
            total = self.log_prior.copy()
            for buckets in grams(text):
                # a sparse row of counts times the matrix
                counts = np.bincount(buckets, minlength=BUCKETS) if len(buckets) > BUCKETS else None
                total += counts @ self.log_share if counts is not None else self.log_share[buckets].sum(0, dtype=np.float64)
            share = np.exp(total - total.max())
            best = int(np.argmax(share))
            names[at], scores[at] = self.languages[best], float(share[best] / share.sum())
        return names, scores


def train(docs: DataFrame, held_out: Column, key: str = "doc_id", bound: int = TRAINING_DOCUMENTS) -> Model:
    """Count n-grams by language over at most `bound` documents that have a language and are not held out."""
    known = docs.where(~held_out & F.col("text").isNotNull())
    sample = labelled_sample(known, key, ["lang"], bound).select(key)

    def task(batches: Batches) -> Batches:
        counts: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.setdefault(lang, np.zeros(BUCKETS, np.int64))[:] += gram_counts(text)
                texts[lang] = texts.get(lang, 0) + 1
        for lang, own in counts.items():
            there = np.append(np.flatnonzero(own), -1)  # -1 counts the texts
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(there)), pa.array(there.astype(np.int32)),
                 pa.array(np.append(own[there[:-1]], texts[lang]))],
                names=["lang", "bucket", "n"],
            )

    chosen = known.where(F.col("lang").isNotNull()).join(F.broadcast(sample), key, "left_semi").select("text", "lang")
    rows = mapped(chosen, task, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")
    ).toArrow()
    names, buckets, n = (rows.column(c).to_numpy() for c in ("lang", "bucket", "n"))
    languages = tuple(sorted(set(names)))
    counts, texts = np.zeros((BUCKETS, len(languages))), np.zeros(len(languages))
    column = np.array([languages.index(x) for x in names], int)
    texts[column[buckets < 0]] = n[buckets < 0]
    counts[buckets[buckets >= 0], column[buckets >= 0]] = n[buckets >= 0]
    log_share = np.log(counts + SMOOTHING) - np.log((counts + SMOOTHING).sum(0))
    return Model(languages, log_share.astype(np.float32), np.log(texts / max(1, texts.sum())))


def held_out(key: str = "doc_id") -> Column:
    """A fifth of the documents, by the CRC of the key as text; a null key is not among them."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, lang_pred and score. Only the text decides on lang_pred and score.

    A null or empty text, or one without letters, is `und` with score 0. Repeated rows each get their row.
    """
    rows = docs.select(F.col(key).alias("id"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Batches) -> Batches:
        for batch in batches:
            names, scores = held.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[key, "held_out", "lang_pred", "score"],
            )

    return mapped(rows, task, f"`{key}` {kind}, held_out boolean, lang_pred string, score double")
