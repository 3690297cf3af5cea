"""Document quality by a regularised quadratic discriminant.

Each text becomes a vector of transformed statistics (shares of characters,
words and lines; logarithms of lengths; repetition). For each class the model
holds a mean and a covariance shrunk towards the pooled covariance and then
towards its diagonal; the score is the posterior from the difference of the two
Gaussian log-densities, whose Mahalanobis terms use Cholesky factors computed
once when the model is made.

Fitting needs each class's count, sum and sum of outer products only, which
tasks add up over all labelled rows; nothing is sampled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = (
    "log_chars", "log_words", "log_lines", "word_chars", "upper", "digit", "symbol", "comma_stop", "space", "newline",
    "beyond_ascii", "word_symbol_end", "symbol_kinds", "distinct_words", "top_word", "pair_repeats", "line_repeats",
    "same_next_word", "words_per_line", "upper_words", "stops_per_word", "char_entropy",
)
_CLASS = np.zeros(256, np.int64)  # 1 lower, 2 upper, 3 digit, 4 space, 5 newline, 6 .,;:?!'"()- 7 other symbol, 8 beyond ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[32], _CLASS[9], _CLASS[10], _CLASS[13] = 4, 4, 5, 5
_CLASS[33:48] = 7
_CLASS[[ord(c) for c in ".,;:?!'\"()-"]] = 6
_CLASS[[*range(60, 65), *range(91, 97), *range(123, 127)]] = 7
_CLASS[[ord(c) for c in ";:?"]] = 6
_CLASS[128:] = 8
_SYMBOLS = np.flatnonzero(_CLASS >= 6)[:40]


def statistics(raw: bytes) -> np.ndarray:
    """The transformed statistics of one text (``FEATURES``); finite for any text, also empty."""
    n = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if n else np.zeros(256, np.int64)
    by = np.bincount(_CLASS, weights=counts, minlength=9)
    total = max(1, n)
    words = raw.split()
    w = max(1, len(words))
    lines = raw.split(b"\n")
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    same = sum(map(bytes.__eq__, words, words[1:]))
    share = counts[counts > 0] / total
    letters = max(1.0, by[1] + by[2] + by[8])
    marked = sum(x[-1] in b"#$%&*!|" for x in words)
    upper_words = sum(map(bytes.isupper, words))
    root = np.sqrt
    return np.array([
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), np.log1p((n - by[4] - by[5]) / w),
        root(by[2] / letters), root(by[3] / total), root(by[7] / total), root(by[6] / total), root(by[4] / total),
        root(by[5] / total), root(by[8] / total), root(marked / w), np.log1p((counts[_SYMBOLS] > 0).sum()),
        np.log1p(len(seen)) - np.log1p(len(words)), root(max(seen.values(), default=0) / w),
        root(1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0), root(1 - len(set(lines)) / len(lines)),
        root(same / w), np.log1p(len(words) / len(lines)), root(upper_words / w), root((counts[46] + counts[44]) / w),
        float(-(share * np.log(share)).sum()),
    ])


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussian classes; ``factor`` holds each class's inverse Cholesky factor."""

    mean: np.ndarray
    factor: np.ndarray
    log_det: np.ndarray
    log_prior: np.ndarray
    temper: float

    @staticmethod
    def fit(count: np.ndarray, total: np.ndarray, outer: np.ndarray, pool: float, diagonal: float,
            temper: float) -> Discriminant:
        """From the classes' counts, sums and sums of outer products.

        ``pool`` and ``diagonal`` are the shrinkage shares. A class without rows takes the pooled
        moments, so the score is then the prior.
        """
        d = total.shape[1]
        everything = max(1.0, count.sum())
        grand = total.sum(axis=0) / everything
        whole = outer.sum(axis=0) / everything - np.outer(grand, grand)
        ridge = 1e-4 * max(1e-6, float(np.trace(whole)) / d) * np.eye(d)
        mean = np.stack([total[k] / count[k] if count[k] else grand for k in (0, 1)])
        own = [outer[k] / count[k] - np.outer(mean[k], mean[k]) if count[k] else whole for k in (0, 1)]
        within = (count[0] * own[0] + count[1] * own[1]) / everything if count.sum() else whole
        factor, log_det = [], []
        for k in (0, 1):
            share = d / (d + count[k]) if count[k] else 1.0  # few rows: lean on the pooled covariance
            cov = (1 - max(pool, share)) * own[k] + max(pool, share) * within
            cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + ridge
            lower = np.linalg.cholesky(cov)
            factor.append(np.linalg.inv(lower))
            log_det.append(2 * np.log(np.diag(lower)).sum())
        prior = np.log((count + 1) / (count.sum() + 2))
        return Discriminant(mean, np.stack(factor), np.array(log_det), prior, temper)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1 of each row."""
        density = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.factor[k].T
            density.append(-0.5 * ((z * z).sum(axis=1) + self.log_det[k]))
        gap = self.temper * (density[1] - density[0]) + self.log_prior[1] - self.log_prior[0]
        return 1 / (1 + np.exp(-np.clip(gap, -500, 500)))


def held_out(doc_id: Column) -> Column:
    """The documents never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, y`` of the ids to learn from: labelled 0 or 1 and not held out.

    Labels repeated for an id count once if they agree; where they differ the larger counts.
    """
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the statistics of each row's text; null counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()).tolist() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), len(FEATURES))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(FEATURES)
    count, total, outer = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for batch in batches:
        y, x = np.asarray(batch.column(1)), _matrix(batch.column(0))
        for k in (0, 1):
            own = x[y == k]
            count[k] += len(own)
            total[k] += own.sum(axis=0)
            outer[k] += own.T @ own
    flat = np.concatenate([count, total.ravel(), outer.ravel()])
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([flat.tolist()], pa.list_(pa.float64()))],
                                     names=["k", "v"])


def fit_quality(stats: DataFrame, labels: DataFrame, label: str = "quality", pool: float = 0.6, diagonal: float = 0.05,
                temper: float = 0.5) -> Discriminant:
    """Fit on all labelled rows of ``stats(doc_id, x)`` that are not held out.

    The moments of each task (about 1,000 numbers) are added up by a Spark
    aggregate; one row's worth of them reaches the driver. ``temper`` scales the
    log-density difference, as the statistics are not independent of each other
    given the class.
    """
    d = len(FEATURES)
    rows = stats.join(known_labels(labels, label), "doc_id").select("x", "y")
    parts = rows.mapInArrow(_moments, "k long, v array<double>")
    n = 2 + 2 * d + 2 * d * d
    total = parts.select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(n)
    for r in total:
        flat[r["i"]] = r["v"]
    return Discriminant.fit(flat[:2], flat[2:2 + 2 * d].reshape(2, d), flat[2 + 2 * d:].reshape(2, d, d), pool, diagonal, temper)


def score_quality(stats: DataFrame, model: Discriminant, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``stats(doc_id, x)``.

    Null and empty texts are scored by the statistics of an empty text. Repeated
    rows each give a row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return stats.select("doc_id", "x", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Discriminant, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` scored at ``threshold`` or more, whole."""
    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        x = [statistics(t.as_py()) for t in text.cast(pa.binary())]
        return pa.array(model.score(np.stack(x)) if x else [], pa.float64())

    return docs.where(score(F.coalesce(F.col("text").cast("string"), F.lit(""))) >= threshold)
