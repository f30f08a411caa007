"""Regularised quadratic discriminant: a quality score from transformed statistics of the text.

Each class has a mean and a covariance of the statistics, summed over all labelled rows of the training folds in one
aggregate: the sums are of fixed size, so neither class ever meets in one task. Each covariance is shrunk towards
the pooled one and towards its own diagonal; its Cholesky factor is computed once and cached in the model, and a
row's score is the logistic of the difference of the two Gaussian log densities (Mahalanobis distance and log
determinant), tempered so that correlated statistics do not make it overconfident.

Null texts are empty and have all statistics 0. Labels that are null are left out; rows of a document without label only get
a score. If a class has no labelled row, every score is the share of the other class (0.5 without any). Repeated
rows count as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphatlas.llm.common import MIX, Words, doc_texts, held_out, in_pieces, mixed, span_hashes, utf8
from glyphatlas.session import cut_lineage

TO_POOLED, TO_DIAGONAL = 0.4, 0.02
TEMPER = 0.3
RIDGE = 1e-4

_CLASSES = {
    "upper": lambda b: (b >= 65) & (b <= 90), "lower": lambda b: (b >= 97) & (b <= 122), "digit": lambda b: (b >= 48) & (b <= 57),
    "symbol": lambda b: np.isin(b, [ord(c) for c in "#*$%&|<>@^~=+_\\/{}[]"]), "stop": lambda b: np.isin(b, [ord(c) for c in ".,;:"]),
    "shout": lambda b: np.isin(b, [33, 63]), "pipe": lambda b: b == 124, "high": lambda b: b >= 0x80, "feed": lambda b: b == 10,
}
STATISTICS = (
    "log_words", "word_length", "length_spread", "distinct_share", "repeat_share", "next_share", "dup_line_share", "line_words",
    "short_words", "byte_entropy", *(f"share_{c}" for c in _CLASSES),
)
_TABLES = {name: test(np.arange(256)) for name, test in _CLASSES.items()}


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics per text: logs of counts, square roots of shares."""
    rows = len(offsets) - 1
    words = Words(data, offsets, lower=False)
    n = np.diff(words.first)
    some = np.maximum(n, 1)
    length = (words.end - words.start).astype(np.float64)
    sums = lambda v: np.bincount(words.row, weights=v, minlength=rows)
    mean = sums(length) / some
    spread = np.sqrt(np.maximum(sums(length ** 2) / some - mean ** 2, 0))
    own = mixed(words.hash + words.row.astype(np.uint64) * MIX)
    distinct = np.bincount(words.row[np.unique(own, return_index=True)[1]], minlength=rows)
    row, window = words.shingles(3)
    key = mixed(window + row.astype(np.uint64) * MIX)
    fresh = np.bincount(row[np.unique(key, return_index=True)[1]], minlength=rows)
    windows = np.bincount(row, minlength=rows)
    following = np.zeros(len(own))
    following[1:] = own[1:] == own[:-1]
    feeds = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    ends = np.sort(np.concatenate([offsets[1:], feeds]))
    full = ends > start
    start, ends = start[full], ends[full]
    owner = np.searchsorted(offsets, start, "right") - 1
    lines = np.bincount(owner, minlength=rows)
    key = mixed(span_hashes(data, start, ends) + owner.astype(np.uint64) * MIX)
    new_lines = np.bincount(owner[np.unique(key, return_index=True)[1]], minlength=rows)
    size = np.diff(offsets)
    byte_row = np.repeat(np.arange(rows), size)
    seen = np.bincount(byte_row * 256 + data, minlength=rows * 256).reshape(rows, 256).astype(np.float64)
    share = seen / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    shares = [
        distinct / some, 1 - fresh / np.maximum(windows, 1), sums(following) / some, 1 - new_lines / np.maximum(lines, 1),
    ]
    columns = [np.log1p(n), np.log1p(mean), np.log1p(spread), *[np.sqrt(np.clip(x, 0, 1)) for x in shares],
               np.log1p(n / np.maximum(lines, 1)), np.sqrt(sums(length <= 2) / some), entropy,
               *[np.sqrt(share[:, t].sum(axis=1)) for t in _TABLES.values()]]
    out = np.stack(columns, axis=1)
    out[n == 0] = 0
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats array<double>) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 1 << 19):
            found = statistics(*utf8(batch.column(1)))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat], ["doc_id", "stats"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, stats array<double>")


@dataclass(frozen=True)
class Model:
    """Per class the log prior, the mean, the Cholesky factor and its log determinant; `flat` if it cannot tell classes apart."""

    log_prior: tuple[float, float]
    mean: tuple[np.ndarray, np.ndarray]
    factor: tuple[np.ndarray, np.ndarray]
    log_det: tuple[float, float]
    flat: float | None = None

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        side = []
        for k in (0, 1):
            scaled = np.linalg.solve(self.factor[k], (x - self.mean[k]).T)
            side.append(-0.5 * ((scaled ** 2).sum(axis=0) + self.log_det[k]))
        return side[1] - side[0]

    def scores(self, x: np.ndarray, temper: float = TEMPER) -> np.ndarray:
        """Between 0 and 1, higher where class 1 is likelier."""
        if self.flat is not None:
            return np.full(len(x), self.flat)
        odds = temper * self.log_odds(x) + self.log_prior[1] - self.log_prior[0]
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def class_sums(labelled: DataFrame) -> DataFrame:
    """(label, n, s, ss): count, sums and sums of products of the statistics. Partial sums leave every task as one row per class."""
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            x = np.array(batch.column(1).flatten()).reshape(-1, d)
            y = np.array(batch.column(0))
            for k in np.unique(y):
                part = x[y == k]
                n, s, ss = total.get(k, (0, np.zeros(d), np.zeros((d, d))))
                total[k] = n + len(part), s + part.sum(axis=0), ss + part.T @ part
        for k, (n, s, ss) in total.items():
            values = np.concatenate([[n], s, ss.ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(values), k), pa.int32()), pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], ["label", "place", "value"])

    parts = labelled.select("label", "stats").mapInArrow(run, "label int, place int, value double")
    return parts.groupBy("label", "place").agg(F.sum("value").alias("value"))


def fit(labelled: DataFrame, to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL) -> Model:
    """The model of (label, stats) rows with labels 0 and 1. The driver sees 2 * (1 + d + d * d) numbers."""
    d = len(STATISTICS)
    sums = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for row in class_sums(labelled).collect():  # of fixed size
        sums[row["label"]][row["place"]] = row["value"]
    counts = [sums[k][0] for k in (0, 1)]
    if min(counts) < 2:
        flat = counts[1] / sum(counts) if sum(counts) else 0.5
        return Model((0.0, 0.0), (np.zeros(d), np.zeros(d)), (np.eye(d), np.eye(d)), (0.0, 0.0), float(flat))
    mean, own = [], []
    for k in (0, 1):
        n, s, ss = counts[k], sums[k][1:1 + d], sums[k][1 + d:].reshape(d, d)
        mean.append(s / n)
        own.append(ss / n - np.outer(mean[k], mean[k]))
    pooled = (counts[0] * own[0] + counts[1] * own[1]) / sum(counts)
    factor, log_det = [], []
    for k in (0, 1):
        c = (1 - to_pooled) * own[k] + to_pooled * pooled
        c = (1 - to_diagonal) * c + to_diagonal * np.diag(np.diag(c)) + RIDGE * np.eye(d)
        factor.append(np.linalg.cholesky(c))
        log_det.append(2 * np.log(np.diag(factor[k])).sum())
    prior = np.log(np.array(counts) / sum(counts))
    return Model(tuple(prior.tolist()), tuple(mean), tuple(factor), tuple(float(x) for x in log_det))


def score(stats: DataFrame, model: Model, temper: float = TEMPER) -> DataFrame:
    """(doc_id, score) for (doc_id, stats) rows."""
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).flatten()).reshape(-1, d)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x, temper))], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; labels of the held-out fold are never read."""
    stats = cut_lineage(with_statistics(docs))
    known = labels.select(F.col("doc_id").cast("long").alias("known"), F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out(F.col("known"), folds, fold))
    model = fit(stats.join(known, F.col("doc_id") == F.col("known")).select("label", "stats"))
    scored = score(stats, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
