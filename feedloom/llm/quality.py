"""Quality classifier: a regularised quadratic discriminant.

Each text becomes a few transformed statistics.  Every labelled row outside the
held-out fold adds to its class's count, sums and products; tasks return these
moments, so training covers all labels without moving them.  The class
covariances shrink towards the pooled one and its diagonal; scores come from
Mahalanobis log-density differences with the Cholesky factors kept in the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import WordHasher, filtered, long_rows, need_columns, shingles, stored

THRESHOLD = 0.3
FOLDS = 5
# Weight of the pooled covariance, and of its diagonal in what results.
TO_POOLED = 0.1
TO_DIAGONAL = 0.05
# Log-density differences are divided by this before they become a probability:
# the statistics are not independent of each other's noise.
TEMPERATURE = 2.0
NAMES = (
    "words",
    "word_length",
    "long_words",
    "symbols",
    "upper",
    "digits",
    "bars",
    "exclaims",
    "distinct_words",
    "distinct_shingles",
    "distinct_lines",
    "top_word",
    "line_words",
    "stops",
    "short_words",
    "markup",
)


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


class Statistics:
    """Transformed statistics of one text's bytes."""

    def __init__(self) -> None:
        self.hasher = WordHasher()
        self.kind = np.zeros((6, 256), bool)
        for row, chars in enumerate((b"#$%&*~^@=+_\\{}[]<>", b"|", b"!", b".,;:?", b"0123456789", b"<>/{}")):
            self.kind[row, list(chars)] = True

    def __call__(self, data: bytes) -> list[float]:
        raw = np.frombuffer(data, np.uint8)
        words = self.hasher.words(data)
        n, size = len(words), max(1, len(raw))
        counts = np.bincount(raw, minlength=256)
        letters = max(1, counts[65:91].sum() + counts[97:123].sum())
        blank = int(counts[32] + counts[9:14].sum())
        repeats = np.unique(words, return_counts=True)[1] if n else np.ones(1, int)
        runs = shingles(words, 3)
        lines = [line for line in data.split(b"\n") if line.strip()]
        per = lambda x, y: float(x) / max(1.0, float(y))
        rare = lambda x: np.log(x + 1e-3)
        per_kind = self.kind @ counts
        if n:
            edges = np.flatnonzero(np.diff(np.concatenate([[True], self.hasher.gap[raw], [True]]).astype(np.int8)))
            lengths = edges[1::2] - edges[::2]
        else:
            lengths = np.zeros(1, int)
        return [
            np.log1p(n),
            np.log1p(per(size - blank, n)),
            rare(per((lengths > 15).sum(), n)),
            rare(per(per_kind[0], size)),
            rare(per(counts[65:91].sum(), letters)),
            rare(per(per_kind[4], size)),
            rare(per(per_kind[1], n)),
            rare(per(per_kind[2], n)),
            np.log(per(len(repeats), n) + 1e-2),
            np.log(per(len(runs), max(1, n - 2)) + 1e-2),
            np.log(per(len(set(lines)), len(lines)) + 1e-2),
            np.log(per(repeats.max(), n) + 1e-2),
            np.log1p(per(n, len(lines))),
            rare(per(per_kind[3], n)),
            rare(per((lengths < 3).sum(), n)),
            rare(per(per_kind[5], size)),
        ]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    of = Statistics()
    for batch in batches:
        rows = [of(t.as_py() or b"") for t in batch.column("text").cast(pa.large_binary())]
        flat = np.asarray(rows, np.float64).reshape(-1)
        offsets = pa.array(np.arange(0, len(flat) + 1, len(NAMES)), pa.int32())
        x = pa.ListArray.from_arrays(offsets, pa.array(flat))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in batch.schema.names if c != "text"] + [x],
            [c for c in batch.schema.names if c != "text"] + ["x"],
        )


def text_statistics(documents: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns and x, the statistics of the whole text (null: empty)."""
    need_columns(documents, "text", *keep)
    rows = long_rows(documents).select(*keep, "text")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text")
    return rows.mapInArrow(_statistics, schema + "x array<double>")


def _moments(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + dim + dim * dim))
        for batch in batches:
            x = np.asarray(batch.column("x").flatten(), np.float64).reshape(-1, dim)
            label = np.asarray(batch.column("label"))
            for k in (0, 1):
                own = x[label == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "value"]
        )

    return run


@dataclass
class Discriminant:
    """Centre and scale of the statistics; per class mean, inverse Cholesky factor, log weight."""

    center: np.ndarray
    scale: np.ndarray
    means: list
    factors: list
    constants: list
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.prior)
        x = (x - self.center) / self.scale
        log = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True):
            z = (x - mean) @ factor.T
            log.append(constant - 0.5 * (z * z).sum(axis=1))
        return 1 / (1 + np.exp(np.clip((log[0] - log[1]) / TEMPERATURE, -700, 700)))


def fit(labelled: DataFrame, dim: int = len(NAMES)) -> Discriminant:
    """A model of rows (x, label 0/1).  Without both classes it scores all alike:
    the smoothed share of label 1, one half for no label at all."""
    rows = labelled.select("x", F.col("label").cast("int").alias("label"))
    sums = rows.mapInArrow(_moments(dim), "at long, value double")
    sums = sums.groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    flat = np.zeros((2, 1 + dim + dim * dim))
    flat.reshape(-1)[sums["at"]] = sums["value"]
    n = flat[:, 0]
    prior = float((n[1] + 1) / (n.sum() + 2))
    if n.min() < 2:
        return Discriminant(np.zeros(dim), np.ones(dim), [], [], [], prior)
    means = flat[:, 1 : dim + 1] / n[:, None]
    squares = flat[:, dim + 1 :].reshape(2, dim, dim)
    center = flat[:, 1 : dim + 1].sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(squares.sum(axis=0)) / n.sum() - center**2, 1e-4))
    spread = [squares[k] / n[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    spread = [s / np.outer(scale, scale) for s in spread]
    pooled = (n[0] * spread[0] + n[1] * spread[1]) / n.sum()
    factors, constants = [], []
    for k in (0, 1):
        part = (1 - TO_POOLED) * spread[k] + TO_POOLED * pooled
        part = (1 - TO_DIAGONAL) * part + TO_DIAGONAL * (np.diag(np.diag(pooled)) + 0.01 * np.eye(dim))
        lower = np.linalg.cholesky(part)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(n[k] / n.sum()) - np.log(np.diag(lower)).sum()))
    return Discriminant(center, scale, list((means - center) / scale), factors, constants, prior)


def _score(model: Discriminant):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten(), np.float64).reshape(-1, len(model.center))
            keep = [c for c in batch.schema.names if c != "x"]
            score = model.scores(x) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(score)], [*keep, "score"]
            )

    return run


def training_labels(labels: DataFrame) -> DataFrame:
    """doc_id and label outside the held-out fold; of several labels of a doc the smallest."""
    need_columns(labels, "doc_id", "quality")
    rows = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    rows = rows.where(fold(F.col("doc_id")) != 0)
    return rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("label"))


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    Null and empty texts have the statistics of no words.  A null doc_id is
    never held out and never trains.  Labels other than 0 and 1 are void.
    """
    need_columns(documents, "doc_id", "text")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(text_statistics(docs, "doc_id"))
    model = fit(rows.join(training_labels(labels), "doc_id").select("x", "label"))
    scored = rows.mapInArrow(_score(model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the classifier does not reject, all columns.

    Texts are read twice and never shuffled; only statistics meet the labels.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = text_statistics(docs, "doc_id").join(training_labels(labels), "doc_id")
    # Stored, so that no task needs two Python workers, which stay in memory.
    model = fit(stored(known.select("x", "label")))
    return filtered(documents, _keep(model))


def _keep(model: Discriminant):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Statistics()
        for batch in batches:
            if batch.num_rows:
                x = [of(t.as_py() or b"") for t in batch.column("text").cast(pa.large_binary())]
                yield batch.filter(pa.array(model.scores(np.asarray(x)) >= THRESHOLD))

    return run
