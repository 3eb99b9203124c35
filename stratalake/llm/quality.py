"""Quality scores by a regularised quadratic discriminant over statistics of texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stratalake.llm.arrow_words import SpacedWords, slices, texts
from stratalake.llm.labelled import bounded

# What kinds of bytes are counted.
MARKS = b".,;:'\"?-()"
SYMBOLS = b"!#$%&*+/<=>@[\\]^_`{|}~"
FEATURES = [
    "log_words",
    "log_word_length",
    "symbols",
    "upper",
    "digits",
    "marks",
    "spaces",
    "lines",
    "log_distinct",
    "repeats",
    "no_letter_words",
    "short_words",
    "long_words",
]


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    for k, members in enumerate((SYMBOLS, bytes(range(65, 91)), bytes(range(48, 58)), MARKS, b" \t\r\x0b\x0c", b"\n"), 1):
        kinds[list(members)] = k
    kinds[128:192] = 7  # not the first byte of a character
    return kinds


def features(rows: pa.Array) -> np.ndarray:
    """Transformed statistics of whole texts, one row for each; all 0 for an empty text.

    Shares are taken as square roots and counts as logs, so that they spread evenly enough for normal densities.
    """
    n = len(rows)
    offsets = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset : rows.offset + n + 1].astype(np.int64)
    data = rows.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    kinds, offsets = _byte_kinds()[raw], offsets - offsets[0]
    row_of = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    by_kind = np.bincount(row_of * 8 + kinds, minlength=n * 8).reshape(n, 8).astype(float)
    chars = np.maximum(by_kind[:, :7].sum(axis=1), 1.0)

    words = SpacedWords(rows)
    count = np.maximum(words.counts, 1)
    names = pa.array(words.distinct, pa.string())
    lengths = pc.utf8_length(names).to_numpy(zero_copy_only=False).astype(float)
    plain = pc.match_substring_regex(names, r"\pL").to_numpy(zero_copy_only=False)
    codes, rows_of = words.codes.astype(np.int64), words.rows_of

    def share(of_words: np.ndarray) -> np.ndarray:
        return np.bincount(rows_of, weights=of_words, minlength=n) / count

    # the number of different words, and of words like one of the two before them
    pairs = np.unique(rows_of * max(len(lengths), 1) + codes)
    distinct = np.bincount(pairs // max(len(lengths), 1), minlength=n)
    again = np.zeros(len(codes), bool)
    for back in (1, 2):
        again[back:] |= (codes[back:] == codes[:-back]) & (rows_of[back:] == rows_of[:-back])
    word_length = share(lengths[codes])
    columns = [
        np.log1p(words.counts),
        np.log1p(word_length),
        *(np.sqrt(by_kind[:, k] / chars) for k in range(1, 7)),
        np.log((distinct + 1) / (words.counts + 1)),
        np.sqrt(share(again)),
        np.sqrt(share(~plain[codes])),
        np.sqrt(share(lengths[codes] <= 3)),
        np.sqrt(share(lengths[codes] >= 15)),
    ]
    return np.stack(columns, axis=1) * (words.counts > 0)[:, None]


@dataclass(frozen=True)
class QualityModel:
    """For class 0 and 1: the mean of scaled features, the inverse Cholesky factor of their covariance, log constants."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    only: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1: the logistic of the difference of the classes' Mahalanobis log densities."""
        if self.only is not None:
            return np.full(len(x), self.only)
        z = (x - self.centre) / self.scale
        logs = [c - 0.5 * np.square((z - m) @ f).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, shrinkage: float = 0.1) -> QualityModel:
    """Class covariances, shrunk towards the pooled covariance and a little towards the identity.

    With one class in the labels every score is that class's smoothed share; without labels it is one half.
    """
    counts = [int((y == k).sum()) for k in (0, 1)]
    if min(counts) < 2:
        return QualityModel(np.zeros(0), np.ones(0), [], [], [], only=(counts[1] + 1) / (sum(counts) + 2))
    centre, spread = x.mean(axis=0), x.std(axis=0)
    scale = np.where(spread > 1e-9, spread, 1.0)
    z = (x - centre) / scale
    groups = [z[y == k] for k in (0, 1)]
    own = [np.cov(g, rowvar=False) for g in groups]
    pooled = sum(c * n for c, n in zip(own, counts, strict=True)) / sum(counts)
    factors, constants = [], []
    for cov, n in zip(own, counts, strict=True):
        shrunk = (1 - shrinkage) * cov + shrinkage * (0.9 * pooled + 0.1 * np.eye(len(cov)))
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower).T)
        constants.append(float(np.log(n / sum(counts)) - np.log(np.diag(lower)).sum()))
    return QualityModel(centre, scale, [g.mean(axis=0) for g in groups], factors, constants)


def _featured(docs: DataFrame, label: str | None = None) -> DataFrame:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                values = pa.array(features(texts(piece)).tolist(), pa.list_(pa.float64()))
                yield pa.record_batch([piece.column("label"), values], names=["label", "x"])

    return docs.select(F.col(label).cast("int").alias("label"), "text").mapInArrow(work, "label int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 20_000, shrinkage: float = 0.1) -> QualityModel:
    """Learns from documents (doc_id, text) with labels (doc_id, quality 0 or 1).

    At most about `max_docs` labelled documents are read, chosen by a hash of their ids, with their whole texts. Their
    features, a few numbers each, are gathered and fitted on the driver. Labels that are null or neither 0 nor 1 are
    left out.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").alias("label"))
    chosen = bounded(known, max_docs)
    rows = _featured(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "label").collect()
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["label"] for r in rows], int), shrinkage)


def score(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """All columns and last, as `name`, the quality score (0 to 1) of every whole text.

    Null and empty texts have all features 0 and are scored like others. Rows are scored one by one, so null ids and
    repeated rows stay as they are. An empty table gives no rows. `name` must be new among the columns.

    One pass, no shuffle.
    """
    if name in docs.columns:
        raise ValueError(f"there already is a column {name}")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                chance = shared.value.scores(features(texts(piece)))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(chance)], names=[*piece.schema.names, name])

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
