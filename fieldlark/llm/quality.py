"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Two passes: one over the texts makes a row of statistics for each document (stored), one over those rows scores them. The
class moments (count, sum, sum of outer products) are summed by Spark over *all* labelled training rows, so fitting
needs no sample and the driver gets two small matrices. Covariances are shrunk towards the pooled one and its diagonal;
their Cholesky factors are computed once and travel with the model.

Null or empty text: the statistics of an empty document, scored like any other. Labels null or of unknown documents
take no part. One class only, or none: every score is that class's smoothed share. Repeated rows are scored alike, and each
counts in the moments. A score of exactly the threshold is predicted 1. A very long text is counted in bounded pieces. An
empty table gives no rows, and no labelled rows the score of no class. Extra columns are not read, whatever their names; the
filtering form keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._spark import small, stored, table

NAMES = ("words", "word_length", "upper", "symbol", "mark", "digit", "stops", "pipe", "distinct", "line_length", "repeated_lines", "word_spread")
D = len(NAMES)
#: Weight of the pooled covariance, and of the pooled diagonal, in each class's covariance.
SHRINK_POOLED, SHRINK_DIAGONAL = 0.10, 0.05
#: Prior of label 1; the query's threshold of 0.3 is applied to a posterior under the training shares.
_LINES = np.zeros(256, bool)
_LINES[[10, 13]] = True


def _class(text: bytes | range) -> np.ndarray:
    x = np.zeros(256, bool)
    x[list(text)] = True
    return x


_UPPER, _DIGIT = _class(range(65, 91)), _class(range(48, 58))
_LETTER = _class([*range(65, 91), *range(97, 123), *range(128, 256)])
_SYMBOL, _MARK, _STOPS, _PIPE = _class(b"#$%&*@^~+=<>{}[]\\_/`"), _class(b"!?"), _class(b".,;:"), _class(b"|")


def _logit(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A share on a scale where its noise is about even: log odds with half a count added."""
    return np.log((part + 0.5) / (whole - part + 0.5))


def statistics(column: pa.Array) -> np.ndarray:
    """Rows of the D transformed statistics of whole texts."""
    out = []
    for _, raw, at in T.chunks(column):
        rows = len(at) - 1
        each = T.counts(raw, at)
        count = lambda x: each[:, x].sum(1).astype(float)  # noqa: E731, B023
        w, first, starts, ends = T.words(raw, at, T.SPACE)
        lines, line_at, _, _ = T.words(raw, at, _LINES)
        n, m = np.diff(first).astype(float), np.diff(line_at).astype(float)
        solid = ~T.SPACE
        chars, letters = count(solid), count(_LETTER)
        length = (ends - starts).astype(float)
        per = lambda x: np.diff(np.concatenate(([0.0], np.cumsum(x)))[first]) / np.maximum(n, 1)  # noqa: E731, B023
        mean = per(length)
        spread = np.sqrt(np.maximum(per(length**2) - mean**2, 0))
        distinct, kept = np.zeros(rows), np.zeros(rows)
        for i in range(rows):
            distinct[i] = len(np.unique(w[first[i] : first[i + 1]]))
            kept[i] = len(np.unique(lines[line_at[i] : line_at[i + 1]]))
        x = np.stack(
            [
                np.log1p(n),
                np.log1p(mean),
                _logit(count(_UPPER), letters),
                _logit(count(_SYMBOL), chars),
                _logit(count(_MARK), chars),
                _logit(count(_DIGIT), chars),
                _logit(count(_STOPS), chars),
                _logit(count(_PIPE), chars),
                np.log1p(distinct) - np.log1p(n),
                np.log1p(chars) - np.log1p(m),
                _logit(m - kept, m),
                np.log1p(spread),
            ],
            axis=1,
        )
        out.append(x)
    return np.concatenate(out) if out else np.zeros((0, D))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = statistics(batch.column(1))
        values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), D).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["doc_id", "x"])


def document_statistics(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the stored statistics of every document."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(docs.mapInArrow(_described, "doc_id long, x array<double>"))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's sums for each class, as (label, place, value)."""
    total = np.zeros((2, 1 + D + D * D))
    for batch in batches:
        y = batch.column(0).to_numpy()
        x = batch.column(1).flatten().to_numpy().reshape(-1, D)
        for c in (0, 1):
            z = x[y == c]
            total[c] += np.concatenate(([len(z)], z.sum(0), (z.T @ z).ravel()))
    c, at = np.indices(total.shape)
    yield pa.RecordBatch.from_arrays([pa.array(c.ravel().astype(np.int32)), pa.array(at.ravel().astype(np.int32)), pa.array(total.ravel())], names=["label", "place", "value"])


@dataclass
class Discriminant:
    """Log priors, means, inverse Cholesky factors and log determinants of the two classes."""

    share: float
    log_prior: np.ndarray | None = None
    mean: np.ndarray | None = None
    factor: np.ndarray | None = None
    log_det: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of label 1."""
        if self.mean is None:
            return np.full(len(x), self.share)
        z = [(x - m) @ f.T for m, f in zip(self.mean, self.factor, strict=True)]
        log = [p - 0.5 * (d + (v**2).sum(1)) for p, d, v in zip(self.log_prior, self.log_det, z, strict=True)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(statistics: DataFrame, labels: DataFrame, label: str) -> Discriminant:
    """From all rows of `statistics` that have a 0/1 `label`."""
    y = stored(labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y")))
    rows = statistics.join(small(y), "doc_id").select("y", "x")
    sums = rows.mapInArrow(_moments, "label int, place int, value double").groupBy("label", "place").agg(F.sum("value").alias("v"))
    total = np.zeros((2, 1 + D + D * D))
    for r in sums.collect():  # two times 1 + D + D * D numbers
        total[r["label"], r["place"]] = r["v"]
    n = total[:, 0]
    share = (n[1] + 1) / (n.sum() + 2)
    if n.min() < 2:
        return Discriminant(share)
    mean = total[:, 1 : 1 + D] / n[:, None]
    scatter = total[:, 1 + D :].reshape(2, D, D) - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    pooled = scatter.sum(0) / n.sum() + 1e-6 * np.eye(D)
    diagonal = np.diag(np.diag(pooled))
    own = 1 - SHRINK_POOLED - SHRINK_DIAGONAL
    factors = [np.linalg.cholesky(own * s / m + SHRINK_POOLED * pooled + SHRINK_DIAGONAL * diagonal) for s, m in zip(scatter, n, strict=True)]
    return Discriminant(share, np.log(n / n.sum()), mean, np.stack([np.linalg.inv(f) for f in factors]), np.array([2 * np.log(np.diag(f)).sum() for f in factors]))


def scored(statistics: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score) of every row of `statistics`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(batch.column(1).flatten().to_numpy().reshape(-1, D))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    return statistics.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def accepted(documents: DataFrame, model: Discriminant, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores at least `threshold`."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(model.score(statistics(text)))

    return documents.where(score(F.col(text_col).cast("string")) >= threshold)


def held_out(n: int, remainder: int, column: str = "doc_id"):
    """crc32 of the id as text modulo n; a null id is never held out, nor trained on."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n == remainder, F.lit(False))


def op9_quality_discriminant(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.3) of every document."""
    x = document_statistics(table(spark, sf_dir, "documents"))
    train = table(spark, sf_dir, "labels").where(~held_out(5, 0) & F.col("doc_id").isNotNull())
    model = fit(x, train, "quality")
    return scored(x, model).select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
