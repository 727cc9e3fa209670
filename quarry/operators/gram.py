"""One Gram aggregate: count, sums and cross products of columns in one scan.

``RowMatrix.computeGramianMatrix`` adds every row into a packed upper triangle
(an array per task, combined in a tree of aggregations on the executors). With
a leading column of ones the same triangle holds the count and the sums, so means,
covariances, correlations and principal components all follow from one (d + 1) x (d + 1)
matrix, the only thing that reaches the driver.

Cross products about zero lose digits when a column's mean is large against its
spread. Only if that is so, the scan is repeated about the means found.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_FEATURES = 512       # the d x d solve on the driver stays small
FAR_FROM_ZERO = 1e5      # mean squared against variance: beyond it products are taken about the mean


@dataclass
class Gram:
    """Moments of ``features``: rows, means and centred sums of products."""

    features: list[str]
    rows: int
    mean: np.ndarray
    products: np.ndarray

    @property
    def covariance(self) -> np.ndarray:
        return self.products / max(1, self.rows - 1)

    @property
    def std(self) -> np.ndarray:
        return np.sqrt(np.diag(self.covariance))

    @property
    def correlation(self) -> np.ndarray:
        """Pearson's r; NaN against a constant column."""
        spread = np.sqrt(np.diag(self.products))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = self.products / np.outer(spread, spread)
        return np.clip(r, -1, 1)

    @property
    def of_scores(self) -> np.ndarray:
        """The covariance of the z-scores: correlations, 0 for constant columns."""
        return np.nan_to_num(self.correlation, nan=0.0)


def gram(df: DataFrame, features: list[str]) -> Gram:
    """The moments of rows without NULL in ``features``. Eager: one scan, or two
    if a column lies far from zero."""
    if len(features) > MAX_FEATURES:
        raise ValueError(f"too many features for a driver-side solve ({len(features)})")
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in features]).na.drop()
    centre = np.zeros(len(features))
    found = _about(rows, features, centre)
    variance = np.diag(found.products) / max(1, found.rows)
    # a variance that rounding has taken below zero is far from zero as well
    if found.rows and (found.mean ** 2 > FAR_FROM_ZERO * np.maximum(variance, 0)).any():
        found = _about(rows, features, found.mean)
    return found


def _about(rows: DataFrame, features: list[str], centre: np.ndarray) -> Gram:
    parts = rows.select(F.lit(1.0).alias("__one"), *[(F.col(c) - F.lit(float(m))).alias(c) for c, m in zip(features, centre)])
    # a row of zeros adds nothing, and there is no empty matrix to reduce
    parts = parts.unionByName(rows.sparkSession.range(1).select(*[F.lit(0.0).alias(c) for c in parts.columns]))
    vectors = VectorAssembler(inputCols=parts.columns, outputCol="__v").transform(parts).select("__v")
    d = len(features)
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "__v"), 0, d + 1).computeGramianMatrix().toArray()
    n, sums = matrix[0, 0], matrix[0, 1:]
    if not n:
        return Gram(features, 0, np.full(d, np.nan), np.zeros((d, d)))
    products = matrix[1:, 1:] - np.outer(sums, sums) / n
    constant = np.diag(matrix)[1:] * 1e-15 * n >= np.diag(products)  # nothing but rounding is left
    products[constant, :] = 0
    products[:, constant] = 0
    return Gram(features, int(round(n)), centre + sums / n, products)


def components(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (largest first, not below 0) and eigenvectors of a symmetric
    matrix; a vector's largest loading is positive."""
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    lead = np.abs(vectors).argmax(axis=0)
    signs = np.where(vectors[lead, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return values, vectors * signs
