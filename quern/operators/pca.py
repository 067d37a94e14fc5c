"""Principal components of vector and time-series columns."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.vectors import apply_matrix, literal_vector, vec_dot, vec_scale
from quern.operators.stats import dense_rows
from quern.session import stable


@dataclass
class PcaModel:
    components: np.ndarray  # d x k, one component per column
    eigenvalues: np.ndarray  # largest first; all d, or those of the components
    mean: np.ndarray
    total: float | None = None  # sum of all eigenvalues, where not all are known

    def scores(self, c: Column) -> Column:
        """The vector as it is, not centred, times the components."""
        return apply_matrix(c, self.components.T.tolist())

    def variance_explained(self, k: int) -> float:
        return float(self.eigenvalues[:k].sum() / (self.eigenvalues.sum() if self.total is None else self.total))


def _signed(components: np.ndarray) -> np.ndarray:
    """Components with signs such that the largest loading of each is positive."""
    largest = components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])]
    return components * np.where(largest < 0, -1.0, 1.0)


def pca_fit(df: DataFrame, col: str, k: int = 2) -> PcaModel:
    """Top ``k`` components and all eigenvalues of the covariance (divided by n).

    Spark ML gives shares of variance; times the trace of the covariance they are
    eigenvalues. Signs are fixed so that the largest loading of a component is positive.
    """
    vectors = df.select(array_to_vector(F.col(col).cast("array<double>")).alias("v"))
    n, mean, variance = vectors.agg(
        F.count("v"), Summarizer.mean(F.col("v")), Summarizer.variance(F.col("v"))
    ).first()
    trace = float(variance.toArray().sum()) * (n - 1) / n
    fitted = PCA(k=len(mean), inputCol="v", outputCol="s").fit(vectors)
    return PcaModel(
        _signed(fitted.pc.toArray()[:, :k]),
        fitted.explainedVariance.toArray() * trace,
        np.asarray(mean.toArray()),
    )


def _covariance_times(rows: DataFrame, mean: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Sum over all rows of the centred vector times its products with the columns of ``block``.

    A task folds its rows into one matrix of the shape of ``block``; Spark adds those by row.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(block.shape)
        for batch in batches:
            if batch.num_rows:
                x = dense_rows(batch.column(0)) - mean
                total += x.T @ (x @ block)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(total) + 1) * total.shape[1], pa.int32()), pa.array(total.ravel()))
        yield pa.record_batch({"i": pa.array(np.arange(len(total)), pa.int32()), "y": lists})

    parts = rows.mapInArrow(fold, "i int, y array<double>").groupBy("i")
    sums = parts.agg(F.array(*[F.sum(F.col("y")[j]) for j in range(block.shape[1])]).alias("y")).toArrow()
    result = np.zeros(block.shape)
    result[sums["i"].to_numpy()] = dense_rows(sums["y"].combine_chunks())
    return result


def _new_directions(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what ``block`` has outside ``basis``; none where rounding is all that is left."""
    scale = np.abs(block).max() if block.size else 0.0
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    if not scale or np.abs(block).max() <= 1e-14 * scale:
        return block[:, :0]
    left, sizes, _ = np.linalg.svd(block, full_matrices=False)
    left = left[:, sizes > 1e-13 * sizes[0]]
    left = left - basis @ (basis.T @ left)
    return np.linalg.qr(left)[0]


def pca_top(
    df: DataFrame, col: str, k: int = 2, oversample: int = 8, tolerance: float = 1e-12, passes: int = 60, width: int = 8, seed: int = 0
) -> PcaModel:
    """Top ``k`` components of long vectors, without a d x d matrix anywhere.

    Randomised block Krylov iteration: a pass multiplies the covariance with ``k + oversample``
    directions, and the best components within all directions so far are taken. It ends when
    those of the first ``k`` are eigenvectors up to ``tolerance`` times the largest
    eigenvalue; after ``width`` blocks it starts again from the best directions. The driver
    holds ``2 * width`` blocks of d rows. Vectors are written once and read in every pass.
    """
    rows = stable(df.select(F.col(col).cast("array<double>").alias("v")).filter("v is not null"))
    if rows.isEmpty():
        raise ValueError("no vectors")
    n, mean, variance = rows.select(array_to_vector("v").alias("v")).agg(
        F.count("v"), Summarizer.mean(F.col("v")), Summarizer.variance(F.col("v"))
    ).first()
    mean, total = mean.toArray(), float(variance.toArray().sum()) * (n - 1) / n
    d = len(mean)
    size = min(d, k + oversample)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, size)))[0]
    basis = image = np.zeros((d, 0))
    for _ in range(passes):
        product = _covariance_times(rows, mean, block) / n
        basis, image = np.hstack([basis, block]), np.hstack([image, product])
        small = basis.T @ image
        values, inner = np.linalg.eigh((small + small.T) / 2)
        values, inner = values[::-1], inner[:, ::-1]
        error = image @ inner[:, :k] - (basis @ inner[:, :k]) * values[:k]
        if basis.shape[1] >= d or (np.linalg.norm(error, axis=0) <= tolerance * max(values[0], 0)).all():
            break
        if basis.shape[1] + size > width * size:
            basis, image = basis @ inner[:, :size], image @ inner[:, :size]
            values, inner = values[:size], np.eye(size)
            product = image
        block = _new_directions(product, basis)
        if not block.shape[1]:
            break
    known = values if basis.shape[1] >= d else values[:k]  # short vectors: the directions are all there are
    return PcaModel(_signed(basis @ inner[:, :k]), np.maximum(known, 0), mean, total)


def pca_scores(df: DataFrame, col: str, k: int = 2, model: PcaModel | None = None) -> DataFrame:
    """Adds ``scores``, an array of length ``k``."""
    model = model or pca_top(df, col, k)
    return df.withColumn("scores", model.scores(F.col(col).cast("array<double>")))


def eigen_table(df: DataFrame, model: PcaModel) -> DataFrame:
    """``pos, eigenvalue, explained``, explained being the share up to and with ``pos``."""
    rows = [
        (i, float(v), model.variance_explained(i + 1)) for i, v in enumerate(model.eigenvalues)
    ]
    return df.sparkSession.createDataFrame(rows, "pos int, eigenvalue double, explained double")


def pca_reconstruct(df: DataFrame, col: str, model: PcaModel | None = None) -> DataFrame:
    """Adds ``projected``: the vector's projection on the first component, mean put back."""
    model = model or pca_top(df, col, 1)
    first, mean = literal_vector(model.components[:, 0]), literal_vector(model.mean)
    centred = F.zip_with(F.col(col).cast("array<double>"), mean, lambda x, m: x - m)
    along = vec_dot(centred, first) / float(model.components[:, 0] @ model.components[:, 0])
    return df.withColumn("projected", F.zip_with(vec_scale(first, along), mean, lambda x, m: x + m))


def series_pca(df: DataFrame, series: Column, k: int = 3) -> tuple[PcaModel, DataFrame]:
    """PCA of a series expression (rescaled, folded, ..); keys of ``df`` are kept."""
    folded = df.withColumn("series", series)
    model = pca_top(folded, "series", k)
    return model, pca_scores(folded, "series", k, model)
