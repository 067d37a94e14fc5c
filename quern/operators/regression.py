"""Linear regression by gradient descent and its evaluation.

Squared error is quadratic in the weights, so all a full-batch method needs from the data
is the sum of outer products of ``(features, 1, label)``. One distributed pass computes
it; every iteration, and every model of a grid, then works on (d + 2)^2 numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.maths import squared_error
from quern.functions.vectors import literal_vector, two_way_interactions, vec_dot, vec_scale
from quern.operators.stats import cross_products, dense_rows, vector_sum


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.sqrt(F.avg(squared_error(F.col(label), F.col(prediction)))).alias("rmse"))


def shift_label(df: DataFrame, label: str) -> DataFrame:
    """Subtracts the smallest label."""
    return df.withColumn(label, F.col(label) - df.agg(F.min(label)).scalar())


def constant_prediction(df: DataFrame, value: Column | float) -> DataFrame:
    """The same prediction on every row; a one-row subquery such as a mean is fine."""
    return df.withColumn("prediction", value if isinstance(value, Column) else F.lit(float(value)))


def mean_baseline(train: DataFrame, parts: dict[str, DataFrame], label: str) -> DataFrame:
    """RMSE on each part when the training mean is predicted everywhere: ``part, rmse``."""
    mean = train.agg(F.avg(label)).scalar()
    tagged = [df.select(F.lit(name).alias("part"), F.col(label).alias("label")) for name, df in parts.items()]
    rows = tagged[0]
    for other in tagged[1:]:
        rows = rows.unionAll(other)
    scored = constant_prediction(rows, mean)
    return scored.groupBy("part").agg(
        F.sqrt(F.avg(squared_error(F.col("label"), F.col("prediction")))).alias("rmse")
    )


@dataclass
class LinearModel:
    weights: np.ndarray
    intercept: float = 0.0
    errors: list[float] = field(default_factory=list)  # training RMSE before each update

    def predict(self, features: Column) -> Column:
        return vec_dot(features, literal_vector(self.weights)) + F.lit(float(self.intercept))


def linreg_predict(df: DataFrame, weights: Sequence[float], intercept: float = 0.0) -> DataFrame:
    """``label`` and ``prediction`` of rows with ``label, features``."""
    model = LinearModel(np.asarray(weights), intercept)
    return df.select("label", model.predict(F.col("features")).alias("prediction"))


def gradient_summand(df: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Adds ``summand``: the residual of the row times its features."""
    residual = vec_dot(F.col("features"), literal_vector(weights)) - F.col("label")
    return df.withColumn("summand", vec_scale(F.col("features"), residual))


def gradient(df: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Sum of the summands as rows ``pos, total``."""
    return vector_sum(gradient_summand(df, weights), "summand")


@dataclass
class Moments:
    """Sum of outer products of ``(features, 1, label)`` over a data set."""

    total: np.ndarray

    @property
    def n(self) -> float:
        return float(self.total[-2, -2])

    @property
    def d(self) -> int:
        return len(self.total) - 2

    def gradient(self, w: np.ndarray) -> np.ndarray:
        """Gradient of half the squared error, for ``w`` over features and the constant."""
        return self.total[:-1, :-1] @ w - self.total[:-1, -1]

    def rmse(self, weights: np.ndarray, intercept: float = 0.0) -> float:
        z = np.append(weights, [intercept, -1.0])
        return float(np.sqrt(max(z @ self.total @ z, 0.0) / self.n))


def moments(df: DataFrame, features: str = "features", label: str = "label") -> Moments:
    row = F.concat(F.col(features), F.array(F.lit(1.0), F.col(label).cast("double")))
    cells = cross_products(df.select(row.alias("z")), "z").toPandas()
    d = int(cells["i"].max()) + 1
    total = np.zeros((d, d))
    total[cells["i"], cells["j"]] = cells["v"]
    return Moments(total)


def batch_moments(
    df: DataFrame, iterations: int, fraction: float, key: str, seed: int, features: str = "features", label: str = "label"
) -> dict[int, Moments]:
    """Moments of the rows that each iteration 1.. draws by a hash of ``key``, all in one pass.

    A row lists the iterations that draw it; a task adds its products to one matrix for each
    iteration and hands those on. An iteration that draws no row is left out.
    """
    limit = f"{math.ceil(fraction * 2**32):08x}"
    text = F.col(key).cast("string")
    draws = F.filter(
        F.sequence(F.lit(1), F.lit(iterations)),
        lambda i: F.substring(F.md5(F.concat_ws(":", text, (i + seed).cast("string"))), 1, 8) < limit,
    )
    row = F.concat(F.col(features).cast("array<double>"), F.array(F.lit(1.0), F.col(label).cast("double")))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            z, lists = dense_rows(batch.column(0)), batch.column(1)
            iteration = lists.flatten().to_numpy(zero_copy_only=False)
            order = np.argsort(iteration, kind="stable")
            drawn = np.repeat(np.arange(len(z)), lists.value_lengths().to_numpy(zero_copy_only=False))[order]
            stops = np.searchsorted(iteration[order], np.arange(1, iterations + 2))
            if total is None:
                total = np.zeros((iterations, z.shape[1], z.shape[1]))
            for t in range(iterations):
                x = z[drawn[stops[t] : stops[t + 1]]]
                total[t] += x.T @ x
        if total is not None:
            t, i, j = np.nonzero(total)
            yield pa.record_batch(
                {**{n: pa.array(x, pa.int32()) for n, x in (("t", t), ("i", i), ("j", j))}, "v": pa.array(total[t, i, j])}
            )

    parts = df.select(row.alias("z"), draws.alias("draws")).mapInArrow(fold, "t int, i int, j int, v double")
    cells = parts.groupBy("t", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    d = int(cells["i"].max()) + 1 if len(cells) else 0
    found = {int(t): np.zeros((d, d)) for t in cells["t"].unique()}
    for t, part in cells.groupby("t"):
        found[int(t)][part["i"], part["j"]] = part["v"]
    return {t + 1: Moments(m) for t, m in found.items()}


def linreg_gd(train: DataFrame | Moments, iterations: int, alpha: float = 1.0) -> LinearModel:
    """Batch gradient descent without intercept, step ``alpha / (n sqrt(i + 1))``."""
    m = train if isinstance(train, Moments) else moments(train)
    w, errors = np.zeros(m.d), []
    for i in range(iterations):
        errors.append(m.rmse(w))
        w = w - alpha / (m.n * np.sqrt(i + 1)) * m.gradient(np.append(w, 0.0))[:-1]
    return LinearModel(w, 0.0, errors)


def linreg_sgd(
    train: DataFrame | Moments,
    iterations: int = 100,
    step: float = 1.0,
    reg: float = 0.0,
    fraction: float = 1.0,
    key: str | None = None,
    seed: int = 42,
) -> LinearModel:
    """Gradient descent with L2 shrinkage and an intercept.

    Follows the update rule of Spark's ``LinearRegressionWithSGD``: mean gradient, step
    ``step / sqrt(i)``, intercept started at 1 and shrunk with the weights; no early stop.
    A ``fraction`` below 1 draws rows anew for each iteration by a hash of ``key``; an
    iteration that draws none changes nothing. All iterations together take one pass.
    """
    sampled = fraction < 1.0
    if sampled and (key is None or isinstance(train, Moments)):
        raise ValueError("mini-batches need rows with a key")
    if sampled:
        drawn = batch_moments(train, iterations, fraction, key, seed)
        if not drawn:
            raise ValueError("no iteration draws a row")
    else:
        drawn = dict.fromkeys(range(1, iterations + 1), train if isinstance(train, Moments) else moments(train))
    w = np.append(np.zeros(next(iter(drawn.values())).d), 1.0)
    errors = []
    for i, m in sorted(drawn.items()):
        errors.append(m.rmse(w[:-1], w[-1]))
        rate = step / np.sqrt(i)
        w = w * (1 - rate * reg) - rate * m.gradient(w) / m.n
    return LinearModel(w[:-1], float(w[-1]), errors)


def grid_search(
    train: DataFrame, validation: DataFrame, grid: Iterable[dict]
) -> tuple[LinearModel, DataFrame]:
    """Fits a model per setting of ``linreg_sgd`` and keeps the best on validation data.

    Two passes over data in all, whatever the size of the grid. Returns the best model and
    a table ``setting, rmse``.
    """
    fit_on, judge_on = moments(train), moments(validation)
    tried = []
    for setting in grid:
        model = linreg_sgd(fit_on, **setting)
        tried.append((setting, model, judge_on.rmse(model.weights, model.intercept)))
    best = min(tried, key=lambda t: t[2] if np.isfinite(t[2]) else np.inf)
    rows = [(", ".join(f"{k}={v:g}" for k, v in s.items()), float(e)) for s, _, e in tried]
    return best[1], train.sparkSession.createDataFrame(rows, "setting string, rmse double")


def with_interactions(df: DataFrame) -> DataFrame:
    return df.withColumn("features", two_way_interactions(F.col("features")))


def linreg_interactions(train: DataFrame, parts: dict[str, DataFrame], **setting) -> tuple[LinearModel, DataFrame]:
    """Fits on two-way interactions; returns the model and ``part, rmse``."""
    model = linreg_sgd(with_interactions(train), **setting)
    rows = [
        (name, moments(with_interactions(df)).rmse(model.weights, model.intercept)) for name, df in parts.items()
    ]
    return model, train.sparkSession.createDataFrame(rows, "part string, rmse double")
