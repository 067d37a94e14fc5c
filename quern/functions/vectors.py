"""Vectors and series as ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def doubles(c: Column) -> Column:
    return c.cast("array<double>")


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value computed once per row, also where ``fn`` uses it in lambdas."""
    return F.transform(F.array(value), fn)[0]


def array_sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def vec_scale(c: Column, k) -> Column:
    return F.transform(c, lambda x: x * F.lit(k))


def vec_mul(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def vec_dot(a: Column, b: Column) -> Column:
    return array_sum(vec_mul(a, b))


def vec_slice(c: Column, n: int) -> Column:
    """The last ``n`` elements."""
    return F.slice(c, -n, n)


def vec_concat(a: Column, b: Column) -> Column:
    return F.concat(a, b)


def series_mean(c: Column) -> Column:
    return array_sum(c) / F.size(c)


def series_std(c: Column) -> Column:
    """Population standard deviation of one series."""

    def around(mean: Column) -> Column:
        return array_sum(F.transform(c, lambda x: (x - mean) * (x - mean)))

    return F.sqrt(bind(series_mean(c), around) / F.size(c))


def rescale_series(c: Column) -> Column:
    """Change relative to the mean of the series."""
    return bind(c, lambda s: bind(series_mean(s), lambda mean: F.transform(s, lambda x: (x - mean) / mean)))


def fold_by_period(c: Column, period: int) -> Column:
    """Sum of the elements whose positions agree modulo ``period``."""

    def fold(s: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(period - 1)),
            lambda phase: array_sum(F.filter(s, lambda _, i: i % period == phase)),
        )

    return bind(c, fold)


def fold_by_block(c: Column, length: int) -> Column:
    """Sums of consecutive blocks of ``length`` elements."""

    def fold(s: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), (F.size(s) / length).cast("int") - 1),
            lambda block: array_sum(F.slice(s, block * length + 1, length)),
        )

    return bind(c, fold)


def apply_matrix(c: Column, matrix: Sequence[Sequence[float]]) -> Column:
    """A small fixed matrix times the vector of each row."""
    return bind(c, lambda v: F.array(*[vec_dot(literal_vector(row), v) for row in matrix]))


def two_way_interactions(c: Column) -> Column:
    """The features, then all their products row by row."""
    products = F.transform(c, lambda a: F.transform(c, lambda b: a * b))
    return F.concat(c, F.flatten(products))
