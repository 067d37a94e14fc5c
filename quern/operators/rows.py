"""Rows from arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(value: Column) -> Column:
    """``value`` as a generated column, computed once however often later columns name it."""
    return F.explode(F.array(value))


def exploded(df: DataFrame, *keep: str | Column, **array: Column) -> DataFrame:
    """One row per element of an array expression, ``name=array``; other columns are listed.

    An inner explode makes Spark filter on the size of the array first, which computes the
    expression twice, and even in front of a shuffle. Null elements are dropped.
    """
    ((name, values),) = array.items()
    return df.select(*keep, F.explode_outer(values).alias(name)).filter(F.col(name).isNotNull())
