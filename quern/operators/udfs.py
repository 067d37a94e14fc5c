"""User functions: per partition, per row and as aggregates."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T


def map_partitions(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``fn`` maps the batches (pandas frames) of one partition to result batches."""
    return df.mapInPandas(fn, schema)


def map_partitions_with_index(df: DataFrame, fn: Callable[[int, Iterator], Iterator], schema: str) -> DataFrame:
    """The same with the number of the partition as first argument."""
    return df.mapInPandas(_Indexed(fn), schema)


class _Indexed:
    def __init__(self, fn: Callable):
        self.fn = fn

    def __call__(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        return self.fn(TaskContext.get().partitionId(), batches)


def custom_aggregate(
    df: DataFrame,
    zero: Callable[[], object],
    add: Callable[[object, pd.DataFrame], object],
    merge: Callable[[object, object], object],
    finish: Callable[[object], pd.DataFrame],
    schema: str | T.StructType,
) -> DataFrame:
    """Folds all rows with user code: ``add`` a batch to a state, ``merge`` two states.

    Each task folds its own rows and hands on one state. States are merged in two rounds,
    first by about the square root of the number of partitions, then by one task, so
    neither rows nor all states gather in one place.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = zero()
        for batch in batches:
            state = add(state, batch)
        yield pd.DataFrame({"state": [pickle.dumps(state)]})

    def combine(batches: Iterator[pd.DataFrame]) -> object:
        state = zero()
        for batch in batches:
            for other in batch["state"]:
                state = merge(state, pickle.loads(other))
        return state

    def middle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"state": [pickle.dumps(combine(batches))]})

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield finish(combine(batches))

    partials = df.mapInPandas(fold, "state binary")
    width = max(2, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    merged = partials.repartition(width, F.xxhash64("state")).mapInPandas(middle, "state binary")
    return merged.repartition(1).mapInPandas(last, schema)
