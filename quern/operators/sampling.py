"""Splits and samples that depend on row keys alone, not on partitions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F, types as T

from quern.functions.hashing import hash_text, unit_hash
from quern.operators.joins import lookup_join
from quern.operators.ordering import value_at_rank, values_at_ranks, zip_with_index


def with_split(df: DataFrame, key: str, weights: Sequence[float], seed: int) -> DataFrame:
    """Adds ``split``, the number of the part a row belongs to, from a hash of its key."""
    cuts = [w / sum(weights) for w in accumulate(weights)][:-1]
    draw = unit_hash(F.col(key), seed)
    split = F.lit(len(cuts))
    for i, cut in reversed(list(enumerate(cuts))):
        split = F.when(F.col("_u") < cut, i).otherwise(split)
    return df.withColumn("_u", draw).withColumn("split", split).drop("_u")


def random_split(df: DataFrame, key: str, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Disjoint parts that together hold every row."""
    tagged = with_split(df, key, weights, seed)
    return [tagged.filter(F.col("split") == i).drop("split") for i in range(len(weights))]


def take_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows if there are fewer).

    The draw of the n-th row is found by counting, and the sample is a filter; only rows
    that tie with it, about one in four billion, are ordered.
    """
    draw = unit_hash(F.col(key), seed)
    cut = value_at_rank(df.select(draw.alias("u")), "u", n - 1) if n > 0 else 0.0
    if cut is None:
        return df
    below = df.filter(draw < F.lit(cut))
    ties = df.filter(draw == F.lit(cut)).orderBy(hash_text(F.col(key), seed), key)
    return below.unionAll(ties.limit(n - below.count()))


def take_sample_replace(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` draws with replacement: ``draw`` numbers them, other columns are the row drawn.

    Rows are drawn by their place in the order of ``key``, which is unique. The keys at all
    drawn places are located together in two scans (``values_at_ranks``), so whole integers
    and doubles are neither sorted nor shuffled; keys of other types are numbered first.
    """
    total = df.agg(F.count(key)).first()[0]
    spark = df.sparkSession
    places = spark.range(n).select(
        F.col("id").alias("draw"), F.least(F.floor(unit_hash(F.col("id"), seed) * total), F.lit(total - 1)).alias("_at")
    )
    if not isinstance(df.schema[key].dataType, (T.IntegralType, T.FloatType, T.DoubleType)):
        # draws are spread evenly over the rows, so the join has no frequent key
        return zip_with_index(df.filter(F.col(key).isNotNull()), [key], "_at").join(places, "_at").drop("_at")
    drawn = [(r.draw, r._at) for r in places.collect()] if total else []  # n rows, as many as the caller asked for
    keys = values_at_ranks(df, key, [at for _, at in drawn])
    rows = [(draw, k) for (draw, _), k in zip(drawn, keys)]
    found = spark.createDataFrame(rows, T.StructType([T.StructField("draw", T.LongType()), T.StructField(key, _kind(df, key))]))
    return lookup_join(df, found, key).select("draw", *df.columns)


def _kind(df: DataFrame, key: str) -> T.DataType:
    return T.LongType() if isinstance(df.schema[key].dataType, T.IntegralType) else T.DoubleType()
