"""One-hot and hashed features of categorical points.

A point is a row with an id and ``features: array<struct<feature int, value string>>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.hashing import md5_bucket
from quern.functions.maths import sigmoid_clipped
from quern.functions.vectors import bind
from quern.operators.joins import lookup_join
from quern.operators.ordering import zip_with_index
from quern.operators.rows import exploded


def _pairs(points: DataFrame, *keep: str) -> DataFrame:
    value = F.coalesce("f.value", F.lit("")).alias("value")
    return exploded(points, *keep, f=F.col("features")).select(*keep, "f.feature", value)


def one_hot_dict(points: DataFrame) -> DataFrame:
    """Each distinct (feature, value) with an ``idx`` from 0, ordered by feature then value."""
    pairs = _pairs(points).distinct()
    return zip_with_index(pairs, ["feature", "value"], "idx")


def one_hot_encode(points: DataFrame, dictionary: DataFrame, id_col: str) -> DataFrame:
    """Sorted indices of each point's features, all with value 1; unseen ones are ignored.

    A null category is the empty one. Frequent categories are cut into several tasks by
    adaptive execution. A point's own list is bounded by its features.
    """
    rest = [c for c in points.columns if c != "features"]
    value = F.coalesce("f.value", F.lit("")).alias("value")
    each = points.select(*rest, F.explode_outer("features").alias("f")).select(*rest, "f.feature", value)
    found = lookup_join(each, dictionary, ["feature", "value"], "left")
    indices = F.array_sort(F.collect_set("idx")).alias("idx")
    return found.groupBy(id_col).agg(*[F.any_value(c).alias(c) for c in rest if c != id_col], indices).select(*rest, "idx")


def hash_features(features: Column, buckets: int) -> Column:
    """Map from bucket to count for one point, without leaving the row.

    Features are told apart by the text ``value`` + ``feature`` alone; equal texts count once,
    a null category is the empty one.
    """
    names = F.array_distinct(
        F.transform(features, lambda f: F.concat(F.coalesce(f["value"], F.lit("")), f["feature"].cast("string")))
    )

    def counts(hashed: Column) -> Column:
        distinct = F.array_distinct(hashed)
        each = F.transform(distinct, lambda b: F.size(F.filter(hashed, lambda h: h == b)).cast("double"))
        return F.map_from_arrays(distinct, each)

    return bind(F.array_sort(F.transform(names, lambda s: md5_bucket(s, buckets))), counts)


def sparsity(df: DataFrame, non_zeros: Column, dimensions: Column | int) -> DataFrame:
    """Mean number of non-zero entries over the number of dimensions."""
    return df.agg((F.avg(non_zeros) / dimensions).alias("sparsity"))


def predict_proba(points: DataFrame, weights: DataFrame, intercept: float, id_col: str) -> DataFrame:
    """Probability per point from ``idx`` lists and a weight table ``idx, w``."""
    each = exploded(points.withColumnRenamed("idx", "_i"), id_col, idx=F.col("_i"))
    scores = (
        lookup_join(each, weights, "idx")
        .groupBy(id_col)
        .agg(F.sum("w").alias("_raw"))
    )
    raw = F.coalesce(F.col("_raw"), F.lit(0.0)) + F.lit(float(intercept))
    return points.join(scores, id_col, "left").withColumn("p", sigmoid_clipped(raw)).drop("_raw")
