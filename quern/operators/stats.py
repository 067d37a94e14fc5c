"""Descriptive statistics of amounts and vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from quern.operators.ordering import quantile_sketch, running_totals, values_at_ranks
from quern.session import stable


def mean_median(df: DataFrame, value: str) -> DataFrame:
    """Mean and exact median; nulls are left out, NaN is the largest value and makes the mean NaN.

    Two scans: a sketch that also takes the mean brackets the median, and counts inside the
    bracket find it (``values_at_ranks``); no aggregation buffer gathers all values.
    """
    spark = df.sparkSession
    schema = "mean double, median double"
    sketch = quantile_sketch(df, value, total=F.count(value), mean=F.avg(value))
    if not sketch.total:
        return spark.createDataFrame([(None, None)], schema)
    middle = values_at_ranks(df, value, [(sketch.total - 1) // 2, sketch.total // 2], sketch=sketch)
    median = middle[0] if middle[0] == middle[1] else (middle[0] + middle[1]) / 2
    return spark.createDataFrame([(float(sketch.mean), float(median))], schema)


def _beta_fraction(a: float, b: float, x: float) -> float:
    # Continued fraction of the incomplete beta function, evaluated from the tail.
    terms = 400
    value = 1.0
    for m in range(terms, 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = 1.0 + even / (1.0 + odd / value)
    return 1.0 / (1.0 - (a + b) * x / (a + 1) / value)


def student_t_two_sided(t: float, dof: float) -> float:
    """P(|T| >= |t|) of Student's t; 0 where it is below the range of doubles."""
    x = dof / (dof + t * t)
    a, b = dof / 2, 0.5

    def part(a: float, b: float, x: float, log_rest: float) -> float:
        log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * log_rest
        return math.exp(log_front) * _beta_fraction(a, b, x) / a

    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x < (a + 1) / (a + b + 2):
        return part(a, b, x, math.log1p(-x))
    return 1.0 - part(b, a, 1 - x, math.log(x))


def welch_t_test(df: DataFrame, group: str, value: str) -> DataFrame:
    """Two-sided t test of two groups with unequal variances: ``t, df, p``.

    Groups are taken in ascending order. One aggregation yields two rows; the test itself
    works on those.
    """
    stats = (
        df.filter(F.col(value).isNotNull())
        .groupBy(group)
        .agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))
        .orderBy(group)
        .take(3)
    )
    if len(stats) != 2:
        raise ValueError("the test needs exactly two groups")
    first, second = stats
    e1, e2 = first["var"] / first["n"], second["var"] / second["n"]
    t = (first["mean"] - second["mean"]) / math.sqrt(e1 + e2)
    dof = (e1 + e2) ** 2 / (e1**2 / (first["n"] - 1) + e2**2 / (second["n"] - 1))
    row = (float(t), float(dof), student_t_two_sided(t, dof))
    return df.sparkSession.createDataFrame([row], "t double, df double, p double")


def roc_curve(df: DataFrame, score: str, truth: str, bins: int | None = None) -> DataFrame:
    """One point per distinct score, best first: running counts and both rates.

    Rows are counted per score first, and the running sums go over range partitions. A rate
    is null if no row is of its class. For scores that hardly repeat, ``bins`` keeps about as
    many points of the same curve, at scores with equal numbers of rows between them; null
    scores are then left out. ``roc_area`` tells how far its area may be off.
    """
    if bins is None:
        per_score = df.groupBy(F.col(score).alias("score")).agg(
            F.sum(F.col(truth).cast("bigint")).alias("_pos"), F.count("*").alias("_n")
        )
    else:
        per_score = _counts_at(df.filter(F.col(score).isNotNull()), score, truth, bins)
    per_score = per_score.withColumn("_neg", F.col("_n") - F.col("_pos")).drop("_n").withColumnRenamed("_pos", "_hit")
    curve = running_totals(per_score, [F.desc("score")], {"tp": "_hit", "fp": "_neg"})
    positives, negatives = curve.agg(F.max("tp")).scalar(), curve.agg(F.max("fp")).scalar()
    return curve.select(
        "score", "tp", "fp",
        F.try_divide(F.col("tp"), positives).alias("tpr"), F.try_divide(F.col("fp"), negatives).alias("fpr"),
    )


def _counts_at(df: DataFrame, score: str, truth: str, bins: int) -> DataFrame:
    """``score, _pos, _n``: rows counted at the largest of about ``bins`` cut points they reach.

    Cut points are the scores at equal steps of rank, found in two scans; a third counts.
    """
    sketch = quantile_sketch(df, score)
    n = sketch.below + sketch.n + sketch.above + sketch.nan
    found = values_at_ranks(df, score, [i * n // bins for i in range(bins)], sketch=sketch) if n else []
    cuts = np.unique(np.array(found))  # NaN last, as in Spark's order

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, rows = np.zeros(len(cuts)), np.zeros(len(cuts), np.int64)
        for batch in batches:
            at = np.searchsorted(cuts, batch.column(0).to_numpy(zero_copy_only=False), "right") - 1
            rows += np.bincount(at, minlength=len(cuts))
            hits += np.bincount(at, weights=batch.column(1).to_numpy(zero_copy_only=False), minlength=len(cuts))
        some = np.flatnonzero(rows)
        yield pa.record_batch({"score": pa.array(cuts[some]), "_pos": pa.array(hits[some].astype(np.int64)), "_n": pa.array(rows[some])})

    kind = "bigint" if cuts.dtype.kind == "i" else "double"
    rows = df.select(F.col(score).cast(kind), F.coalesce(F.col(truth).cast("bigint"), F.lit(0)))
    parts = rows.mapInArrow(count, f"score {kind}, _pos bigint, _n bigint")
    return parts.groupBy("score").agg(F.sum("_pos").alias("_pos"), F.sum("_n").alias("_n"))


def roc_area(curve: DataFrame) -> DataFrame:
    """One row ``area, error``: the area under a curve of ``roc_curve``, and the most it can differ from that of all scores.

    Between two points of a binned curve the rows may come in any order, so their part of the
    area is known up to half the rectangle between the points.
    """
    steps = running_totals(curve.withColumn("_one", F.lit(1)), [F.desc("score")], {"_at": "_one"})
    after = stable(steps.select("_at", "tpr", "fpr"))
    before = after.select((F.col("_at") + 1).alias("_at"), F.col("tpr").alias("_t"), F.col("fpr").alias("_f"))
    both = after.join(before, "_at", "left").na.fill(0.0, ["_t", "_f"])
    up, along = F.col("tpr") - F.col("_t"), F.col("fpr") - F.col("_f")
    return both.agg(
        F.sum(along * (F.col("tpr") + F.col("_t")) / 2).alias("area"), F.sum(up * along / 2).alias("error")
    )


def vector_mean(df: DataFrame, col: str) -> DataFrame:
    """Element-wise mean as rows ``pos, mean``."""
    mean = df.select(array_to_vector(F.col(col)).alias("v")).agg(Summarizer.mean(F.col("v")).alias("m"))
    return mean.select(F.posexplode(vector_to_array("m")).alias("pos", "mean"))


def vector_sum(df: DataFrame, col: str) -> DataFrame:
    """Element-wise sum as rows ``pos, total``."""
    total = df.select(array_to_vector(F.col(col)).alias("v")).agg(Summarizer.sum(F.col("v")).alias("s"))
    return total.select(F.posexplode(vector_to_array("s")).alias("pos", "total"))


def array_min_max(df: DataFrame, col: str) -> DataFrame:
    """Smallest and largest element over all arrays, in one pass."""
    return df.agg(F.min(F.array_min(col)).alias("min"), F.max(F.array_max(col)).alias("max"))


def dense_rows(column) -> np.ndarray:
    """An Arrow list column as a 2-D array; null lists, null elements and unequal lengths are refused."""
    lengths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False)) if len(column) else np.zeros(1)
    if column.null_count or column.flatten().null_count or len(lengths) > 1:
        raise ValueError("vectors must be of one length, without nulls")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    return flat.reshape(len(column), -1)


def cross_products(df: DataFrame, col: str, centre: np.ndarray | None = None) -> DataFrame:
    """Sum of outer products of the vectors in ``col`` as rows ``i, j, v``.

    Each task folds its batches with one matrix product and hands on one matrix; Spark
    adds those up by cell.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = dense_rows(batch.column(0))
            if centre is not None:
                x = x - centre
            gram = x.T @ x
            total = gram if total is None else total + gram
        if total is not None:
            d = len(total)
            yield pa.record_batch(
                {
                    "i": pa.array(np.repeat(np.arange(d, dtype="int32"), d)),
                    "j": pa.array(np.tile(np.arange(d, dtype="int32"), d)),
                    "v": pa.array(total.ravel()),
                }
            )

    parts = df.select(F.col(col).cast("array<double>").alias("v")).mapInArrow(fold, "i int, j int, v double")
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v"))


def covariance_matrix(df: DataFrame, col: str) -> DataFrame:
    """Population covariance as rows ``i, j, cov``: mean first, then centred products."""
    vectors = df.select(F.col(col).cast("array<double>").alias("v"))
    n, mean = vectors.select(array_to_vector(F.col("v")).alias("v")).agg(
        F.count("v"), Summarizer.mean(F.col("v"))
    ).first()
    return cross_products(vectors, "v", np.asarray(mean.toArray())).select(
        "i", "j", (F.col("v") / n).alias("cov")
    )
