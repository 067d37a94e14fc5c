"""Grouped counts, sums and shares. All combine on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quern.operators.rows import exploded


def count_by_key(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def having_min_count(df: DataFrame, key: str, n: int) -> DataFrame:
    """Keys with more than ``n`` rows."""
    return count_by_key(df, key).filter(F.col("n") > n)


def count_mean_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))


def min_max_avg(df: DataFrame, value: str) -> DataFrame:
    """Smallest, largest and floored mean of integer sizes, in one pass."""
    v = F.col(value).cast("bigint")
    mean = F.floor(F.sum(v).cast("decimal(38,0)") / F.count(v))
    return df.agg(F.min(v).alias("min"), F.max(v).alias("max"), mean.cast("bigint").alias("avg"))


def fraction_of_total(df: DataFrame, key: str) -> DataFrame:
    """Count of each group and its share of all rows."""
    total = df.agg(F.count("*")).scalar()
    return count_by_key(df, key).withColumn("fraction", F.col("n") / total)


def mean_count_per_unique(df: DataFrame, col: str) -> DataFrame:
    """Rows, distinct values and rows per value, rounded to 2 digits."""
    per_value = df.groupBy(col).agg(F.count("*").alias("n"))
    return per_value.agg(
        F.sum("n").alias("total"),
        F.count("*").alias("uniques"),
        F.round(F.sum("n") / F.count("*"), 2).alias("mean_count"),
    )


def count_distinct_by_key(df: DataFrame, key: Column | str, value: str) -> DataFrame:
    """Distinct values per key: duplicates go before any key is brought together."""
    k = F.col(key) if isinstance(key, str) else key
    return (
        df.select(k.alias("key"), value)
        .distinct()
        .groupBy("key")
        .agg(F.count(value).alias("uniques"))
    )


def avg_rows_per_unique_by_key(df: DataFrame, key: Column, value: str) -> DataFrame:
    """Per key: rows divided by distinct values, floored.

    Counting per (key, value) first keeps a key with most of the rows spread out.
    """
    per_pair = df.groupBy(key.alias("key"), value).agg(F.count("*").alias("_n"))
    return per_pair.groupBy("key").agg(F.floor(F.sum("_n") / F.count(value)).alias("avg_rows"))


def top_k_by_count(df: DataFrame, key: str, k: int, where: Column | None = None) -> DataFrame:
    """The ``k`` most frequent keys of the rows that pass ``where``; ties by key."""
    rows = df if where is None else df.filter(where)
    return count_by_key(rows, key).orderBy(F.desc("n"), key).limit(k)


def top_k_by_sum(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias("total")).orderBy(F.desc("total"), key).limit(k)


def top_k_per_group(df: DataFrame, group: str, key: str, amount: str, k: int) -> DataFrame:
    """The ``k`` rows with the largest amount of each group.

    The rank filter lets Spark cut every group to ``k`` rows before the shuffle.
    """
    rank = F.row_number().over(W.partitionBy(group).orderBy(F.desc(amount), key))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def argmax_row(df: DataFrame, measure: Column, tie: str) -> DataFrame:
    return df.withColumn("measure", measure).orderBy(F.desc("measure"), tie).limit(1)


def histogram_fixed(df: DataFrame, value: str, bins: int) -> DataFrame:
    """``bins`` equal-width bins from the smallest to the largest value, empty bins left out."""
    low, high = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    width = (F.col("_high") - F.col("_low")) / bins
    bin_of = F.when(
        F.col("_high") > F.col("_low"), F.least(F.floor((F.col(value) - F.col("_low")) / width), F.lit(bins - 1))
    ).otherwise(F.lit(0))
    return (
        df.select(value, low.alias("_low"), high.alias("_high"))
        .filter(F.col(value).isNotNull())
        .groupBy(bin_of.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def histogram_pow2(counts: DataFrame, count_col: str) -> DataFrame:
    """Keys per bucket, the least power of two not below their count, whatever that is."""
    n = F.col(count_col).cast("bigint")
    bits = F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)  # of n - 1
    power = F.pow(F.lit(2.0), bits).cast("bigint")  # exact for a double
    return counts.filter(n.isNotNull()).groupBy(power.alias("bucket")).agg(F.count("*").alias("keys"))


def reduce_product(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.product(value).alias("product"))


def category_counts(points: DataFrame) -> DataFrame:
    """Distinct values of each feature of ``features: array<(feature, value)>``."""
    pairs = exploded(points, f=F.col("features")).select("f.feature", "f.value")
    return pairs.distinct().groupBy("feature").agg(F.count("*").alias("categories"))


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Appends tables by column name and keeps duplicates."""
    for other in others:
        first = first.unionByName(other)
    return first


def histogram_by(df: DataFrame, bucket: Column, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per value of a bucket expression (hour, weekday, day), in order."""
    return df.groupBy(*keys, bucket.alias(name)).agg(F.count("*").alias("n")).orderBy(*keys, name)
