"""Word counts and TF-IDF weights in long form ``(id, token, value)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from quern.functions.text import remove_punctuation, split_words
from quern.operators.joins import lookup_join
from quern.operators.rows import exploded
from quern.session import stable


def lines_of(df: DataFrame, col: str) -> DataFrame:
    """One row ``value`` per line of a text column."""
    return exploded(df, value=F.split(F.col(col), "\n", -1))


def drop_empty(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) != "")


def words(lines: DataFrame, col: str = "value") -> DataFrame:
    """Cleaned, non-empty words, one per row."""
    return drop_empty(exploded(lines, word=split_words(remove_punctuation(F.col(col)))), "word")


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    return words(lines, col).groupBy("word").agg(F.count("*").alias("n"))


def drop_stop_words(tokens: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Removes listed tokens; the list is a table with column ``token`` of any length."""
    return lookup_join(tokens, stop_words, "token", "left_anti")


def token_total(df: DataFrame, tokens: Column) -> DataFrame:
    return df.agg(F.coalesce(F.sum(F.size(tokens)), F.lit(0)).cast("bigint").alias("tokens"))


TASK_BYTES = 16 << 20


def _dealt(df: DataFrame, id_col: str) -> DataFrame:
    """Rows dealt out by id to so many tasks that each gets about ``TASK_BYTES`` of text, however much there is."""
    sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType == T.StringType()]
    if not sizes:
        return df.repartition(F.col(id_col))
    total = df.agg(F.sum(sum(sizes, F.lit(0)).cast("bigint"))).first()[0] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES)), F.col(id_col))


def term_frequency(df: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    """Share of each token among the tokens of its record: ``id, token, tf``.

    The texts are dealt out by id before they are split: they are smaller than their
    tokens, and neither the count nor a later step per id has to shuffle again. A task's
    table of counts is many times its texts, so their size decides on the number of tasks.
    """
    listed = _dealt(df, id_col).select(F.col(id_col).alias("id"), tokens.alias("_t"))
    each = exploded(listed, "id", F.size("_t").alias("_size"), token=F.col("_t"))
    counted = each.groupBy("id", "token", "_size").agg(F.count("*").alias("_n"))
    return counted.select("id", "token", (F.col("_n") / F.col("_size")).alias("tf"))


def record_tokens(df: DataFrame, tokens: Column) -> DataFrame:
    """Each token once per record that has it, as column ``token``."""
    return exploded(df, token=F.array_distinct(tokens))


def idf(df: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    """``N / n(token)`` without logarithm: distinct ids over records with the token."""
    n = df.agg(F.count_distinct(id_col)).scalar()
    return record_tokens(df, tokens).groupBy("token").agg((n / F.count("*")).alias("idf"))


def inverse_frequency(tf: DataFrame, n: Column | int) -> DataFrame:
    """``token, idf`` from a table with one row per record and token, as ``term_frequency`` gives for unique ids."""
    return tf.groupBy("token").agg((n / F.count("*")).alias("idf"))


def tfidf(df: DataFrame, id_col: str, tokens: Column, idfs: DataFrame | None = None) -> DataFrame:
    """Weights ``id, token, weight``; tokens missing from ``idfs`` have no weight.

    Texts are split once: the frequencies are written, and the IDF is counted from them. The
    IDF table is written too, so that Spark knows its size and can cut the rows of a frequent
    token into several tasks. Pass a stored table as ``idfs``.
    """
    tf = term_frequency(df, id_col, tokens)
    if idfs is None:
        tf = stable(tf)
        idfs = stable(inverse_frequency(tf, df.agg(F.count_distinct(id_col)).scalar()))
    joined = lookup_join(tf, idfs, "token")
    return joined.select("id", "token", (F.col("tf") * F.col("idf")).alias("weight"))


def doc_norms(weights: DataFrame) -> DataFrame:
    return weights.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))


def unit_weights(weights: DataFrame) -> DataFrame:
    """Weights divided by the norm of their record; a window is bounded by one record."""
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(W.partitionBy("id")))
    return weights.withColumn("weight", F.col("weight") / norm)


def inverted_index(weights: DataFrame) -> DataFrame:
    return weights.select("token", "id")
